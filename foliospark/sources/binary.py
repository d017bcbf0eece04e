"""Binary files: format sniffing, office documents, archives, tables and XML, profiled in Arrow batches.

Every reader is a step of ``mapInPandas`` over ``binaryFile`` rows that
catches errors into a column; what can be aggregated is left to Spark.
"""

from __future__ import annotations

import csv
import io
import re
import time
import zipfile
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
PAGES = "path string, sha256 string, engine string, page_basis string, seconds double, error string, page_number int, text string"


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).withColumn("sha256", F.sha2("content", 256))


def sniff(content: bytes) -> str:
    """Format by magic bytes; labels and extensions are not trusted."""
    if content[:4] == b"%PDF":
        return "PDF"
    if content[:4] == b"\xd0\xcf\x11\xe0":
        return "OLE"
    if content[:2] == b"PK":
        try:
            names = zipfile.ZipFile(io.BytesIO(content)).namelist()
        except zipfile.BadZipFile:
            return "UNKNOWN"
        for prefix, kind in (("word/", "DOCX"), ("ppt/", "PPTX"), ("xl/", "XLSX")):
            if any(n.startswith(prefix) for n in names):
                return kind
        return "ZIP"
    return "UNKNOWN"


@F.pandas_udf(StringType())
def sniff_format(content: pd.Series) -> pd.Series:
    return content.map(lambda c: sniff(bytes(c)) if c is not None else "UNKNOWN")


def _paragraph(node) -> list[str]:
    """Text of a paragraph; a hard page break starts a new part."""
    parts = [""]
    for x in node.iter():
        if x.tag == f"{W}t":
            parts[-1] += x.text or ""
        elif x.tag == f"{W}tab":
            parts[-1] += "\t"
        elif x.tag == f"{W}br":
            if x.get(f"{W}type") == "page":
                parts.append("")
            else:
                parts[-1] += "\n"
    return parts


def _table(node) -> str:
    """Rows joined by bars; cells that continue a vertical merge are left out."""
    lines = []
    for row in node.findall(f"{W}tr"):
        cells = []
        for cell in row.findall(f"{W}tc"):
            merge = cell.find(f"{W}tcPr/{W}vMerge")
            if merge is not None and merge.get(f"{W}val") != "restart":
                continue
            cells.append(" ".join(" ".join(_paragraph(p)) for p in cell.iter(f"{W}p")).strip())
        lines.append("| " + " | ".join(cells) + " |")
    return "\n".join(lines)


def docx_pages(content: bytes) -> list[str]:
    """Pages in body order, cut at hard page breaks; headers, footers and notes once each at the end."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        pages: list[list[str]] = [[]]
        for node in ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body"):
            if node.tag == f"{W}tbl":
                pages[-1].append(_table(node))
            elif node.tag == f"{W}p":
                parts = _paragraph(node)
                pages[-1].append(parts[0])
                for extra in parts[1:]:
                    pages.append([extra])
        seen: set[str] = set()
        for kind in ("header", "footer", "footnotes", "endnotes", "comments"):
            for n in sorted(x for x in names if re.fullmatch(rf"word/{kind}\d*\.xml", x)):
                text = "\n".join("".join(_paragraph(p)) for p in ElementTree.fromstring(z.read(n)).iter(f"{W}p")).strip()
                if text and text not in seen:
                    seen.add(text)
                    pages[-1].append(f"## {kind}\n{text}")
    return ["\n".join(x for x in p if x).strip() for p in pages]


def pptx_pages(content: bytes) -> list[str]:
    """One page for each slide: paragraphs and tables in shape order, notes at the end."""

    def paragraphs(node) -> str:
        return "\n".join("".join(t.text or "" for t in p.iter(f"{A}t")) for p in node.iter(f"{A}p")).strip()

    def shapes(node) -> list[str]:
        out = []
        for child in node:
            if child.tag.endswith("}grpSp"):
                out += shapes(child)
            elif child.tag.endswith("}graphicFrame"):
                for row in child.iter(f"{A}tr"):
                    out.append("| " + " | ".join(" ".join(paragraphs(c).split()) for c in row.iter(f"{A}tc")) + " |")
            elif child.tag.endswith("}sp"):
                out.append(paragraphs(child))
        return out

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        slides = sorted((n for n in names if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        out = []
        for n in slides:
            root = ElementTree.fromstring(z.read(n))
            tree = next((e for e in root.iter() if e.tag.endswith("}spTree")), None)
            text = paragraphs(root) if tree is None else "\n".join(x for x in shapes(tree) if x)
            notes = n.replace("slides/slide", "notesSlides/notesSlide")
            spoken = paragraphs(ElementTree.fromstring(z.read(notes))) if notes in names else ""
            out.append(text + (f"\n\n## notes\n{spoken}" if spoken else ""))
    return out


def docx_runs(content: bytes) -> list[str]:
    """The text of a DOCX whose body is no well-formed XML: its runs in order, one pseudo-page."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = z.read("word/document.xml").decode("utf-8", "replace")
    paragraphs = ["".join(unescape(t) for t in re.findall(r"<w:t(?:\s[^>]*)?>([^<]*)</w:t>", p)) for p in re.split(r"</w:p>", body)]
    found = "\n".join(p for p in paragraphs if p.strip())
    if not found:
        raise ValueError("no text runs")
    return [found]


def printable_runs(content: bytes) -> list[str]:
    """Readable runs of a legacy container: 20 bytes or more, mostly ASCII, ten letters at least, in order."""
    out = []
    for run in re.findall(rb"[\x09\x0a\x0d\x20-\x7e\xa0-\xff]{20,}", content):
        ascii_share = sum(b < 128 for b in run) / len(run)
        if ascii_share >= 0.9 and len(re.findall(rb"[A-Za-z]", run)) >= 10:
            out.append(run.decode("latin-1").strip())
    return ["\n".join(out)]


CONVERTERS: dict[str, tuple[str, str, Callable[[bytes], list[str]]]] = {
    "DOCX": ("ooxml-body", "explicit-page-break", docx_pages),
    "PPTX": ("ooxml-slides", "slide", pptx_pages),
    "OLE": ("printable-runs", "single-pseudo-page", printable_runs),
}


#: Engines that a format falls back to, in the shape of CONVERTERS.
FALLBACKS: dict[str, tuple[str, str, Callable[[bytes], list[str]]]] = {"DOCX": ("text-runs", "single-pseudo-page", docx_runs)}


def convert(files: DataFrame, converters: dict = CONVERTERS, fallbacks: dict = FALLBACKS) -> DataFrame:
    """One row for each page of each file, or one with an error; engines for other formats can be passed in.

    Where an engine fails, the format's fallback is tried; if that fails too, the row names both errors.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, sha, content in zip(frame.path, frame.sha256, frame.content):
                kind, began = sniff(bytes(content)), time.perf_counter()
                errors = []
                for engine, basis, f in [e for e in (converters.get(kind), fallbacks.get(kind)) if e] or [("none", "none", None)]:
                    try:
                        if f is None:
                            raise ValueError(f"no engine for {kind}")
                        pages = f(bytes(content))
                        rows += [(path, sha, engine, basis, time.perf_counter() - began, None, i + 1, p) for i, p in enumerate(pages)]
                        break
                    except Exception as e:  # noqa: BLE001 - the error is the row's result
                        errors.append(f"{type(e).__name__}: {e}" if not errors else f"{engine}: {type(e).__name__}: {e}")
                else:
                    rows.append((path, sha, engine, basis, time.perf_counter() - began, "; ".join(errors), None, None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGES.split(", ")]).astype({"page_number": "Int32"})

    return files.select("path", "sha256", "content").mapInPandas(run, PAGES)


def zip_members(files: DataFrame) -> DataFrame:
    """One row for each member of each archive: name, suffix, bytes and the target namespace of schemas."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame.path, frame.content):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                        for m in z.infolist():
                            if m.is_dir():
                                continue
                            suffix = "." + m.filename.rsplit(".", 1)[-1].lower() if "." in m.filename.rsplit("/", 1)[-1] else ""
                            space = None
                            if suffix in (".xsd", ".xml"):
                                with z.open(m) as f:
                                    found = re.search(rb'targetNamespace\s*=\s*"([^"]*)"', f.read(4096))
                                space = found[1].decode("utf-8", "replace") if found else None
                            rows.append((path, m.filename, suffix, m.file_size, space, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "member", "suffix", "bytes", "namespace", "error"]).astype({"bytes": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, member string, suffix string, bytes long, namespace string, error string")


def suffix_profile(members: DataFrame) -> DataFrame:
    return members.groupBy("path", "suffix").agg(F.count("*").alias("members"), F.sum("bytes").alias("bytes"))


def largest_members(members: DataFrame, top: int = 120) -> DataFrame:
    """The ``top`` largest members of each archive with their place; ties by name."""
    order = Window.partitionBy("path").orderBy(F.desc("bytes"), "member")
    return members.filter(F.col("member").isNotNull()).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def xml_profile(elements: DataFrame, top: int = 20, samples: int = 15) -> DataFrame:
    """Per file: elements, greatest depth, the ``top`` commonest local names, namespaces and first texts of ``xml_elements`` rows.

    Names are counted before they are ranked, and only what stays is collected.
    """
    names = elements.groupBy("path", "tag").agg(F.count("*").alias("n"))
    ranked = names.withColumn("_k", F.row_number().over(Window.partitionBy("path").orderBy(F.desc("n"), "tag"))).filter(F.col("_k") <= top)
    histogram = ranked.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "tag", "n"))), lambda x: F.concat_ws(":", x["tag"], x["n"].cast("string"))).alias("names"))
    texts = elements.filter("text is not null").groupBy("path", "text").agg(F.count("*").alias("_c")).withColumn("_k", F.row_number().over(Window.partitionBy("path").orderBy("text"))).filter(F.col("_k") <= samples)
    texts = texts.groupBy("path").agg(F.array_sort(F.collect_list("text")).alias("samples"))
    whole = elements.groupBy("path").agg(F.count("*").alias("elements"), F.max("depth").alias("max_depth"), F.array_sort(F.collect_set("namespace")).alias("namespaces"))
    return whole.join(histogram, "path").join(texts, "path", "left")


def workbook_summary(sheets: DataFrame, cap: int = 4000) -> DataFrame:
    """Per workbook: sheets, visible ones, sums of cells, sheet names joined and sample texts up to ``cap`` characters."""
    named = F.array_sort(F.collect_list("sheet"))
    texts = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("sheet", "texts"))), lambda s: s["texts"])), " | ")
    return sheets.filter(F.col("sheet").isNotNull()).groupBy("path").agg(
        F.count("*").alias("sheets"), F.count_if("visible").alias("visible_sheets"), F.sum("filled").alias("filled"), F.sum("numeric").alias("numeric"), F.sum("formulas").alias("formulas"), F.array_join(named, " | ").alias("names"), F.left(texts, F.lit(cap)).alias("sample")
    )


def choose_encoding(content: bytes) -> str:
    if content[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    for name in ("utf-8-sig", "cp1252"):
        try:
            content.decode(name)
            return name
        except UnicodeDecodeError:
            pass
    return "latin-1"


def profile_csv(files: DataFrame) -> DataFrame:
    """Physical rows, widest row, histogram of widths (top five), header and four sample rows of each file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(2**27)
        for frame in frames:
            rows = []
            for path, content in zip(frame.path, frame.content):
                raw = bytes(content)
                encoding, widths, header, sample, n = choose_encoding(raw), Counter(), None, [], 0
                for row in csv.reader(io.StringIO(raw.decode(encoding, "replace").replace("\0", ""), newline="")):
                    n += 1
                    widths[len(row)] += 1
                    if header is None:
                        header = [c[:500] for c in row]
                    elif len(sample) < 4:
                        sample.append([c[:500] for c in row])
                rows.append((path, encoding, n, max(widths, default=0), [f"{w}:{c}" for w, c in widths.most_common(5)], header, sample))
            yield pd.DataFrame(rows, columns=["path", "encoding", "row_count", "max_columns", "widths", "header", "sample"])

    return files.select("path", "content").mapInPandas(run, "path string, encoding string, row_count long, max_columns long, widths array<string>, header array<string>, sample array<array<string>>")


def xml_elements(files: DataFrame) -> DataFrame:
    """One row for each element: path, local name, namespace, depth and the first 200 characters of its text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame.path, frame.content):
                rows, depth = [], 0
                for event, node in ElementTree.iterparse(io.BytesIO(bytes(content)), events=("start", "end")):
                    if event == "start":
                        depth += 1
                        space, _, name = node.tag.rpartition("}")
                        rows.append([path, name, space.lstrip("{"), depth, None])
                        node.set("_row", str(len(rows) - 1))
                    else:
                        rows[int(node.attrib.pop("_row"))][4] = (node.text or "").strip()[:200] or None
                        depth -= 1
                        node.clear()
                yield pd.DataFrame(rows, columns=["path", "tag", "namespace", "depth", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, tag string, namespace string, depth int, text string")


def workbook_sheets(files: DataFrame, rows_: int = 25, columns_: int = 15) -> DataFrame:
    """Non-empty, numeric and formula cells and up to 12 texts in the corner of each sheet, read from the OOXML parts."""
    S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

    def column(ref: str) -> int:
        n = 0
        for c in re.match(r"[A-Z]+", ref)[0]:
            n = 26 * n + ord(c) - 64
        return n

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame.path, frame.content):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                        shared = []
                        if "xl/sharedStrings.xml" in z.namelist():
                            shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{S}si")]
                        sheets = ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{S}sheet")
                        for i, sheet in enumerate(sheets, 1):
                            filled = numeric = formulas = 0
                            texts: list[str] = []
                            for c in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).iter(f"{S}c"):
                                ref = c.get("r", "A1")
                                if int(re.search(r"\d+", ref)[0]) > rows_ or column(ref) > columns_:
                                    continue
                                value, formula = c.find(f"{S}v"), c.find(f"{S}f")
                                inline = "".join(t.text or "" for t in c.iter(f"{S}t"))
                                if value is None and not inline:
                                    continue
                                filled += 1
                                formulas += formula is not None
                                if c.get("t") in ("s", "inlineStr", "str"):
                                    text = shared[int(value.text)] if c.get("t") == "s" else inline or value.text
                                    if len(texts) < 12:
                                        texts.append(" ".join((text or "").split())[:160])
                                else:
                                    numeric += 1
                            out.append((path, sheet.get("name"), sheet.get("state", "visible") == "visible", filled, numeric, formulas, texts, None))
                except Exception as e:  # noqa: BLE001
                    out.append((path, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "sheet", "visible", "filled", "numeric", "formulas", "texts", "error"]).astype({"filled": "Int64", "numeric": "Int64", "formulas": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, sheet string, visible boolean, filled long, numeric long, formulas long, texts array<string>, error string")


def zstd_bytes(files: DataFrame, level: int = 9) -> DataFrame:
    """Each file's bytes compressed, with both sizes and the hash of the source."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for frame in frames:
            packed = [zstandard.ZstdCompressor(level=level).compress(bytes(c)) for c in frame.content]
            yield pd.DataFrame({"path": frame.path, "sha256": frame.sha256, "source_bytes": [len(c) for c in frame.content], "compressed_bytes": [len(p) for p in packed], "compressed": packed})

    return files.select("path", "sha256", "content").mapInPandas(run, "path string, sha256 string, source_bytes long, compressed_bytes long, compressed binary")


def verify_hashes(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest rows (key, sha256, bytes) whose file is missing or differs in size or hash."""
    have = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("key"), F.col("sha256").alias("_sha"), F.length("content").cast("long").alias("_n"))
    fault = F.when(F.col("_sha").isNull(), "missing").when(F.col("_n") != F.col("bytes"), "size").when(F.col("_sha") != F.col("sha256"), "sha256")
    return manifest.join(have, "key", "left").withColumn("fault", fault).filter("fault is not null").select("key", "fault")
