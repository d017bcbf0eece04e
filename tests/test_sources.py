"""Readers, binary files and sinks on generated fixtures."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from foliospark.sources import binary, readers, sinks

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
MD = '---\ntitle: "A: b"\npages: 2\nno colon here\n---\n<!-- source-page: 1 -->\n<a id="page-1"></a>\n\n First \n<!-- source-page: 2 -->\n<a id="page-2"></a>\nSecond\n'


def test_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes('﻿id,"V�"\r\n1,"a\nb"\r\n1,"c\0d"\r\n2,"x ""q"""\r\n'.encode())
    rows = readers.read_keyed_csv(spark, str(path), "id").orderBy("id").collect()
    assert [(r.id, r["V€"]) for r in rows] == [("1", "cd"), ("2", 'x "q"')]


def test_jsonl_and_catalogues(spark, tmp_path):
    (tmp_path / "j.jsonl").write_text('{"k":"a","n":1}\n\n{"k":"b","n":2}\n')
    assert [(r.k, r.n) for r in readers.read_jsonl(spark, str(tmp_path / "j.jsonl"), "k string, n long").orderBy("seq").collect()] == [("a", 1), ("b", 2)]
    found = {"result": {"results": [{"name": "d", "title": "D", "resources": [{"id": "1", "name": "r", "url": "https://x/a.csv", "format": "csv"}, {"id": "2", "url": "ftp://x"}]}]}}
    assert [(r.dataset, r.format) for r in readers.ckan_resources(spark.createDataFrame([(json.dumps(found),)], "b string"), "b").collect()] == [("d", "CSV")]
    (tmp_path / "s.json").write_text(json.dumps({"files": {"u": {"status": "downloaded", "format": "PDF"}, "v": {"status": "failed", "format": "PDF"}}}, indent=1))
    state = readers.read_json_document(spark, str(tmp_path / "s.json"), "files map<string, struct<status:string, format:string>>")
    assert [r.canonical_url for r in readers.crawl_files(state, kind="PDF").collect()] == ["u"]


def test_markdown(spark, tmp_path):
    (tmp_path / "a.md").write_text(MD)
    (tmp_path / "b.md").write_text("no front matter")
    rows = readers.read_markdown(spark, str(tmp_path)).collect()
    good = sorted((r.page_number, r.text) for r in rows if r.error is None)
    assert good == [(1, "First"), (2, "Second")] and sum(r.error is not None for r in rows) == 1
    assert next(r.meta for r in rows if r.error is None) == {"title": '"A: b"', "pages": "2"}


def test_markdown_sink_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("ab12", 2, "Second", "A: b"), ("ab12", 1, "First", "A: b")], "sha string, n int, text string, title string")
    made = sinks.markdown(pages, "sha", "n", "text", {"title": "title"})
    sinks.write_markdown(made, str(tmp_path / "out"), "sha")
    files = list((tmp_path / "out" / "a=ab" / "b=12").rglob("*.txt"))
    (tmp_path / "x.md").write_text(files[0].read_text())
    back = readers.read_markdown(spark, str(tmp_path / "x.md")).orderBy("page_number").collect()
    assert [(r.page_number, r.text) for r in back] == [(1, "First"), (2, "Second")] and back[0].meta["title"] == '"A: b"'


def docx():
    cell = lambda t, m="": f"<w:tc><w:tcPr>{m}</w:tcPr><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    body = (
        "<w:p><w:r><w:t>One</w:t></w:r></w:p>"
        f"<w:tbl><w:tr>{cell('a', '<w:vMerge w:val=' + chr(34) + 'restart' + chr(34) + '/>')}{cell('b')}</w:tr><w:tr>{cell('a', '<w:vMerge/>')}{cell('c')}</w:tr></w:tbl>"
        '<w:p><w:r><w:br w:type="page"/><w:t>Two</w:t></w:r></w:p>'
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/header1.xml", f"<w:hdr {W}><w:p><w:r><w:t>Head</w:t></w:r></w:p></w:hdr>")
        z.writestr("word/header2.xml", f"<w:hdr {W}><w:p><w:r><w:t>Head</w:t></w:r></w:p></w:hdr>")
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.pdf").write_bytes(docx())  # the name lies
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "c.doc").write_bytes(b"\xd0\xcf\x11\xe0" + b"\0" * 9 + b"Readable words in an old container file" + b"\1" * 5)
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("s/x.xsd", '<schema targetNamespace="urn:t"/>')
        z.writestr("y.XML", "<a/>")
    (tmp_path / "bad.zip").write_bytes(b"PKbroken")
    return tmp_path


def test_sniff_and_convert(spark, folder):
    files = binary.read_binary(spark, str(folder))
    kinds = {r.p: r.k for r in files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("p"), binary.sniff_format("content").alias("k")).collect()}
    assert kinds == {"a.pdf": "DOCX", "b.pdf": "PDF", "c.doc": "OLE", "z.zip": "ZIP", "bad.zip": "UNKNOWN"}
    rows = binary.convert(files).collect()
    pages = {r.page_number: r.text for r in rows if r.path.endswith("a.pdf")}
    assert pages == {1: "One\n| a | b |\n| c |", 2: "Two\n## header\nHead"}
    assert next(r.text for r in rows if r.path.endswith("c.doc")) == "Readable words in an old container file"
    assert all(r.error for r in rows if r.path.endswith(("b.pdf", ".zip")))


def test_archives_tables_and_xml(spark, folder, tmp_path):
    files = binary.read_binary(spark, str(folder / "z.zip"))
    members = binary.zip_members(files)
    assert sorted((r.suffix, r.namespace) for r in members.collect()) == [(".xml", None), (".xsd", "urn:t")]
    assert {r.suffix: r.members for r in binary.suffix_profile(members).collect()} == {".xml": 1, ".xsd": 1}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_bytes("h1,h2\n1,é\n\n1,2,3\n".encode("cp1252"))
    r = binary.profile_csv(binary.read_binary(spark, str(tmp_path / "t"))).first()
    assert (r.encoding, r.row_count, r.max_columns, r.header) == ("cp1252", 4, 3, ["h1", "h2"]) and "0:1" in r.widths
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xml").write_text('<r xmlns="urn:n"><a>t</a><a><b/></a></r>')
    got = binary.xml_elements(binary.read_binary(spark, str(tmp_path / "x"))).groupBy("tag").agg(F.count("*").alias("n"), F.max("depth").alias("d")).collect()
    assert {r.tag: (r.n, r.d) for r in got} == {"r": (1, 1), "a": (2, 2), "b": (1, 3)}


def test_workbook(spark, tmp_path):
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {s}><sheets><sheet name="S" sheetId="1" state="hidden"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {s}><si><t>Text  here</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {s}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1"><v>1</v></c><c r="C1"><f>B1</f><v>1</v></c><c r="Z99"><v>9</v></c></row></sheetData></worksheet>')
    r = binary.workbook_sheets(binary.read_binary(spark, str(tmp_path))).first()
    assert (r.sheet, r.visible, r.filled, r.numeric, r.formulas, r.texts) == ("S", False, 3, 2, 1, ["Text here"])


def test_hashes_and_layout(spark, folder):
    files = binary.read_binary(spark, str(folder))
    good = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("key"), "sha256", F.length("content").cast("long").alias("bytes"))
    assert binary.verify_hashes(files, good).count() == 0
    bad = good.withColumn("sha256", F.when(F.col("key") == "b.pdf", "0").otherwise(F.col("sha256"))).union(spark.createDataFrame([("gone", "1", 1)], good.schema))
    assert {r.key: r.fault for r in binary.verify_hashes(files, bad).collect()} == {"b.pdf": "sha256", "gone": "missing"}
    r = sinks.blob_layout(files).filter(F.col("path").endswith("b.pdf")).first()
    assert r.key == f"{r.sha256[:2]}/{r.sha256[2:4]}/{r.sha256}.pdf" and r.bytes_saved == 0


@pytest.mark.parametrize("codec", [None, "gzip"])
def test_manifest_round_trip(spark, tmp_path, codec):
    df = spark.createDataFrame([("b", ["x", "y"], None), ("a", [], 'q"1,2\n3')], "url string, aliases array<string>, note string")
    sinks.write_manifest(df, str(tmp_path / "m"), "url", codec=codec)
    rows = readers.read_csv(spark, str(tmp_path / "m")).orderBy("url").collect()
    assert [(r.url, r.aliases, r.note) for r in rows] == [("a", None, 'q"1,2\n3'), ("b", "x | y", None)]


def test_zstd_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,2\n" * 1)
    r = binary.zstd_bytes(binary.read_binary(spark, str(tmp_path))).first()
    (tmp_path / "m.csv.zst").write_bytes(bytes(r.compressed))
    assert r.source_bytes == 8 and [(x.a, x.b) for x in readers.read_csv(spark, str(tmp_path / "m.csv.zst")).collect()] == [("1", "2")]


def test_published_tables(spark, tmp_path):
    docs = spark.createDataFrame([(f"{i:03d}", f"t{i}") for i in range(50)], "sha string, title string")
    pages = docs.select("sha", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    sinks.write_documents(docs, str(tmp_path / "d"), "sha")
    sinks.write_pages(pages, docs, str(tmp_path / "p"), "sha", "n", ["title"])
    got, lacking = readers.published(spark, str(tmp_path / "p"), ["sha", "n", "title", "voice"])
    assert got.count() == 150 and lacking == ["voice"]
    assert json.loads(sinks.summary(docs, rows=F.count("*"))) == {"rows": 50}
    assert "PushedFilters: [IsNotNull(sha), EqualTo(sha,007)]" in got.filter("sha = '007'")._jdf.queryExecution().executedPlan().toString()


def test_small_sinks(spark):
    df = spark.createDataFrame([('a"b', 1), (None, 2), ("x,y", 3)], "v string, n int")
    assert [r.e for r in df.orderBy("n").select(sinks.csv_escape(F.col("v")).alias("e")).collect()] == ['"a""b"', "", '"x,y"']
    assert [r.e for r in df.orderBy("n").select(sinks.yaml_scalar(F.col("v")).alias("e")).collect()] == ['"a\\"b"', "null", '"x,y"']
    c = spark.createDataFrame([("s", "u.docx", "office"), ("s", "u.docx", "pdf"), ("t", "u.pdf", "pdf"), ("r", "a.pdf", "pdf"), ("r", "a.pdf", "office")], "sha string, url string, corpus string")
    assert {r.sha: r.preferred for r in sinks.extraction_preferences(c, "sha", "url", "corpus").collect()} == {"s": "office", "r": "pdf"}
    long = spark.createDataFrame([(1, "a" * 300), (2, "short"), (3, "b" * 300), (4, "c" * 300)], "n int, t string")
    assert [r.n for r in sinks.bundle_text(long, ["n"], F.lit("h"), "t", 650).orderBy("n").collect()] == [1, 3]


def test_sqlite_in_ranges(spark, tmp_path):
    """Every row once, in any number of ranges, gaps of row ids and mixed cell types included; the file stays as it is."""
    import sqlite3

    from foliospark.sources import database

    path = str(tmp_path / "a b.sqlite")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE pages (id INTEGER PRIMARY KEY, title TEXT, score REAL, raw BLOB, odd VARCHAR(9))")
        db.executemany("INSERT INTO pages VALUES (?, ?, ?, ?, ?)", [(i * 3 + 1, f"t{i}", i / 2 if i % 5 else "x", bytes([i % 256]), i if i % 2 else None) for i in range(9500)])
        db.execute("CREATE TABLE hollow (a INT)")
    for parts in (1, 7):
        df = database.read_sqlite(spark, path, "pages", parts)
        rows = sorted(tuple(r) for r in df.collect())
        assert len(rows) == 9500 and rows[6] == (19, "t6", 3.0, bytes([6]), None) and rows[5][2] is None and rows[7][4] == "7"
    assert database.read_sqlite(spark, path, "hollow").count() == 0
    with pytest.raises(LookupError):
        database.read_sqlite(spark, path, "absent")


def test_pptx_tables_and_docx_fallback(spark):
    import io
    import zipfile

    from foliospark.sources import binary

    def pack(parts):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, text in parts.items():
                z.writestr(name, text)
        return out.getvalue()

    ns = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
    para = lambda t: f"<a:p><a:r><a:t>{t}</a:t></a:r></a:p>"
    cell = lambda t: f"<a:tc><a:txBody>{para(t)}</a:txBody></a:tc>"
    slide = f"<p:sld {ns}><p:cSld><p:spTree><p:sp>{para('Title')}</p:sp><p:graphicFrame><a:tbl><a:tr>{cell('a')}{cell('b')}</a:tr><a:tr>{cell('1')}{cell('2')}</a:tr></a:tbl></p:graphicFrame><p:grpSp><p:sp>{para('Last')}</p:sp></p:grpSp></p:spTree></p:cSld></p:sld>"
    assert binary.pptx_pages(pack({"ppt/slides/slide1.xml": slide, "ppt/notesSlides/notesSlide1.xml": f"<p:notes {ns}>{para('Say it')}</p:notes>"})) == ["Title\n| a | b |\n| 1 | 2 |\nLast\n\n## notes\nSay it"]
    broken = pack({"[Content_Types].xml": "<Types/>", "word/document.xml": "<w:document><w:body><w:p><w:t>One &amp; two</w:t></w:p><w:p><w:t xml:space='preserve'>three</w:t></w:p>"})
    empty = pack({"[Content_Types].xml": "<Types/>", "word/document.xml": "<w:document><w:body>"})
    files = spark.createDataFrame([("a.docx", "s1", broken), ("b.docx", "s2", empty)], "path string, sha256 string, content binary")
    got = {r.path: r for r in binary.convert(files).collect()}
    assert got["a.docx"].engine == "text-runs" and got["a.docx"].text == "One & two\nthree" and got["a.docx"].error is None
    assert "ParseError" in got["b.docx"].error and "text-runs: ValueError: no text runs" in got["b.docx"].error


def test_sitemap_closure(spark):
    from foliospark.functions import urls as U

    locs = lambda *u: "".join(f"<url><loc>{x}</loc></url>" for x in u)
    index = lambda *u: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in u) + "</sitemapindex>"
    docs = spark.createDataFrame([("i", index("a", "j")), ("j", index("b", "i", "lost")), ("a", f"<urlset>{locs('p1', 'p2')}</urlset>"), ("b", f"<urlset>{locs('p2', 'p3')}</urlset>"), ("c", f"<urlset>{locs('p9')}</urlset>")], "url string, xml string")
    assert sorted(r.url for r in U.sitemap_closure(docs, ["i"]).collect()) == ["p1", "p2", "p3"]
    assert sorted(r.url for r in U.sitemap_closure(docs, ["i"], most=2).collect()) == ["p1", "p2"]


def test_index_store(spark, tmp_path):
    from foliospark.plans import fts

    pages = spark.createDataFrame([(i, f"Title {i}", "credit union " * (i % 4) + "plain words") for i in range(40)], "id long, title string, text string")
    fts.write_index(pages, str(tmp_path / "index"), ["id"], title="title")
    stored = fts.read_index(spark, str(tmp_path / "index"))
    fresh = fts.bm25(fts.with_norms(pages, title="title"), '"credit union"').orderBy("id").collect()
    assert [tuple(r) for r in fts.bm25(stored, '"credit union"').select("id", "title", "text", "score").orderBy("id").collect()] == [tuple(r) for r in fresh]
    assert stored.filter("id = 3").first().token_count == 2 + 8
