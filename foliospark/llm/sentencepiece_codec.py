"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces.

Pieces and log scores come from a model file that the caller names.  The trie
walks UTF-8 bytes; characters that no piece covers cost the lowest score less
ten and are written as byte pieces.  A text is escaped (space becomes the
marker U+2581, one marker in front) and cut where no piece can reach across:
before each run of markers and around line breaks.  Best paths of the parts
make the best path of the whole, and a bounded cache keeps those of words seen
before.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 400_000


class DoubleArray:
    """base/check arrays over byte codes 1..256; ``value[node]`` is a piece id or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in keys:
            node = 0
            for c in key:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = value
        size = 2 * len(children) + 600
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        place, free = [0] * len(children), 257  # a base is never negative, so lower places could get stuck
        self.check[0] = 0
        front = 1  # where wide nodes start to look; holes behind it are left to single children
        queue = [0]
        for node in queue:
            at = place[node]
            self.value[at] = ends[node]
            codes = sorted(children[node])
            if not codes:
                continue
            while free < len(self.check) and self.check[free] >= 0:
                free += 1
            start = free if len(codes) == 1 else max(front, free)
            base = max(0, start - codes[0] - 1)
            tried = 0
            while True:
                if base + 257 >= len(self.check):
                    more = len(self.check)
                    self.base += [0] * more
                    self.check += [-1] * more
                    self.value += [-1] * more
                if all(self.check[base + c + 1] < 0 for c in codes):
                    break
                base += 1
                tried += 1
            if len(codes) > 1 and tried > 30:
                front = base + codes[0] + 1
            self.base[at] = base
            for c in codes:
                place[children[node][c]] = base + c + 1
                self.check[base + c + 1] = at
                queue.append(children[node][c])


class Codec:
    """Encoder and decoder; needs only plain lists, so it can be broadcast (its size is the vocabulary's)."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        self.scores = [sp.get_score(i) for i in range(n)]
        self.byte_ids, self.surface, normal = [-1] * 256, [b""] * n, []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.surface[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append((piece.encode(), i))
                self.surface[i] = piece.replace(MARK, " ").encode()
        self.unknown = min(self.scores[i] for _, i in normal) - UNKNOWN_PENALTY
        self.trie = DoubleArray(normal)
        #: Whether a piece holds a marker behind another character, or a line break: then texts cannot be cut there.
        names = [k.decode() for k, _ in normal]
        self.whole = any(MARK in p.lstrip(MARK) or "\n" in p for p in names)
        self.cache: dict[str, list[int]] = {}
        self.bare: dict[str, list[int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "bare": {}}

    def best_path(self, part: str) -> list[int]:
        """The piece ids with the largest sum of scores for an escaped text."""
        text = part.encode()
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        size, limit = len(text), len(check)
        best = [-1e300] * (size + 1)
        best[0] = 0.0
        came, piece = [0] * (size + 1), [-1] * (size + 1)
        at = 0
        while at < size:
            score, first = best[at], text[at]
            step = at + (1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4)
            node, end, alone = 0, at, False
            while end < size:
                nxt = base[node] + text[end] + 1
                if nxt >= limit or check[nxt] != node:
                    break
                node, end = nxt, end + 1
                found = value[node]
                if found >= 0:
                    total = score + scores[found]
                    if total > best[end]:
                        best[end], came[end], piece[end] = total, at, found
                    if end == step:
                        alone = True
            if not alone and score + self.unknown > best[step]:
                best[step], came[step], piece[step] = score + self.unknown, at, -1
            at = step
        out: list[int] = []
        while at:
            back = came[at]
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[back:at]))
            at = back
        out.reverse()
        return out

    def _part(self, held: dict, key: str, lead: str) -> list[int]:
        found = held.get(key)
        if found is None:
            found = self.best_path(lead + key)
            if len(held) < CACHE:
                held[key] = found
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the empty text has none."""
        if not text:
            return []
        if self.whole:
            return self.best_path(MARK + text.replace(" ", MARK))
        out: list[int] = []
        cache, bare = self.cache, self.bare
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.byte_ids[10])
            if MARK in line or "  " in line or line[-1:] == " " or line[:1] == " " or not line:
                escaped = (MARK if not i else "") + line.replace(" ", MARK)
                for part in re.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", escaped):
                    out += self._part(bare, part, "")
                continue
            words = line.split(" ")
            if i:
                out += self._part(bare, words[0], "")
                del words[0]
            for w in words:
                found = cache.get(w)
                if found is None:
                    found = self._part(cache, w, MARK)
                out += found
        return out

    def decode(self, ids) -> str:
        """The text of ids: pieces joined, markers as spaces, byte pieces as UTF-8, without the leading marker."""
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every row; null counts as empty, which has no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return picked.mapInArrow(_encode(shared), "doc_id long, ids array<int>")


def decode(coded: DataFrame, codec: Codec) -> DataFrame:
    """doc_id and text of rows with ids."""
    shared = coded.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, n_byte_ids, ids_crc32 (little-endian unsigned 32-bit ids) and round_trip (does decoding give the text?)."""
    Scratch(docs.sparkSession, "pieces")  # sets the Arrow batch size
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        is_byte = np.zeros(len(codec.scores), dtype=bool)
        is_byte[[i for i in codec.byte_ids if i >= 0]] = True
        for batch in batches:
            n, nb, crc, same = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text)
                arr = np.array(ids, dtype="<u4")
                n.append(len(ids))
                nb.append(int(is_byte[arr].sum()))
                crc.append(zlib.crc32(arr.tobytes()))
                same.append(codec.decode(ids) == text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(nb, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "round_trip"])

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean")
