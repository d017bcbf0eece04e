"""Edit-aware token counts over pre-token segment trees.

Byte-level BPE never merges across pre-tokens, and the pre-token pattern is
memoryless: from any pre-token boundary on, the cuts depend only on what
follows.  A document's tree holds, over leaves of up to ``LEAF`` pre-tokens,
sums of characters and tokens.  An edit re-encodes from the pre-tokens just
before it (their matches may now end elsewhere) up to the first new boundary behind the
edit that is also an old one; everything else keeps its counts, and the sums
above the touched leaves are brought up to date.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .tokenizer import PATTERN, load_byte_bpe

LEAF = 64
CACHE = 500_000
_CUT = regex.compile(PATTERN)


class Counter(dict):
    """pre-token -> number of tokens; bounded."""

    def __init__(self, json_path: str, rank_path: str):
        self.encode = load_byte_bpe(json_path, rank_path)

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(self) < CACHE:
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(json_path: str, rank_path: str) -> Counter:
    return Counter(json_path, rank_path)


class SegmentTree:
    """Pre-tokens of a text in leaves; an implicit binary tree sums characters and tokens of the leaves."""

    def __init__(self, text: str, count: Counter):
        self.count, self.text, self.reencoded = count, text, 0
        pieces = _CUT.findall(text)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        tokens = np.fromiter(map(count.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        self._build(lengths, tokens)

    def _build(self, lengths: np.ndarray, tokens: np.ndarray) -> None:
        cuts = range(LEAF, len(lengths), LEAF)
        self.leaves = list(zip(np.split(lengths, cuts), np.split(tokens, cuts)))
        self.cap = 1 << max(0, (len(self.leaves) - 1).bit_length())
        self.chars, self.tokens = np.zeros(2 * self.cap, dtype=np.int64), np.zeros(2 * self.cap, dtype=np.int64)
        for i, (a, b) in enumerate(self.leaves):
            self.chars[self.cap + i], self.tokens[self.cap + i] = a.sum(), b.sum()
        level = self.cap
        while level > 1:
            for tree in (self.chars, self.tokens):
                tree[level // 2 : level] = tree[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def _leaf_at(self, char: int) -> tuple[int, int]:
        """(leaf that holds the character, characters before it); the last leaf behind the end."""
        node, before = 1, 0
        while node < self.cap:
            left = int(self.chars[2 * node])
            if char - before < left:
                node = 2 * node
            else:
                before += left
                node = 2 * node + 1
        leaf = node - self.cap
        while leaf >= len(self.leaves) or leaf and not len(self.leaves[leaf][0]):
            leaf -= 1
            before -= int(self.chars[self.cap + leaf])
        return leaf, before

    def _set(self, leaf: int, lengths: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves[leaf] = (lengths, tokens)
        node = self.cap + leaf
        self.chars[node], self.tokens[node] = lengths.sum(), tokens.sum()
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, delete: int, insert: str) -> None:
        """Replace ``delete`` characters at ``start`` by ``insert``; positions are clipped to the text."""
        size = len(self.text)
        start = min(max(start, 0), size)
        delete = min(max(delete, 0), size - start)
        if not delete and not insert:
            return
        old_end, shift = start + delete, len(insert) - delete
        text = self.text = self.text[:start] + insert + self.text[old_end:]
        # A run of white space is cut by what follows the run, one character beyond its own match.
        safe = max(start - 2, 0)
        first, before = self._leaf_at(safe)
        lengths, tokens = self.leaves[first]
        ends = before + np.cumsum(lengths)
        keep = int(np.searchsorted(ends, safe, side="right"))  # pre-tokens that the edit cannot reach
        at = before + int(lengths[:keep].sum())
        head = lengths[:keep], tokens[:keep]
        # Old boundaries behind the edit, leaf by leaf.
        leaf, begin, bounds, index = first, before, ends, 0
        fresh_len, fresh_tok, met = [], [], False
        for m in _CUT.finditer(text, at):
            if m.start() >= start + len(insert) and m.start() - shift >= old_end:
                wanted = m.start() - shift
                while (not len(bounds) or bounds[-1] <= wanted) and leaf + 1 < len(self.leaves) and not (len(bounds) and bounds[-1] == wanted):
                    begin += int(self.chars[self.cap + leaf])
                    leaf += 1
                    bounds = begin + np.cumsum(self.leaves[leaf][0])
                if wanted == begin:
                    index, met = 0, True
                else:
                    index = int(np.searchsorted(bounds, wanted))
                    if index < len(bounds) and bounds[index] == wanted:
                        index, met = index + 1, True
            if met:
                break
            fresh_len.append(m.end() - m.start())
            fresh_tok.append(self.count[m[0]])
            self.reencoded += m.end() - m.start()
        if met:
            tail = self.leaves[leaf][0][index:], self.leaves[leaf][1][index:]
        else:
            leaf, tail = len(self.leaves) - 1, (lengths[:0], tokens[:0])
        none = lengths[:0]
        new_lengths = np.concatenate([head[0], np.array(fresh_len, dtype=np.int64), tail[0] if leaf == first else none])
        new_tokens = np.concatenate([head[1], np.array(fresh_tok, dtype=np.int64), tail[1] if leaf == first else none])
        for i in range(first + 1, leaf):
            self._set(i, none, none)
        if leaf > first:
            self._set(leaf, *tail)
        self._set(first, new_lengths, new_tokens)
        if len(new_lengths) > 16 * LEAF:
            self._build(np.concatenate([a for a, _ in self.leaves]), np.concatenate([b for _, b in self.leaves]))

    def to_bytes(self) -> bytes:
        """Pre-token lengths and token counts, for keeping beside the text."""
        return np.concatenate([*[a for a, _ in self.leaves], *[b for _, b in self.leaves]]).astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes, text: str, count: Counter) -> SegmentTree:
        tree = cls.__new__(cls)
        tree.count, tree.text, tree.reencoded = count, text, 0
        both = np.frombuffer(blob, dtype="<u4").astype(np.int64)
        tree._build(both[: len(both) // 2], both[len(both) // 2 :])
        return tree


EDITS = "array<struct<start:long,delete:long,insert:string>>"


def _apply(json_path: str, rank_path: str, with_tree: bool, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(json_path, rank_path)
        for batch in batches:
            out = [[] for _ in range(7)]
            for row in zip(*(batch.column(i).to_pylist() for i in range(1, batch.num_columns))):
                tree = SegmentTree.from_bytes(row[2], row[0], count) if with_tree and row[2] is not None else SegmentTree(row[0], count)
                before = tree.total
                for e in row[1]:
                    tree.edit(e["start"] or 0, e["delete"] or 0, e["insert"] or "")
                for x, v in zip(out, (before, tree.total, len(row[1]), tree.reencoded, len(tree.text), None if digest else tree.text, None if digest else tree.to_bytes())):
                    x.append(v)
            kinds = [pa.int64()] * 5 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds)], names=["doc_id", "tokens_before", "tokens_after", "n_edits", "reencoded_chars", "n_chars", "text", "tree"])

    return run


RESULT = "doc_id long, tokens_before long, tokens_after long, n_edits long, reencoded_chars long, n_chars long, text string, tree binary"


def count_edited(docs: DataFrame, edits, json_path: str, rank_path: str, id_col: str = "doc_id", text_col: str = "text", tree_col: str | None = None, digest: bool = False) -> DataFrame:
    """Token counts of every row before and after its edits, with the edited text and its tree.

    ``edits`` is a Column of type ``EDITS``, applied in order, each to the text
    the one before left; null means none.  ``tree_col`` names trees kept by an
    earlier call (a null tree is built), else they are built; ``digest`` leaves
    text and tree null.  Null text counts as empty, repeated rows give repeated
    results, an empty table gives an empty one, and extra columns are not read.
    Positions are clipped to the text; texts may have any length.  Strings of
    special tokens count as ordinary text, as pre-tokens cannot see them.
    """
    Scratch(docs.sparkSession, "edits")  # sets the Arrow batch size
    cols = [docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), F.coalesce(edits.cast(EDITS), F.array().cast(EDITS)).alias("edits")]
    if tree_col:
        cols.append(docs[tree_col].alias("tree"))
    return docs.select(*cols).mapInArrow(_apply(json_path, rank_path, bool(tree_col), digest), RESULT)


def keep_trees(docs: DataFrame, json_path: str, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and tree of every row, written in the shared folder: what a later call of ``count_edited`` starts from."""
    built = count_edited(docs, F.lit(None), json_path, rank_path, id_col, text_col).select("doc_id", "text", "tree")
    return Scratch(docs.sparkSession, "trees").save(built, "trees")
