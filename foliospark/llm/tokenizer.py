"""Byte-level BPE by vocabulary files that the caller names; loaded once for each Python worker."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from functools import lru_cache

#: The pre-tokenisation pattern of the byte-level vocabulary; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _fast(rank_path: str):
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _exact(json_path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@lru_cache(maxsize=2)
def _special(json_path: str) -> tuple[str, ...]:
    return tuple(t.content for t in _exact(json_path).get_added_tokens_decoder().values())


def load_byte_bpe(json_path: str, rank_path: str) -> Callable[[str], list[int]]:
    """text -> ids without added special tokens.

    The rank file holds the same vocabulary and merges four times faster; a
    text that spells a special token goes through the JSON definition, which
    alone knows how that is read.
    """
    fast, special = _fast(rank_path), _special(json_path)

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return _exact(json_path).encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode
