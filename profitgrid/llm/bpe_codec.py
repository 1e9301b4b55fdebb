"""Operator 10: BPE encoding and decoding.

Each word of a text starts as its bytes; a priority queue of merge ranks over a doubly linked list of
symbols joins neighbours, skipping stale entries (``ByteBpe.merged``). Decoding concatenates the strings
of the vocabulary. A row needs nothing but its own text, so there is no shuffle: each task reads its
rows, and words that it has met before come from a bounded cache.

Defined cases: a NULL or empty text has no tokens; repeated rows give repeated results; a NULL doc_id is
kept; the string of a special token inside a text becomes that token, as in the library's default; other
columns of the input, whatever their names, are not looked at. A very long word costs n log n.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable
from struct import pack

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from profitgrid.llm import byte_bpe
from profitgrid.llm.common import per_row, table


@functools.lru_cache(maxsize=4)
def _cache(path: str) -> byte_bpe.WordCache:
    bpe = byte_bpe.load(path)

    def ids(word: str) -> bytes:
        if word in bpe.special:
            return pack("<I", bpe.special[word])
        tokens = bpe.merged(word.encode())
        return pack(f"<{len(tokens)}I", *tokens)

    return byte_bpe.WordCache(ids)


def encode(text: str, path: str) -> bytes:
    """Token ids as little-endian unsigned 32-bit integers."""
    return b"".join(map(_cache(path).__getitem__, byte_bpe.load(path).words(text)))


def decode(ids: bytes, path: str) -> str:
    """Text of token ids, special tokens included; what is not UTF-8 becomes U+FFFD."""
    strings = byte_bpe.load(path).token_bytes
    return b"".join(map(strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns but the text, and ``n_tokens``, ``ids`` (binary) and ``decoded``."""

    def make() -> Callable[[str], tuple]:
        def row(value: str) -> tuple:
            ids = encode(value, path)
            return len(ids) // 4, ids, decode(ids, path)

        return row

    return per_row(docs, text, "n_tokens bigint, ids binary, decoded string", make)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """As ``encoded``, with the SHA-256 of ids and decoded text in place of them."""

    def make() -> Callable[[str], tuple]:
        def row(value: str) -> tuple:
            ids = encode(value, path)
            back = decode(ids, path).encode()
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

        return row

    return per_row(docs, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)


def vocabulary() -> str:
    """Path of the vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary())
