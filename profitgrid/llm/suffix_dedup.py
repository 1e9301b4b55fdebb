"""Operator 9: removal of repeated substrings by q-gram buckets of sample positions.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else too. The method dealt for
this operator, bucket-pointer refinement, gives every position a bucket number and refines buckets in rounds
by looking up the numbers at later offsets. It was exchanged (see the README for its measured cost): here
buckets hold few positions, and hashes of bytes take the place of stored numbers, so that a "pointer" to
another offset needs no look-up in another task. What is kept of it are initial buckets by q-gram, and that
only buckets with several positions are refined, by identifiers at other offsets.

1. Initial buckets: q-grams of half the length, at sample positions only. Samples are chosen by content:
   any string of ``LENGTH`` bytes has its smallest gram among them, at the same place in each of its
   occurrences. A bucket with one position is closed: no string whose smallest gram this is repeats.
2. Open buckets are refined by the identifier of the surroundings, all bytes of strings through the sample.
   Equal surroundings decide all these strings at once: they repeat. The strings through a sample that stands
   alone with its surroundings are refined in four zones by the place of the gram in them: those of a zone may
   repeat only if the bytes that all of them hold occur with the gram elsewhere. 16 bits of an identifier tell;
   a sample without such a zone is closed.
3. Undecided strings, those whose smallest gram is open and that hold no decided sample, are refined one by
   one on the identifiers of half the string, rounded up, at its start and at its end, which together are
   the whole string. Decided positions of their buckets take part once per different surroundings, as the
   other occurrence.

Identifiers are sums modulo 2^64 over random numbers for the bytes, mixed afterwards; two of them name a
string in step 3. Such sums are known to fail for strings of a thousand bytes and more, so ``LENGTH`` may not
exceed ``LONGEST``. Within a task equal surroundings and equal strings are combined before the shuffle, so
copies, however many, send one row per task. Samples cross the network once: buckets are counted first, and
what follows for open ones needs no further shuffle. Rows of one bucket that differ are sorted with spilling, in
one task but never gathered in memory. Text crosses the network once, and a second time for undecided documents.

Defined cases: a NULL text is empty; texts shorter than ``LENGTH`` stay whole; copies of a text (repeated
rows included) remove each other whole; a NULL doc_id is kept; other columns are not looked at. Matches
never cross documents. Texts may have up to 2^29 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.llm.common import prepare, small, stored, table
from profitgrid.llm.grams import Block

LENGTH = 200
LONGEST = 256
ZONES = 4
ASKED, KNOWN = 1 << 30, 1 << 31  # flags beside the start of a string
BLOCK_BYTES = 1 << 20
RESOLVED, EDGE, SAMPLE = 0, 1, 2  # what a mark says of a sample position; SAMPLE: resolved, and shown to others


def _key(raw: bytes) -> tuple[int, int]:
    """96 bits that name a text: a signed long and 31 more bits."""
    digest = xxhash.xxh3_128_intdigest(raw)
    return (digest & (1 << 64) - 1) - (1 << 63), digest >> 97


def _blocks(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    """Texts of a batch in runs of about a megabyte."""
    run, size = [], 0
    for text in batch.column("text").to_pylist():
        raw = (text or "").encode()
        run.append(raw)
        size += len(raw)
        if size >= BLOCK_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _joined(parts: list[tuple[np.ndarray, ...]], width: int) -> list[np.ndarray]:
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(width)]


def _first_of_equal(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element: whether it is the first of its equals, and how many equals there are."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    first, count = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
    first[order] = new
    count[order] = np.bincount(group)[group] if len(order) else 0
    return first, count


def _places(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys = [_key(s) for s in strings]
    return np.array([k for k, _ in keys], np.int64), np.array([k for _, k in keys], np.int64)


def _zones(length: int) -> list[tuple[int, int]]:
    """The offsets of a sample's gram in the strings through it, from .. to, in ``ZONES`` runs."""
    offsets = length - length // 2 + 1
    edges = [k * offsets // ZONES for k in range(ZONES + 1)]
    return [(low, high - 1) for low, high in zip(edges[:-1], edges[1:], strict=True)]


def _samples(length: int):
    """Rows (key, place, gram, around, cores, n). n: positions of this task with these surroundings; 0: decided.
    ``cores``: 16 bits for each zone, of the identifier of the bytes that all strings of the zone hold."""
    q = length // 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            parts = []
            for strings in _blocks(batch):
                block = Block.of(strings)
                at = block.samples(q, length)
                if not len(at):
                    continue
                doc = np.searchsorted(block.ends, at, side="right")
                low = np.maximum(at - (length - q), block.starts[doc])
                high = np.minimum(at + length, block.ends[doc])
                cut = ((at - low) * (2 * length) + (high - at)).astype(np.uint64)
                around = block.between(low, high) + cut * np.uint64(0x9E3779B97F4A7C15)
                cores = np.zeros(len(at), np.uint64)
                for k, (near, far) in enumerate(_zones(length)):
                    first = np.maximum(at - near, block.starts[doc])
                    last = np.minimum(np.maximum(at + length - far, first), block.ends[doc])
                    cores |= block.between(first, last) >> np.uint64(48) << np.uint64(16 * k)
                key, more = _places(strings)
                parts.append((key[doc], (more[doc] << 32) | (at - block.starts[doc]), block.grams(q)[at], around, cores))
            key, place, gram, around, cores = _joined(parts, 5)
            first, n = _first_of_equal(gram, around)
            n[~first] = 0
            gram = np.where(first, gram, (key ^ place * 0x9E37).view(np.uint64) if len(key) else gram)
            columns = [pa.array(key), pa.array(place), _signed(gram), _signed(around), _signed(cores), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "place", "gram", "around", "cores", "n"])

    return run


def _marks(docs: DataFrame, length: int) -> DataFrame:
    """(key, more, marks): for every text the positions of open samples, 64 times the position plus 4 times the
    zones, as bits, in which strings may repeat, plus the mark."""
    schema = "key bigint, place bigint, gram bigint, around bigint, cores bigint, n bigint"
    rows = docs.select("text").mapInArrow(_samples(length), schema)
    # All windows follow the partitioning by gram that the first one asks for.
    same, bucket = Window.partitionBy("gram", "around"), Window.partitionBy("gram")
    n = rows.withColumn("n_all", F.sum("n").over(bucket)).where((F.col("n") == 0) | (F.col("n_all") > 1))
    n = n.withColumns({"first": F.row_number().over(same.orderBy("key", "place")), "n_same": F.sum("n").over(same)})
    n = n.withColumn("least", F.min("n_same").over(bucket))
    zones = F.lit(0)
    for k in range(ZONES):
        core, shared = f"core_{k}", F.sum("n").over(Window.partitionBy("gram", f"core_{k}")) > F.col("n_same")
        n = n.withColumn(core, F.shiftright("cores", 16 * k).bitwiseAND(0xFFFF)).withColumn(core, shared)
        zones = zones + F.when(F.col(core), 1 << k).otherwise(0)
    mark = (
        F.when(F.col("n") == 0, RESOLVED)
        .when(F.col("n_same") == 1, EDGE)
        .when((F.col("least") == 1) & (F.col("first") == 1), SAMPLE)
        .otherwise(RESOLVED)
    )
    marked = n.select("key", "place", mark.alias("mark"), zones.alias("zones"))
    # A lone sample without a zone is in no repeated string.
    marked = marked.where((F.col("mark") != EDGE) | (F.col("zones") > 0))
    position = F.col("place").bitwiseAND(0xFFFFFFFF)
    return (
        marked.select(
            "key", F.shiftright("place", 32).alias("more"), (position * 64 + F.col("zones") * 4 + F.col("mark")).alias("mark")
        )
        .groupBy("key", "more")
        .agg(F.collect_set("mark").alias("marks"))
    )


def _covered(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the intervals [low, high)."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.cumsum(steps[:-1]) > 0


def _strings_through(n: int, at: np.ndarray, length: int) -> np.ndarray:
    """For each start of a string of ``length`` bytes in a text of n bytes: whether it holds one of the samples."""
    starts = n - length + 1
    return _covered(starts, np.clip(at - (length - length // 2), 0, starts), np.clip(at + 1, 0, starts))


def _in_zones(n: int, at: np.ndarray, zones: np.ndarray, length: int) -> np.ndarray:
    """For each start of a string in a text of n bytes: whether it holds a sample in one of that sample's zones."""
    starts = n - length + 1
    low = [at[zones >> k & 1 > 0] - far for k, (_, far) in enumerate(_zones(length))]
    high = [at[zones >> k & 1 > 0] - near + 1 for k, (near, _) in enumerate(_zones(length))]
    return _covered(starts, np.clip(np.concatenate(low), 0, starts), np.clip(np.concatenate(high), 0, starts))


def _result(raw: bytes, repeated: np.ndarray, length: int) -> tuple[int, int, str]:
    """Removed bytes and spans, and the digest of what remains, from the starts of repeated strings."""
    at = np.flatnonzero(repeated)
    gone = _covered(len(raw), at, at + length)
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()


def _pack(raw: bytes) -> bytes:
    """A text for the shuffle: its size and its bytes, compressed."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)


RESULT = "n_removed bigint, n_spans bigint, kept_sha256 string"


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        raws = [(t or "").encode() for t in batch.column("text").to_pylist()]
        key, more = _places(raws)
        packed = pa.array(map(_pack, raws), pa.binary())
        columns = [batch.column("doc_id"), pa.array(key), pa.array(more), packed]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "more", "raw"])


def _settle(length: int):
    """Documents without undecided strings get their result; the others keep text and marks, and so does
    one copy of a text whose samples others must see."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = set()
        for batch in small(batches):
            rows = []
            for doc_id, key, more, packed, marks in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                raw, marks = _unpack(packed), np.array(marks or [], np.int64)
                kind, at = marks & 3, marks >> 6
                undecided = bool((kind == EDGE).any())
                repeated = _strings_through(len(raw), at[kind != EDGE], length) if len(raw) >= length else np.zeros(0, bool)
                result = (None, None, None) if undecided else _result(raw, repeated, length)
                seen = undecided or (bool((kind == SAMPLE).any()) and (key, more) not in shown)
                if seen and not undecided:
                    shown.add((key, more))
                rows.append((doc_id, key, more, len(raw), *result, *((packed, marks) if seen else (None, None))))
            names = ["doc_id", "key", "more", "n_bytes", "n_removed", "n_spans", "kept_sha256", "raw", "marks"]
            kinds = [batch.column(0).type, *[pa.int64()] * 5, pa.string(), pa.binary(), pa.list_(pa.int64())]
            columns = zip(*rows, strict=True) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _open_strings(length: int):
    """Rows (key, place, a, b): identifiers of undecided strings and of those shown to them.

    ``place`` holds the rest of the text's name, two flags and the start. Flags: the string is asked for, and it
    was found equal to another in this task; such a row is spread by its place and needs no partner.
    """
    q = length // 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            parts = []
            for key, more, packed, marks in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                raw, marks = _unpack(packed), np.array(marks, np.int64)
                n, kind, zones, at = len(raw), marks & 3, marks >> 2 & 15, marks >> 6
                block = Block.of([raw])
                ids, own = block.grams(q), block.lowest(q, length)
                lone, open_ = kind == EDGE, kind != RESOLVED
                asked = np.isin(own, ids[at[lone]]) & _in_zones(n, at[lone], zones[lone], length)
                asked &= ~_strings_through(n, at[~lone], length)
                shown = np.isin(own, ids[at[open_]]) & _in_zones(n, at[open_], zones[open_], length)
                start = np.flatnonzero(shown)
                same = np.full(len(start), key), np.full(len(start), more)
                # an odd length is one byte more than two of the q-grams
                halves = block.grams(length - q)
                parts.append((*same, start, halves[start], halves[start + q], asked[start]))
            key, more, start, a, b, asked = _joined(parts, 6)
            first, n = _first_of_equal(a, b)
            known = ~first | (n > 1)
            # the first of equals still looks for others' sake
            keep = first | asked.astype(bool)
            a = np.where(first, a.astype(np.uint64), (key ^ (start * 0x9E37 + more)).view(np.uint64)) if len(key) else a
            place = (more << 32) | start | (asked.astype(np.int64) * ASKED) | (known.astype(np.int64) * KNOWN)
            columns = [pa.array(key), pa.array(place, pa.int64()), _signed(a), _signed(b)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "place", "a", "b"]).filter(pa.array(keep.astype(bool)))

    return run


def _finish(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for packed, marks, starts in zip(*(batch.column(c).to_pylist() for c in range(2, 5)), strict=True):
                raw, marks = _unpack(packed), np.array(marks, np.int64)
                repeated = _strings_through(len(raw), marks[marks & 3 != EDGE] >> 6, length)
                repeated[np.array(starts or [], np.int64)] = True
                rows.append(_result(raw, repeated, length))
            columns = zip(*rows, strict=True) if rows else [()] * 3
            made = [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.string()], strict=True)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs`` (doc_id, text)."""
    if not 2 <= length <= LONGEST:
        raise ValueError(f"a string has 2 to {LONGEST} bytes")
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.mapInArrow(_texts, f"doc_id {id_type}, key bigint, more bigint, raw binary")
    settled = stored(
        texts.join(_marks(docs, length), ["key", "more"], "left")
        .select("doc_id", "key", "more", "raw", "marks")
        .mapInArrow(
            _settle(length),
            f"doc_id {id_type}, key bigint, more bigint, n_bytes bigint, {RESULT}, raw binary, marks array<bigint>",
        )
    )
    rows = settled.where(F.col("raw").isNotNull()).select("key", "more", "raw", "marks")
    strings = rows.mapInArrow(_open_strings(length), "key bigint, place bigint, a bigint, b bigint")
    asked, known = (F.col("place").bitwiseAND(flag) != 0 for flag in (ASKED, KNOWN))
    place, equal = F.struct("key", F.col("place").bitwiseAND(~(ASKED | KNOWN))), Window.partitionBy("a", "b")
    strings = strings.withColumns({"low": F.min(place).over(equal), "high": F.max(place).over(equal)})
    repeated = strings.where(asked & (known | (F.col("low") != F.col("high"))))
    start = F.col("place").bitwiseAND(ASKED - 1).cast("int")
    repeated = repeated.groupBy("key", F.shiftright("place", 32).alias("more")).agg(F.collect_set(start).alias("starts"))
    undecided = settled.where(F.col("n_removed").isNull()).select("doc_id", "key", "more", "n_bytes", "raw", "marks")
    finished = (
        undecided.join(repeated, ["key", "more"], "left")
        .select("doc_id", "n_bytes", "raw", "marks", "starts")
        .mapInArrow(_finish(length), f"doc_id {id_type}, n_bytes bigint, {RESULT}")
    )
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return settled.where(F.col("n_removed").isNotNull()).select(*columns).union(finished)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
