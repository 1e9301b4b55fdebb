"""Operator 6: SimHash near-duplicates, found by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits are cut into two halves (fewer segments than
bits, so not every link has an equal half): one half differs in at most one bit. Each half is therefore
indexed once as it is and 32 times with one bit wild; fingerprints meet by equality of (half, wild bit,
remaining bits) and are then verified on all 64 bits. In the index of a wild bit only fingerprints on
different sides of that bit are compared, since those on one side are equal there and meet in the index
of the whole half.

Copies share a fingerprint and are indexed once. A bucket of the index yields a spanning forest of its
links, never all pairs: the components are those of all links. A bucket with more fingerprints than
``BUCKET`` is dealt out anew: its links differ in at most three bits of the other half, so one of the
half's four bytes is equal, and once more by pieces of six bits of the remaining 24. What is left then
holds at most 2^19 fingerprints, whatever the data, so no task grows with the corpus.

Defined cases: a NULL text counts as empty; a text without words has fingerprint zero and is linked like
any other; fewer than three words are one shingle; repeated rows each get their row; a row without doc_id
joins its component and does not name it (NULL if the component has no doc_id at all); other columns are
not looked at. Shingles of very long texts are hashed in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.llm.common import per_row, small, stored, table, whole_text, unused
from profitgrid.llm.components import components

SHINGLE = 3
DISTANCE = 3
FINGERPRINTS_PER_TASK = 20_000
SEED = 42
BUCKET = 4096
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the text's word shingles, as an unsigned integer."""
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    line = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words])
    starts, ends = np.concatenate([[0], stops[:-1]]), stops - 1
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)
        hashes = np.array([digest(line[i:j], SEED) for i, j in pairs], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """All columns but the text, and ``bits``: the fingerprint as a signed long."""

    def make() -> Callable[[str], tuple]:
        def row(value: str) -> tuple:
            found = fingerprint(value, shingle)
            return (found - (1 << 64) if found >> 63 else found,)

        return row

    return per_row(docs, text, "bits bigint", make)


def variants(distinct: DataFrame) -> DataFrame:
    """(key, side, bits): 33 entries for each half of a fingerprint.

    The key packs half, wild bit (32: none) and the other bits of the half; side is the wild bit itself.
    """
    halves = [F.shiftrightunsigned("bits", 32), F.col("bits").bitwiseAND(0xFFFFFFFF)]
    entries = []
    for h, half in enumerate(halves):
        for wild in range(33):
            tag = F.lit((h * 33 + wild) << 32)
            kept = half if wild == 32 else half.bitwiseAND(0xFFFFFFFF ^ (1 << wild))
            side = F.lit(0) if wild == 32 else F.shiftright(half, wild).bitwiseAND(1).cast("int")
            entries.append(F.struct(tag.bitwiseOR(kept).alias("key"), side.alias("side")))
    return distinct.select("bits", F.explode(F.array(*entries)).alias("e")).select("e.key", "e.side", "bits")


def _other_half() -> Column:
    """The half that the key does not hold."""
    first = F.shiftright(F.col("key"), 32) < 33
    return F.when(first, F.col("bits").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("bits", 32))


def _pieces(used: Column | None) -> Column:
    """Ways to deal out a large bucket: byte number and value, or the six-bit pieces of the other bytes."""
    other = _other_half()
    if used is None:
        return F.array(
            *(F.shiftright(other, 8 * i).bitwiseAND(255).bitwiseOR(i << 8).alias(f"p{i}") for i in range(4))
        )
    number = F.shiftright(used, 8)
    rest = F.lit(0).cast("bigint")
    for i in range(4):
        below = other.bitwiseAND((1 << (8 * i)) - 1)
        above = F.shiftright(other, 8 * (i + 1))
        rest = F.when(number == i, F.shiftleft(above, 8 * i).bitwiseOR(below)).otherwise(rest)
    return F.array(*(F.shiftright(rest, 6 * i).bitwiseAND(63).bitwiseOR(i << 8) for i in range(4)))


def _forest(left: np.ndarray, right: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that connect what all links between the two sides connect; one array twice: within it.

    A search from side to side: what a fingerprint reaches is taken out, so each is reached once.
    """
    within = left is right
    todo = [left, left if within else right]
    queue: list[tuple[int, np.uint64]] = []
    while queue or (len(todo[0]) and len(todo[1])):
        if not queue:
            queue.append((0, todo[0][0]))
            todo[0] = todo[0][1:]
            if within:
                todo[1] = todo[0]
        side, value = queue.pop()
        pool = todo[1 - side]
        near = np.bitwise_count(pool ^ value) <= distance
        found, todo[1 - side] = pool[near], pool[~near]
        if within:
            todo = [todo[1 - side]] * 2
        yield from ((value, x) for x in found)
        queue.extend((1 - side, x) for x in found)


def _links(distance: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ends: list[tuple[int, int]] = []
            for zeros, ones, whole in zip(*(batch.column(c) for c in ("zeros", "ones", "whole")), strict=True):
                a, b = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (zeros, ones))
                ends += _forest(a, a if whole.as_py() else b, distance)
            both = np.array(ends, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return run


def links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Verified links (a, b) of distinct fingerprints that connect the same components as all links do."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with one wild bit find distances up to 3")
    distinct = stored(distinct)
    tasks = -(-distinct.count() // FINGERPRINTS_PER_TASK)  # a fingerprint is 8 bytes, its entries are 66 rows
    entries = variants(distinct.repartition(max(1, tasks)))
    found = None
    for level in range(3):
        keys = ["key", "p1", "p2"][: level + 1]
        sizes = entries.groupBy(*keys).agg(
            F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high")
        )
        whole = F.shiftright("key", 32) % 33 == 32
        sizes = sizes.where((F.col("n") > 1) & ((F.col("low") < F.col("high")) | whole)).drop("low", "high")
        shared = entries.join(sizes, keys)
        fits = shared if level == 2 else shared.where(F.col("n") <= bucket)
        lists = fits.groupBy(*keys).agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("bits"))).alias("zeros"),
            F.collect_list(F.when(F.col("side") == 1, F.col("bits"))).alias("ones"),
        )
        at_level = lists.select("zeros", "ones", whole.alias("whole")).mapInArrow(_links(distance), "a bigint, b bigint")
        found = at_level if found is None else found.union(at_level)
        if level < 2:
            large = shared.where(F.col("n") > bucket)
            piece = F.explode(_pieces(None if level == 0 else F.col("p1")))
            entries = large.select("key", "side", "bits", *(["p1"] if level else []), piece.alias(f"p{level + 1}"))
    return found.distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each document."""
    rows = stored(fingerprints(docs.select(doc_id, text), shingle, text))
    named = _components(rows, doc_id, distance)
    return rows.join(named, "bits").select(
        doc_id, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(rows: DataFrame, member: str, distance: int) -> DataFrame:
    """(bits, component_id): for each fingerprint the smallest ``member`` of its component."""
    classes = rows.groupBy("bits").agg(F.min(member).alias("first_id"))
    roots = components(links(classes.select("bits"), distance))
    classes = classes.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
    classes = classes.withColumn("root", F.coalesce("root", "bits"))
    named = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return classes.join(named, "root").select("bits", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and others) without all but one document of each component.

    The one with the smallest doc_id stays (rows without doc_id come last); of rows with the same doc_id the
    one whose text has the smallest digest, and of rows that repeat both the one whose other columns, as JSON,
    have the smallest hash.
    """
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.md5(whole_text()).alias("name"))
    rows = stored(fingerprints(docs.select(member.alias("member"), "text"), shingle))
    stay = _components(rows, "member", distance).select("component_id.*").distinct()
    name, row, stay_id, stay_name = (unused(docs, c) for c in ("_name", "_row", "_stay_id", "_stay_name"))
    stay = stay.select(F.col("doc_id").alias(stay_id), F.col("name").alias(stay_name))
    same = F.col("doc_id").eqNullSafe(F.col(stay_id)) & (F.col(name) == F.col(stay_name))
    kept = docs.withColumn(name, F.md5(whole_text())).join(stay, same, "left_semi")
    others = F.xxhash64(F.to_json(F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c not in ("doc_id", "text")))))
    least = F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), others).alias(row)
    return kept.groupBy("doc_id", name).agg(least).select(f"{row}.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
