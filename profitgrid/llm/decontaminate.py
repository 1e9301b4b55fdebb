"""Operator 3: benchmark decontamination over a distributed positional inverted index.

``build_index`` stores token postings of the training texts: (shard, term, positions), where a shard holds
some two million words of whole documents and positions count through the shard. Shards are built where
the text is read, so the index costs no shuffle. A benchmark item becomes windows of ten words. For each
shard the lists of a window's terms are intersected from the rarest on, each list moved back by the term's
offset; most windows end at a term that the shard lacks. What is left are exact phrase matches. Proximity
matches are texts where an item's three rarest terms stand close together in any order. Rarest is counted
over all shards and among the terms that some text has, so neither shards nor partitions change a match.

The benchmark is handled in blocks of items of a bounded number of words: only the words of one block
travel to the executors, and the shards read only the postings of its terms, so neither side needs to be
small. Postings of a shard meet in one task; a shard is as large as two million words or one document.

Defined cases: NULL texts have no words; items without words or without item_id take no part; rows with the
same item_id are one item; every document row has its own result, repeated rows and NULL doc_ids included;
other columns are not looked at; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.llm.common import folded_words, prepare, raw_texts, small, stored, table, whole_text

WINDOW = 10
SHARD_WORDS = 2_000_000
BLOCK_WORDS = 200_000
NEAR = 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The letters that lose their case.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text: str | None) -> list[str]:
    """Words of a text after A-Z became lower case."""
    return WORD.findall((text or "").translate(LOWER)) if text else []


def _shard(number: int, docs: list, ids: list[np.ndarray], terms: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Index rows of one shard: a row per term, then one with the documents and their first positions."""
    names = ["shard", "term", "n", "positions", "doc_ids", "starts"]
    all_ids = np.concatenate([np.zeros(0, np.int32), *ids])
    sizes = np.bincount(all_ids, minlength=len(terms)).astype(np.int64)
    order = np.argsort(all_ids, kind="stable").astype("<i4")
    ends = np.concatenate([[0], np.cumsum(sizes) * 4]).astype(np.int64)
    positions = pa.Array.from_buffers(pa.large_binary(), len(terms), [None, pa.py_buffer(ends), pa.py_buffer(order)])
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    empty = pa.nulls(len(terms), pa.list_(pa.int64()))
    doc_ids = pa.nulls(len(terms), pa.list_(docs[1]))
    names_of = pa.array(list(terms), pa.binary()).cast(pa.string())
    columns = [pa.array(np.full(len(terms), number)), names_of, pa.array(sizes)]
    columns += [positions.cast(pa.binary()), doc_ids, empty]
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, len(terms), 20_000):
        yield whole.slice(at, 20_000)
    last = [[number], [None], [len(all_ids)], [None], [docs[0]], [starts]]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(docs[1]), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(last, kinds, strict=True)], names=names)


def _index(shard_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        terms: defaultdict[bytes, int] = defaultdict()
        terms.default_factory = terms.__len__
        docs, ids, held = [], [], 0
        for batch in small(batches):
            id_type = batch.column("doc_id").type
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch), strict=True):
                found = folded_words(raw)
                docs.append(doc_id)
                ids.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
                held += len(found)
                if held >= shard_words or len(docs) >= shard_words // 100:
                    yield from _shard(part + made, [docs, id_type], ids, terms)
                    terms.clear()
                    docs, ids, held, made = [], [], 0, made + 1
        if docs:
            yield from _shard(part + made, [docs, id_type], ids, terms)

    return run


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text): (shard, term, n, positions), and a row without term per
    shard with ``doc_ids`` and ``starts``, the first position of each document and the end of the last."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard bigint, term string, n bigint, positions binary, doc_ids array<{kind}>, starts array<bigint>"
    return stored(docs.mapInArrow(_index(shard_words), schema))


def _blocks(benchmark: DataFrame, block_words: int) -> list[list]:
    """Items (id, words) in blocks whose number follows from the benchmark's size; each comes to the driver
    by itself and is bounded by about ``block_words``."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // (4 * block_words)
    which = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for k in range(blocks):
        rows = ((r.item_id, words(r.text)) for r in items.where(which == k).toLocalIterator())
        yield [(i, w) for i, w in rows if w]


def _windows(items: list, size: int) -> dict[tuple[str, ...], list[int]]:
    """Window -> numbers of the items that have it."""
    found = defaultdict(set)
    for k, (_, w) in enumerate(items):
        for at in range(max(1, len(w) - size + 1)):
            found[tuple(w[at : at + size])].add(k)
    return {w: sorted(k) for w, k in found.items()}


def _among(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_list, values)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == values


def phrase_starts(lists: dict[str, np.ndarray], window: tuple[str, ...]) -> np.ndarray:
    """Positions where the words of ``window`` stand one after the other."""
    if any(w not in lists for w in window):
        return np.zeros(0, np.int32)
    rarest_first = sorted(range(len(window)), key=lambda k: len(lists[window[k]]))
    starts = lists[window[rarest_first[0]]] - rarest_first[0]
    for k in rarest_first[1:]:
        if not len(starts):
            break
        starts = starts[_among(starts + k, lists[window[k]])]
    return starts


def rarest(terms: set[str], counts: dict[str, int]) -> list[str]:
    """The three terms with the lowest counts, rarest first; terms without a count are in no text. Empty if
    fewer are left than an item of so many terms needs."""
    rare = sorted((t for t in terms if t in counts), key=lambda t: (counts[t], t))[:3]
    return rare if len(rare) == min(3, len(terms)) else []


def near_places(
    lists: dict[str, np.ndarray], terms: Iterable[str], near: int, starts: np.ndarray | None = None
) -> np.ndarray:
    """Positions of the first of ``terms`` that have the others within ``near`` words, in any order, and in
    the same document of ``starts``. A set has no first term; its rarest one in ``lists`` is taken."""
    if not terms or any(t not in lists for t in terms):
        return np.zeros(0, np.int32)
    first, *others = sorted(terms, key=lambda t: (len(lists[t]), t)) if isinstance(terms, set) else terms
    at = lists[first]
    for t in others:
        if not len(at):
            break
        low, high = at - near, at + near
        if starts is not None:
            doc = np.searchsorted(starts, at, side="right") - 1
            low, high = np.maximum(low, starts[doc]), np.minimum(high, starts[doc + 1] - 1)
        after = np.searchsorted(lists[t], low)
        close = lists[t][np.minimum(after, len(lists[t]) - 1)]
        at = at[(close >= low) & (close <= high)]
    return at


def _search(items: list, size: int, near: int, id_type: str, counts: dict[str, int]):
    windows = _windows(items, size)
    rare = [rarest(set(w), counts) for _, w in items]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        documents = rows[rows.term.isnull()].iloc[0]
        starts, shard = np.asarray(documents.starts), documents.shard
        postings = rows[rows.term.notnull()]
        lists = {t: np.frombuffer(p, "<i4") for t, p in zip(postings.term, postings.positions, strict=True)}
        hit = np.zeros(starts[-1] + 1, np.int32)
        exact, close = defaultdict(set), defaultdict(set)
        for window, which in windows.items():
            at = phrase_starts(lists, window)
            if not len(at):
                continue
            doc = np.searchsorted(starts, at, side="right") - 1
            inside = (at >= 0) & (at + len(window) <= starts[np.minimum(doc + 1, len(starts) - 1)])
            at, doc = at[inside], doc[inside]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + len(window), -1)
            for d in np.unique(doc).tolist():
                exact[d].update(which)
        for k, terms in enumerate(rare):
            at = near_places(lists, terms, near, starts)
            for d in np.unique(np.searchsorted(starts, at, side="right") - 1).tolist():
                close[d].add(k)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(hit[:-1]) > 0).astype(np.int8), [0]])))
        spans = defaultdict(list)
        for low, high in edges.reshape(-1, 2).tolist():
            first, last = np.searchsorted(starts, [low, high - 1], side="right") - 1
            for d in range(first, last + 1):
                a, b = max(low, starts[d]), min(high, starts[d + 1])
                if a < b and covered[b] > covered[a]:
                    spans[d].append((int(a - starts[d]), int(b - starts[d])))
        found = sorted({*exact, *close})
        columns = {
            "low": [[a for a, _ in spans[d]] for d in found],
            "high": [[b for _, b in spans[d]] for d in found],
            "items": [[items[k][0] for k in sorted(exact[d])] for d in found],
            "near_items": [[items[k][0] for k in sorted(close[d])] for d in found],
        }
        lists_of = {c: pd.Series(v, dtype=object) for c, v in columns.items()}
        return pd.DataFrame({"shard": np.full(len(found), shard), "doc": np.array(found, np.int32), **lists_of})

    lists = f"low array<int>, high array<int>, items array<{id_type}>, near_items array<{id_type}>"
    return run, f"shard bigint, doc int, {lists}"


def matches(
    index: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = NEAR, block_words: int = BLOCK_WORDS
) -> DataFrame | None:
    """(shard, doc, low, high, items, near_items) for each document of the index with a match: the words
    [low, high) that windows hit, the items with an exact window and those with a proximity match."""
    spark, found = index.sparkSession, None
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    for items in _blocks(benchmark, block_words):
        if not items:
            continue
        terms = spark.createDataFrame([(t,) for t in sorted({t for _, w in items for t in w})], "term string")
        counts = index.select("term", "n").join(F.broadcast(terms), "term", "left_semi").groupBy("term")
        counts = {r.term: r.n for r in counts.agg(F.sum("n").alias("n")).collect()}
        needed = index.select("shard", "term", "positions").join(F.broadcast(terms), "term", "left_semi")
        rows = needed.withColumn("starts", F.lit(None).cast("array<bigint>")).unionByName(
            index.where(F.col("term").isNull()).select("shard", "term", "positions", "starts")
        )
        run, schema = _search(items, window, near, id_type, counts)
        block = rows.groupBy("shard").applyInPandas(run, schema)
        found = block if found is None else found.union(block)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items) for each row of ``docs``."""
    index = build_index(docs)
    documents = index.where(F.col("term").isNull()).select(
        "shard", "starts", F.posexplode("doc_ids").alias("doc", "doc_id")
    )
    documents = documents.select(
        "shard", "doc", "doc_id", (F.get("starts", F.col("doc") + 1) - F.get("starts", F.col("doc"))).alias("n_words")
    )
    found = matches(index, benchmark, window)
    if found is None:
        kind = benchmark.schema["item_id"].dataType.simpleString()
        none = f"cast(array() as array<{kind}>)"
        spans = documents.withColumns({"n_hit": F.lit(0).cast("bigint"), "items": F.expr(none), "near": F.expr(none)})
    else:
        merged = found.groupBy("shard", "doc").agg(
            F.flatten(F.collect_list(F.arrays_zip("low", "high"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near"),
        )
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
        n_hit = F.aggregate(
            F.array_sort("spans"),
            zero,
            lambda seen, span: F.struct(
                F.greatest(seen["end"], span["high"]).alias("end"),
                (seen["n"] + F.greatest(F.lit(0), span["high"] - F.greatest(span["low"], seen["end"]))).alias("n"),
            ),
            lambda seen: seen["n"],
        )
        merged = merged.select("shard", "doc", n_hit.alias("n_hit"), "items", "near")
        spans = documents.join(merged, ["shard", "doc"], "left")
    names = F.array_sort(F.transform(F.coalesce("items", F.array()), lambda i: i.cast("string")))
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return spans.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.coalesce(F.size("near"), F.lit(0)).cast("bigint").alias("n_near_items"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text no benchmark window hits."""
    name = F.md5(whole_text())
    found = contamination(docs.select(name.alias("doc_id"), "text"), benchmark)
    found = found.where("contaminated").select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(found, name == F.col("__hit"), "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return contamination(documents, table(spark, sf_dir, "benchmark", "item_id", "text")).drop("n_near_items")


def op3_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op3_decontamination``, and ``n_near_items``, the items with a proximity match."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return contamination(documents, table(spark, sf_dir, "benchmark", "item_id", "text"))


UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size, array_to_string(w[s:s + {WINDOW} - 1], ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - {WINDOW} + 1))) AS s FROM b WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, s, z.size, array_to_string(w[s:s + z.size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS s FROM d) g
  JOIN (SELECT DISTINCT size FROM windows) z ON s + z.size - 1 <= len(w)
), found AS (
  SELECT doc_id, s, size, item_id FROM grams JOIN windows USING (gram, size)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(s, s + size - 1)) AS p FROM found)
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
