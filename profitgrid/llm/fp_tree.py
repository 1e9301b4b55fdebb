"""Operator 13: ranked lexical search by branch and bound over document FP-trees.

One pass over the texts keeps of each document its length and its restricted term vector: the terms that
some item of the block asks for, with their frequencies. These vectors are stored; counts of documents and
words over all of them give weights and lengths. Then each task puts its documents, shard by shard, into an
FP-tree: vectors list their terms from the most frequent to the rarest, so documents share paths from the
root. Every node knows for each term below it the largest frequency and for all of its documents the
smallest length; a term's node list (the header of the tree) leads to these maxima. For an item the two give
each node a score that none of its documents can exceed. The search goes depth first, the most promising
child first, and turns round where the bound is below the k-th best score so far. Nodes of few documents are
not divided further but scored. The best of all shards meet in one ranking per item.

Items are handled in blocks of a bounded number of terms; only the terms of one block travel to the tasks,
each block reads the texts once. No text is shuffled; what is shuffled are the vectors, dealt out evenly, and k
rows per item and shard.

Defined cases: NULL and texts without terms are in no ranking and not counted; rows with the same item_id
(NULL included) are one item with the terms of all its texts; an item without terms that occur has no rows;
every document row is ranked by itself, repeated rows too; equal scores go by doc_id, NULL last; other columns
are not looked at; an empty table of either kind gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.llm.common import folded_words, prepare, raw_texts, small, stored, table

BEST = 10
BLOCK_TERMS = 200_000
SHARD_DOCS = 8_192
SHARD_ENTRIES = 2_000_000
LEAF = 48


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, terms, n): the different terms of each item that has some."""
    prepare(benchmark.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = pa.array([sorted(set(folded_words(t))) for t in raw_texts(batch)], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), found], names=["item_id", "terms"])

    rows = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<binary>")
    found = rows.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))
    return found.withColumn("n", F.size("terms")).where(F.col("n") > 0)


def vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): length and restricted vector of each document with terms. ``number`` counts from 1."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.get
        for batch in small(batches):
            sizes, found, counts = [], [], []
            for raw in raw_texts(batch):
                terms = folded_words(raw)
                ids = np.array(list(filter(None, map(known, terms))), np.int32)
                values, times = np.unique(ids, return_counts=True)
                sizes.append(len(terms))
                found.append(values)
                counts.append(times.astype(np.int32))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *x])))
                for x in (found, counts)
            ]
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists]
            made = pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tf"])
            yield made.filter(pa.array(np.array(sizes, np.int64) > 0, pa.bool_()))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tf array<int>")


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of a term's weight, in millionths; grows with tf and falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class FpTree:
    """FP-tree of one shard. ``ptr``, ``ranks``, ``tf`` are the vectors of the documents, terms by rank (0: most
    frequent) in rising order; ``m`` their lengths and ``tie`` their places among equal scores."""

    def __init__(self, ptr: np.ndarray, ranks: np.ndarray, tf: np.ndarray, m: np.ndarray, tie: np.ndarray, leaf: int):
        raw = ranks.astype(">u4").tobytes()
        paths = [raw[4 * a : 4 * b] for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
        self.row = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        size = np.diff(ptr)[self.row]
        self.ptr = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(ptr[:-1][self.row] - self.ptr[:-1], size) + np.arange(self.ptr[-1])
        self.ranks, self.tf = ranks[at], tf[at].astype(np.int64)
        self.m, self.tie = m[self.row], tie[self.row]
        self._grow(self._shared(size), leaf)
        self._summarize(int(ranks.max()) + 1 if len(ranks) else 0)

    def _shared(self, size: np.ndarray) -> np.ndarray:
        """For each document the length of the path that it shares with the one before."""
        shared = np.zeros(len(size), np.int64)
        same = np.arange(1, len(size))
        depth = 0
        while len(same):
            same = same[np.minimum(size[same], size[same - 1]) > depth]
            same = same[self.ranks[self.ptr[same] + depth] == self.ranks[self.ptr[same - 1] + depth]]
            depth += 1
            shared[same] = depth
        return shared

    def _grow(self, shared: np.ndarray, leaf: int) -> None:
        """Nodes as ranges of documents: subtrees of more than ``leaf`` documents are divided where their
        paths part, and small neighbours below one parent are put together in one node that is not."""
        low, high, children = [0], [len(shared)], [[]]
        todo = [0] if len(shared) > leaf else []
        while todo:
            node = todo.pop()
            a, b = low[node], high[node]
            inside = shared[a + 1 : b]
            cuts = [a, *(np.flatnonzero(inside == inside.min()) + a + 1).tolist(), b]
            parts, start = [], a
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if y - start > leaf and x > start:
                    parts.append((start, x))
                    start = x
                if y - start > leaf:
                    parts.append((start, y))
                    start = y
            if start < b:
                parts.append((start, b))
            for x, y in parts:
                children[node].append(len(low))
                if y - x > leaf:
                    todo.append(len(low))
                low.append(x)
                high.append(y)
                children.append([])
        self.low, self.high, self.children = np.array(low), np.array(high), children

    def _summarize(self, n_terms: int) -> None:
        """The header: for each term the nodes above it with the largest frequency; the smallest length per node."""
        self.least_m = np.array([self.m[a:b].min() if b > a else 1 for a, b in zip(self.low, self.high, strict=True)])
        nodes, terms, most = [], [], []
        for node, (a, b) in enumerate(zip(self.low.tolist(), self.high.tolist(), strict=True)):
            part = slice(self.ptr[a], self.ptr[b])
            largest = np.zeros(n_terms, np.int64)
            np.maximum.at(largest, self.ranks[part], self.tf[part])
            there = np.flatnonzero(largest)
            nodes.append(np.full(len(there), node, np.int32))
            terms.append(there)
            most.append(largest[there])
        by_term = np.argsort(np.concatenate(terms), kind="stable")
        self.header = np.searchsorted(np.concatenate(terms)[by_term], np.arange(n_terms + 1))
        self.nodes, self.most = np.concatenate(nodes)[by_term], np.concatenate(most)[by_term]
        self.column = np.full(n_terms, -1, np.int64)

    def bounds(self, ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node a score that no document below it exceeds."""
        largest = np.zeros((len(self.low), len(ranks)), np.int64)
        for j, r in enumerate(ranks.tolist()):
            part = slice(self.header[r], self.header[r + 1])
            largest[self.nodes[part], j] = self.most[part]
        return gain(largest, self.least_m[:, None]) @ weights

    def best(self, ranks: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best documents, best first."""
        inside = ranks < len(self.column)
        ranks, weights = ranks[inside], weights[inside]
        bound = self.bounds(ranks, weights)
        self.column[ranks] = np.arange(len(ranks))
        found, scores, least, todo = np.zeros(0, np.int64), np.zeros(0, np.int64), 1, [0]
        while todo:
            node = todo.pop()
            if bound[node] < least:
                continue
            if below := self.children[node]:
                todo += sorted((c for c in below if bound[c] >= least), key=bound.__getitem__)
                continue
            a, b = int(self.low[node]), int(self.high[node])
            part = slice(self.ptr[a], self.ptr[b])
            column = self.column[self.ranks[part]]
            asked = np.flatnonzero(column >= 0)
            doc = np.searchsorted(self.ptr[a : b + 1], asked + self.ptr[a], side="right") - 1
            score = np.zeros(b - a, np.int64)
            np.add.at(score, doc, weights[column[asked]] * gain(self.tf[part][asked], self.m[a + doc]))
            good = np.flatnonzero(score >= least)
            if len(good):
                found, scores = np.concatenate([found, good + a]), np.concatenate([scores, score[good]])
                order = np.lexsort((self.tie[found], -scores))[:k]
                found, scores = found[order], scores[order]
                if len(found) == k:
                    least = int(scores[-1])
        self.column[ranks] = -1
        return self.row[found], scores


def _search(items: list, weight: np.ndarray, rank: np.ndarray, n_docs: int, n_words: int, k: int, shard_docs: int, leaf: int):
    """The function of a task: for each shard and item (number, term numbers) the k best documents."""

    def of_shard(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        ids, terms = rows.column("doc_id").combine_chunks(), rows.column("terms").combine_chunks()
        ptr = terms.offsets.to_numpy().astype(np.int64)
        ranks, tf = rank[terms.flatten().to_numpy()], rows.column("tf").combine_chunks().flatten().to_numpy()
        ptr -= ptr[0]
        by_rank = np.lexsort((ranks, np.repeat(np.arange(len(ids)), np.diff(ptr))))
        values = ids.to_pylist()
        tie = np.empty(len(values), np.int64)
        tie[sorted(range(len(values)), key=lambda i: (values[i] is None, values[i] or 0))] = np.arange(len(values))
        m = 10 + (90 * rows.column("n").to_numpy() * n_docs) // n_words
        tree = FpTree(ptr, ranks[by_rank], tf[by_rank], m, tie, leaf)
        numbers, found, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for number, asked in items:
            at, score = tree.best(rank[asked], weight[asked], k)
            numbers += [number] * len(at)
            found.append(at)
            scores.append(score)
        columns = [pa.array(numbers, pa.int64()), ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(scores))]
        return pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, entries = [], 0, 0
        for batch in small(batches):
            held.append(batch)
            docs += len(batch)
            entries += len(batch.column("terms").flatten())
            if docs >= shard_docs or entries >= SHARD_ENTRIES:
                yield of_shard(held)
                held, docs, entries = [], 0, 0
        if held:
            yield of_shard(held)

    return run


def _block(docs: DataFrame, items: list, k: int, shard_docs: int, leaf: int) -> DataFrame:
    """(item, doc_id, score): for each shard of ``docs`` and each (number, terms) of ``items`` the k best."""
    number = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}), 1)}
    rows = stored(vectors(docs, number))
    n_docs, n_words = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = np.zeros(len(number) + 1, np.int64)
    for term, n in holders:
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    asked = [(i, np.array([x for t in terms if df[x := number[t]]], np.int64)) for i, terms in items]
    asked = [(i, terms) for i, terms in asked if len(terms)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    search = _search(asked, weight, rank, n_docs, n_words, k, shard_docs, leaf)
    rows = rows.repartition(max(1, -(-n_docs // shard_docs)))  # vectors are a tenth of the texts; even shards, and enough
    return rows.mapInArrow(search, f"item bigint, doc_id {kind}, score bigint")


def ranked(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = BEST,
    block_terms: int = BLOCK_TERMS,
    shard_docs: int = SHARD_DOCS,
    leaf: int = LEAF,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item, scores above 0."""
    items = stored(items_of(benchmark))
    blocks = 1 + (items.agg(F.sum("n")).first()[0] or 0) // block_terms
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for b in range(blocks):
        rows = items.where(block == b).collect()
        if not rows:
            continue
        names = docs.sparkSession.createDataFrame(
            [(i, r.item_id) for i, r in enumerate(rows)], f"item bigint, item_id {items.schema['item_id'].dataType.simpleString()}"
        )
        here = _block(docs, [(i, [bytes(t) for t in r.terms]) for i, r in enumerate(rows)], k, shard_docs, leaf)
        here = stored(here.join(F.broadcast(names), "item").drop("item"))
        found = here if found is None else found.union(here)
    if found is None:
        kinds = {c: d.schema[c].dataType.simpleString() for c, d in (("item_id", items), ("doc_id", docs))}
        kind = f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score bigint"
        return docs.sparkSession.createDataFrame([], kind)
    best_first = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return placed.select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for every benchmark item."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return ranked(documents, table(spark, sf_dir, "benchmark", "item_id", "text"))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), s AS (
  SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) SEMI JOIN q USING (term)
  GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), scores AS (
  SELECT item_id, r, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM tf JOIN q USING (term) JOIN weights USING (term), s
  GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
  doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= {BEST}
"""
