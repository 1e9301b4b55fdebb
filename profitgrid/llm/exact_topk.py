"""Operator 2: exact top-k search by the threshold algorithm over sorted lists, one per dimension.

The score is the inner product of whole-number vectors. Candidates are dealt into blocks of bounded size;
a block keeps, for each dimension, its rows sorted by that component. A query reads the lists of its
nonzero components from the end that suits their sign, all to the same depth, which doubles from round to
round; rows seen for the first time are scored in full. A row not seen yet scores at most the sum of
component times list value at the present depth. As soon as this bound is below the k-th best score, no
unseen row can matter, ties included, and the search stops.

Queries are a stated subset of the rows and go to every block (queries times blocks, not rows times rows);
each block returns k rows a query, and a window per query ranks them. Blocks and query blocks have fixed
sizes, so tasks do not grow with the table. All scores are exact: products are summed in 32- or 64-bit
floats only where every possible sum is a whole number they hold exactly, else as Python integers.

Defined cases: a vector that is NULL or holds a NULL or non-finite component takes no part, nor does a row
without vec_id; of rows with the same vec_id the smallest vector stays; shorter vectors count as filled up
with zeros; a query of zeros scores 0 everywhere, so the smallest vec_ids win; fewer than k candidates are
all returned; equal scores are ranked by vec_id; other columns are not looked at. Sums must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.llm.common import prepare, small, stored, table

K = 20
SCALE = 64
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
FIRST_DEPTH = 256
TOGETHER = 64


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): components as floor(scale * x), one row per vec_id."""
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )
    vector = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    rows = embeddings.where(usable).select("vec_id", vector.alias("vector"))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """(block, n, ids, cells): the rows of a block by vec_id, ids and row-wise components as int64."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        width = int(group.vector.map(len).max())
        cells = np.zeros((len(group), width), "<i8")
        for row, vector in zip(cells, group.vector, strict=True):
            row[: len(vector)] = vector
        ids = group.vec_id.to_numpy().astype("<i8").tobytes()
        return pd.DataFrame({"block": [group.block.iloc[0]], "n": [len(group)], "ids": [ids], "cells": [cells.tobytes()]})

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    return rows.select("vec_id", "vector", block).groupBy("block").applyInPandas(
        pack, "block bigint, n bigint, ids binary, cells binary"
    )


class SortedLists:
    """A block of candidates with its sorted lists."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray) -> None:
        self.ids, self.cells = ids, cells
        self.largest = int(np.abs(cells).max(initial=0))
        n, width = cells.shape
        ascending = np.argsort(cells, axis=0, kind="stable").T
        self.reach, self.edge = [], []
        depth = min(FIRST_DEPTH, n)
        while True:
            seen = np.zeros((2 * width, n), bool)  # list j from its small end, list width + j from its large end
            np.put_along_axis(seen[:width], ascending[:, :depth], True, 1)
            np.put_along_axis(seen[width:], ascending[:, n - depth :], True, 1)
            self.reach.append(np.packbits(seen, axis=1))
            dims = np.arange(width)
            low, high = cells[ascending[:, depth - 1], dims], cells[ascending[:, n - depth], dims]
            self.edge.append(np.concatenate([low, high]))
            if depth == n:
                break
            depth = min(2 * depth, n)
        self._as: dict[type, np.ndarray] = {}

    def _cells(self, queries: np.ndarray) -> np.ndarray:
        """The components in the cheapest kind of number that holds every partial sum exactly."""
        largest = self.largest * int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
        kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else object
        if kind not in self._as:
            self._as[kind] = self.cells.astype(kind)
        return self._as[kind]

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """For each query: ids and scores of the k best rows other than its own, and how many rows it saw.

        The queries go through the rounds together: rows that any of them sees for the first time are
        scored as one product of matrices, and each query takes the scores of the rows that it has seen.
        """
        n, width = self.cells.shape
        cells = self._cells(queries)
        weights = queries.astype(cells.dtype)
        skip = np.searchsorted(self.ids, own)
        skip[self.ids[np.minimum(skip, n - 1)] != own] = -1
        used = [np.flatnonzero(q) for q in queries]
        lists = [u + width * (q[u] > 0) for u, q in zip(used, queries, strict=True)]
        known = np.zeros((len(own), -(-n // 8)), np.uint8)
        best = [(np.zeros(0, np.int64), np.zeros(0, cells.dtype))] * len(own)
        running = [i for i, u in enumerate(used) if len(u)]
        for i in set(range(len(own))) - set(running):
            rows = np.arange(min(k + 1, n))
            rows = rows[rows != skip[i]][:k]
            best[i] = rows, np.zeros(len(rows), cells.dtype)
        for reach, edge in zip(self.reach, self.edge, strict=True):
            if not running:
                break
            now = np.array([np.bitwise_or.reduce(reach[lists[i]], axis=0) for i in running])
            new = np.unpackbits(now & ~known[running], axis=1, count=n).astype(bool)
            known[running] = now
            any_new = np.flatnonzero(new.any(axis=0))
            scores, new = weights[running] @ cells[any_new].T, new[:, any_new]
            still = []
            for a, i in enumerate(running):
                least = best[i][1].min() if len(best[i][0]) == k else -np.inf
                at = np.flatnonzero(new[a] & (scores[a] >= least) & (any_new != skip[i]))
                found = np.concatenate([best[i][0], any_new[at]]), np.concatenate([best[i][1], scores[a, at]])
                best[i] = _best(*found, k)
                bound = edge[lists[i]].astype(cells.dtype) @ weights[i, used[i]]
                if len(best[i][0]) < k or best[i][1].min() <= bound:
                    still.append(i)
            running = still
        result = []
        for i, (rows, scores) in enumerate(best):
            order = np.lexsort((rows, -scores))
            seen = int(np.bitwise_count(known[i]).sum())
            result.append((self.ids[rows[order]], scores[order].astype(np.int64), seen))
        return result


def _best(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, of equal ones the first rows."""
    if len(rows) <= k:
        return rows, scores
    at = len(rows) - k
    kth = sorted(scores)[at] if scores.dtype == object else np.partition(scores, at)[at]
    keep = np.flatnonzero(scores >= kth)
    keep = keep[np.lexsort((rows[keep], -scores[keep]))][:k]
    return rows[keep], scores[keep]


def _search(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lists = None, None
        for batch in small(batches):
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, ids = row["block"], np.frombuffer(row["ids"], "<i8")
                    cells = np.frombuffer(row["cells"], "<i8").reshape(row["n"], -1)
                    lists = SortedLists(ids, cells)
                own = np.frombuffer(row["query_ids"], "<i8")
                queries = np.frombuffer(row["query_cells"], "<i8").reshape(len(own), -1)
                width = lists.cells.shape[1]
                if queries.shape[1] < width:
                    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
                found = []
                for at in range(0, len(own), TOGETHER):
                    found += lists.search(own[at : at + TOGETHER], queries[at : at + TOGETHER, :width], k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, [len(f[0]) for f in found])),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                        pa.array(np.repeat([f[2] for f in found], [len(f[0]) for f in found])),
                    ],
                    names=["query_id", "vec_id", "score", "scored"],
                )

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for every row of ``vectors`` that ``is_query`` marks."""
    prepare(vectors.sparkSession)
    vectors = stored(vectors)
    queries = vectors.where(is_query)
    blocks = max(1, -(-vectors.count() // block_rows))
    parts = max(1, -(-queries.count() // QUERY_ROWS))
    asked = _packed(queries, parts).select(F.col("ids").alias("query_ids"), F.col("cells").alias("query_cells"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    pairs = stored(_packed(vectors, blocks)).join(asked, "block")
    pairs = pairs.repartitionById(blocks, F.col("block").cast("int"))  # a task each; a hash puts several into one
    found = pairs.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint, scored bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


SQL = """
WITH whole AS (
  SELECT vec_id, min([CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id
), cells AS (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM whole
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM cells q JOIN cells c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
  GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
