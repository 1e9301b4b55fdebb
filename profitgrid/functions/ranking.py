"""``rank()`` over any number of rows and columns, without a window that holds them all in one task."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitgrid.session import stored_once

VALUES_PER_TASK = 1_000_000
ROW = "_row"


@dataclass(frozen=True)
class Rank:
    """A rank to add. NULL ranks last in both directions.

    With ``among``, a boolean column, only its true rows are ranked; the others get NULL. ``weight`` is what
    the rank counts for in a sum of ranks. Values are compared as doubles.
    """

    column: str
    name: str
    descending: bool = False
    among: str | None = None
    weight: float = 1

    def value(self) -> Column:
        """A number that grows with the place of a value."""
        number = F.col(self.column).cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value
        return F.lit(0.0) - number if self.descending else number


def quantile_bucket(df: DataFrame, column: str, buckets: int) -> Column:
    """Bucket number that grows with the column; about equally many rows in each."""
    return quantile_buckets(df, [column], buckets)[0]


def quantile_buckets(df: DataFrame, columns: list[str], buckets: int) -> list[Column]:
    """For each column a bucket number that grows with it; about equally many rows in each.

    Runs one job for all columns and brings ``buckets - 1`` split points of each to the driver. Any split
    points give right ranks; approximate ones only make buckets less even. A value is compared with the last
    point of each group of points and then with its own group, so thousands of buckets stay cheap.
    """
    points = [i / buckets for i in range(1, buckets)]
    if not points:
        return [F.lit(0) for _ in columns]
    found = df.approxQuantile(columns, points, 0.25 / buckets)
    return [_bucket(c, sorted(set(splits))) for c, splits in zip(columns, found, strict=True)]


def _bucket(column: str, splits: list[float]) -> Column:
    if not splits:
        return F.lit(0)
    size = math.isqrt(len(splits)) + 1
    groups = [splits[i : i + size] for i in range(0, len(splits), size)]
    lasts = F.lit(np.array([group[-1] for group in groups]))
    members = F.array(*[F.lit(np.array(group)) for group in [*groups, [math.inf]]])

    def below(points_of_group: Column) -> Column:
        return F.size(F.filter(points_of_group, lambda point: point < F.col(column)))

    return below(lasts) * size + below(F.get(members, below(lasts)))


def rank_table(long: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, measure, value, place) from rows (``by``, measure, bucket, value): the rank of every value.

    Values are counted first, so one that very many rows share is one row. The rank of a value is one more
    than the rows in earlier buckets of its measure plus the rows with earlier values in its own bucket.
    Buckets must grow with the value; NULL, the last of all, has bucket NULL.
    """
    group = [*by, "measure"]
    counts = long.groupBy(*group, "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    in_bucket = Window.partitionBy(*group, "bucket").orderBy("value").rowsBetween(*earlier)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
    # One row per bucket, so few rows per group.
    buckets = long.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("n"))
    in_group = Window.partitionBy(*group).orderBy(F.asc_nulls_last("bucket")).rowsBetween(*earlier)
    starts = buckets.select(*[F.col(c).alias(f"_{c}") for c in (*group, "bucket")], F.coalesce(F.sum("n").over(in_group), F.lit(0)).alias("start"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, "bucket")])
    return counts.join(starts, same).select(*group, "value", (F.col("start") + F.col("before") + 1).alias("place"))


def add_ranks(
    rows: DataFrame, by: list[str], ranks: list[Rank], values_per_task: int = VALUES_PER_TASK
) -> DataFrame:
    """Add ``rank() over (partition by <by> order by <column>)`` for each of ``ranks``, all in one pass.

    Rows become long ones (row, measure, value). These are counted per value and ranked in buckets of about
    ``values_per_task`` values, joined with their ranks and brought back to one row each. So the shuffles are
    the same, whatever the number of ranks. The rows are read three times and stored once.
    """
    rows = rows.withColumns({f"_value_{i}": r.value() for i, r in enumerate(ranks)})
    rows = stored_once(rows.withColumn(ROW, F.monotonically_increasing_id()))
    values = [f"_value_{i}" for i in range(len(ranks))]
    buckets = quantile_buckets(rows, values, -(-rows.count() // values_per_task))
    cells = [
        F.when(
            F.lit(True) if rank.among is None else F.col(rank.among),
            F.struct(F.lit(i).alias("measure"), F.when(F.col(v).isNotNull(), b).alias("bucket"), F.col(v).alias("value")),
        )
        for i, (rank, v, b) in enumerate(zip(ranks, values, buckets, strict=True))
    ]
    long = rows.select(ROW, *by, F.explode(F.array_compact(F.array(*cells))).alias("_cell")).select(ROW, *by, "_cell.*")
    table = rank_table(long, by).select(
        *[F.col(c).alias(f"_{c}") for c in (*by, "measure")], F.col("value").alias("_value"), "place"
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "measure", "value")])
    placed = long.join(table, same).groupBy(F.col(ROW).alias("_placed")).agg(
        *[F.max(F.when(F.col("measure") == i, F.col("place"))).alias(r.name) for i, r in enumerate(ranks)]
    )
    return rows.join(placed, F.col(ROW) == F.col("_placed"), "left").drop(ROW, "_placed", *values)


def rank_sum(
    rows: DataFrame,
    by: list[str],
    score: str,
    ranks: list[Rank],
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Add the ranks and their weighted sum as ``score``; the lowest score is best."""
    ranked = add_ranks(rows, by, ranks, values_per_task)
    parts = [F.col(r.name) if r.weight == 1 else F.col(r.name) * F.lit(r.weight) for r in ranks]
    return ranked.withColumn(score, reduce(add, parts))
