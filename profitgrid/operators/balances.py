"""The one pass over loan balances, for weights and for the NPL ratio alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitgrid import rules as R
from profitgrid.functions.columns import bucket_or_1

RISKS = ("rows_bad", "balance_bad", "balance_all", "flow_bad", "flow_all")


def rows_of(weight: str) -> Column:
    """The balance rows that count for a weight. A missing bucket counts as 1."""
    bucket = F.col("max_bucket")
    return {
        R.BALANCE_1: bucket_or_1() == 1,
        R.BALANCE_2: bucket == 2,
        R.BALANCE_2_TO_5: bucket.between(2, 5),
        R.BALANCE_ALL: F.lit(True),
        R.ACTIVATIONS: F.col("psdn") == 1,
    }[weight]


def point_sums(balances: DataFrame) -> DataFrame:
    """All sums that any report needs, per month and point of sale.

    Summing before a dimension is joined leaves few rows however many loans a point of sale has. Sums
    that a report does not use are pruned by Spark. ``sum_*`` and ``rows_*`` belong to a weight; bad
    loans are in bucket 3 or higher; a write-off flows in the month whose snapshot shows it.
    """
    owed, written_off = F.col("outstanding_principal"), F.col("write_off_balance_principal")
    bad = F.col("max_bucket") >= 3
    flow = F.col("kpi_month") == F.col("write_off_month")
    sums = []
    for weight in R.BALANCE_WEIGHTS:
        counted = rows_of(weight)
        value = F.lit(1) if weight == R.ACTIVATIONS else owed
        sums.append(F.sum(F.when(counted, value)).alias(f"sum_{weight}"))
        sums.append(F.count(F.when(counted, 1)).alias(f"rows_{weight}"))
    return balances.groupBy("kpi_month", "pos_cde", "pos_city").agg(
        *sums,
        F.count(F.when(bad, 1)).alias("rows_bad"),
        F.sum(F.when(bad, owed)).alias("balance_bad"),
        F.sum(owed).alias("balance_all"),
        F.sum(F.when(flow & bad, written_off)).alias("flow_bad"),
        F.sum(F.when(flow, written_off)).alias("flow_all"),
    )
