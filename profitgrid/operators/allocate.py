"""Pool allocation: direct amount + pool x weight / total weight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profitgrid.functions.columns import HEAD
from profitgrid.operators.weights import shares


def with_pool(sums: DataFrame) -> DataFrame:
    """Direct rows of year-to-date sums, each with the head-office pool of its metric.

    Without a head-office posting the pool is NULL, and so is every amount allocated from it.
    """
    scopes = Window.partitionBy("year", "month", "metric")  # at most nine rows
    pool = F.max(F.when(F.col("scope") == HEAD, F.col("amount"))).over(scopes)
    return (
        sums.withColumn("pool", pool)
        .where(F.col("scope") != HEAD)
        .withColumnRenamed("scope", "area_cde")
        .withColumnRenamed("amount", "direct")
    )


def allocate(sums: DataFrame, weights: DataFrame) -> DataFrame:
    """Split every pool of ``sums`` by its weight (``weights`` with totals).

    Inner join: a region needs direct postings and a weight to appear, and the share of a region
    that has a weight only is lost (see ``residual``).
    """
    # Weights: at most six kinds x eight regions per report month, so always small enough to ship.
    regions = F.broadcast(
        weights.select(
            "year", "month", "weight", "area_cde", F.col("amount").alias("w"), F.col("total").alias("w_total")
        )
    )
    joined = with_pool(sums).join(regions, ["year", "month", "weight", "area_cde"])
    allocated = F.col("pool").cast("double") * F.col("w") / F.nullif(F.col("w_total"), F.lit(0.0))
    return joined.withColumn("allocated", allocated).withColumn(
        "value", F.col("direct").cast("double") + F.col("allocated")
    )


def residual(sums: DataFrame, weights: DataFrame) -> DataFrame:
    """Part of each pool that reaches no region because weighted regions lack direct postings."""
    scopes = Window.partitionBy("year", "month", "metric")
    pool = F.max(F.when(F.col("scope") == HEAD, F.col("amount"))).over(scopes)
    regions = F.broadcast(
        shares(weights).select("year", "month", "weight", F.col("area_cde").alias("scope"), "share")
    )
    # Decimal, since a sum of doubles would depend on the order of the rows.
    part = (F.col("pool") * F.col("share")).cast("decimal(38,6)")
    allocated = F.coalesce(F.sum(part).cast("double"), F.lit(0.0))
    return (
        sums.withColumn("pool", pool.cast("double"))
        .join(regions, ["year", "month", "weight", "scope"], "left")
        .groupBy("year", "month", "metric")
        .agg(F.max("pool").alias("pool"), allocated.alias("allocated"))
        .where(F.col("pool").isNotNull())
        .select(
            "metric", "year", "month", "pool", "allocated", (F.col("pool") - F.col("allocated")).alias("residual")
        )
    )
