"""Non-performing-loan ratio before write-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitgrid.operators.balances import RISKS
from profitgrid.periods import Periods


def risk_by_area(sums: DataFrame, city: DataFrame, periods: Periods, fan_out: bool = True) -> DataFrame:
    """Balances and write-off flows per month and region, bad loans and all loans, from ``point_sums``.

    The report has always joined on the city, so a loan counts once per point of sale of its city;
    ``fan_out=False`` joins on the point of sale instead. Sums are multiplied by the number of
    points of sale, so the join never makes copies of rows.
    """
    key = "pos_city" if fan_out else "pos_cde"
    points = city.groupBy(key, "area_cde").agg(F.count(F.lit(1)).alias("points"))
    return (
        sums.where(periods.keys("kpi_month"))
        .join(points, key)
        .groupBy(
            F.expr("cast(kpi_month div 100 as int)").alias("year"),
            (F.col("kpi_month") % 100).cast("int").alias("month"),
            "area_cde",
        )
        .agg(*[F.sum(F.col(c) * F.col("points")).alias(c) for c in RISKS])
        .repartition("year")  # few rows from here on; later steps all group by year
    )


def zero_filled(risk: DataFrame) -> DataFrame:
    """Months without a write-off have a flow of zero."""
    return risk.withColumn("flow_bad", F.coalesce("flow_bad", F.lit(0))).withColumn(
        "flow_all", F.coalesce("flow_all", F.lit(0))
    )


def long_by_side(risk: DataFrame) -> DataFrame:
    """Numerator (``bad``) and denominator (``all``) as rows; regions without bad loans have no ``bad``."""
    sides = F.array(
        *[
            F.struct(
                F.lit(side).alias("side"),
                rows.alias("n"),
                F.col(f"balance_{side}").alias("balance"),
                F.col(f"flow_{side}").alias("flow"),
            )
            for side, rows in (("bad", F.col("rows_bad")), ("all", F.lit(1).cast("long")))
        ]
    )
    return (
        risk.select("year", "month", "area_cde", F.explode(sides).alias("s"))
        .where("s.n > 0")
        .select("year", "month", "area_cde", "s.side", "s.balance", "s.flow")
    )


def running_write_off(risk: DataFrame) -> DataFrame:
    """Write-offs cumulated from January, per region and side."""
    to_date = Window.partitionBy("year", "area_cde", "side").orderBy("month")
    return long_by_side(zero_filled(risk)).withColumn("written_off", F.sum("flow").over(to_date))


def average_before_write_off(risk: DataFrame, periods: Periods) -> DataFrame:
    """Mean over the months of balance plus cumulated write-off, one column per side."""
    before = (F.col("balance") + F.col("written_off")).alias("before")

    def mean(side: str) -> Column:
        value = F.when(F.col("side") == side, F.col("before"))
        return (F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))).alias(f"avg_{side}")

    return (
        periods.to_report_months(running_write_off(risk).select("year", "month", "area_cde", "side", before))
        .groupBy("year", "month", "area_cde")
        .agg(mean("bad"), mean("all"), F.count(F.when(F.col("side") == "bad", 1)).alias("n"))
        .where("n > 0")
        .drop("n")
    )


def npl_ratio(risk: DataFrame, periods: Periods) -> DataFrame:
    """Bad loans before write-off in percent of all loans before write-off."""
    ratio = F.col("avg_bad") * 100.0 / F.nullif(F.col("avg_all"), F.lit(0.0))
    return average_before_write_off(risk, periods).select("year", "month", "area_cde", ratio.alias("npl"))
