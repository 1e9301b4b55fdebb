"""Weights that split a head-office pool over regions: balances, activations, headcount."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitgrid import rules as R
from profitgrid.operators.sheet import complete_january
from profitgrid.periods import Periods


def monthly_by_area(
    sums: DataFrame, city: DataFrame, keys: Column, weights: Iterable[str] = R.BALANCE_WEIGHTS
) -> DataFrame:
    """(year, month, area_cde, weight, total) from ``point_sums``, all weights in one pass.

    A region with no matching row in a month has no row here; one whose matching rows hold only
    NULLs has a NULL total.
    """
    weights = sorted(weights)
    columns = [c for w in weights for c in (f"sum_{w}", f"rows_{w}")]
    per_area = (
        sums.where(keys)
        .join(city.select("pos_cde", "area_cde"), "pos_cde")
        .select(
            F.expr("cast(kpi_month div 100 as int)").alias("year"),
            (F.col("kpi_month") % 100).cast("int").alias("month"),
            "area_cde",
            *columns,
        )
        .groupBy("year", "month", "area_cde")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .repartition("year")  # few rows from here on; later steps all group by year
    )
    stacked = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(w).alias("weight"),
                    F.col(f"sum_{w}").alias("total"),
                    F.col(f"rows_{w}").alias("n"),
                )
                for w in weights
            ]
        )
    )
    return (
        per_area.select("year", "month", "area_cde", stacked.alias("s"))
        .where("s.n > 0")
        .select("year", "month", "area_cde", "s.weight", "s.total")
    )


def over_report_months(monthly: DataFrame, periods: Periods) -> DataFrame:
    """Year-to-date weight: activations add up, balances are averaged over the months present."""
    total, months = F.sum("total").cast("double"), F.nullif(F.count("total"), F.lit(0))
    amount = F.when(F.col("weight") == R.ACTIVATIONS, total).otherwise(total / months)
    return (
        periods.to_report_months(monthly)
        .groupBy("year", "month", "weight", "area_cde")
        .agg(amount.alias("amount"))
    )


def balance_weights(
    sums: DataFrame, city: DataFrame, periods: Periods, weights: Iterable[str] = R.BALANCE_WEIGHTS
) -> DataFrame:
    monthly = monthly_by_area(sums, city, periods.keys("kpi_month"), weights)
    return over_report_months(monthly, periods)


def headcount_weights(sales: DataFrame, area: DataFrame, periods: Periods) -> DataFrame:
    """Sales managers per region with a complete January, the same for each month of the year."""
    per_name = (
        complete_january(sales.where(periods.in_years("year")))
        .groupBy("year", "area_name")
        .agg(F.count("sale_name").cast("double").alias("amount"))
    )
    months = F.explode(F.array(*[F.lit(m) for m in periods.months]))
    return per_name.join(F.broadcast(area), "area_name").select(  # area: one row per letter
        "year", months.alias("month"), F.lit(R.HEADCOUNT).alias("weight"), "area_cde", "amount"
    )


def with_total(weights: DataFrame) -> DataFrame:
    """Add the total over all regions; at most eight rows share a total.

    Averages are added in the order of the letters, so that every run gives the same last digit.
    """
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    regions = Window.partitionBy("year", "month", "weight").orderBy("area_cde").rowsBetween(*whole)
    return weights.withColumn("total", F.sum("amount").over(regions))


def all_weights(
    sums: DataFrame,
    city: DataFrame,
    sales: DataFrame,
    area: DataFrame,
    periods: Periods,
    weights: set[str],
) -> DataFrame:
    """The requested weights with their totals; a source that no weight needs is not read.

    Totals come before the union, while balance weights still are spread by year.
    """
    parts = []
    of_balances = weights & set(R.BALANCE_WEIGHTS)
    if of_balances:
        parts.append(with_total(balance_weights(sums, city, periods, of_balances)))
    if R.HEADCOUNT in weights:
        parts.append(with_total(headcount_weights(sales, area, periods)))
    if not parts:
        raise ValueError(f"no weight of {sorted(weights)} comes from balances or the sales sheet")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def shares(weights: DataFrame) -> DataFrame:
    """Share of each region in the total, from weights with totals."""
    return weights.withColumn("share", F.col("amount") / F.nullif(F.col("total"), F.lit(0.0)))
