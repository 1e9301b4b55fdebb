"""Monthly profit-and-loss reports per region, for one month or many in the same single pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitgrid import rules as R
from profitgrid.functions.columns import HEAD, per_unit, percent, position_in, to_whole
from profitgrid.operators import allocate as A
from profitgrid.operators import ledger as L
from profitgrid.operators import reshape
from profitgrid.operators import weights as W
from profitgrid.operators.sheet import headcount_by_area
from profitgrid.periods import Periods
from profitgrid.plans.frames import Frames

KEY = ["year", "month", "area_name"]


def _sums(frames: Frames, periods: Periods, rules: R.RuleBook) -> DataFrame:
    return L.year_to_date(frames.monthly_sums(periods, rules), periods, rules)


def _weights(frames: Frames, periods: Periods, weights: set[str]) -> DataFrame:
    return W.all_weights(frames.balance_sums, frames.city, frames.january_sales(periods), frames.area, periods, weights)


def allocated(frames: Frames, periods: Periods, metrics: Iterable[str] = R.LEVEL_1) -> DataFrame:
    """Direct amount, pool, weight and allocated value per metric, report month and region letter."""
    rules = frames.organisation.rules.only(metrics)
    return A.allocate(_sums(frames, periods, rules), _weights(frames, periods, rules.weights))


def level1_metric(frames: Frames, periods: Periods, metric: str) -> DataFrame:
    """One level-1 metric; reads only the weight source that the metric needs."""
    return allocated(frames, periods, [metric]).select("year", "month", "area_cde", F.col("value").alias(metric))


def allocation_residual(frames: Frames, periods: Periods, metrics: Iterable[str] = R.LEVEL_1) -> DataFrame:
    rules = frames.organisation.rules.only(metrics)
    return A.residual(_sums(frames, periods, rules), _weights(frames, periods, rules.weights))


def interest_in_term_by_name(frames: Frames, periods: Periods, months: tuple[int, ...]) -> DataFrame:
    """Interest in term of a fixed set of months by region name, highest first.

    The quick check that precedes the full report: any direct letter counts, amounts have two digits.
    """
    rules = frames.organisation.rules.only(["interest_in_term"])
    in_set = F.col("month").isin(*months)
    monthly = L.monthly_by_rule_key(frames.ledger, periods, rules, letters=None).where(in_set)
    keys = periods.of_months(*months).keys("kpi_month") & (F.col("kpi_month") % 100).isin(*months)
    balances = W.monthly_by_area(frames.balance_sums, frames.city, keys, rules.weights)
    weights = W.with_total(W.over_report_months(balances, periods))
    values = A.allocate(L.year_to_date(monthly, periods, rules), weights)
    best = Window.partitionBy("year", "month").orderBy(
        F.col("interest_in_term").desc_nulls_first(), "area_name"
    )
    return (
        values.join(F.broadcast(frames.area), "area_cde")
        .select("year", "month", "area_name", F.round("value", 2).alias("interest_in_term"))
        .withColumn("sort_pos", F.row_number().over(best))  # at most eight regions per month
        .orderBy("year", "month", "sort_pos")
    )


def summary(frames: Frames, periods: Periods) -> DataFrame:
    """Level 1 rounded to whole amounts and level 2 per region: a row per year, month and region.

    A region stays only if it has a row in each of the twelve level-1 metrics; its value may be
    NULL. Level 2 splits its pools by the rounded card income.
    """
    rules = frames.organisation.rules
    sums = _sums(frames, periods, rules)
    months = Window.partitionBy("year", "month")
    pools = {
        m: F.max(F.when((F.col("metric") == m) & (F.col("scope") == HEAD), F.col("amount"))).over(months)
        for m in R.LEVEL_2
    }
    for metric, pool in pools.items():
        sums = sums.withColumn(f"pool_{metric}", pool)
    missing = set(R.LEVEL_1) - {r.metric for r in rules.rules}
    if missing:
        raise ValueError(f"the rule book lacks {sorted(missing)}")
    level1_rules = rules.only(R.LEVEL_1)
    values = A.allocate(
        sums.where(F.col("metric").isin(*R.LEVEL_1)), _weights(frames, periods, level1_rules.weights)
    )
    level1 = (
        values.groupBy("year", "month", "area_cde")
        .agg(
            *[to_whole(F.max(F.when(F.col("metric") == m, F.col("value")))).alias(m) for m in R.LEVEL_1],
            *[F.max(f"pool_{m}").alias(f"pool_{m}") for m in R.LEVEL_2],
            F.count(F.lit(1)).alias("metrics"),
        )
        .where(F.col("metrics") == len(R.LEVEL_1))
        .join(F.broadcast(frames.area), "area_cde")  # one row per letter
    )
    card = _plus(R.CARD_INCOMES)
    total = [F.sum(c.cast("decimal(38,0)")).over(months).cast("double") for c in (card, F.col("rev_business"))]
    with_total = level1.withColumn("card", card.cast("double")).withColumn("income", total[0] + total[1])
    level2 = [
        F.when(F.col("income") == 0, F.lit(0.0))
        .otherwise(F.col(f"pool_{m}").cast("double") * F.col("card") / F.nullif("income", F.lit(0.0)))
        .alias(m)
        for m in R.LEVEL_2
    ]
    return with_total.select(*KEY, *R.LEVEL_1, *level2)


def level1_report(frames: Frames, periods: Periods) -> DataFrame:
    """The twelve level-1 metrics as whole amounts by region name."""
    return summary(frames, periods).select(*KEY, *R.LEVEL_1)


def _plus(columns: Iterable[str]) -> Column:
    first, *rest = [F.col(c) for c in columns]
    for column in rest:
        first = first + column
    return first


def aggregates(stored: DataFrame, frames: Frames) -> DataFrame:
    """Aggregate metrics and headcount from stored level-1 and level-2 rows, without head office.

    Costs are stored as negative amounts, so they are added.
    """
    # One row per region name that also is in the region dimension, so at most eight.
    heads = headcount_by_area(frames.roster).join(F.broadcast(frames.area.select("area_name")), "area_name")
    return (
        stored.where(F.col("area_name") != frames.organisation.head_office)
        .join(F.broadcast(heads), "area_name")
        .withColumn("card_income", _plus(R.CARD_INCOMES))
        .withColumn("net_fund_cost", F.col("cost_fund_tt2") + F.col("cost_fund_cctg"))
        .withColumn("net_other", _plus(["rev_business", "cost_commission", "cost_other_business"]))
        .withColumn("total_income", _plus(["card_income", "net_fund_cost", "net_other"]))
        .withColumn("total_cost", _plus(["cost_staff", "cost_admin", "cost_asset"]))
        .withColumn("profit_before_tax", _plus(["total_income", "total_cost", "cost_provision"]))
    )


def ratios(aggregated: DataFrame) -> DataFrame:
    """Cost-income ratio, margin, return on capital (percent) and profit per head."""
    profit = F.col("profit_before_tax")
    return (
        aggregated.withColumn("cir", percent(-F.col("total_cost").cast("double"), F.col("total_income")))
        .withColumn("margin", percent(profit, (F.col("card_income") + F.col("rev_business")).cast("double")))
        .withColumn("return_on_capital", percent(-profit, F.col("net_fund_cost")))
        .withColumn("profit_per_head", per_unit(profit, F.col("headcount")))
    )


def measures(frames: Frames, periods: Periods, stored: DataFrame | None = None) -> DataFrame:
    """All measures per month and region with unrounded level 2.

    ``stored`` takes rows already kept in a summary table instead of computing them.
    """
    if stored is None:
        stored = summary(frames, periods)
    return ratios(aggregates(stored, frames))


WIDE = [measure for _, measure in reshape.CRITERIA]
STORED_WHOLE = ("profit_before_tax", "net_fund_cost", "cost_fund_tt2", "cost_fund_cctg", "total_income")


def wide_report(frames: Frames, periods: Periods, stored: DataFrame | None = None) -> DataFrame:
    """A row per month and region with 25 measures; amounts are whole, ratios have two digits."""
    columns = [
        to_whole(F.col(c)).alias(c) if c in STORED_WHOLE else F.col(c) for c in WIDE if c is not None
    ]
    return measures(frames, periods, stored).select(*KEY, *columns)


def in_area_order(report: DataFrame, frames: Frames) -> DataFrame:
    """Order of the single-month report: months, then regions as listed, others last."""
    names = frames.organisation.area_names
    place = F.coalesce(position_in(F.col("area_name"), names), F.lit(len(names) + 1))
    return report.withColumn("sort_pos", place).orderBy("year", "month", "sort_pos")


def in_month_order(report: DataFrame) -> DataFrame:
    """Order of the multi-month report: regions by name, then months."""
    return report.orderBy("area_name", "year", "month")


def with_labels(report: DataFrame) -> DataFrame:
    """Display names as column names, of a wide or a pivoted report."""
    labels = {measure: label for label, measure in reshape.CRITERIA} | reshape.DISPLAY_NAMES
    return report.select(*[F.col(f"`{c}`").alias(labels.get(c, c)) for c in report.columns])


def melted_report(frames: Frames, periods: Periods, criteria: reshape.Criteria = reshape.CRITERIA_ONE_MONTH) -> DataFrame:
    return reshape.melt(measures(frames, periods), criteria)


def pivot_report(
    frames: Frames,
    periods: Periods,
    criteria: reshape.Criteria = reshape.CRITERIA_ONE_MONTH,
    total_ratios: bool = True,
    text: bool = False,
) -> DataFrame:
    """A row per criterion and a column per region: 32 criteria for one month, 25 for many."""
    melted = melted_report(frames, periods, criteria)
    return reshape.pivot(melted, frames.organisation.area_names, criteria, total_ratios, text)


def revenue_shares(frames: Frames, periods: Periods) -> DataFrame:
    """Each region's share in total card income and total revenue of the month, in percent."""
    months = Window.partitionBy("year", "month")
    revenue = F.col("card_income") + F.col("rev_business")
    rows = aggregates(summary(frames, periods), frames).select(
        *KEY, F.col("card_income").cast("double").alias("card_income"), revenue.cast("double").alias("revenue")
    )
    return rows.select(
        *KEY,
        *[
            F.round(F.col(c) / F.nullif(F.sum(c).over(months), F.lit(0.0)) * 100, 2).alias(f"{c}_share")
            for c in ("card_income", "revenue")
        ],
    )
