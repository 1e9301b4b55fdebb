"""Scorecard of sales managers: KPI ranks, NPL rank and the finance ranks of their region."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitgrid.functions.columns import month_key, to_whole
from profitgrid.functions.ranking import VALUES_PER_TASK, Rank, add_ranks, rank_sum
from profitgrid.operators import npl
from profitgrid.operators.sheet import asm_averages
from profitgrid.periods import Periods
from profitgrid.plans.frames import Frames
from profitgrid.plans.report import wide_report
from profitgrid.session import stored_together

MONTH = ["month_key"]
KPIS = ("ltn_avg", "psdn_avg", "approve_rate_avg")
KPI_RANKS = [Rank(c, f"rank_{c}", descending=True) for c in KPIS]
NPL_RANK = Rank("npl", "rank_npl", among="has_npl")
FINANCE = ("cir", "margin", "return_on_capital", "profit_per_head")


def _managers(frames: Frames, periods: Periods) -> DataFrame:
    """Managers with all three KPIs and a region of the dimension."""
    return (
        asm_averages(frames.sales, periods)
        .dropna(subset=list(KPIS))
        .join(F.broadcast(frames.area), "area_name")  # one row per region letter
        .withColumnRenamed("area_cde", "area_code")
    )


def kpi_ranks(
    frames: Frames, periods: Periods, values_per_task: int = VALUES_PER_TASK
) -> DataFrame:
    """Managers with all three KPIs, each KPI ranked within the month, highest first."""
    return add_ranks(_managers(frames, periods), MONTH, KPI_RANKS, values_per_task)


def npl_by_area(frames: Frames, periods: Periods, fan_out: bool = True) -> DataFrame:
    risk = npl.risk_by_area(frames.balance_sums, frames.city, periods, fan_out)
    return npl.npl_ratio(risk, periods).select(
        month_key(F.col("year"), F.col("month")).alias("month_key"), F.col("area_cde").alias("area_code"), "npl"
    )


def _with_npl(managers: DataFrame, ratios: DataFrame) -> DataFrame:
    """Managers, the NPL ratio of their region, and whether the region has one at all."""
    ratios = F.broadcast(ratios.withColumn("has_npl", F.lit(True)))  # at most eight rows per month
    rows = managers.join(ratios, ["month_key", "area_code"], "left")
    return rows.withColumn("has_npl", F.coalesce("has_npl", F.lit(False)))


def asm_npl_report(
    frames: Frames,
    periods: Periods,
    fan_out: bool = True,
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """KPI ranks plus the NPL ratio of the manager's region, lowest ratio first.

    KPI ranks count managers whose region has no ratio, too; the report leaves these managers out.
    """
    rows = _with_npl(_managers(frames, periods), npl_by_area(frames, periods, fan_out))
    rows = add_ranks(rows, MONTH, [*KPI_RANKS, NPL_RANK], values_per_task)
    return rows.where("has_npl").select(
        "month_key",
        "area_code",
        "area_name",
        "email",
        "ltn_avg",
        "rank_ltn_avg",
        "psdn_avg",
        "rank_psdn_avg",
        "approve_rate_avg",
        "rank_approve_rate_avg",
        "npl",
        "rank_npl",
    )


def scorecard(
    frames: Frames,
    periods: Periods,
    best_high: tuple[str, ...] = (),
    fan_out: bool = True,
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Scale score, finance score, total and final rank of each manager for each report month, in one pass.

    Two passes of ranks: KPIs, NPL and finance measures together, then the three scores that follow from them.
    All finance ranks are ascending, as the scorecard has always done, although a high margin is
    good; name measures in ``best_high`` to rank them the other way round.
    """
    frames = frames.stored(periods)  # balances and sheet feed both the region report and the ranks
    finance = wide_report(frames, periods).select(
        month_key(F.col("year"), F.col("month")).alias("month_key"), "area_name", *FINANCE, F.lit(True).alias("has_finance")
    )
    # Two small reports and the managers do not depend on each other: their jobs run side by side.
    finance, ratios, managers = stored_together(finance, npl_by_area(frames, periods, fan_out), _managers(frames, periods))
    rows = _with_npl(managers, ratios).join(F.broadcast(finance), ["month_key", "area_name"], "left")  # at most eight per month
    rows = rows.withColumn("complete", F.col("has_npl") & F.coalesce("has_finance", F.lit(False)))
    finance_ranks = [Rank(c, f"rank_{c}", c in best_high, among="complete") for c in FINANCE]
    rows = add_ranks(rows, MONTH, [*KPI_RANKS, NPL_RANK, *finance_ranks], values_per_task).where("complete")
    scale = F.col("rank_ltn_avg") + F.col("rank_psdn_avg") + F.col("rank_approve_rate_avg") + F.col("rank_npl")
    finance_score = sum((F.col(r.name) for r in finance_ranks), F.lit(0))
    rows = rows.withColumn("scale_score", scale).withColumn("finance_score", finance_score)
    rows = rows.withColumn("total_score", F.col("scale_score") + F.col("finance_score"))
    last = [
        Rank("scale_score", "rank_scale"),
        Rank("finance_score", "rank_finance"),
        Rank("total_score", "rank_final"),
    ]
    return add_ranks(rows, MONTH, last, values_per_task).select(
        "month_key",
        "area_code",
        "area_name",
        "email",
        "total_score",
        "rank_final",
        to_whole(F.col("ltn_avg")).alias("ltn_avg"),
        "rank_ltn_avg",
        "psdn_avg",
        "rank_psdn_avg",
        "approve_rate_avg",
        "rank_approve_rate_avg",
        "npl",
        "rank_npl",
        "scale_score",
        "rank_scale",
        "cir",
        "rank_cir",
        "margin",
        "rank_margin",
        "return_on_capital",
        "rank_return_on_capital",
        to_whole(F.col("profit_per_head")).alias("profit_per_head"),
        "rank_profit_per_head",
        "finance_score",
        "rank_finance",
    )


def kpi_rank_sum(
    frames: Frames, periods: Periods, ranks: list[Rank] | None = None, weights: dict[str, float] | None = None
) -> DataFrame:
    """Any rank sum over manager KPIs: ranks per column and direction, and their sum by weight.

    ``weights`` maps names of ranks to what they count for; ranks that it does not name keep their own weight.
    """
    rows = asm_averages(frames.sales, periods).dropna(subset=list(KPIS))
    given = weights or {}
    unknown = set(given) - {r.name for r in ranks or KPI_RANKS}
    if unknown:
        raise ValueError(f"no rank is named {sorted(unknown)}")
    weighted = [replace(r, weight=given.get(r.name, r.weight)) for r in ranks or KPI_RANKS]
    return rank_sum(rows, MONTH, "score", weighted)
