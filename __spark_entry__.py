"""Registered queries and the SQL that checks them.

Every query works on whole tables. Reports "of the year" cover December year-to-date of every year
in the data; the scorecard and the multi-month reports cover every month.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from profitgrid import rules as R  # noqa: E402
from profitgrid.operators import audit, dims, ledger, npl, reshape, sheet, weights  # noqa: E402
from profitgrid.operators.balances import point_sums  # noqa: E402
from profitgrid.periods import Months, Periods  # noqa: E402
from profitgrid.plans import increments, report, scorecard, store  # noqa: E402
from profitgrid.plans.frames import Frames  # noqa: E402
from profitgrid.session import shared_folder  # noqa: E402
from profitgrid.sources import readers, sinks  # noqa: E402
from profitgrid.sources.star import FINANCE, FINANCE_CHART, STAR_RULES, StarModel  # noqa: E402

try:
    import corpus_pipeline
    from profitgrid.llm import queries as llm
except ImportError as error:  # these two may be missing; a fault inside them is a fault
    if error.name not in ("corpus_pipeline", "profitgrid.llm"):
        raise
    llm = None

YEAR_END = Periods.every_year(12)
FEBRUARY = Periods.every_year(2)
JUNE = Periods.every_year(6)
ALL_MONTHS = Periods.every_year(*range(1, 13))

LEVEL_1_RULES = STAR_RULES.only(R.LEVEL_1)


def two_digits(df: DataFrame, *columns: str) -> DataFrame:
    """Two digits for amounts that the engine leaves unrounded."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in columns})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the wide profit-and-loss report of every month, one pass over each fact table."""
    return multi_month_wide(spark, "/root/testdata/sf0.001")


# Sources


def src_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger_rows = StarModel(spark, sf_dir).ledger
    return ledger_rows.withColumn("transaction_date", F.col("transaction_date").cast("string"))


def src_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return StarModel(spark, sf_dir).balances


def src_sales_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return model.sales_of_all_months().drop("manager")


def dim_city_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return dims.build_city(model.balances, model.city_letters)


def dim_area_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return dims.build_area(model.roster, model.area, "AFRICA")


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return audit.load_audit(
        {
            "ledger": (model.postings, "account_code"),
            "balances": (model.balances, "pos_cde"),
            "city": (model.city, "pos_cde"),
            "sales": (model.roster, "email"),
        }
    )


# Ledger


def ledger_head_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return ledger.head_pool(model.ledger, YEAR_END, STAR_RULES)


def ledger_direct_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return ledger.direct_by_area(model.ledger, YEAR_END, STAR_RULES)


def ledger_account_set_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.account_set_totals(StarModel(spark, sf_dir).postings, STAR_RULES)


def ledger_account_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.account_class_totals(StarModel(spark, sf_dir).postings)


def ledger_ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return ledger.ledger_year_to_date(model.ledger, ALL_MONTHS)


# Weights


def balance_monthly_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    keys = ALL_MONTHS.keys("kpi_month")
    return weights.monthly_by_area(point_sums(model.balances), model.city, keys, [R.BALANCE_ALL]).drop("weight")


def balance_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return weights.monthly_by_area(point_sums(model.balances), model.city, ALL_MONTHS.keys("kpi_month"))


def balance_avg_of_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    kinds = [w for w in R.BALANCE_WEIGHTS if w != R.ACTIVATIONS]
    return two_digits(weights.balance_weights(point_sums(model.balances), model.city, ALL_MONTHS, kinds), "amount")


def activation_count_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    counts = weights.balance_weights(point_sums(model.balances), model.city, ALL_MONTHS, [R.ACTIVATIONS])
    return counts.select("year", "month", "area_cde", F.col("amount").cast("long").alias("activations"))


def headcount_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    counts = weights.headcount_weights(model.sales, model.area, YEAR_END)
    return counts.select("year", "month", "area_cde", F.col("amount").cast("long").alias("headcount"))


def area_weight_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    every = weights.all_weights(
        point_sums(model.balances), model.city, model.sales, model.area, YEAR_END, LEVEL_1_RULES.weights
    )
    return weights.shares(every).select("year", "month", "weight", "area_cde", F.round("share", 6).alias("share"))


def headcount_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheet.headcount_by_area(StarModel(spark, sf_dir).roster)


def asm_complete_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sheet.complete_january(StarModel(spark, sf_dir).sales)
    return rows.select("year", "area_name", "sale_name", "email")


def asm_complete_all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return sheet.complete_through(model.sales, ALL_MONTHS)


# Allocation and level 1


def pool_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    rows = report.allocated(model.frames_once(YEAR_END), YEAR_END)
    return two_digits(
        rows.select("metric", "year", "month", "area_cde", "direct", "pool", "allocated", "value"),
        "allocated",
        "value",
    )


def allocation_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    rows = report.allocation_residual(model.frames_once(YEAR_END), YEAR_END)
    return two_digits(rows, "pool", "allocated", "residual")


def level1_metric(metric: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = StarModel(spark, sf_dir)
        of_lines_alone = STAR_RULES.weight_of(metric) == R.HEADCOUNT  # then ledger and sheet share one pass
        frames = model.frames_once(YEAR_END) if of_lines_alone else model.frames()
        return two_digits(report.level1_metric(frames, YEAR_END, metric), metric)

    return run


def interest_in_term_adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return report.interest_in_term_by_name(model.frames(FEBRUARY), FEBRUARY, (1, 2))


def level1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return report.level1_report(model.frames_once(YEAR_END), YEAR_END)


# Level 2 and reports


def cost_of_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    rows = report.summary(model.frames_once(YEAR_END), YEAR_END)
    return two_digits(rows.select("year", "month", "area_name", *R.LEVEL_2), *R.LEVEL_2)


def aggregate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    frames = model.frames_once(YEAR_END)
    rows = report.aggregates(report.summary(frames, YEAR_END), frames)
    whole = ["card_income", "net_other", "total_cost", "headcount"]
    exact = ["net_fund_cost", "total_income", "profit_before_tax"]
    return two_digits(rows.select("year", "month", "area_name", *whole, *exact), *exact)


def ratio_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return report.measures(model.frames_once(YEAR_END), YEAR_END).select(
        "year", "month", "area_name", *reshape.RATIOS
    )


def wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    frames = model.frames_once(YEAR_END)
    return report.in_area_order(report.wide_report(frames, YEAR_END), frames)


def multi_month_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return report.in_month_order(report.wide_report(model.frames_once(ALL_MONTHS), ALL_MONTHS))


def melt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return two_digits(report.melted_report(model.frames_once(YEAR_END), YEAR_END), "value")


def _numeric_cells(table: DataFrame) -> DataFrame:
    cells = [c for c in table.columns if c not in ("year", "month", "criterion", "sort_pos")]
    return table.withColumns({c: F.col(f"`{c}`").cast("double") for c in cells})


def pivot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return _numeric_cells(report.pivot_report(model.frames_once(YEAR_END), YEAR_END))


def multi_month_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return _numeric_cells(report.pivot_report(model.frames_once(ALL_MONTHS), ALL_MONTHS, reshape.CRITERIA))


def pivot_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot as it is delivered: cells as text, display names as column names."""
    model = StarModel(spark, sf_dir)
    return report.with_labels(report.pivot_report(model.frames_once(YEAR_END), YEAR_END, text=True))


def metric_hierarchy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    frames = model.frames_once(YEAR_END)
    rows = report.aggregates(report.summary(frames, YEAR_END), frames)
    leaves = [*R.LEVEL_1, *R.LEVEL_2]
    long = rows.unpivot(
        report.KEY, [F.col(c).cast("double").alias(c) for c in leaves], "metric", "amount"
    )
    return two_digits(dims.roll_up(long, report.KEY), "amount")


def stored_hierarchy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same roll-up along a metric dimension that is a stored table, of any depth."""
    model = StarModel(spark, sf_dir)
    dimension = sinks.overwrite(dims.metric_dimension(spark), shared_folder(spark))
    frames = model.frames_once(YEAR_END)
    rows = report.aggregates(report.summary(frames, YEAR_END), frames)
    leaves = [F.col(c).cast("double").alias(c) for c in (*R.LEVEL_1, *R.LEVEL_2)]
    long = rows.unpivot(report.KEY, leaves, "metric", "amount")
    return two_digits(dims.roll_up(long, report.KEY, dimension), "amount")


def region_revenue_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return report.revenue_shares(model.frames_once(YEAR_END), YEAR_END)


# The finance company's own accounts


def _finance(spark: SparkSession, sf_dir: str) -> StarModel:
    return StarModel(spark, sf_dir, FINANCE, FINANCE_CHART)


def finance_account_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.account_set_totals(_finance(spark, sf_dir).postings, R.FINANCE_COMPANY)


def finance_level1_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _finance(spark, sf_dir)
    rows = report.allocated(model.frames_once(YEAR_END), YEAR_END)
    return two_digits(rows.select("metric", "year", "month", "area_cde", "value"), "value")


def finance_level1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _finance(spark, sf_dir)
    return report.level1_report(model.frames_once(YEAR_END), YEAR_END)


def finance_cost_of_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _finance(spark, sf_dir)
    rows = report.summary(model.frames_once(YEAR_END), YEAR_END)
    return two_digits(rows.select("year", "month", "area_name", *R.LEVEL_2), *R.LEVEL_2)


# Sinks


def _kept(spark: SparkSession, sf_dir: str, refresh: bool) -> tuple[Frames, Periods, DataFrame]:
    """June is stored; then every posting counts twice, and June and December are stored again."""
    model, path = StarModel(spark, sf_dir), shared_folder(spark)
    periods = Periods.every_year(6, 12)
    store.keep_summary(model.frames_once(JUNE), JUNE, path)
    later = replace(model.frames(), ledger=model.ledger.withColumn("amount", F.col("amount") * 2))
    return later, periods, store.keep_summary(later, periods, path, refresh)


def stored_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide report from the stored summary, where June keeps its first values."""
    frames, periods, stored = _kept(spark, sf_dir, refresh=False)
    return report.wide_report(frames, periods, stored)


def refreshed_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide report from the stored summary, both months replaced."""
    frames, periods, stored = _kept(spark, sf_dir, refresh=True)
    return report.wide_report(frames, periods, stored)


def stored_facts_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide report over a ledger and balances that were written and read back."""
    model, path = StarModel(spark, sf_dir), shared_folder(spark)
    sinks.write_ledger(model.ledger, f"{path}/ledger")
    sinks.write_balances(model.balances, f"{path}/balances")
    kept_ledger, kept_balances = readers.read_ledger(spark, f"{path}/ledger"), readers.read_balances(spark, f"{path}/balances")
    city = dims.build_city(kept_balances, model.city_letters)
    frames = replace(model.frames(), ledger=kept_ledger, balances=kept_balances, city=city)
    return report.wide_report(frames, YEAR_END)


def incremental_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide report from stored monthly sums: January to November first, then a load that reads December only."""
    model, path = StarModel(spark, sf_dir), shared_folder(spark)
    sinks.write_ledger(model.ledger, f"{path}/ledger")
    sinks.write_balances(model.balances, f"{path}/balances")
    stored_ledger, stored_balances = readers.read_ledger(spark, f"{path}/ledger"), readers.read_balances(spark, f"{path}/balances")
    frames = replace(model.frames(), ledger=stored_ledger, balances=stored_balances)
    increments.add_months(frames, f"{path}/sums", Months.every_year(*range(1, 12)))
    increments.add_months(frames, f"{path}/sums", Months.every_year(12))
    return report.wide_report(increments.frames_of(frames, f"{path}/sums", YEAR_END), YEAR_END)


def csv_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger, balances and sheet as CSV files with two broken lines each: rows per reason, with a total."""
    model, path = StarModel(spark, sf_dir), shared_folder(spark)
    sheet_columns = readers.sheet_schema().fieldNames()
    loads = {
        "ledger": (model.ledger, readers.read_ledger_checked, "amount", "1997-01-01,810000000000,,DVML0000B1,,C,-1"),
        "balances": (model.balances, readers.read_balances_checked, "outstanding_principal", "199701,,FRANCE,1,1,,,1,1,-1"),
        "sheet": (model.sheet().select(sheet_columns), readers.read_sales_sheet_checked, "psdn_jan", "ASIA" + "," * (len(sheet_columns) - 1)),
    }
    audits = []
    for name, (rows, read, measure, incomplete) in loads.items():
        rows.write.option("header", "true").csv(f"{path}/{name}")
        broken = "\n".join([",".join(rows.columns), "not,a,row", incomplete])
        spark.range(1).select(F.lit(broken)).write.mode("append").text(f"{path}/{name}")
        checked = read(spark, f"{path}/{name}").no_more_than(2)
        total = checked.kept.agg(F.sum(measure).cast("bigint").alias("total")).withColumn("kept", F.lit(True))
        counts = checked.counts().withColumn("kept", F.col("reason").isNull()).join(total, "kept", "left")
        audits.append(counts.select(F.lit(name).alias("table"), "reason", "rows", "total"))
    return audits[0].union(audits[1]).union(audits[2])


def dimension_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of sale loaded twice: those of nations with an even key first, then all, some renamed."""
    model, path = StarModel(spark, sf_dir), shared_folder(spark)
    nation = F.split("pos_cde", "-")[0].cast("int")
    sinks.load_dimension(model.city.where(nation % 2 == 0), path, ["pos_cde"], "pos_id")
    renamed = model.city.withColumn("pos_city", F.when(nation % 4 == 0, F.lower("pos_city")).otherwise(F.col("pos_city")))
    stored = sinks.load_dimension(renamed, path, ["pos_cde"], "pos_id")
    per_load = stored.groupBy(F.col(sinks.CREATED).alias("stamp")).agg(
        F.min("pos_id").alias("lowest"), F.max("pos_id").alias("highest"), F.count("*").alias("rows")
    )
    stamps = stored.agg(F.min(sinks.CREATED)).scalar(), stored.agg(F.max(sinks.CREATED)).scalar()
    return stored.join(F.broadcast(per_load), F.col(sinks.CREATED) == F.col("stamp")).select(  # one row per load
        "pos_cde", "pos_city", "area_cde", "lowest", "highest", "rows",
        stored.agg(F.countDistinct("pos_id")).scalar().alias("serials"),
        (F.col(sinks.CREATED) == stamps[0]).alias("loaded_first"),
        (F.col(sinks.CREATED) < F.col(sinks.UPDATED)).alias("updated_later"),
        (F.col(sinks.UPDATED) == stamps[1]).alias("stamp_of_second_load"),
    )


def sink_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full refreshes: what remains is the second one."""
    model = StarModel(spark, sf_dir)
    frames, path = model.frames_once(YEAR_END), shared_folder(spark)
    sinks.overwrite(report.wide_report(frames, FEBRUARY), path)
    return sinks.overwrite(report.wide_report(frames, YEAR_END), path)


def append_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends: the second repeats June with other amounts, which stay out, and adds December."""
    model = StarModel(spark, sf_dir)
    frames, path = model.frames_once(YEAR_END), shared_folder(spark)
    first = report.summary(frames, JUNE)
    second = report.summary(frames, Periods.every_year(6, 12))
    second = second.withColumns({m: F.col(m) + 1 for m in R.LEVEL_1})
    sinks.append_if_absent(first, path, partition_by=["year", "month"])
    stored = sinks.append_if_absent(second, path, partition_by=["year", "month"])
    return two_digits(stored, *R.LEVEL_2)


# NPL ratio


def _risk(spark: SparkSession, sf_dir: str, fan_out: bool = True) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return npl.risk_by_area(point_sums(model.balances), model.city, ALL_MONTHS, fan_out)


def npl_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _risk(spark, sf_dir).select("year", "month", "area_cde", "balance_bad", "balance_all")


def npl_city_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_city = _risk(spark, sf_dir).select("year", "month", "area_cde", "balance_all", F.lit("city").alias("joined_on"))
    by_point = _risk(spark, sf_dir, fan_out=False).select(
        "year", "month", "area_cde", "balance_all", F.lit("point").alias("joined_on")
    )
    return by_city.unionByName(by_point)


def writeoff_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = _risk(spark, sf_dir).select("year", "month", "area_cde", "flow_bad", "flow_all")
    return flows.where(F.col("flow_all").isNotNull())


def npl_left_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = npl.zero_filled(_risk(spark, sf_dir))
    return filled.select("year", "month", "area_cde", "balance_bad", "flow_bad", "balance_all", "flow_all")


def writeoff_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return npl.running_write_off(_risk(spark, sf_dir))


def npl_before_writeoff_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return two_digits(npl.average_before_write_off(_risk(spark, sf_dir), ALL_MONTHS), "avg_bad", "avg_all")


def npl_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return npl.npl_ratio(_risk(spark, sf_dir), ALL_MONTHS).withColumn("npl", F.round("npl", 6))


# Scorecard


def _rounded_rates(rows: DataFrame) -> DataFrame:
    rates = [c for c in ("approve_rate_avg", "npl") if c in rows.columns]
    return rows.withColumns({c: F.round(c, 6) for c in rates})


def asm_kpi_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every manager of the sheet, with NULL where a month is missing."""
    model = StarModel(spark, sf_dir)
    sales = model.sales_of_all_months()
    return _rounded_rates(sheet.asm_averages(sales, ALL_MONTHS))


def asm_kpi_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return _rounded_rates(scorecard.kpi_ranks(model.frames(), ALL_MONTHS))


def asm_npl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return _rounded_rates(scorecard.asm_npl_report(model.frames(), ALL_MONTHS))


def asm_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return _rounded_rates(scorecard.scorecard(model.frames_once(ALL_MONTHS, ALL_MONTHS.months), ALL_MONTHS))


def rank_sum_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    return _rounded_rates(scorecard.kpi_rank_sum(model.frames(), ALL_MONTHS))


def rank_sum_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = StarModel(spark, sf_dir)
    weights_ = {"rank_ltn_avg": 3, "rank_psdn_avg": 2}
    return _rounded_rates(scorecard.kpi_rank_sum(model.frames(), ALL_MONTHS, weights=weights_))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = [
        src_ledger, src_balances, src_sales_kpi, dim_city_build, dim_area_build, load_audit,
        ledger_head_pool, ledger_direct_by_area, ledger_account_set_filter, ledger_account_class, ledger_ytd,
        balance_monthly_by_area, balance_by_bucket, balance_avg_of_months, activation_count_weight,
        headcount_weight, area_weight_share, headcount_by_area, asm_complete_filter, asm_complete_all_months,
        pool_allocation, allocation_residual, interest_in_term_adhoc, level1_report,
        cost_of_funds, aggregate_metrics, ratio_metrics, wide_report, multi_month_wide, melt_report,
        pivot_report, pivot_report_text, multi_month_pivot, metric_hierarchy_rollup, region_revenue_share,
        finance_account_sets, finance_level1_metrics, finance_level1_report, finance_cost_of_funds,
        sink_overwrite_roundtrip, append_if_absent, stored_wide_report, refreshed_wide_report, stored_facts_wide_report,
        npl_balances, npl_city_fanout, writeoff_flow, npl_left_zero_fill, writeoff_running_total,
        npl_before_writeoff_avg, npl_ratio,
        asm_kpi_avg, asm_kpi_ranks, asm_npl_report, asm_scorecard, rank_sum_generic, rank_sum_weighted,
        incremental_wide_report, csv_load_audit, dimension_serials, stored_hierarchy_rollup,
    ]
    ours = {q.__name__: q for q in plain} | {metric: level1_metric(metric) for metric in R.LEVEL_1}
    return ours | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (llm.oracle_sql() if llm else {})
