"""Every registered query next to its SQL, and the plans of the heavy ones."""

from __future__ import annotations

import check_all
import oracle
import pytest
from fixtures import as_set, balances, city, direct, head, ledger, loan, plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from profitgrid import rules as R
from profitgrid.operators import ledger as L
from profitgrid.operators import weights as W
from profitgrid.operators.balances import point_sums
from profitgrid.periods import Periods
from profitgrid.plans import report
from profitgrid.rules import FINANCE_COMPANY
from profitgrid.sources import readers, sinks
from profitgrid.sources.star import StarModel

REPORTS = sorted(oracle.statements())


def test_every_report_query_has_sql():
    others = {n for n in entry.queries() if n == "pipeline" or n[:2] == "op" and n[2].isdigit()}
    assert set(entry.queries()) - others == set(REPORTS)
    assert len(REPORTS) == 73


@pytest.mark.parametrize("name", REPORTS)
def test_query_agrees_with_sql(spark, small, name):
    ok, note = check_all.compare(spark, check_all.connect(small), small, name)
    assert ok, note


def test_entry_has_rows(spark, small):
    assert entry.entry(spark).count() > 0


def scans_of(df, file: str) -> list[str]:
    """The parts of the plan that scan a file, each with its filters and columns."""
    parts = plan_of(df).split("\n\n")
    return [p for p in parts if "Location:" in p and f"/{file}.parquet" in p]


def test_facts_are_scanned_once_for_all_metrics_and_months(spark, small):
    """One scan of ledger and balances; the headcount's own scan of the lines is bounded by January's dates."""
    plan = report.wide_report(StarModel(spark, small).frames(), Periods.months_of(1997, 1, 12))
    lines = scans_of(plan, "lineitem")
    assert sum("l_extendedprice" in scan for scan in lines) == 1 and len(lines) == 2
    assert len(scans_of(plan, "orders")) == 1
    sheet = next(scan for scan in lines if "l_extendedprice" not in scan)
    assert "LessThan(l_shipdate,1997-02-01" in sheet and "GreaterThanOrEqual(l_shipdate,1997-01-01" in sheet
    physical = plan_of(plan)
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_periods_reach_the_files_of_the_tables(spark, small):
    periods = Periods.of(1997, 2)
    plan = report.wide_report(StarModel(spark, small).frames(periods), periods)
    (orders,) = scans_of(plan, "orders")
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in orders and "LessThan(o_orderdate,1997-03-01" in orders


def test_counts_of_accounts_need_no_dimension(spark, small):
    for name in ("ledger_account_class", "ledger_account_set_filter", "finance_account_sets"):
        assert not scans_of(entry.queries()[name](spark, small), "supplier"), name


def test_period_accounts_and_prefixes_reach_the_ledger_scan(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger(spark, [head(1, 702000030001, 5), direct(2, 850000000001, "B", -7)]).write.parquet(path)
    plan = plan_of(L.monthly_by_rule_key(spark.read.parquet(path), Periods.of(2023, 2), FINANCE_COMPANY))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(transaction_date,2023-01-01),LessThan(transaction_date,2023-03-01)" in pushed.replace(", ", ",")
    assert "StringStartsWith(analysis_code,HEAD)" in pushed and "StringStartsWith(analysis_code,DVML)" in pushed
    assert "GreaterThanOrEqual(account_code,850000000000)" in pushed
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert read == "ReadSchema: struct<transaction_date:date,account_code:bigint,analysis_code:string,amount:bigint>"


def test_month_range_reaches_the_balance_scan(spark, tmp_path):
    path = str(tmp_path / "balances")
    balances(spark, [loan(1, "B", 5)]).write.parquet(path)
    plan = plan_of(W.balance_weights(point_sums(spark.read.parquet(path)), city(spark), Periods.of(2023, 2)))
    assert "GreaterThanOrEqual(kpi_month,202301), LessThanOrEqual(kpi_month,202302)" in plan


def test_stored_months_are_pruned(spark, tmp_path):
    path, periods = str(tmp_path), Periods((2022, 2023), (2,))
    rows = [head(1, 702000030001, 5), direct(2, 702000030001, "B", -7), direct(3, 702000030001, "B", 9)]
    sinks.write_ledger(ledger(spark, rows), f"{path}/ledger")
    stored = L.monthly_by_rule_key(readers.read_ledger(spark, f"{path}/ledger"), periods, FINANCE_COMPANY)
    assert as_set(stored, "year", "month", "scope", "amount") == {(2023, 1, "HEAD", 5), (2023, 2, "B", -7)}
    pruned = next(line for line in plan_of(stored).splitlines() if line.startswith("PartitionFilters"))
    assert "year#" in pruned and "month#" in pruned
    sinks.write_balances(balances(spark, [loan(1, "B", 5), loan(3, "B", 7)]), f"{path}/balances")
    stored = point_sums(readers.read_balances(spark, f"{path}/balances"))
    weights = W.balance_weights(stored, city(spark), periods, [R.BALANCE_ALL])
    assert as_set(weights, "year", "area_cde", "amount") == {(2023, "B", 5.0)}
    assert "kpi_month#" in next(line for line in plan_of(weights).splitlines() if line.startswith("PartitionFilters"))


def test_large_dimensions_join_without_broadcast(spark, small):
    want = as_set(report.wide_report(StarModel(spark, small).frames(), Periods.of(1997, 12)), "*")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = StarModel(spark, small)
        assert "SortMergeJoin" in plan_of(model.ledger)
        assert as_set(report.wide_report(model.frames(), Periods.of(1997, 12)), "*") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_supplier_and_customer_split_by_adaptive_execution(spark, small, tmp_path):
    """A third of all lines and orders on one key: same totals, and the hot partition is split."""
    folder = str(tmp_path)
    for name in ("region", "nation", "supplier", "customer"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_suppkey"))
    lines.withColumn("l_suppkey", hot).repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{small}/orders.parquet")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", hot).repartition(8).write.parquet(f"{folder}/orders.parquet")
    periods = Periods(tuple(range(1995, 2002)), (12,))
    want = as_set(report.wide_report(StarModel(spark, folder).frames(), periods), "*")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        model = StarModel(spark, folder)
        assert as_set(report.wide_report(model.frames(), periods), "*") == want
        monthly = L.monthly_by_rule_key(model.ledger, periods, model.frames().organisation.rules)
        monthly.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(monthly)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_whole_supplier_keys_and_years_beyond_the_usual_ones(spark, small, tmp_path):
    """Suppliers 9,999 to 10,011 keep a code each, and a line shipped in 2005 reaches the reports."""
    folder = str(tmp_path)
    for name in ("region", "nation", "customer", "orders"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    suppliers, lines = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("supplier", "lineitem"))
    keys = spark.range(9999, 10012).withColumnRenamed("id", "s_suppkey")
    suppliers.limit(1).drop("s_suppkey").crossJoin(keys).select(*suppliers.columns).write.parquet(f"{folder}/supplier.parquet")
    late = F.to_timestamp(F.lit("2005-03-01")).cast(lines.schema["l_shipdate"].dataType)
    moved = lines.limit(13).drop("l_suppkey", "l_shipdate").withColumn("l_shipdate", late)
    number = F.row_number().over(Window.orderBy("l_orderkey", "l_linenumber"))
    moved.withColumn("l_suppkey", (number + 9998).cast("long")).select(*lines.columns).write.parquet(f"{folder}/lineitem.parquet")
    assert StarModel(spark, folder).ledger.select("analysis_code").distinct().count() == 13
    assert 2005 in {r["year"] for r in entry.queries()["ledger_ytd"](spark, folder).collect()}
