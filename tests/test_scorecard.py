"""NPL ratio, ranks and the sales-manager scorecard."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from fixtures import as_set, city, frames, loan, manager, plan_of, sales, sums
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from profitgrid.functions.ranking import Rank, add_ranks, quantile_bucket, rank_sum
from profitgrid.operators import npl
from profitgrid.operators.sheet import asm_averages, monthly_sheet, sheet_to_long
from profitgrid.periods import Periods
from profitgrid.plans import scorecard

FEB = Periods.of(2023, 2)


def test_write_offs_cumulate_and_silent_months_are_zero(spark):
    rows = [
        loan(1, "B", 10, 3),
        loan(1, "B", 90, 1),
        loan(2, "B", 20, 4, written_off=(202302, 5)),
        loan(2, "B", 80, None),
    ]
    risk = npl.risk_by_area(sums(spark, rows), city(spark), FEB)
    running = as_set(npl.running_write_off(risk).where("side = 'bad'"), "month", "balance", "written_off")
    assert running == {(1, 10, 0), (2, 20, 5)}
    means = npl.average_before_write_off(risk, FEB)
    assert as_set(means, "area_cde", "avg_bad", "avg_all") == {("B", 17.5, 102.5)}
    assert npl.npl_ratio(risk, FEB).first()["npl"] == pytest.approx(17.0732, abs=1e-4)


def test_write_off_of_another_month_does_not_count(spark):
    risk = npl.risk_by_area(sums(spark, [loan(2, "B", 20, 3, written_off=(202301, 5))]), city(spark), FEB)
    assert as_set(npl.zero_filled(risk), "flow_bad", "flow_all") == {(0, 0)}


def test_loan_counts_once_per_point_of_sale_of_its_city(spark):
    points = city(spark, points=3)
    rows = sums(spark, [loan(1, "B", 7, 3)])
    assert as_set(npl.risk_by_area(rows, points, FEB), "balance_all") == {(21,)}
    assert as_set(npl.risk_by_area(rows, points, FEB, fan_out=False), "balance_all") == {(7,)}


def test_regions_without_bad_loans_have_no_ratio(spark):
    risk = npl.risk_by_area(sums(spark, [loan(1, "B", 7, 1), loan(1, "C", 7, 3)]), city(spark), FEB)
    assert as_set(npl.npl_ratio(risk, FEB), "area_cde", "npl") == {("C", 100.0)}


def test_averages_need_every_month(spark):
    rows = [
        manager("a", "B", 1, ltn=3, psdn=2, rate=0.5),
        manager("a", "B", 2, ltn=4, psdn=5, rate=0.25),
        manager("b", "B", 1, ltn=3),
    ]
    got = asm_averages(sales(spark, rows), FEB)
    assert as_set(got, "month_key", "email", "ltn_avg", "psdn_avg", "approve_rate_avg") == {
        (202302, "a@x", 3.5, 3.5, 0.75),
        (202302, "b@x", None, None, None),
    }


def test_sheet_to_long_and_back(spark):
    rows = [manager("a", "B", 1), manager("a", "B", 2, ltn=None), manager("b", "C", 12)]
    long = sheet_to_long(monthly_sheet(sales(spark, rows)))
    assert long.count() == 24
    filled = long.where("app_in is not null")
    columns = ["area_name", "sale_name", "email", "year", "month", "ltn", "psdn", "approve", "app_in", "approval_rate"]
    assert as_set(filled, *columns) == set(rows)


def test_sheet_with_two_months_and_a_missing_column(spark):
    sheet = spark.createDataFrame(
        [("north", "a", "a@x", 1, 2)], "area_name string, sale_name string, email string, ltn_jan long, ltn_feb long"
    )
    long = sheet_to_long(sheet, F.lit(2023))
    assert as_set(long, "year", "month", "ltn", "psdn") == {(2023, 1, 1, None), (2023, 2, 2, None)}


@pytest.mark.parametrize("values_per_task", [2, 10])
def test_ties_and_nulls(spark, values_per_task):
    rows = spark.createDataFrame([(1, "a", 10.0), (1, "b", 10.0), (1, "c", 5.0), (1, "d", None)], ["g", "id", "v"])
    ranks = [Rank("v", "high", descending=True), Rank("v", "low")]
    got = add_ranks(rows, ["g"], ranks, values_per_task)
    assert as_set(got, "id", "high", "low") == {("a", 1, 2), ("b", 1, 2), ("c", 3, 1), ("d", 4, 4)}


numbers = st.one_of(st.none(), st.integers(-20, 20), st.floats(-5, 5, allow_nan=False).map(lambda x: round(x, 1) + 0.0))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), numbers), min_size=1, max_size=60), st.booleans())
def test_rank_by_value_ranges_equals_a_plain_window(spark, rows, descending):
    data = [(i, g, None if v is None else float(v) or 0.0) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, g int, v double")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    want = as_set(df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order)).cast("long")), "id", "r")
    got = add_ranks(df, ["g"], [Rank("v", "r", descending)], values_per_task=7)
    assert as_set(got, "id", "r") == want


@pytest.mark.parametrize("buckets", [1, 2, 3, 10, 50, 400])
def test_buckets_grow_with_the_value(spark, buckets):
    df = spark.range(1000).select(((F.col("id") * 619 % 1000) / 7).alias("v"))
    rows = df.select("v", quantile_bucket(df, "v", buckets).alias("b")).orderBy("v").collect()
    numbers_ = [r["b"] for r in rows]
    assert numbers_ == sorted(numbers_) and len(set(numbers_)) > buckets * 0.9
    assert max(numbers_.count(b) for b in set(numbers_)) <= 3 * 1000 / buckets + 2


def test_rank_of_whole_numbers(spark):
    df = spark.range(100).select("id", F.lit(1).alias("g"), (F.col("id") * 37 % 50 - 25).alias("v"))
    want = as_set(df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy("v")).cast("long")), "id", "r")
    got = add_ranks(df, ["g"], [Rank("v", "r")], values_per_task=8)
    assert as_set(got, "id", "r") == want


def test_rank_sum(spark):
    rows = spark.createDataFrame([(1, "a", 1, 9), (1, "b", 2, 8), (1, "c", 3, 9)], ["g", "id", "x", "y"])
    got = rank_sum(rows, ["g"], "score", [Rank("x", "rx"), Rank("y", "ry", descending=True)])
    assert as_set(got, "id", "score") == {("a", 2), ("b", 5), ("c", 4)}


@pytest.mark.parametrize("values_per_task", [3, 1000])
def test_many_ranks_in_one_pass_equal_plain_windows(spark, values_per_task):
    pick = random.Random(6)
    data = [(i, pick.choice([1, 2, None]), pick.choice([None, 0.0, -0.0, 2.5, float(i % 9)]), i % 7, pick.random() < 0.6) for i in range(90)]
    df = spark.createDataFrame(data * 2, "id int, g int, v double, w int, some boolean")
    ranks = [Rank("v", "v_low"), Rank("v", "v_high", descending=True), Rank("w", "w_some", among="some"), Rank("v", "v_some", True, "some")]
    got = Counter(tuple(r) for r in add_ranks(df, ["g"], ranks, values_per_task).collect())
    want = df
    for r in ranks:
        order = F.col(r.column).desc_nulls_last() if r.descending else F.col(r.column).asc_nulls_last()
        kept = F.lit(True) if r.among is None else F.col(r.among)
        want = want.withColumn(r.name, F.when(kept, F.rank().over(Window.partitionBy("g", kept).orderBy(order)).cast("long")))
    assert got == Counter(tuple(r) for r in want.collect())


def test_shuffles_do_not_depend_on_the_number_of_ranks(spark):
    df = spark.createDataFrame([(1, i, float(i % 5), i % 3) for i in range(50)], "g int, id int, v double, w int")

    def exchanges(ranks):
        ranked = add_ranks(df, ["g"], ranks, 5)
        return ranked._jdf.queryExecution().sparkPlan().toString().count("Window"), plan_of(ranked).count("Exchange hashpartitioning")

    one = exchanges([Rank("v", "a")])
    assert exchanges([Rank("v", "a"), Rank("w", "b"), Rank("v", "c", True), Rank("w", "d", True)]) == one


def test_weighted_rank_sum(spark):
    rows = spark.createDataFrame([(1, "a", 1, 9), (1, "b", 2, 8), (1, "c", 3, 9)], ["g", "id", "x", "y"])
    got = rank_sum(rows, ["g"], "score", [Rank("x", "rx", weight=0.5), Rank("y", "ry", descending=True, weight=2)])
    assert as_set(got, "id", "score") == {("a", 2.5), ("b", 7.0), ("c", 3.5)}


def test_kpi_rank_sum_by_weight(spark):
    rows = [manager(n, "B", m, ltn=v) for n, v in (("a", 1), ("b", 2)) for m in (1, 2)]
    got = scorecard.kpi_rank_sum(frames(spark, [], [], rows), FEB, weights={"rank_ltn_avg": 4})
    assert as_set(got, "email", "score") == {("a@x", 10), ("b@x", 6)}
    with pytest.raises(ValueError, match="no rank"):
        scorecard.kpi_rank_sum(frames(spark, [], [], rows), FEB, weights={"rank_of_nothing": 1})


def test_kpi_ranks_come_before_the_ratio_join(spark):
    rows = [manager(n, a, m, ltn=v) for n, a, v in (("a", "B", 1), ("b", "C", 2), ("c", "D", 3)) for m in (1, 2)]
    loans = [loan(1, "B", 10, 3), loan(1, "B", 30, 1), loan(1, "C", 10, 3)]
    got = scorecard.asm_npl_report(frames(spark, [], loans, rows), FEB)
    assert as_set(got, "email", "rank_ltn_avg", "npl", "rank_npl") == {("a@x", 3, 25.0, 1), ("b@x", 2, 100.0, 2)}


def test_scorecard_by_value_ranges_equals_plain_windows(spark, small):
    from profitgrid.sources.star import StarModel

    model = StarModel(spark, small).frames()
    periods = Periods((1996, 1997), (2,))
    plain = scorecard.scorecard(model, periods)
    ranged = scorecard.scorecard(model, periods, values_per_task=3)
    assert as_set(plain, *plain.columns) == as_set(ranged, *plain.columns)


def test_scorecard_of_many_months_equals_each_month_alone(spark, small):
    from profitgrid.sources.star import StarModel

    model = StarModel(spark, small.replace("0.001", "0.01")).frames()
    together = scorecard.scorecard(model, Periods((1997,), (1, 3))).collect()
    alone = [r for m in (1, 3) for r in scorecard.scorecard(model, Periods.of(1997, m)).collect()]
    assert together and sorted(together) == sorted(alone)


def test_finance_ranks_can_be_turned_round(spark, small):
    from profitgrid.sources.star import StarModel

    model = StarModel(spark, small.replace("0.001", "0.01")).frames()
    periods = Periods.of(1997, 2)
    low = scorecard.scorecard(model, periods).select("email", "margin", F.col("rank_margin").alias("low"))
    high = scorecard.scorecard(model, periods, best_high=("margin",)).select("email", F.col("rank_margin").alias("high"))
    both = low.join(high, "email").orderBy("margin").collect()
    assert both[0]["low"] == 1 and both[-1]["high"] == 1


def test_managers_with_equal_or_missing_email_stay_apart(spark):
    sheet = spark.createDataFrame(
        [("north", "a", None, 1, 1, 1.0, 3, 1, 1.0), ("north", "b", None, 5, 1, 1.0, 7, 1, 1.0),
         ("north", "c", "x@x", 2, 1, 1.0, 2, 1, 1.0), ("north", "c", "x@x", 9, 1, 1.0, 9, 1, 1.0)],
        "area_name string, sale_name string, email string, ltn_jan long, psdn_jan long, approval_rate_jan double, "
        "ltn_feb long, psdn_feb long, approval_rate_feb double",
    )
    averages = asm_averages(sheet_to_long(sheet, F.lit(2023)), FEB)
    assert sorted(r.ltn_avg for r in averages.collect()) == [2.0, 2.0, 6.0, 9.0]
    ranked = add_ranks(averages, ["month_key"], [Rank("ltn_avg", "r", descending=True)])
    assert sorted(r.r for r in ranked.collect()) == [1, 2, 3, 3]
