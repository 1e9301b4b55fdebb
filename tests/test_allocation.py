"""Pools, direct amounts, weights and their allocation, against values computed by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import (
    ONE_METRIC,
    as_set,
    city,
    direct,
    frames,
    head,
    ledger,
    loan,
    manager,
    posting,
    sales,
    sums,
    area,
)
from profitgrid import rules as R
from profitgrid.operators import ledger as L
from profitgrid.operators import weights as W
from profitgrid.operators.sheet import complete_january, complete_through
from profitgrid.periods import Periods
from profitgrid.plans import report
from profitgrid.rules import FINANCE_COMPANY, MetricRule, RuleBook

INTEREST = 702000030001
FEB = Periods.of(2023, 2)
BASIC_LOANS = [loan(1, "B", 30), loan(2, "B", 50), loan(1, "C", 60)]
BASIC = [head(1, INTEREST, 100), direct(1, INTEREST, "B", 10), direct(2, INTEREST, "C", 20)]


def values(spark, ledger_rows, loans, periods=FEB):
    rows = report.level1_metric(frames(spark, ledger_rows, loans), periods, "interest_in_term")
    return as_set(rows, "month", "area_cde", "interest_in_term")


def test_average_counts_months_present_only(spark):
    assert values(spark, BASIC, BASIC_LOANS) == {(2, "B", 50.0), (2, "C", 80.0)}


def test_region_without_direct_postings_is_dropped_and_its_share_reported(spark):
    rows = BASIC[:2]
    assert values(spark, rows, BASIC_LOANS) == {(2, "B", 50.0)}
    left = report.allocation_residual(frames(spark, rows, BASIC_LOANS), FEB, ["interest_in_term"])
    assert as_set(left, "pool", "allocated", "residual") == {(100.0, 40.0, 60.0)}


def test_whole_pool_is_allocated_when_every_region_has_postings(spark):
    left = report.allocation_residual(frames(spark, BASIC, BASIC_LOANS), FEB, ["interest_in_term"])
    assert as_set(left, "pool", "residual") == {(100.0, 0.0)}


def test_missing_pool_makes_the_metric_null(spark):
    assert values(spark, BASIC[1:], BASIC_LOANS) == {(2, "B", None), (2, "C", None)}


def test_silent_month_keeps_earlier_amounts(spark):
    rows = [head(1, INTEREST, 100), direct(1, INTEREST, "B", 10)]
    periods = Periods.months_of(2023, 1, 3)
    got = values(spark, rows, [loan(1, "B", 5)], periods)
    assert got == {(1, "B", 110.0), (2, "B", 110.0), (3, "B", 110.0)}


def test_region_appears_with_its_first_posting(spark):
    rows = [head(1, INTEREST, 100), direct(1, INTEREST, "B", 10), direct(2, INTEREST, "C", 20)]
    got = values(spark, rows, [loan(1, "B", 50), loan(1, "C", 50)], Periods.months_of(2023, 1, 2))
    assert got == {(1, "B", 60.0), (2, "B", 60.0), (2, "C", 70.0)}


def test_other_years_and_later_months_do_not_count(spark):
    rows = [*BASIC, head(3, INTEREST, 999), posting(1, INTEREST, "DVML0001B", 999, year=2022)]
    assert values(spark, rows, BASIC_LOANS) == {(2, "B", 50.0), (2, "C", 80.0)}


def test_letters_outside_the_regions_do_not_count(spark):
    rows = [*BASIC, direct(1, INTEREST, "X", 5), posting(1, INTEREST, "DVML", 5), posting(1, INTEREST, "OTHER", 5)]
    assert values(spark, rows, BASIC_LOANS) == {(2, "B", 50.0), (2, "C", 80.0)}


def test_head_office_takes_weight(spark):
    loans = [loan(1, "A", 60), loan(1, "B", 40)]
    rows = [head(1, INTEREST, 100), direct(1, INTEREST, "B", 0)]
    assert values(spark, rows, loans) == {(2, "B", 40.0)}


def test_zero_weights_give_null(spark):
    assert values(spark, BASIC, [loan(1, "B", 0), loan(1, "C", 0)]) == {(2, "B", None), (2, "C", None)}


def test_bucket_rules(spark):
    rows = sums(spark, [loan(1, "B", p, b) for p, b in ((1, None), (2, 1), (4, 2), (8, 3))])
    got = W.monthly_by_area(rows, city(spark), FEB.keys("kpi_month"))
    totals = {weight: total for weight, total in as_set(got, "weight", "total")}
    assert totals == {R.BALANCE_1: 3, R.BALANCE_2: 4, R.BALANCE_2_TO_5: 12, R.BALANCE_ALL: 15}


def test_null_balances_keep_the_region_with_a_null_weight(spark):
    got = W.balance_weights(sums(spark, [loan(1, "B", None)]), city(spark), FEB, [R.BALANCE_ALL])
    assert as_set(got, "area_cde", "amount") == {("B", None)}


def test_activations_add_up(spark):
    rows = sums(spark, [loan(1, "B", 1, psdn=1), loan(1, "B", 1, psdn=0), loan(2, "B", 1, psdn=1), loan(2, "C", 1)])
    got = W.balance_weights(rows, city(spark), FEB, [R.ACTIVATIONS])
    assert as_set(got, "area_cde", "amount") == {("B", 2.0)}


def test_headcount_needs_a_complete_january_whatever_the_month(spark):
    rows = [manager("a", "B", 1), manager("b", "B", 1, ltn=None), manager("c", "C", 1), manager("c", "C", 2, ltn=None)]
    kpis = sales(spark, rows)
    got = W.headcount_weights(kpis, area(spark), Periods.months_of(2023, 1, 2))
    assert as_set(got, "month", "area_cde", "amount") == {(m, a, 1.0) for m in (1, 2) for a in "BC"}
    assert as_set(complete_january(kpis), "sale_name") == {("a",), ("c",)}
    assert as_set(complete_through(kpis, FEB), "sale_name") == set()
    assert as_set(complete_through(kpis, Periods.of(2023, 1)), "sale_name") == {("a",), ("c",)}
    both = complete_through(kpis, Periods.months_of(2023, 1, 2))
    assert as_set(both, "month", "sale_name") == {(1, "a"), (1, "c")}


def test_shares_add_up_to_one(spark):
    every = W.balance_weights(sums(spark, BASIC_LOANS), city(spark), FEB, [R.BALANCE_ALL])
    assert as_set(W.shares(W.with_total(every)), "area_cde", "share") == {("B", 0.4), ("C", 0.6)}


def test_one_account_may_feed_two_metrics(spark):
    book = RuleBook((MetricRule("x", R.BALANCE_1, (790000050101,)), MetricRule("y", R.BALANCE_1, (790000050101,))))
    got = L.direct_by_area(ledger(spark, [direct(1, 790000050101, "B", 5)]), FEB, book)
    assert as_set(got, "metric", "total_direct") == {("x", 5), ("y", 5)}


def test_account_class_is_a_range(spark):
    book = RuleBook((MetricRule("x", R.HEADCOUNT, account_classes=(85,)),))
    codes = (849999999999, 850000000000, 859999999999, 860000000000)
    rows = ledger(spark, [direct(1, code, "B", 10**i) for i, code in enumerate(codes)])
    assert as_set(L.direct_by_area(rows, FEB, book), "total_direct") == {(110,)}


def test_listed_account_of_another_metrics_class_counts_in_both(spark):
    book = RuleBook(
        (MetricRule("x", R.HEADCOUNT, account_classes=(85,)), MetricRule("y", R.HEADCOUNT, (850000000001, 700000000001)))
    )
    codes = (850000000001, 850000000002, 700000000001, 700000000002)
    rows = ledger(spark, [direct(1, code, "B", 10**i) for i, code in enumerate(codes)])
    assert as_set(L.direct_by_area(rows, FEB, book), "metric", "total_direct") == {("x", 11), ("y", 101)}
    assert as_set(L.account_set_totals(rows, book), "metric", "account_code") == {
        ("x", 850000000001), ("x", 850000000002), ("y", 850000000001), ("y", 700000000001)
    }


def test_account_in_list_and_class_of_one_metric_is_refused():
    with pytest.raises(ValueError):
        MetricRule("x", R.HEADCOUNT, (850000000001,), (85,))


def test_rule_book_of_the_finance_company():
    accounts = {r.metric: len(r.accounts) for r in FINANCE_COMPANY.rules}
    assert accounts["rev_business"] == 15 and accounts["cost_other_business"] == 22 and accounts["cost_provision"] == 12
    shared = [r.metric for r in FINANCE_COMPANY.rules if 790000050101 in r.accounts]
    assert shared == ["cost_other_business", "cost_provision"]
    assert FINANCE_COMPANY.weight_of("cost_staff") == R.HEADCOUNT


def test_whole_amount_overflow_raises_instead_of_wrapping(spark):
    rows = ledger(spark, [direct(1, INTEREST, "B", 2**62), direct(1, INTEREST, "B", 2**62)])
    with pytest.raises(Exception, match="OVERFLOW"):
        L.direct_by_area(rows, FEB, ONE_METRIC).collect()


def test_adhoc_month_set_and_order(spark):
    rows = [head(1, INTEREST, 100), direct(1, INTEREST, "B", 10), direct(2, INTEREST, "C", 20)]
    got = report.interest_in_term_by_name(frames(spark, rows, BASIC_LOANS), FEB, (1, 2))
    assert [tuple(r) for r in got.orderBy("sort_pos").select("area_name", "interest_in_term", "sort_pos").collect()] == [
        ("south", 80.0, 1),
        ("north", 50.0, 2),
    ]


def test_periods():
    assert Periods((2001, 1999), (3, 1, 3)) == Periods((1999, 2001), (1, 3))
    with pytest.raises(ValueError):
        Periods.of(2023, 0)
    with pytest.raises(ValueError):
        Periods.months_of(2023, 2, 1)


def test_period_keys_and_dates_pick_the_same_months(spark):
    days = spark.sql("SELECT explode(sequence(date'2018-12-01', date'2024-02-01', interval 1 month)) AS day").select(
        "day", (F.year("day") * 100 + F.month("day")).alias("key"), F.year("day").alias("year"), F.month("day").alias("month")
    )
    for periods in (FEB, Periods((2020,), (12,)), Periods((2019, 2020, 2021), (3,)), Periods((2019, 2022), (12, 5)), Periods((2019, 2022), (4,))):
        want = {(y * 100 + m,) for y in periods.years for m in range(1, periods.last + 1)}
        assert as_set(days.where(periods.keys("key")), "key") == want
        assert as_set(days.where(periods.dates("day")), "key") == want
        assert as_set(days.where(periods.year_months()), "key") == want
