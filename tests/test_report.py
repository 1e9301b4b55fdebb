"""Assembly of level 1, level 2, aggregates, ratios, reshaping and multi-month reports."""

from __future__ import annotations

import pytest
from fixtures import account, as_set, complete_book, direct, frames, head, loan, manager
from pyspark.sql import functions as F

from profitgrid import rules as R
from profitgrid.operators import dims, reshape
from profitgrid.periods import Periods
from profitgrid.plans import report
from profitgrid.plans.scorecard import FINANCE
from profitgrid.plans.store import keep_summary
from profitgrid.session import shared_folder

JAN, FEB = Periods.of(2023, 1), Periods.of(2023, 2)
MANAGERS = [manager("a", "B", 1), manager("b", "B", 1), manager("c", "C", 1)]


def full_ledger(amounts: dict[str, int], letters: str = "BC", month: int = 1) -> list[tuple]:
    """Every level-1 metric with a pool of zero and the given direct amount per region."""
    rows = []
    for metric in R.LEVEL_1:
        rows.append(head(month, account(metric), 0))
        rows += [direct(month, account(metric), letter, amounts.get(metric, 0)) for letter in letters]
    return rows


def company(spark, rows, loans=None):
    return frames(spark, rows, loans or [loan(1, "B", 1), loan(1, "C", 1)], MANAGERS, complete_book())


def test_amounts_are_rounded_half_away_from_zero_when_stored(spark):
    # pools of 5, -5 and 4.8 halved: 2.5, -2.5 and 2.4 per region
    rows = full_ledger({}) + [head(1, account("rev_business"), 5), head(1, account("cost_staff"), -5)]
    got = report.level1_report(company(spark, rows), JAN)
    assert as_set(got, "area_name", "rev_business", "cost_staff") == {("north", 3, -3), ("south", 3, -3)}


def test_region_needs_all_twelve_metrics(spark):
    rows = full_ledger({}, "BC")
    missing = [r for r in rows if not (r[1] == account("cost_asset") and r[3].endswith("C"))]
    assert as_set(report.level1_report(company(spark, missing), JAN), "area_name") == {("north",)}


def test_null_metric_keeps_the_region(spark):
    rows = [r for r in full_ledger({"cost_asset": -7}) if not (r[1] == account("cost_asset") and r[3].startswith("HEAD"))]
    got = report.level1_report(company(spark, rows), JAN)
    assert as_set(got, "area_name", "cost_asset") == {("north", None), ("south", None)}


def test_cost_of_funds_follows_rounded_card_income(spark):
    rows = full_ledger({"interest_in_term": 30, "fee_insurance": 10, "rev_business": 60})
    rows += [head(1, account("cost_fund_cctg"), -100), head(1, account("cost_fund_tt2"), -50)]
    got = report.summary(company(spark, rows), JAN)
    # 40 card income of 80 + 120 revenue in total
    assert as_set(got, "area_name", *R.LEVEL_2) == {("north", -20.0, -10.0), ("south", -20.0, -10.0)}


def test_cost_of_funds_is_zero_without_income_and_null_without_pool(spark):
    nothing = full_ledger({}) + [head(1, account("cost_fund_cctg"), -100)]
    got = report.summary(company(spark, nothing), JAN)
    assert as_set(got, *R.LEVEL_2) == {(0.0, 0.0)}
    income = full_ledger({"interest_in_term": 1}) + [head(1, account("cost_fund_cctg"), -100)]
    got = report.summary(company(spark, income), JAN)
    assert as_set(got, *R.LEVEL_2) == {(-50.0, None)}


def test_zero_denominators_give_null_ratios(spark):
    rows = full_ledger({}) + [head(1, account(m), 0) for m in R.LEVEL_2]
    got = report.measures(company(spark, rows), JAN)
    assert as_set(got, "area_name", *FINANCE) == {("north", None, None, None, 0.0), ("south", None, None, None, 0.0)}


def test_head_office_is_not_reported(spark):
    rows = full_ledger({}, "ABC") + [head(1, account(m), 0) for m in R.LEVEL_2]
    company_ = frames(
        spark, rows, [loan(1, a, 1) for a in "ABC"], [*MANAGERS, manager("h", "A", 1)], complete_book()
    )
    assert as_set(report.summary(company_, JAN), "area_name") == {("head office",), ("north",), ("south",)}
    assert as_set(report.wide_report(company_, JAN), "area_name", "headcount") == {("north", 2), ("south", 1)}


# Three published rows of a real month: level 1, level 2 and headcount, then results.
PUBLISHED = {
    "north": (
        (71210401716, 64191654, 2248781647, 3625425756, 634722991, 5445450, -74515640, -5112847483,
         -9172655789, -356162358, -894738097, -40615928951),
        (-13832500478, -1049734026),
        {"card_income": 77783523764, "net_fund_cost": -14882234504, "net_other": -5181917673,
         "total_cost": -10423556244, "cir": 18.06},
    ),
    "south": (
        (96090675424, 87499120, 944207739, 5004389958, 741649960, 6684151, -91043735, -6169920131,
         -13799752480, -544890364, -1249420516, -43413672058),
        (-18293430670, -1388269363),
        {"card_income": 102868422201, "net_fund_cost": -19681700033, "net_other": -6254279715,
         "total_cost": -15594063360, "cir": 20.27},
    ),
    "east": (
        (19822618842, 765223, 60962181, 1040022295, 156193505, 1774191, -25259007, -1630922532,
         -3477629404, -136693619, -319438705, -6498522434),
        (-3748825850, -284494481),
        {"card_income": 21080562046, "net_fund_cost": -4033320331, "net_other": -1654407348,
         "total_cost": -3933761728, "cir": 25.56},
    ),
}


def test_aggregates_of_published_rows(spark):
    stored = spark.createDataFrame(
        [(2023, 2, name, *level1, *map(float, level2)) for name, (level1, level2, _) in PUBLISHED.items()],
        ["year", "month", "area_name", *R.LEVEL_1, *R.LEVEL_2],
    )
    company_ = frames(spark, [], [], [manager(n, a, 1) for n, a in (("a", "B"), ("b", "C"), ("c", "D"))])
    rows = {r["area_name"]: r for r in report.measures(company_, FEB, stored).collect()}
    for name, (_, _, expected) in PUBLISHED.items():
        got = rows[name].asDict()
        assert {c: got[c] for c in expected} == expected
        assert got["total_income"] == expected["card_income"] + expected["net_fund_cost"] + expected["net_other"]
        profit = got["total_income"] + expected["total_cost"] + got["cost_provision"]
        assert got["profit_before_tax"] == profit


def test_many_months_in_one_pass_equal_month_by_month(spark, small):
    from profitgrid.sources.star import StarModel

    frames_ = StarModel(spark, small).frames()
    together = as_set(report.wide_report(frames_, Periods.months_of(1997, 1, 12)), "*")
    assert together
    for month in (1, 2, 4, 7, 12):
        alone = as_set(report.wide_report(frames_, Periods.of(1997, month)), "*")
        assert {row for row in together if row[1] == month} == alone


def test_years_in_one_pass_equal_year_by_year(spark, small):
    from profitgrid.sources.star import StarModel

    frames_ = StarModel(spark, small).frames()
    together = as_set(report.level1_report(frames_, Periods((1996, 1998), (12,))), "*")
    apart = as_set(report.level1_report(frames_, Periods.of(1996, 12)), "*")
    apart |= as_set(report.level1_report(frames_, Periods.of(1998, 12)), "*")
    assert together == apart and together


@pytest.fixture
def wide(spark):
    columns = ["year", "month", "area_name", *[m for _, m in reshape.CRITERIA]]
    amounts = list(range(1, 22))
    return spark.createDataFrame(
        [
            (2023, 2, "north", *amounts, 1.5, 2.5, 3.5, 4.5),
            (2023, 2, "south", *[2 * a for a in amounts], None, 1.25, 1.25, 1.25),
        ],
        ", ".join(
            ["year int", "month int", "area_name string"] + [f"{c} bigint" for c in columns[3:24]] + [f"{c} double" for c in columns[24:]]
        ),
    )


def test_pivot_and_back(wide):
    names = ("north", "south", "east")
    melted = reshape.melt(wide)
    table = reshape.pivot(melted, names)
    back = reshape.unpivot(table, names).where("value is not null")
    kept = melted.where("value is not null")
    columns = ["year", "month", "area_name", "criterion", "value"]
    assert as_set(back, *columns) == as_set(kept, *columns)


def test_totals_add_ratios_unless_told_not_to(wide):
    melted = reshape.melt(wide, reshape.CRITERIA_ONE_MONTH)
    rows = {r["criterion"]: r for r in reshape.pivot(melted, ("north", "south"), reshape.CRITERIA_ONE_MONTH).collect()}
    assert len(rows) == 32
    assert float(rows["1.Lợi nhuận trước thuế"]["Total"]) == 3.0
    assert float(rows["CIR (%)"]["Total"]) == 1.5 and rows["CIR (%)"]["south"] is None
    assert float(rows["3.Chỉ số tài chính"]["Total"]) == 0.0
    assert float(rows["DT Fintech"]["north"]) == 0.0
    without = reshape.pivot(melted, ("north", "south"), reshape.CRITERIA_ONE_MONTH, total_ratios=False)
    assert {r["criterion"]: r["Total"] for r in without.collect()}["CIR (%)"] is None


def test_pivot_order_and_text(wide):
    rows = reshape.pivot(reshape.melt(wide), ("north", "south"), text=True).collect()
    assert [r["criterion"] for r in rows] == [label for label, _ in reshape.CRITERIA]
    assert [r["sort_pos"] for r in rows] == list(range(1, 26))
    assert rows[0]["north"] == "1.00" and rows[0]["Total"] == "3.00"
    assert rows[1]["north"] == "2" and rows[21]["north"] == "1.50" and rows[21]["south"] is None


def test_wide_report_with_display_names(wide):
    names = report.with_labels(wide).columns
    assert names[2:4] == ["tenkhuvuc", "1.Lợi nhuận trước thuế"] and len(set(names)) == 28
    table = report.with_labels(reshape.pivot(reshape.melt(wide), ("north", "south")))
    assert table.columns == ["year", "month", "Tiêu chí", "north", "south", "Total", "sort_pos"]


def test_area_order_puts_unlisted_last(spark, wide):
    frames_ = frames(spark, [], [])
    others = wide.where("area_name = 'south'").withColumn("area_name", F.lit("new"))
    rows = report.in_area_order(others.unionByName(wide), frames_).collect()
    assert [(r["area_name"], r["sort_pos"]) for r in rows] == [("north", 1), ("south", 2), ("new", 4)]


def test_roll_up_adds_leaves_to_every_level(spark):
    leaves = spark.createDataFrame(
        [("r", "interest_in_term", 10.0), ("r", "rev_business", 5.0), ("r", "cost_staff", -4.0), ("r", "cost_provision", -1.0)],
        ["area_name", "metric", "amount"],
    )
    got = dict(as_set(dims.roll_up(leaves, ["area_name"]), "funding_code", "amount"))
    assert got["card_income"] == 10.0 and got["net_other"] == 5.0 and got["total_income"] == 15.0
    assert got["total_cost"] == -4.0 and got["profit_before_tax"] == 10.0
    assert "net_fund_cost" not in got


def test_metric_dimension(spark):
    dimension = dims.metric_dimension(spark)
    assert dimension.where("rec_created_dt is null").count() == 0
    rows = dimension.orderBy("sortorder").collect()
    assert [r["funding_id"] for r in rows] == list(range(1, 21))
    assert rows[1]["funding_parent_id"] == 1 and rows[0]["funding_parent_id"] is None


def test_revenue_shares(spark):
    rows = full_ledger({"interest_in_term": 30, "rev_business": 10}, "B")
    rows += full_ledger({"interest_in_term": 10, "rev_business": 30}, "C")
    got = report.revenue_shares(company(spark, rows), JAN)
    assert as_set(got, "area_name", "card_income_share", "revenue_share") == {("north", 75.0, 50.0), ("south", 25.0, 50.0)}


def test_stored_months_keep_their_first_values(spark):
    path = shared_folder(spark)
    before = company(spark, full_ledger({"interest_in_term": 30}))
    after = company(spark, full_ledger({"interest_in_term": 70}))
    keep_summary(before, JAN, path)
    stored = keep_summary(after, Periods.months_of(2023, 1, 2), path)
    assert as_set(stored, "month", "interest_in_term") == {(1, 30), (2, 70)}
    wide = report.wide_report(after, FEB, stored.where("month = 1"))
    assert as_set(wide, "month", "area_name", "interest_in_term") == {(1, "north", 30), (1, "south", 30)}
    stored = keep_summary(after, JAN, path, refresh=True)
    assert as_set(stored, "month", "interest_in_term") == {(1, 70)}
