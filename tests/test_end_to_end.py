"""From CSV files to the reports, against a brute-force computation in exact fractions."""

from __future__ import annotations

import datetime as dt
import random
from fractions import Fraction

import fixtures
import pytest
from pyspark.sql import functions as F

from profitgrid import rules as R
from profitgrid.operators import dims, sheet
from profitgrid.periods import Periods
from profitgrid.plans import report, scorecard
from profitgrid.plans.frames import Frames
from profitgrid.rules import FINANCE_COMPANY
from profitgrid.session import shared_folder
from profitgrid.sources import readers

CITIES = {"Hà Giang": "B", "Tây Ninh": "H", "Cần Thơ": "G", "Nowhere": "A"}
NAMES = {"A": "Hội Sở", "B": "Đông Bắc Bộ", "G": "Tây Nam Bộ", "H": "Đông Nam Bộ"}
MONTHS = (1, 2, 3)


def rule_accounts() -> list[int]:
    listed = [a for r in FINANCE_COMPANY.rules for a in r.accounts]
    classes = [c * 10**10 + n for r in FINANCE_COMPANY.rules for c in r.account_classes for n in (1, 2)]
    return [*listed, *classes, 111000000001]


class Company:
    """Random rows of one company and what its reports must say."""

    def __init__(self, seed: int) -> None:
        rnd = random.Random(seed)
        self.postings = [
            (dt.date(2023, rnd.choice(MONTHS), rnd.randint(1, 28)), account, analysis, rnd.randint(-500, 900))
            for account in rule_accounts()
            for analysis in ("HEAD0001", "DVML0001A", "DVML0001B", "DVML0001G", "DVML0001H", "DVML0001Z", "OTHER001B")
            for _ in range(rnd.randint(0, 2) if analysis[-1] in "AZ" else rnd.randint(2, 5))
        ]
        self.loans = []
        for i in range(300):
            month, name = 202300 + rnd.choice(MONTHS), rnd.choice(list(CITIES))
            off = rnd.choice([None, month, month - 1])
            self.loans.append(
                (month, f"{name}-{rnd.randint(1, 3)}", name, i, rnd.randint(1, 10**6), off,
                 rnd.randint(1, 10**5) if off else None, rnd.choice([0, 1, None]), rnd.choice([None, 1, 2, 3, 4, 5]))
            )
        self.managers = [(rnd.choice(list(NAMES.values())), f"m{i}", f"m{i}@x") for i in range(25)]
        self.kpis = {
            (email, m): tuple(rnd.choice([None, *range(1, 9)]) if rnd.random() < 0.3 else rnd.randint(1, 9) for _ in range(4))
            + (rnd.randint(1, 100) / 100,)
            for _, _, email in self.managers
            for m in MONTHS
        }

    def write(self, spark, folder: str) -> Frames:
        ledger = [(d, a, None, code, amount, None, None) for d, a, code, amount in self.postings]
        fixtures.ledger(spark, ledger).write.csv(f"{folder}/ledger", header=True)
        fixtures.balances(spark, [(*loan, None) for loan in self.loans]).write.csv(f"{folder}/balances", header=True)
        short = sheet.MONTHS[: len(MONTHS)]
        rows = [(*m, *[v for i in MONTHS for v in self.kpis[m[2], i]]) for m in self.managers]
        spark.createDataFrame(rows, readers.sheet_schema(short)).write.csv(f"{folder}/sheet", header=True)

        balances = readers.read_balances(spark, f"{folder}/balances", "csv")
        wide = readers.read_sales_sheet(spark, f"{folder}/sheet", short, "csv")
        roster = readers.roster_of(wide)
        return Frames(
            readers.read_ledger(spark, f"{folder}/ledger", "csv"),
            balances,
            dims.build_city(balances, dims.city_letters(spark)),
            dims.build_area(roster, dims.area_letters(spark)),
            sheet.sheet_to_long(wide, F.lit(2023)),
            roster,
        )

    def weight(self, kind: str, last: int) -> dict[str, Fraction]:
        if kind == R.HEADCOUNT:
            letters = {name: letter for letter, name in NAMES.items()}
            heads: dict[str, Fraction] = {}
            for area, _, email in self.managers:
                ltn, _, approve, app_in, rate = self.kpis[email, 1]
                if None not in (ltn, approve, app_in, rate):
                    heads[letters[area]] = heads.get(letters[area], Fraction(0)) + 1
            return heads
        test = {
            R.BALANCE_1: lambda bucket, psdn: (bucket or 1) == 1,
            R.BALANCE_2: lambda bucket, psdn: bucket == 2,
            R.BALANCE_2_TO_5: lambda bucket, psdn: bucket is not None and 2 <= bucket <= 5,
            R.BALANCE_ALL: lambda bucket, psdn: True,
            R.ACTIVATIONS: lambda bucket, psdn: psdn == 1,
        }[kind]
        monthly: dict[tuple[str, int], int] = {}
        for month, _, name, _, principal, _, _, psdn, bucket in self.loans:
            if month <= 202300 + last and test(bucket, psdn):
                key = CITIES[name], month
                monthly[key] = monthly.get(key, 0) + (1 if kind == R.ACTIVATIONS else principal)
        result = {}
        for letter in {a for a, _ in monthly}:
            values = [v for (a, _), v in monthly.items() if a == letter]
            result[letter] = Fraction(sum(values), 1 if kind == R.ACTIVATIONS else len(values))
        return result

    def pool(self, rule: R.MetricRule, last: int) -> int | None:
        """Head-office total, None without any posting."""
        amounts = [
            p[3] for p in self.postings if self.uses(rule, p[1]) and p[0].month <= last and p[2].startswith("HEAD")
        ]
        return sum(amounts) if amounts else None

    def level1(self, last: int) -> dict[str, dict[str, int | None]]:
        """Rounded level-1 metrics per region letter."""
        metrics: list[dict[str, int | None]] = []
        for rule in FINANCE_COMPANY.only(R.LEVEL_1).rules:
            mine = [p for p in self.postings if self.uses(rule, p[1]) and p[0].month <= last]
            pool = self.pool(rule, last)
            own: dict[str, int] = {}
            for _, _, code, amount in mine:
                if code.startswith("DVML") and code[8] in "ABCDEFGH":
                    own[code[8]] = own.get(code[8], 0) + amount
            weight = self.weight(rule.weight, last)
            total = sum(weight.values())
            metrics.append(
                {
                    a: None if pool is None else half_away(own[a] + pool * weight[a] / total)
                    for a in own.keys() & weight.keys()
                }
            )
        kept = set.intersection(*[set(m) for m in metrics])
        return {a: {name: m[a] for name, m in zip(R.LEVEL_1, metrics)} for a in kept}

    @staticmethod
    def uses(rule: R.MetricRule, account: int) -> bool:
        return account in rule.accounts or account // 10**10 in rule.account_classes

    def level2(self, last: int) -> dict[str, dict[str, Fraction | None]]:
        level1 = self.level1(last)
        pools = {rule.metric: self.pool(rule, last) for rule in FINANCE_COMPANY.only(R.LEVEL_2).rules}
        needed = [row[m] for row in level1.values() for m in (*R.CARD_INCOMES, "rev_business")]
        if None in needed:
            return {a: dict.fromkeys(pools) for a in level1}
        card = {a: sum(row[m] for m in R.CARD_INCOMES) for a, row in level1.items()}
        income = sum(card.values()) + sum(row["rev_business"] for row in level1.values())
        return {
            a: {m: None if pool is None else Fraction(pool * card[a], income) for m, pool in pools.items()}
            for a in level1
        }


def half_away(value: Fraction) -> int:
    whole = abs(value) + Fraction(1, 2)
    return (1 if value >= 0 else -1) * (whole.numerator // whole.denominator)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reports_equal_brute_force(spark, seed):
    company = Company(seed)
    frames = company.write(spark, shared_folder(spark))
    rows = report.summary(frames, Periods.months_of(2023, 1, 3)).collect()
    got = {(r["month"], r["area_name"]): r for r in rows}
    want = {}
    for month in MONTHS:
        level1, level2 = company.level1(month), company.level2(month)
        for letter in level1:
            want[month, NAMES[letter]] = (level1[letter], level2[letter])
    assert set(got) == set(want) and len(want) >= 6
    for key, (level1, level2) in want.items():
        assert {m: got[key][m] for m in R.LEVEL_1} == level1
        for metric, value in level2.items():
            if value is None:
                assert got[key][metric] is None
            else:
                assert got[key][metric] == pytest.approx(float(value), rel=1e-12, abs=1e-9)


def test_reports_of_the_finance_company(spark):
    company = Company(4)
    frames = company.write(spark, shared_folder(spark))
    periods = Periods.of(2023, 2)
    wide = report.in_area_order(report.wide_report(frames, periods), frames).collect()
    order = [r["area_name"] for r in wide]
    assert order == [n for n in frames.organisation.area_names if n in order] and "Hội Sở" not in order
    table = report.pivot_report(frames, periods, text=True)
    assert table.columns[3:10] == list(frames.organisation.area_names)
    rows = {r["criterion"]: r for r in table.collect()}
    assert len(rows) == 32 and rows["DT Fintech"]["Total"] == "0"
    for r in wide:
        assert rows["Lãi trong hạn"][r["area_name"]] == str(r["interest_in_term"])
        assert float(rows["CIR (%)"][r["area_name"]]) == r["cir"]
    assert rows["Lãi trong hạn"]["Total"] == str(sum(r["interest_in_term"] for r in wide))

    cards = scorecard.scorecard(frames, periods).collect()
    assert cards and {c["area_name"] for c in cards} <= set(order)
    both = [m for m in company.managers if None not in (company.kpis[m[2], 1][0], company.kpis[m[2], 2][0])]
    both = [m for m in both if None not in (company.kpis[m[2], 1][1], company.kpis[m[2], 2][1])]
    assert {c["email"] for c in cards} <= {m[2] for m in both}
    for c in cards:
        assert c["total_score"] == c["scale_score"] + c["finance_score"]
        assert c["rank_final"] == 1 + sum(o["total_score"] < c["total_score"] for o in cards)
        better = [m for m in both if mean_ltn(company, m) > mean_ltn(company, (None, None, c["email"]))]
        assert c["rank_ltn_avg"] == 1 + len(better)


def mean_ltn(company: Company, manager: tuple) -> float:
    return (company.kpis[manager[2], 1][0] + company.kpis[manager[2], 2][0]) / 2


@pytest.mark.parametrize("fan_out", [True, False])
def test_npl_equals_brute_force(spark, fan_out):
    company = Company(5)
    frames = company.write(spark, shared_folder(spark))
    got = {r["area_code"]: r["npl"] for r in scorecard.npl_by_area(frames, Periods.of(2023, 3), fan_out).collect()}
    points = {name: len({loan[1] for loan in company.loans if loan[2] == name}) for name in CITIES}
    for name, letter in CITIES.items():
        means = []
        for least in (3, 0):
            off, before = 0, []
            for month in (202301, 202302, 202303):
                mine = [l for l in company.loans if l[0] == month and l[2] == name and (l[8] or 0) >= least]
                factor = points[name] if fan_out else 1
                off += factor * sum(l[6] for l in mine if l[5] == month)
                if mine:
                    before.append(factor * sum(l[4] for l in mine) + off)
            means.append(Fraction(sum(before), len(before)))
        assert got[letter] == pytest.approx(float(100 * means[0] / means[1]), rel=1e-12)
