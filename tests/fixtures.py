"""Small literal tables in the finance model's schemas."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

from pyspark.sql import DataFrame, SparkSession

from profitgrid import rules as R
from profitgrid import schemas
from profitgrid.operators.balances import point_sums
from profitgrid.plans.frames import Frames, Organisation
from profitgrid.rules import MetricRule, RuleBook

ONE_METRIC = RuleBook((MetricRule("interest_in_term", R.BALANCE_1, (702000030001,)),))


def posting(month: int, account: int, analysis: str, amount: int | None, year: int = 2023) -> tuple:
    return (dt.date(year, month, 15), account, None, analysis, amount, None, -1)


def head(month: int, account: int, amount: int | None) -> tuple:
    return posting(month, account, "HEAD0001", amount)


def direct(month: int, account: int, letter: str, amount: int | None) -> tuple:
    return posting(month, account, f"DVML0001{letter}", amount)


def loan(
    month: int,
    area: str,
    principal: int | None,
    bucket: int | None = 1,
    psdn: int | None = None,
    written_off: tuple[int, int] | None = None,
    point: int = 1,
) -> tuple:
    key = 202300 + month
    off_month, off_amount = written_off or (None, None)
    return (key, f"p{area}{point}", f"city {area}", 1, principal, off_month, off_amount, psdn, bucket, -1)


def ledger(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.LEDGER)


def balances(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.BALANCES)


def sums(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return point_sums(balances(spark, rows))


def city(spark: SparkSession, areas: str = "ABCD", points: int = 1) -> DataFrame:
    rows = [(f"p{a}{i}", f"city {a}", a) for a in areas for i in range(1, points + 1)]
    return spark.createDataFrame(rows, schemas.CITY)


AREA_NAMES = {"A": "head office", "B": "north", "C": "south", "D": "east"}


def area(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(AREA_NAMES.items()), schemas.AREA)


def manager(name: str, area_letter: str, month: int, ltn: int | None = 1, psdn: int | None = 1, rate: float | None = 0.5) -> tuple:
    return (AREA_NAMES[area_letter], name, f"{name}@x", 2023, month, ltn, psdn, 1, 2, rate)


def sales(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.SALES)


def frames(
    spark: SparkSession,
    ledger_rows: list[tuple],
    balance_rows: list[tuple],
    sales_rows: list[tuple] | None = None,
    rules: RuleBook = ONE_METRIC,
    points: int = 1,
) -> Frames:
    kpis = sales(spark, sales_rows or [])
    return Frames(
        ledger(spark, ledger_rows),
        balances(spark, balance_rows),
        city(spark, points=points),
        area(spark),
        kpis,
        kpis.select("area_name", "sale_name", "email").distinct(),
        Organisation(rules, "head office", ("north", "south", "east")),
    )


def complete_book() -> RuleBook:
    """One account per metric, 100..111 for level 1 and 112, 113 for level 2."""
    weights = {m: R.BALANCE_ALL for m in R.LEVEL_1} | {m: R.CARD_INCOME for m in R.LEVEL_2}
    return RuleBook(tuple(MetricRule(m, w, (account(m),)) for m, w in weights.items()))


def account(metric: str) -> int:
    return 700000000100 + [*R.LEVEL_1, *R.LEVEL_2].index(metric)


def as_set(df: DataFrame, *columns: str) -> set[tuple]:
    return {tuple(r) for r in df.select(*columns).collect()}


def plan_of(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
