"""The sales-manager sheet: wide to long, completeness, headcount, averages."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitgrid.functions.columns import month_key
from profitgrid.periods import Periods

# Months in column names of the wide sheet, January first.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MEASURES = ("ltn", "psdn", "approve", "app_in", "approval_rate")
MANAGER = "manager"  # names a row of the wide sheet; names and e-mails may repeat or be missing
COMPLETE = ("ltn", "approve", "app_in", "approval_rate")


def sheet_to_long(sheet: DataFrame, year: Column | None = None) -> DataFrame:
    """One row per manager and month from a sheet with a column per measure and month.

    Months that the sheet has no columns for are left out; ``year`` defaults to the sheet's column. Rows
    without a ``manager`` column get a number each, so that two managers with one e-mail stay two.
    """
    if MANAGER not in sheet.columns:
        sheet = sheet.withColumn(MANAGER, F.monotonically_increasing_id())
    present = [m for m in MONTHS if f"ltn_{m}" in sheet.columns]
    cells = [
        F.struct(
            F.lit(MONTHS.index(m) + 1).alias("month"),
            *[
                (F.col(f"{c}_{m}") if f"{c}_{m}" in sheet.columns else F.lit(None)).alias(c)
                for c in MEASURES
            ],
        )
        for m in present
    ]
    return sheet.select(
        MANAGER,
        "area_name",
        "sale_name",
        "email",
        (F.col("year") if year is None else year).alias("year"),
        F.explode(F.array(*cells)).alias("cell"),
    ).select(MANAGER, "area_name", "sale_name", "email", "year", "cell.*")


def _row_of(sales: DataFrame) -> list[str]:
    """What names a manager: the sheet's row, or all of its texts in monthly rows without it."""
    return [MANAGER] if MANAGER in sales.columns else []


def complete_january(sales: DataFrame) -> DataFrame:
    """Rows of managers whose January is complete.

    The completeness test of the monthly reports looks at January only, whatever the report month.
    """
    return sales.where(F.col("month") == 1).dropna(subset=list(COMPLETE))


def complete_through(sales: DataFrame, periods: Periods) -> DataFrame:
    """(year, month, area_name, sale_name, email): managers complete in every month up to each report month."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in COMPLETE])
    incomplete_from = F.coalesce(
        *[
            F.when(~F.coalesce(F.bool_and(F.when(F.col("month") == m, complete)), F.lit(False)), F.lit(m))
            for m in range(1, periods.last + 1)
        ],
        F.lit(periods.last + 1),
    )
    report_months = F.array(*[F.lit(m) for m in periods.months])
    return (
        sales.where(periods.year_months())
        .groupBy("year", *_row_of(sales), "area_name", "sale_name", "email")
        .agg(incomplete_from.alias("first"))
        .select(
            "year",
            F.explode(F.filter(report_months, lambda m: m < F.col("first"))).alias("month"),
            "area_name",
            "sale_name",
            "email",
        )
    )


def headcount_by_area(roster: DataFrame) -> DataFrame:
    """All managers on the sheet per region name, complete or not."""
    return roster.groupBy("area_name").agg(F.count("sale_name").alias("headcount"))


def asm_averages(sales: DataFrame, periods: Periods) -> DataFrame:
    """KPIs per manager over months 1..m: mean of ``ltn`` and ``psdn``, *sum* of approval rates.

    One row per manager and report month m, all from one aggregate per manager and year. A manager
    with a month missing gets NULL. The rates are added and not averaged, as the scorecard has
    always done; ranks do not depend on it.
    """
    kpis = ("ltn", "psdn", "approval_rate")
    months = range(1, periods.last + 1)
    cells = [F.max(F.when(F.col("month") == m, F.col(c))).alias(f"{c}_{m}") for c in kpis for m in months]

    def through(measure: str, last: int) -> Column:
        return reduce(add, [F.col(f"{measure}_{m}") for m in range(1, last + 1)])

    averages = [
        F.struct(
            month_key(F.col("year"), F.lit(m)).alias("month_key"),
            (through("ltn", m) / m).alias("ltn_avg"),
            (through("psdn", m) / m).alias("psdn_avg"),
            through("approval_rate", m).alias("approve_rate_avg"),
        )
        for m in periods.months
    ]
    return (
        sales.where(periods.year_months())
        .groupBy("year", *_row_of(sales), "area_name", "sale_name", "email")
        .agg(*cells)
        .select("area_name", "email", F.explode(F.array(*averages)).alias("a"))
        .select("a.month_key", "area_name", "email", "a.ltn_avg", "a.psdn_avg", "a.approve_rate_avg")
    )


def monthly_sheet(sales: DataFrame, keys: list[str] | None = None, months: int = 12) -> DataFrame:
    """The wide sheet of the first months, one row per manager and year, from monthly rows."""

    def cell(measure: str, month: int) -> Column:
        return F.max(F.when(F.col("month") == month, F.col(measure)))

    cells = [cell(c, i).alias(f"{c}_{m}") for i, m in enumerate(MONTHS[:months], 1) for c in MEASURES]
    keys = keys or ["area_name", "sale_name", "email", "year"]
    return sales.where(F.col("month") <= months).groupBy(*keys).agg(*cells)
