"""Stored monthly sums: a new month reads its own postings and loans, and reports read sums only.

Each load stores the sums of its months: ledger per month, rule key and scope, balances per month and point of
sale, and January's rows of the manager sheet. It publishes them at once, month by month: a month that is
loaded again replaces its former sums, also by none, the others stay. So a year's report after month m + 1 costs the scan of
one month, whatever came before.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitgrid.operators import ledger as L
from profitgrid.operators.balances import point_sums
from profitgrid.periods import Months, Periods
from profitgrid.plans.frames import Frames
from profitgrid.sources.published import Parts, Published

JANUARY = 1


def _months_of(rows: DataFrame) -> set[int]:
    """The months that rows have, as yyyymm; one row per month reaches the driver."""
    return {r[0] for r in rows.distinct().collect()}


def add_months(frames: Frames, path: str, months: Months) -> list[int]:
    """Load the sums of some months of ``frames`` into the store at ``path``; returns the months as yyyymm.

    Postings and loans of other months are not read where the facts are stored by month.
    """
    table = Published(frames.ledger.sparkSession, path)
    name = uuid.uuid4().hex
    folder, spark = table.folder(name), table.spark
    sums = L.monthly_by_rule_key(frames.ledger, months, frames.organisation.rules)
    sums.write.partitionBy("year", "month").parquet(f"{folder}/ledger")
    point_sums(frames.balances.where(months.keys("kpi_month"))).write.partitionBy("kpi_month").parquet(f"{folder}/balances")
    sheet = frames.january_sales(months).where(months.year_months() & (F.col("month") == JANUARY))
    sheet.write.partitionBy("year").parquet(f"{folder}/sheet")
    month = (F.col("year") * 100 + F.col("month")).cast("bigint")
    found = _months_of(spark.read.schema(sums.schema).parquet(f"{folder}/ledger").select(month))
    found |= _months_of(spark.read.schema("kpi_month bigint").parquet(f"{folder}/balances"))
    found |= _months_of(spark.read.schema("year int").parquet(f"{folder}/sheet").select(F.col("year") * 100 + JANUARY))

    def loaded(entry: str) -> bool:
        year, number = divmod(int(entry.partition(":")[0]), 100)
        return number in months.months and (months.years is None or year in months.years)

    def next_parts(parts: Parts) -> Parts:
        kept = [p for p in parts if not loaded(p)]
        return tuple(sorted([*kept, *(f"{m}:{name}" for m in found)]))

    table.commit(next_parts)
    return sorted(found)


def frames_of(frames: Frames, path: str, periods: Periods) -> Frames:
    """Frames of a report that reads the stored sums of its months; dimensions and roster are those of ``frames``."""
    table = Published(frames.ledger.sparkSession, path)
    live = defaultdict(list)
    for entry in table.version()[1]:
        month, _, name = entry.partition(":")
        if (periods.years is None or int(month) // 100 in periods.years) and int(month) % 100 <= periods.last:
            live[name].append(int(month))
    if not live:
        raise ValueError(f"no month of {periods} is stored")
    month = F.col("year") * 100 + F.col("month")

    def of_parts(kind: str, schema, key) -> DataFrame:
        reader = table.spark.read.schema(schema)
        parts = [reader.parquet(f"{table.folder(n)}/{kind}").where(key.isin(*m)) for n, m in sorted(live.items())]
        return reduce(DataFrame.unionByName, parts)

    ledger_schema = "rule_key bigint, scope string, amount bigint, year int, month int"
    januaries = of_parts("sheet", frames.january_sales(periods).schema, month)
    return replace(
        frames,
        monthly=of_parts("ledger", ledger_schema, month),
        sums=of_parts("balances", point_sums(frames.balances).schema, F.col("kpi_month")),
        january=lambda _: januaries,
    )
