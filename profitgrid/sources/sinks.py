"""Sinks: full refresh, append-if-absent and replacement of groups, each published at once or not at all."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.session import stored_once
from profitgrid.sources.published import Parts, Published

SUMMARY_KEY = ["year", "month", "area_name"]


def overwrite(report: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace the stored report and return it as read back.

    The old report stays until the new one is complete, so the new one may read it.
    """
    table = Published(report.sparkSession, path)
    part = table.write(report, partition_by)
    return table.change(report.schema, lambda _: (part,))


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Store postings by year and month of their date, so that reports read their months only."""
    dated = ledger.withColumn("year", F.year("transaction_date")).withColumn("month", F.month("transaction_date"))
    dated.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def write_balances(balances: DataFrame, path: str) -> None:
    """Store the loan snapshot by month."""
    balances.write.mode("overwrite").partitionBy("kpi_month").parquet(path)


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None before the first rows are published."""
    table = Published(spark, path)
    return table.read(table.version()[1])


def first_per_key(batch: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, the lowest by its other columns, so that a rerun keeps the same row."""
    rest = [c for c in batch.columns if c not in key]
    return batch.groupBy(*key).agg(F.min(F.struct(*rest)).alias("kept")).select(*key, "kept.*").select(*batch.columns)


def _without(rows: DataFrame, others: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key no row of ``others`` has; NULL is a value like any other."""
    named = others.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
    same: Column = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    return rows.join(named, same, "left_anti")


def append_if_absent(
    batch: DataFrame, path: str, key: list[str] | None = None, partition_by: list[str] | None = None
) -> DataFrame:
    """Add rows whose key is not stored yet and return the stored table.

    A stored row never changes, even when its inputs have; see ``refresh``. A failed run can be repeated. Of
    runs at the same time the first to publish keeps its rows; the others check their keys again.
    """
    table, key = Published(batch.sparkSession, path), key or SUMMARY_KEY
    part, checked = None, ()

    def next_parts(parts: Parts) -> Parts:
        nonlocal part, checked
        fresh = first_per_key(batch, key) if part is None else table.read((part,), batch.schema)
        new = tuple(p for p in parts if p not in checked)
        if part is None or new:
            stored = table.read(new, batch.schema)
            part = table.write(fresh if stored is None else _without(fresh, stored, key), partition_by)
            checked = parts
        return (*parts, part)

    return table.change(batch.schema, next_parts)


def refresh(batch: DataFrame, path: str, groups: list[str]) -> DataFrame:
    """Replace the stored rows of those groups (values of some columns) that the batch has rows for.

    The other stored rows are kept; they are written again beside the batch.
    """
    table = Published(batch.sparkSession, path)
    part = table.write(batch)

    def next_parts(parts: Parts) -> Parts:
        stored = table.read(parts, batch.schema)
        if stored is None:
            return (part,)
        return table.write(_without(stored, table.read((part,), batch.schema), groups)), part

    return table.change(batch.schema, next_parts)


CREATED, UPDATED = "rec_created_dt", "rec_updated_dt"


def numbered(rows: DataFrame, serial: str, after: int = 0) -> DataFrame:
    """Add numbers after + 1, after + 2, ... without a window over all rows.

    A row's number is its place in its task plus the rows of the tasks before; only one count per task
    is added up. The rows are stored first, so that both readings see the same places.
    """
    place = F.monotonically_increasing_id()
    task, within = F.shiftright(place, 33).alias("_task"), place.bitwiseAND((1 << 33) - 1).alias("_within")
    rows = stored_once(rows.select("*", task, within))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(F.col("_task").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    number = F.lit(after) + F.col("_start") + F.col("_within") + 1
    placed = rows.join(F.broadcast(starts), F.col("_task") == F.col("_of")).withColumn(serial, number.cast("bigint"))
    return placed.drop("_task", "_within", "_of", "_start")


def load_dimension(batch: DataFrame, path: str, key: list[str], serial: str) -> DataFrame:
    """Load a dimension by its natural key and return the stored table.

    A key that is new gets the next serial number and the stamp of this load as its time of creation. A stored
    key keeps both; if one of its other columns has changed it gets the new values and the stamp as its time
    of update. All rows of one load have the same stamp. Keys that the batch lacks stay.
    """
    spark = batch.sparkSession
    table, batch = Published(spark, path), stored_once(first_per_key(batch, key))
    values = [c for c in batch.columns if c not in key]
    stamp = F.lit(spark.range(1).select(F.current_timestamp()).first()[0]).cast("timestamp")

    def next_parts(parts: Parts) -> Parts:
        stored = table.read(parts)
        if stored is None:
            return (table.write(numbered(batch, serial).withColumns({CREATED: stamp, UPDATED: stamp})),)
        highest = stored.agg(F.max(serial)).first()[0] or 0
        new = numbered(_without(batch, stored, key), serial, highest).withColumns({CREATED: stamp, UPDATED: stamp})
        given = batch.select(*[F.col(c).alias(f"_{c}") for c in batch.columns], F.lit(True).alias("_given"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
        differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in values], F.lit(False))
        changed = F.coalesce("_given", F.lit(False)) & differs
        kept = stored.join(given, same, "left").select(
            *[F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
              for c in stored.columns if c != UPDATED],
            F.when(changed, stamp).otherwise(F.col(UPDATED)).alias(UPDATED),
        )
        return table.write(kept.select(*stored.columns)), table.write(new.select(*stored.columns))

    return table.read(table.commit(next_parts))
