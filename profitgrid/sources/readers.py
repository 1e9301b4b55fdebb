"""File sources with fixed schemas: no inference pass over the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from profitgrid import schemas
from profitgrid.functions.columns import or_default
from profitgrid.operators.sheet import MEASURES, MONTHS
from profitgrid.session import stored_once


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, **options: str) -> DataFrame:
    if fmt == "csv":
        options = {"header": "true", "mode": "FAILFAST", **options}
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_ledger(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Ledger postings; ``sinks.write_ledger`` stores them so that periods prune files."""
    ledger = _read(spark, path, schemas.LEDGER, fmt, **options)
    return ledger.withColumn("funding_id", or_default("funding_id"))


def read_balances(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Monthly loan snapshot; ``sinks.write_balances`` stores it so that periods prune files."""
    balances = _read(spark, path, schemas.BALANCES, fmt, **options)
    return balances.withColumn("funding_id", or_default("funding_id"))


def sheet_schema(months: tuple[str, ...] = MONTHS) -> T.StructType:
    """Schema of the wide sheet with the given months."""
    names = [T.StructField(c, T.StringType()) for c in ("area_name", "sale_name", "email")]
    kinds = {c: T.DoubleType() if c == "approval_rate" else T.LongType() for c in MEASURES}
    return T.StructType(names + [T.StructField(f"{c}_{m}", kinds[c]) for m in months for c in MEASURES])


def read_sales_sheet(
    spark: SparkSession, path: str, months: tuple[str, ...] = MONTHS, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Wide sales-manager sheet; ``sheet_to_long`` makes rows of its month columns."""
    return _read(spark, path, sheet_schema(months), fmt, **options)


def roster_of(sheet: DataFrame) -> DataFrame:
    """One row per manager of a sheet that has one row per manager."""
    return sheet.select(*[F.col(f.name) for f in schemas.ROSTER])


RAW, FILE, REASON = "_raw", "_file", "_reason"


class TooManyRejected(ValueError):
    """More rows of a load were rejected than allowed."""


@dataclass(frozen=True)
class Checked:
    """A load of text files: ``kept`` rows and ``rejected`` ones (file, reason, raw line), from one parse that is
    stored, so that both and their counts agree."""

    parsed: DataFrame
    schema: T.StructType

    @property
    def kept(self) -> DataFrame:
        return self.parsed.where(F.col(REASON).isNull()).select(*self.schema.fieldNames())

    @property
    def rejected(self) -> DataFrame:
        whole = F.to_json(F.struct(*self.schema.fieldNames()))
        return self.parsed.where(F.col(REASON).isNotNull()).select(
            F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.coalesce(RAW, whole).alias("line")
        )

    def counts(self) -> DataFrame:
        """(reason, rows): NULL for rows that were kept."""
        return self.parsed.groupBy(F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))

    def no_more_than(self, rejected: int) -> Checked:
        """The same, if at most so many rows were rejected."""
        found = self.rejected.limit(rejected + 1).count()
        if found > rejected:
            reasons = self.counts().where("reason is not null").orderBy(F.desc("rows")).limit(5).collect()
            raise TooManyRejected(f"more than {rejected} rows rejected: {[tuple(r) for r in reasons]}")
        return self


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = (), fmt: str = "csv", **options: str
) -> Checked:
    """Text rows (csv or json) of a schema, good and bad ones apart; ``read_ledger`` and others stop at a bad one.

    A row is bad if a field cannot be read as its type or is missing, or if a ``required`` column, or one that
    the schema declares not nullable, is empty.
    """
    if fmt == "csv":
        options = {"header": "true", **options}
    open_schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + [T.StructField(RAW, T.StringType())])
    reader = spark.read.schema(open_schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, **options)
    needed = dict.fromkeys([*required, *(f.name for f in schema.fields if not f.nullable)])
    reason = F.when(F.col(RAW).isNotNull(), F.lit("malformed"))
    for column in needed:
        reason = reason.when(F.col(column).isNull(), F.lit(f"{column} is missing"))
    rows = reader.format(fmt).load(path).select("*", F.col("_metadata.file_path").alias(FILE))
    return Checked(stored_once(rows.withColumn(REASON, reason)), schema)


def read_ledger_checked(spark: SparkSession, path: str, fmt: str = "csv", **options: str) -> Checked:
    """Postings with account, date and amount, and what else the files hold."""
    return read_checked(spark, path, schemas.LEDGER, ("transaction_date", "analysis_code", "amount"), fmt, **options)


def read_balances_checked(spark: SparkSession, path: str, fmt: str = "csv", **options: str) -> Checked:
    return read_checked(spark, path, schemas.BALANCES, ("pos_cde",), fmt, **options)


def read_sales_sheet_checked(
    spark: SparkSession, path: str, months: tuple[str, ...] = MONTHS, fmt: str = "csv", **options: str
) -> Checked:
    return read_checked(spark, path, sheet_schema(months), ("area_name", "sale_name"), fmt, **options)
