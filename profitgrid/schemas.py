"""Schemas of the finance model."""

from __future__ import annotations

from pyspark.sql import types as T

LEDGER = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("account_code", T.LongType(), nullable=False),
        T.StructField("account_description", T.StringType()),
        T.StructField("analysis_code", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("d_c", T.StringType()),
        T.StructField("funding_id", T.IntegerType()),
    ]
)

BALANCES = T.StructType(
    [
        T.StructField("kpi_month", T.LongType(), nullable=False),
        T.StructField("pos_cde", T.StringType()),
        T.StructField("pos_city", T.StringType()),
        T.StructField("application_id", T.LongType(), nullable=False),
        T.StructField("outstanding_principal", T.LongType()),
        T.StructField("write_off_month", T.LongType()),
        T.StructField("write_off_balance_principal", T.LongType()),
        T.StructField("psdn", T.IntegerType()),
        T.StructField("max_bucket", T.IntegerType()),
        T.StructField("funding_id", T.IntegerType()),
    ]
)

CITY = T.StructType(
    [
        T.StructField("pos_cde", T.StringType()),
        T.StructField("pos_city", T.StringType()),
        T.StructField("area_cde", T.StringType()),
    ]
)

AREA = T.StructType(
    [
        T.StructField("area_cde", T.StringType()),
        T.StructField("area_name", T.StringType()),
    ]
)

# One row per sales manager, year and month.
SALES = T.StructType(
    [
        T.StructField("area_name", T.StringType()),
        T.StructField("sale_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("ltn", T.LongType()),
        T.StructField("psdn", T.LongType()),
        T.StructField("approve", T.LongType()),
        T.StructField("app_in", T.LongType()),
        T.StructField("approval_rate", T.DoubleType()),
    ]
)

# One row per sales manager.
ROSTER = T.StructType(
    [
        T.StructField("area_name", T.StringType()),
        T.StructField("sale_name", T.StringType()),
        T.StructField("email", T.StringType()),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("funding_id", T.IntegerType()),
        T.StructField("funding_code", T.StringType()),
        T.StructField("funding_name", T.StringType()),
        T.StructField("funding_parent_id", T.IntegerType()),
        T.StructField("funding_level", T.IntegerType()),
        T.StructField("sortorder", T.IntegerType()),
    ]
)
