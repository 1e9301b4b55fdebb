"""Row counts and key counts after loading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_audit(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, rows, keys) for each named table and its key column, one scan per table.

    Rows are counted per key first, so counting distinct keys needs no second shuffle of the rows.
    """

    def count(name: str, frame: DataFrame, key: str) -> DataFrame:
        per_key = frame.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("key").alias("keys")).select(
            F.lit(name).alias("table"), "rows", "keys"
        )

    return reduce(DataFrame.unionByName, [count(name, *spec) for name, spec in tables.items()])
