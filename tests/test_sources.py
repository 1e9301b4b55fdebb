"""Readers, sinks and dimensions."""

from __future__ import annotations

import pytest
from fixtures import as_set, balances, direct, head, ledger, loan, manager, sales
from pyspark.sql import functions as F

from profitgrid import schemas
from profitgrid.operators import audit, dims
from profitgrid.operators.sheet import monthly_sheet
from profitgrid.session import shared_folder
from profitgrid.sources import readers, sinks
from profitgrid.sources.published import Published


@pytest.fixture
def folder(spark):
    return shared_folder(spark)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_ledger_round_trip(spark, folder, fmt):
    rows = [head(1, 702000030001, 5), direct(2, 850000000001, "B", -7)]
    ledger(spark, rows).drop("funding_id").withColumn("funding_id", F.lit(None).cast("int")).write.format(fmt).option(
        "header", "true"
    ).save(folder)
    got = readers.read_ledger(spark, folder, fmt)
    assert got.schema.fieldNames() == schemas.LEDGER.fieldNames()
    assert as_set(got, "*") == set(rows)


def test_malformed_csv_stops_the_load(spark, folder):
    spark.createDataFrame([("no date", "x")], ["transaction_date", "account_code"]).write.csv(folder, header=True)
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        readers.read_ledger(spark, folder, "csv").collect()


def test_balances_and_sheet_round_trip(spark, folder):
    rows = [loan(1, "B", 5), loan(2, "C", None, None, 1, (202302, 3))]
    balances(spark, rows).write.parquet(f"{folder}/balances")
    assert as_set(readers.read_balances(spark, f"{folder}/balances"), "*") == set(rows)
    sheet = monthly_sheet(sales(spark, [manager("a", "B", 1)])).drop("year")
    sheet.write.option("header", "true").csv(f"{folder}/sheet")
    got = readers.read_sales_sheet(spark, f"{folder}/sheet", fmt="csv")
    assert as_set(got, "sale_name", "ltn_jan", "approval_rate_jan", "ltn_feb") == {("a", 1, 0.5, None)}
    assert as_set(readers.roster_of(got), "*") == {("north", "a", "a@x")}


def stored(spark, rows):
    return spark.createDataFrame(rows, "year int, month int, area_name string, amount long")


@pytest.mark.parametrize("partitions", [None, ["year", "month"]])
def test_append_keeps_first_values(spark, folder, partitions):
    first = stored(spark, [(2023, 1, "north", 1), (2023, 1, "south", 2)])
    second = stored(spark, [(2023, 1, "north", 9), (2023, 2, "north", 3), (2023, 2, "north", 4)])
    sinks.append_if_absent(first, folder, partition_by=partitions)
    got = sinks.append_if_absent(second, folder, partition_by=partitions)
    want = {(2023, 1, "north", 1), (2023, 1, "south", 2), (2023, 2, "north", 3)}
    assert as_set(got, "year", "month", "area_name", "amount") == want
    again = sinks.append_if_absent(second, folder, partition_by=partitions)
    assert as_set(again, "year", "month", "area_name", "amount") == want and again.count() == 3


def test_append_of_nothing(spark, folder):
    nothing = stored(spark, [])
    assert sinks.append_if_absent(nothing, folder, partition_by=["year"]).count() == 0
    got = sinks.append_if_absent(stored(spark, [(2023, 1, "north", 1)]), folder, partition_by=["year"])
    assert got.count() == 1


def test_refresh_replaces_only_its_months(spark, folder):
    first = stored(spark, [(2023, 1, "north", 1), (2023, 2, "north", 2)])
    sinks.append_if_absent(first, folder, partition_by=["year", "month"])
    got = sinks.refresh(stored(spark, [(2023, 2, "north", 7)]), folder, ["year", "month"])
    assert as_set(got, "month", "amount") == {(1, 1), (2, 7)}


def test_overwrite_replaces_everything(spark, folder):
    sinks.overwrite(stored(spark, [(2023, 1, "north", 1)]), folder)
    got = sinks.overwrite(stored(spark, [(2023, 2, "south", 2)]), folder)
    assert as_set(got, "*") == {(2023, 2, "south", 2)}


def test_overwrite_may_read_what_it_replaces(spark, folder):
    sinks.overwrite(stored(spark, [(2023, 1, "north", 1)]), folder)
    old = sinks.read_stored(spark, folder)
    got = sinks.overwrite(old.withColumn("amount", F.col("amount") + 1), folder)
    assert as_set(got, "amount") == {(2,)}


def test_failed_write_leaves_the_old_report(spark, folder):
    sinks.overwrite(stored(spark, [(2023, 1, "north", 1)]), folder)
    broken = stored(spark, [(2023, 2, "south", 2)]).withColumn("amount", F.raise_error(F.lit("midway")).cast("bigint"))
    for write in (sinks.overwrite, sinks.append_if_absent, lambda b, p: sinks.refresh(b, p, ["year"])):
        with pytest.raises(Exception, match="midway"):
            write(broken, folder)
        assert as_set(sinks.read_stored(spark, folder), "*") == {(2023, 1, "north", 1)}


def test_of_two_appends_at_once_one_row_per_key_stays(spark, folder, monkeypatch):
    """Another run publishes between the key check and the commit of the first."""
    sinks.append_if_absent(stored(spark, [(2023, 1, "north", 1)]), folder)
    publish, raced = Published.publish, []

    def late(self, number, parts):
        if not raced:
            raced.append(number)
            sinks.append_if_absent(stored(spark, [(2023, 2, "north", 20), (2023, 3, "north", 30)]), folder)
        return publish(self, number, parts)

    monkeypatch.setattr(Published, "publish", late)
    got = sinks.append_if_absent(stored(spark, [(2023, 2, "north", 99), (2023, 4, "north", 4)]), folder)
    want = {(1, 1), (2, 20), (3, 30), (4, 4)}
    assert as_set(got, "month", "amount") == want and got.count() == 4
    assert as_set(sinks.read_stored(spark, folder), "month", "amount") == want


def test_refresh_and_overwrite_at_once(spark, folder, monkeypatch):
    sinks.append_if_absent(stored(spark, [(2023, 1, "north", 1), (2023, 2, "north", 2)]), folder)
    publish, raced = Published.publish, []

    def late(self, number, parts):
        if not raced:
            raced.append(number)
            sinks.append_if_absent(stored(spark, [(2023, 3, "north", 3)]), folder)
        return publish(self, number, parts)

    monkeypatch.setattr(Published, "publish", late)
    got = sinks.refresh(stored(spark, [(2023, 2, "north", 7)]), folder, ["year", "month"])
    assert as_set(got, "month", "amount") == {(1, 1), (2, 7), (3, 3)}


def test_a_version_can_be_taken_once(spark, folder):
    table = Published(spark, folder)
    assert table.version() == (0, ())
    part = table.write(stored(spark, [(2023, 1, "north", 1)]))
    assert table.publish(1, (part,)) and not table.publish(1, ()) and table.version() == (1, (part,))
    other = table.write(stored(spark, []))
    assert table.publish(2, (part,)) and table.remove_unlisted() == 1
    assert table.read(table.version()[1]).count() == 1 and other


def test_null_keys_are_keys(spark, folder):
    batch = stored(spark, [(2023, 1, None, 1), (2023, None, "north", 2)])
    for _ in range(2):
        got = sinks.append_if_absent(batch, folder)
    assert got.count() == 2


def test_one_row_per_point_of_sale(spark):
    rows = [("p1", "Huế"), ("p1", "Hà Nội"), ("p2", "Paris"), (None, "Huế"), ("p3", None)]
    seen = spark.createDataFrame(rows, "pos_cde string, pos_city string")
    got = dims.build_city(seen, dims.city_letters(spark))
    assert as_set(got, "*") == {("p1", "Huế", "E"), ("p2", "Paris", "A")}


def test_cities_of_every_region(spark):
    letters = as_set(dims.city_letters(spark), "pos_city", "area_cde")
    assert len(letters) == 63 and len({c for c, _ in letters}) == 63
    assert {("Hà Nội", "D"), ("Hồ Chí Minh", "H"), ("Đà Nẵng", "F"), ("Cần Thơ", "G")} <= letters


def test_head_office_name_wins_over_unknown_names(spark):
    names = spark.createDataFrame([("Tây Bắc Bộ",), ("Atlantis",), (None,), ("Tây Bắc Bộ",)], "area_name string")
    got = dims.build_area(names, dims.area_letters(spark))
    assert [tuple(r) for r in got.collect()] == [("A", "Hội Sở"), ("C", "Tây Bắc Bộ")]


def test_load_audit(spark):
    got = audit.load_audit(
        {
            "x": (spark.createDataFrame([(1,), (1,), (None,)], "k int"), "k"),
            "empty": (spark.createDataFrame([], "k int"), "k"),
        }
    )
    assert as_set(got, "*") == {("x", 3, 1), ("empty", 0, 0)}
