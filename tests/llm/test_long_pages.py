from __future__ import annotations

import pytest

from profitgrid.llm import line_dedup
from profitgrid.llm.common import READ_ROWS


@pytest.fixture
def pages(spark, tmp_path):
    rows = [(i, "h", f"same line\nown line {i}\n" * (1 + i % 3)) for i in range(600)]
    rows += [(None, None, None), (600, "h", None), (601, None, ""), (601, None, "x")]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, "id bigint, host string, text string").coalesce(1).write.parquet(path)
    yield spark.read.parquet(path)
    spark.conf.unset(READ_ROWS)


def as_rows(df):
    return sorted(map(repr, df.collect()))


def test_pages_are_read_in_small_batches_unless_the_session_has_its_own(spark, pages):
    spark.conf.unset(READ_ROWS)
    small = line_dedup.drop_boilerplate(pages, "host")
    assert spark.conf.get(READ_ROWS) == "256"
    rows = as_rows(small)
    spark.conf.set(READ_ROWS, "7")
    own = line_dedup.drop_boilerplate(pages, "host")
    assert spark.conf.get(READ_ROWS) == "7"
    assert as_rows(own) == rows
    assert len(rows) == 604


@pytest.mark.parametrize("most", [1.0, 0.5])
def test_a_text_is_split_once(pages, most):
    got = line_dedup.drop_boilerplate(pages, "host", most=most)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_counts_of_pages_without_text_or_boilerplate(pages):
    got = {(r.id, r.text): (r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(pages, "host").collect()}
    assert got[None, None] == got[600, None] == (0, 0)
    assert got[601, ""] == got[601, "x"] == (1, 0)
    assert got[1, "own line 1\nown line 1\n"] == (5, 2)
