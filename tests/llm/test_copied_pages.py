from __future__ import annotations

import corpus_pipeline
from profitgrid.llm import line_dedup
from pyspark.sql import functions as F


def page(i: int) -> str:
    return f"menu of the site\nwords that only page {i} has {i * i} {i * 7}"


def test_a_copied_document_keeps_its_lines_and_one_row(spark):
    copied = "the first line of it\nand a second one\n\nthe end of the text"
    other = "another text with many copies\nand its own second line"
    rows = [(i, page(i), "s") for i in range(40)] + [(100 + i, copied, "s") for i in range(20)]
    rows += [(200 + i, other, "s") for i in range(6)] + [(300, None, "s"), (301, None, "s")]
    rows += [(400 + i, copied, None) for i in range(8)] + [(500 + i, page(500 + i), None) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs = docs.withColumn("n_chars", F.char_length("text").cast("bigint"))
    kept = corpus_pipeline.lines_out(spark, docs, "")
    got = {r.doc_id: r for r in kept.collect()}
    assert len(got) == len(rows) and kept.columns == docs.columns
    for i, text, _ in rows:
        # the menu still goes, and only that
        want = text.split("\n", 1)[1] if text and text.startswith("menu") else text
        assert got[i].text == want and got[i].n_chars == (None if want is None else len(want))
    texts = [r.text for r in corpus_pipeline.near_duplicates_out(spark, kept, "").collect()]
    assert texts.count(copied) == 1 and texts.count(other) == 1 and texts.count("") == 0


def test_different_texts_are_counted_in_both_halves(spark):
    rows = [("h", "a\nb")] * 3 + [("h", "a\nc"), ("h", "a"), ("h", None), ("h", None), ("k", "a")]
    pages = spark.createDataFrame(rows, "host string, text string")
    every = line_dedup.boilerplate(pages, "host", ratio=0.5, least_pages=2).collect()
    once = line_dedup.boilerplate(pages, "host", ratio=0.5, least_pages=2, copies=False).collect()
    assert [(r.host, r.n_pages, len(r.lines)) for r in every] == [("h", 7, 1)]
    assert [(r.host, r.n_pages, len(r.lines)) for r in once] == [("h", 4, 1)]
