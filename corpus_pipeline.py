"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

Toxic documents go, boilerplate lines go, one document of each near-duplicate group stays, documents that
hold benchmark passages go, and what is left is encoded. All stages but the last return the columns of
``documents``, whatever their names; the last one returns a row per document that is left.

Defined cases, beside those of the operators: a NULL or empty text is not toxic by itself and has no lines, and
all such documents are one near-duplicate group; rows that repeat a doc_id and text are one document after the
third stage; a text is never emptied by the second stage, because a page that would lose more than half of its
signs is taken for a copy and left to the third; an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.llm import bpe_codec, decontaminate, line_dedup, simhash, toxicity
from profitgrid.llm.common import stored, table, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
MOST_OF_A_PAGE = 0.5


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below the threshold."""
    model = toxicity.Model(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    own = unused(docs, "_score")  # of the documents, if they have such a column
    scored = model.score(docs.withColumnRenamed("score", own), keep_text=True)
    kept = scored.where(F.col("score") < toxicity.THRESHOLD).drop("score")
    return kept.withColumnRenamed(own, "score").select(*docs.columns)


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows the text.

    Copies of a text count once, and a page that would lose most of itself stays as it is, or the lines of a
    document with many copies or near copies would go from all of them and the next stage could not keep one.
    """
    counts = unused(docs, "_lines"), unused(docs, "_dropped")
    kept = line_dedup.drop_boilerplate(docs, "source", copies=False, most=MOST_OF_A_PAGE, counts=counts)
    size = F.when(F.col(counts[1]) > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size).select(*docs.columns)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no window of a benchmark item hits."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per document."""
    return bpe_codec.digests(docs.select("doc_id", "text"), bpe_codec.vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_out),
    ("near_dedup", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("bpe", encoded),
]

#: Boosted trees and word pieces are not SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
