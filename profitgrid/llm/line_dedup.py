"""Operator 5: line deduplication by site-relative frequency. Built-in functions only.

Rows are pages of a host (for ``documents``: the source). Pages that hold a line are divided by the pages
of its host; lines above a ratio are boilerplate there and are dropped from all its pages. To count, only
hosts and a 16-byte digest of each line are shuffled, pre-aggregated in each task, so a host with a third of
all pages, or a line on all of them, is a few rows per task. A host's boilerplate lines are at most (lines per
page / ratio); they come as one array per host and are stored, so that their size is known when they are
joined with the pages: Spark ships them to the pages if they are few, and only if they are many are pages
shuffled by host, where a hot host is split. Pages are read in small batches and split into lines once, so that
long texts do not fill an executor.

The query counts every page, as its SQL does, so lines of a page with many copies are boilerplate. With
``copies=False`` pages of a host with the same text count as one, which leaves copies of whole pages to a
later stage; digests of the texts are shuffled too, then. Near copies still count. For them there is ``most``:
a page that would lose more than this share of its letters and other signs is no page with boilerplate but a
copy, and stays as it is.

Defined cases: a NULL text stays NULL and counts as a page without lines; blank lines are kept and never
counted; spaces around a line do not matter, tabs do; a line counts once per page; repeated rows are pages of
their own; NULL is a host like any other; a page whose lines all go becomes an empty text, never a lost row;
other columns are passed through, those named like the two counts are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.llm.common import read_small, stored, table, unused

RATIO = 0.05
LEAST_PAGES = 5
COUNTS = ("n_lines", "n_dropped")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _signs(lines: Column) -> Column:
    """Code points of lines, without the spaces around them."""
    return F.aggregate(lines, F.lit(0), lambda total, line: total + F.char_length(F.trim(line)))


def boilerplate(
    pages: DataFrame,
    host: str,
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    copies: bool = True,
) -> DataFrame:
    """(host, n_pages, lines): for each host with boilerplate the digests of these lines. Unless ``copies``,
    pages of a host with the same text count as one, in ``n_pages`` too."""
    trimmed = F.transform(_lines(F.col(text)), lambda line: F.trim(line))  # F.trim itself takes a second argument
    once = F.array_distinct(F.filter(trimmed, lambda line: line != ""))
    page = [] if copies else [F.unhex(F.md5(text)).alias("page")]
    lines = pages.select(F.col(host).alias("host"), *page, F.explode(once).alias("line"))
    lines = lines.withColumn("line", F.unhex(F.md5("line")))
    sites = pages.select(F.col(host).alias("site"), *page)
    if not copies:
        lines, sites = lines.distinct(), sites.distinct()
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = sites.groupBy("site").agg(F.count("*").alias("n_pages"))
    common = counts.where(F.col("n") >= least_pages).join(totals, F.col("host").eqNullSafe(F.col("site")))
    common = common.where(F.col("n") / F.col("n_pages") > ratio)
    return common.groupBy("host", "n_pages").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame,
    host: str,
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    copies: bool = True,
    most: float = 1.0,
    counts: tuple[str, str] = COUNTS,
) -> DataFrame:
    """All columns of ``pages`` with boilerplate lines taken out of the text, and how many lines the text had
    and how many were dropped."""
    read_small(pages.sparkSession)
    found = stored(boilerplate(pages, host, text, ratio, least_pages, copies).select("host", "lines"))
    site, bad, lines, kept = (unused(pages, c) for c in ("_site", "_bad", "_lines", "_kept"))
    joined = pages.join(found.toDF(site, bad), F.col(host).eqNullSafe(F.col(site)), "left")

    def stays(line: Column) -> Column:
        return ~F.coalesce(F.array_contains(bad, F.unhex(F.md5(F.trim(line)))), F.lit(False))

    joined = joined.withColumn(lines, _lines(F.col(text)))
    joined = joined.withColumn(kept, F.when(F.col(bad).isNotNull(), F.filter(lines, stays)))
    if most < 1:
        every = _signs(F.col(lines))
        gone = every - _signs(F.col(kept))
        joined = joined.withColumn(kept, F.when(gone <= every * most, F.col(kept)))
    n_lines = F.size(lines)
    n_dropped = F.when(F.col(kept).isNull(), 0).otherwise(n_lines - F.size(kept))
    out = F.when(F.col(kept).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    there = F.col(text).isNotNull()
    return joined.select(
        *(out.alias(c) if c == text else F.col(c) for c in pages.columns if c not in counts),
        F.when(there, n_lines).otherwise(0).cast("bigint").alias(counts[0]),
        F.when(there, n_dropped).otherwise(0).cast("bigint").alias(counts[1]),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source as host."""
    return drop_boilerplate(table(spark, sf_dir, "documents", "doc_id", "source", "text"), "source")


SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS page, doc_id, source, text FROM documents
), lines AS (
  SELECT page, source, generate_subscripts(w, 1) AS pos, unnest(w) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS w FROM docs WHERE text IS NOT NULL)
), bad AS (
  SELECT l.source, l.line
  FROM (SELECT source, trim(line, ' ') AS line, count(DISTINCT page) AS n FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1, 2) l
  JOIN (SELECT source, count(*) AS n_pages FROM docs GROUP BY 1) t ON l.source IS NOT DISTINCT FROM t.source
  WHERE n >= {LEAST_PAGES} AND n / n_pages > {RATIO}
), judged AS (
  SELECT l.*, b.line IS NOT NULL AS dropped
  FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.line
), kept AS (
  SELECT page, coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY pos), '') AS text,
    count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped
  FROM judged GROUP BY page
)
SELECT doc_id, source, k.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM docs LEFT JOIN kept k USING (page)
"""
