"""Operator 1: secret scan with corpus-wide ownership frequency. Built-in functions only.

Matches of three patterns are located in every whole text: a text is split at a pattern's matches, and
running lengths of pieces and matches give the positions. The method adds a fourth kind, ``owned``: generic
tokens (mixed letters and digits, 20 or more signs, outside other matches) that the frequency table finds
under fewer than ``MIN_OWNERS`` owners. Each candidate value is hashed and counted over distinct repositories
(documents) and distinct owners (sources): values of at least ``MIN_OWNERS`` owners are widely copied examples,
the others owner-specific and live-looking. A row tells how many of its spans are of either kind, and in how
many repositories the most widespread of its live-looking values stands.

Spans depend on the text only, so they are computed per distinct text: copies meet in map-side aggregates
before anything is shuffled, and a hot text, value or owner is one row per task. Texts themselves are never
shuffled; what is, are matches and 16-byte names of texts. Running sums go over one text's matches.

Defined cases: a NULL text is empty; an empty text has no spans; repeated rows each get their row and count
as one repository; NULL doc_ids and sources are kept and count as one repository and owner; other columns
are not looked at. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.llm.common import stored, table, whole_text

# The three patterns, and how long the match (assign: its value) must be.
PATTERNS = {
    "assign": (
        r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
        r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        8,
    ),
    "access": (r"(AKIA[A-Z0-9]+)", 16),
    "hex": (r"([0-9a-f]{32,})", 32),
}
TOKEN = r"([A-Za-z0-9+/_-]{20,})"
KINDS = [*PATTERNS, "owned"]
MIN_OWNERS = 3


def _matches(text: Column, pattern: str) -> Column:
    """Pieces before the matches, the matches and their values, in order."""
    return F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("value"),
    )


def _generic(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def candidates(docs: DataFrame) -> DataFrame:
    """(name, doc_id, source, kind, at, gap, size, value, hashed): every match of every pattern, kept or not.

    ``name`` is a digest of the text, ``kind`` a number, ``at`` the match's number within the text and kind;
    ``gap`` and ``size`` are code points before the match and in it. A dropped match has no ``hashed``.
    """
    text = whole_text()
    found = []
    for kind, (pattern, least) in enumerate([*PATTERNS.values(), (TOKEN, 20)]):
        some = F.when(text.rlike(pattern), _matches(text, pattern))
        fits = F.char_length("m.value") >= least
        if kind == 3:
            fits &= _generic(F.col("m.value"))
        rows = docs.select(
            F.unhex(F.md5(text)).alias("name"), "doc_id", "source", F.posexplode(some).alias("at", "m")
        ).where(F.col("m.whole").isNotNull())
        found.append(
            rows.select(
                "name",
                "doc_id",
                "source",
                F.lit(kind).alias("kind"),
                "at",
                F.char_length("m.before").alias("gap"),
                F.char_length("m.whole").alias("size"),
                F.when(fits, F.unhex(F.md5("m.value"))).alias("hashed"),
            )
        )
    return found[0].union(found[1]).union(found[2]).union(found[3])


def ownership(found: DataFrame, min_owners: int = MIN_OWNERS) -> DataFrame:
    """(hashed, repositories, owners, copied) for each candidate value, pre-aggregated before each shuffle."""
    per_repository = found.where(F.col("hashed").isNotNull()).groupBy("hashed", "source", "doc_id").agg(F.lit(1))
    per_owner = per_repository.groupBy("hashed", "source").agg(F.count("*").alias("n"))
    values = per_owner.groupBy("hashed").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))
    return values.withColumn("copied", F.col("owners") >= min_owners)


def spans(found: DataFrame) -> DataFrame:
    """(name, kind, start, end, hashed) of the kept matches of each distinct text."""
    once = found.groupBy("name", "kind", "at").agg(*(F.first(c).alias(c) for c in ("gap", "size", "hashed")))
    before = Window.partitionBy("name", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    once = once.repartition("name").withColumn("end", end).where(F.col("hashed").isNotNull())
    return once.select("name", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "hashed")


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def scan(docs: DataFrame, min_owners: int = MIN_OWNERS) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, source, text): counts, base digest, spans, and how many spans
    hold widely copied and owner-specific values."""
    docs = docs.select("doc_id", "source", "text")
    found = stored(candidates(docs))
    judged = spans(found).join(ownership(found, min_owners).select("hashed", "repositories", "copied"), "hashed")
    judged = judged.where((F.col("kind") < 3) | ~F.col("copied"))
    span = F.struct("start", "kind", "end", "copied", "repositories")
    per_text = judged.groupBy("name").agg(F.array_sort(F.collect_list(span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    # a generic token that a base span covers or touches is that span's
    extra = F.filter(
        "all",
        lambda s: (s["kind"] == 3)
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    per_text = per_text.select("name", base.alias("base"), F.array_sort(F.concat(base, extra)).alias("all"))

    def listed(column: str) -> Column:
        kind = F.array(*map(F.lit, KINDS))
        parts = F.transform(
            F.coalesce(F.col(column), F.array()),
            lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(parts, ",")

    def number(column: str, test) -> Column:
        return F.coalesce(F.size(F.filter(column, test)), F.lit(0)).cast("bigint")

    named = docs.select("doc_id", F.unhex(F.md5(whole_text())).alias("name"))
    return named.join(per_text, "name", "left").select(
        "doc_id",
        *(number("base", _of_kind(k)).alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)),
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("all").alias("spans"),
        number("all", lambda s: s["copied"]).alias("n_copied"),
        number("all", lambda s: ~s["copied"]).alias("n_live"),
        F.coalesce(
            F.array_max(F.transform(F.filter("all", lambda s: ~s["copied"]), lambda s: s["repositories"])), F.lit(0)
        ).alias("live_repositories"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def _sql() -> str:
    parts = [
        f"""SELECT name, text, {k} AS kind, generate_subscripts(w, 1) AS pos, unnest(w) AS whole, unnest(v) AS value,
          unnest(b) AS before
        FROM (SELECT name, text, regexp_extract_all(text, '{p.replace("'", "''")}', 0) AS w,
          regexp_extract_all(text, '{p.replace("'", "''")}', 1) AS v,
          list_resize(regexp_split_to_array(text, '{p.replace("'", "''")}'),
            len(regexp_extract_all(text, '{p.replace("'", "''")}', 0))) AS b
          FROM texts WHERE regexp_matches(text, '{p.replace("'", "''")}'))"""
        for k, (p, _) in enumerate([*PATTERNS.values(), (TOKEN, 20)])
    ]
    return f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS name FROM documents),
texts AS (SELECT DISTINCT name, text FROM docs),
found AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT name, kind, length(whole) AS size,
    sum(length(before) + length(whole)) OVER (PARTITION BY name, kind ORDER BY pos) AS stop,
    CASE WHEN length(value) >= CASE kind WHEN 0 THEN 8 WHEN 1 THEN 16 WHEN 2 THEN 32 ELSE 20 END
      AND (kind < 3 OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]')
        AND regexp_matches(value, '[A-Z]'))) THEN value END AS value
  FROM found),
spans AS (SELECT name, kind, CAST(stop - size AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, value
  FROM placed WHERE value IS NOT NULL),
owners AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS n, count(DISTINCT row(source, doc_id)) AS repositories
  FROM spans JOIN docs USING (name) GROUP BY value),
judged AS (SELECT spans.*, n >= {MIN_OWNERS} AS copied, repositories FROM spans JOIN owners USING (value)
  WHERE kind < 3 OR n < {MIN_OWNERS}),
kept AS (SELECT * FROM judged j WHERE kind < 3 OR NOT EXISTS (
  SELECT 1 FROM judged b WHERE b.name = j.name AND b.kind < 3 AND b.start < j.stop AND j.start < b.stop)),
lists AS (
  SELECT name,
    count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(CASE WHEN kind < 3 THEN label END, ',' ORDER BY start, kind) AS base,
    string_agg(label, ',' ORDER BY start, kind) AS spans,
    count(*) FILTER (copied) AS n_copied, count(*) FILTER (NOT copied) AS n_live,
    max(repositories) FILTER (NOT copied) AS live_repositories
  FROM (SELECT *, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop AS label FROM kept)
  GROUP BY name)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live, coalesce(live_repositories, 0) AS live_repositories
FROM docs LEFT JOIN lists USING (name)
"""


SQL = _sql()
