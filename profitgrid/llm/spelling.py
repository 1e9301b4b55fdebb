"""Operator 11: spelling variants grouped by bidirectional FM-index search schemes.

``vocabulary`` counts the words of all texts, each task its own first. Words one error apart share the letters
of one half: the error lies behind the left half of a word or before its right half (see ``fm_index``). So
words of six letters and more are dealt out twice, by their first three letters and by their last three. Each
share of words is one delimited text with its index, in one task, and each word is searched there alone: once
to the right in its first share, once to the left in its last one. The two searches never find the same pair,
so pairs are counted where they are found; only one row per word and share is shuffled.

A beginning (or end) with more than ``SHARE`` words is cut into blocks, and every block of its words is
searched in every block. Small ones are put together. A share is thus bounded, whatever the letters.

Forms are links to a word at least five times as frequent, so chains are short and without circles; they are
followed by joins that double their reach.

Defined cases: NULL and texts without letters have no words; repeated rows count again; a NULL doc_id is
written as nothing before the colon; other columns are not looked at; very long words are words like any other;
equal frequencies go by code points; an empty table has no words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.llm.common import prepare, small, stored, table
from profitgrid.llm.fm_index import Vocabulary

LEAST_LETTERS = 6
LEAST_COUNT = 5
DROPPED = 199
FREQUENT = 5
SHARE = 40_000
KEY = 3
HELD_WORDS = 400_000


def _letters() -> bytes:
    """Latin-1 byte -> itself in a word, lower case for A-Z, a space for signs between words."""
    kept = {*range(0x61, 0x7B), *range(0xC0, 0x100)}
    lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    return bytes(b if b in kept else lower.get(b, 0x20) for b in range(256))


LETTERS = _letters()


def runs(text: str | None) -> list[bytes]:
    """Runs of letters in Latin-1, A-Z in lower case. Signs beyond Latin-1 end a run like any other."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def counted(docs: DataFrame, least_letters: int = LEAST_LETTERS, dropped: int = DROPPED) -> DataFrame:
    """(word, n): partial counts of each task. Of one in ``dropped`` runs, chosen by the CRC of document and run,
    the letter that the same CRC points to is left out."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in small(batches):
            ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            for doc_id, text in zip(ids, texts, strict=True):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs(text)).items():
                    if len(word) < least_letters:
                        continue
                    crc = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
                    if crc % dropped == 0:
                        at = crc % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_letters:
                            continue
                    found[word] += n
            if len(found) >= HELD_WORDS:
                yield from _rows(found)
                found.clear()
        yield from _rows(found)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")


def _rows(found: Counter) -> Iterator[pa.RecordBatch]:
    words, counts = [w.decode("latin-1") for w in found], list(found.values())
    for at in range(0, len(words), 20_000):
        columns = [pa.array(words[at : at + 20_000], pa.string()), pa.array(counts[at : at + 20_000], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences."""
    return counted(docs, least_letters).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """For each word asked in one share: near words found there, and the most frequent of them."""
    indexed = rows[rows.indexed].sort_values("word", ignore_index=True)
    asked = rows[rows.asked]
    names = ["word", "n", "n_near", "near_n", "near_word"]
    if not len(indexed) or not len(asked):
        return pd.DataFrame({c: [] for c in names}).astype({"n": "int64", "n_near": "int64", "near_n": "int64"})
    index = Vocabulary(indexed.word.tolist())
    search = index.near_right if rows.side.iloc[0] == 0 else index.near_left
    counts = indexed.n.to_numpy()
    near, best = np.zeros(len(asked), np.int64), np.full(len(asked), -1)
    for who, found in search(asked.word.tolist()):
        near += np.bincount(who, minlength=len(asked))
        order = np.lexsort((found, -counts[found], who))
        who, found = who[order], found[order]
        first = np.flatnonzero(np.diff(who, prepend=-1))
        best[who[first]] = found[first]
    hit = best >= 0
    columns = [asked.word[hit], asked.n[hit], near[hit], counts[best[hit]], indexed.word.to_numpy()[best[hit]]]
    return pd.DataFrame({c: np.asarray(x) for c, x in zip(names, columns, strict=True)})


def near_words(words: DataFrame, share: int = SHARE) -> DataFrame:
    """(word, n_near, near_n, near_word) of words with near ones: how many, and the most frequent of them."""
    prepare(words.sparkSession)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, KEY).alias("key")),
        F.struct(F.lit(1).alias("side"), F.expr(f"right(word, {KEY})").alias("key")),
    )
    dealt = words.select("word", "n", F.explode(sides).alias("s")).select("word", "n", "s.side", "s.key")
    large = dealt.groupBy("side", "key").count().where(F.col("count") > share)
    large = large.select("side", "key", F.ceil(F.col("count") / share).cast("int").alias("blocks"))
    dealt = dealt.join(large, ["side", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", other)
    here, there = F.col("own"), F.col("other")
    roles = F.array_compact(
        F.array(
            F.struct(here.alias("i"), there.alias("j"), F.lit(True).alias("indexed"), (here == there).alias("asked")),
            F.when(
                here != there,
                F.struct(there.alias("i"), here.alias("j"), F.lit(False).alias("indexed"), F.lit(True).alias("asked")),
            ),
        )
    )
    shares = max(1, 4 * (words.count() // share))
    small = F.concat(F.lit("#"), F.pmod(F.xxhash64("key"), F.lit(shares)).cast("string"))
    dealt = dealt.withColumn("key", F.when(F.col("blocks") == 1, small).otherwise(F.col("key")))
    dealt = dealt.select("word", "n", "side", "key", F.explode(roles).alias("r"))
    dealt = dealt.select("word", "n", "side", "key", "r.*").repartition(2 * shares + 6, "side", "key", "i", "j")
    kind = "word string, n bigint, n_near bigint, near_n bigint, near_word string"
    found = dealt.groupBy("side", "key", "i", "j").applyInPandas(_search, kind)
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near_word")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.minus_n")).alias("near_n"), F.col("best.near_word").alias("near_word"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of links (word, form)."""
    now = stored(links.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        joined = now.join(further, F.col("root") == F.col("__word"), "left")
        now = stored(joined.select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("moved")))
        if not now.where("moved").head(1):
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, share: int = SHARE, frequent: int = FREQUENT) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word, the frequent near word that it is a variant of, and the
    end of the chain of such forms."""
    words = stored(vocabulary(docs))
    near = near_words(words, share)
    is_form = F.col("near_n") >= frequent * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("near_word")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents", "doc_id", "text"))


# A run's CRC-32 is computed bit by bit; near words are those that are equal after one letter of either, or the
# same letter of both, is cut out.
SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
), coded AS (
  SELECT run, n, list_reduce(
    [4294967295] || flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda s: CASE WHEN ord(s) < 128 THEN [CAST(ord(s) AS BIGINT)] ELSE [CAST(192 + (ord(s) >> 6) AS BIGINT), 128 + (ord(s) & 63)] END)),
    lambda code, byte: list_reduce([xor(code, byte)] || range(8), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))
  ) AS code FROM counted
), spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM (SELECT run, n, xor(code, 4294967295) AS h FROM coded)
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)
), near AS (
  SELECT p.word, count(*) AS n_near, min({'minus': -w.n, 'other': other}) AS best FROM pairs p JOIN words w ON w.word = other GROUP BY p.word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.minus >= 5 * n THEN best.other END AS form,
    CASE WHEN -best.minus >= 5 * n THEN -best.minus END AS form_n
  FROM words LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON j.word = c.next
)
SELECT j.word, form, root, n, n_near, form_n FROM judged j JOIN chain c ON c.word = j.word AND c.next IS NULL
"""
