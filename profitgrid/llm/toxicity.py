"""Operator 4: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: hits of a lexicon and their density, hits near a second person, shares of
capitals, shouted words, exclamation and other punctuation marks, and of obfuscated words (digits and signs
for letters, letters set apart or drawn out), with the lexicon hits that undoing this reveals. The lexicon
is learned: words, and beginnings of words, that occur in far more toxic than clean training texts. Trees are boosted with Spark ML on
folds 2 to 4 of the labelled rows, and isotonic regression on fold 1 turns their output into probabilities.
Fold 0 (crc32 of the doc_id as text, modulo 5) is held out from all of this.

The fit uses at most about ``SAMPLE`` labelled rows, drawn by a hash of the text; scoring reads every text
once, in place, without a shuffle.

Defined cases: NULL and empty texts have all features zero and are scored; repeated rows each get their
row; a NULL doc_id is neither labelled nor held out; several labels of a document count as toxic if one
is; NULL labels are no labels; without labels of both kinds in folds 2 to 4 every score is the share of
toxic labels there (0 without labels); without calibration rows the trees' probability stands.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.llm.common import per_row, stored, table, whole_text

SAMPLE = 20_000
LEXICON = 400
LEAST_TEXTS = 3
CERTAIN = 10.83  # log-likelihood ratio of a lexicon entry; chance gives as much once in 1,000 entries
IMPLIED = 0.9
STRONG, WEAK = 3.0, 1.0  # log odds of a lexicon entry
THRESHOLD = 0.5
NEAR = 5
BEGINNINGS = (4, 5, 6)  # a beginning of a word stands in the lexicon with a star
TREES, DEPTH, STEP = 20, 3, 0.3

WORD = re.compile(r"\w+")
APART = re.compile(r"(?<!\S)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\w)")
DRAWN = re.compile(r"(\w)\1\1+")
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
SIGNS_FOR_LETTERS = str.maketrans("@430!1|5$7+8", "aaeoiiissttb")
CAPITALS, MARKS = string.ascii_uppercase.encode(), string.punctuation.encode()
LETTERS = string.ascii_letters.encode()


def _plain(word: str) -> str:
    """A word with signs taken for letters and other signs left out."""
    return "".join(c for c in word.translate(SIGNS_FOR_LETTERS) if c.isalpha())


class Lexicon:
    """Whole words and, with a star, beginnings of words, each with its log odds."""

    def __init__(self, entries: list[tuple[str, float]]) -> None:
        self.strong, self.weak = (
            self._sets([e for e, odds in entries if (odds >= STRONG) == strong]) for strong in (True, False)
        )

    @staticmethod
    def _sets(entries: list[str]) -> tuple[frozenset[str], list[tuple[int, frozenset[str]]]]:
        starred = frozenset(e[:-1] for e in entries if e.endswith("*"))
        by_length = [(n, frozenset(e for e in starred if len(e) == n)) for n in sorted(set(map(len, starred)))]
        return frozenset(e for e in entries if not e.endswith("*")), by_length

    def __contains__(self, word: str) -> bool:
        whole, starred = self.strong
        return word in whole or any(word[:n] in some for n, some in starred)

    @staticmethod
    def hits(sets: tuple[frozenset[str], list], words: list[str]) -> list[int]:
        whole, starred = sets
        found = {i for i, w in enumerate(words) if w in whole}
        for n, some in starred:
            found.update(i for i, w in enumerate(words) if w[:n] in some)
        return sorted(found)


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one text; all zero for an empty one."""
    low = text.lower()
    words = WORD.findall(low)
    n = max(1, len(words))
    hits, weak = lexicon.hits(lexicon.strong, words), lexicon.hits(lexicon.weak, words)
    near = sum(1 for i in hits if not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]))
    odd = [w for w in (w.strip(".,;:!?\"'()[]{}#%&*$|") for w in low.split()) if w and not w.isalpha()]
    mixed = [w for w in odd if 2 < len(w) <= 40 and any(c.isalpha() for c in w)]
    shown = {w for w in map(_plain, mixed) if w in lexicon}
    hidden = sum(1 for w in mixed if w not in lexicon and _plain(w) in lexicon)
    apart = [_plain(m) for m in APART.findall(low)]
    drawn = DRAWN.search(low)
    stretched = [w for w in words if DRAWN.search(w)] if drawn else []
    hidden += sum(w in lexicon for w in apart)
    hidden += sum(DRAWN.sub(r"\1", w) in lexicon or DRAWN.sub(r"\1\1", w) in lexicon for w in stretched)
    raw = text.encode()
    size = max(1, len(raw))
    capitals, marks = (len(raw) - len(raw.translate(None, x)) for x in (CAPITALS, MARKS))
    letters = max(1, len(raw) - len(raw.translate(None, LETTERS)))
    shouted = len(re.findall(r"\b[A-Z]{3,}\b", text)) if capitals > 2 else 0
    return [
        float(np.log1p(len(hits))),
        len(hits) / n,
        float(np.log1p(len(weak))),
        len(weak) / n,
        float(len({words[i] for i in hits} | shown)),
        float(near),
        near / n,
        float(np.log1p(hidden)),
        (len(mixed) + len(apart) + len(stretched)) / n,
        capitals / letters,
        shouted / n,
        raw.count(b"!") / n,
        marks / size,
    ]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _features(lexicon: list[tuple[str, float]]) -> Callable[[], Callable[[str], tuple]]:
    def make() -> Callable[[str], tuple]:
        known = Lexicon(lexicon)
        return lambda text: (features(text, known),)

    return make


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic, part): different labelled texts outside the held-out fold, about ``sample`` at most.

    A text that appears under several documents counts once, as toxic if one of them is.
    """
    toxic = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    toxic = toxic.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select("doc_id", whole_text().alias("text")).where(fold(F.col("doc_id")) != 0)
    name = F.md5("text").alias("name")
    labelled = stored(
        rows.select("doc_id", name).join(toxic, "doc_id").groupBy("name").agg(
            F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")
        )
    )
    share = min(1.0, sample / max(1, labelled.count()))
    drawn = F.conv(F.substring("name", 1, 8), 16, 10).cast("long") < int(share * (1 << 32))
    picked = labelled.where(drawn).withColumn("part", fold(F.col("doc_id")))
    named = rows.withColumn("name", name)  # a doc_id may stand beside several texts
    return stored(named.join(picked, ["doc_id", "name"]).dropDuplicates(["name"]).select("text", "toxic", "part"))


def _times_log(count: Column) -> Column:
    """count * log(count), zero for zero."""
    return F.when(count > 0, count * F.log(count)).otherwise(0.0)


def learned_lexicon(training: DataFrame) -> list[tuple[str, float]]:
    """At most ``LEXICON`` words and beginnings, with their log odds, that more toxic than clean texts of the
    boosting folds have.

    An entry needs ``LEAST_TEXTS`` toxic texts and a log-likelihood ratio of ``CERTAIN`` against chance, so rare
    words come in once there are enough labels, whatever their share. A beginning that one word accounts
    for, by ``IMPLIED`` of its toxic texts or more, leaves its place to that word.
    """
    rows = training.where(F.col("part") > 1)
    n = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = (n[0] or 0), (n[1] or 0)
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    starred = [
        F.transform(F.filter("words", lambda w: F.char_length(w) > n), lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*")))
        for n in BEGINNINGS
    ]
    entries = F.explode(F.array_distinct(F.concat("words", *starred)))
    counts = rows.select("toxic", words.alias("words")).select("toxic", entries.alias("word"))
    counts = counts.where("word <> ''").groupBy("word")
    counts = counts.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    t, c = F.col("t"), F.col("c")
    cells, edges = [t, c, toxic - t, clean - c, F.lit(toxic + clean)], [F.lit(toxic), F.lit(clean), t + c, toxic + clean - t - c]
    ratio = 2 * (sum(map(_times_log, cells), F.lit(0.0)) - sum(map(_times_log, edges), F.lit(0.0)))
    certain = (odds >= WEAK) & (ratio >= CERTAIN)
    found = stored(counts.where((F.col("t") >= LEAST_TEXTS) & certain).select("word", "t", odds.alias("odds")))
    words = found.where(~F.col("word").endswith("*")).select("word", "t")
    beginnings = [F.concat(F.left("word", F.lit(n)), F.lit("*")) for n in BEGINNINGS]
    most = words.select(F.explode(F.array_distinct(F.array(*beginnings))).alias("of"), "t")
    most = most.groupBy("of").agg(F.max("t").alias("most"))
    kept = found.join(most, F.col("word") == F.col("of"), "left").where(
        F.col("most").isNull() | (F.col("most") < IMPLIED * F.col("t"))
    )
    best = kept.select("word", "odds").orderBy(F.desc("odds"), "word").limit(LEXICON)
    return [(r.word, r.odds) for r in best.collect()]


class Model:
    """A fitted scorer of texts."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> None:
        training = training_rows(docs, labels, sample)
        self.lexicon = learned_lexicon(training)
        rows = stored(per_row(training, "text", "x array<double>", _features(self.lexicon)))
        rows = rows.withColumns({"features": array_to_vector("x"), "label": F.col("toxic").cast("double")})
        boosting, calibration = rows.where(F.col("part") > 1), rows.where(F.col("part") == 1)
        kinds = boosting.agg(F.countDistinct("label"), F.avg("label")).first()
        self.constant, self.trees, self.calibration = kinds[1] or 0.0, None, None
        if kinds[0] == 2:
            booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, maxBins=64)
            self.trees = booster.fit(boosting.select("features", "label"))
            if not calibration.isEmpty():
                raw = self._raw(calibration)
                self.calibration = IsotonicRegression(featuresCol="raw", predictionCol="score").fit(raw)

    def _raw(self, rows: DataFrame) -> DataFrame:
        scored = self.trees.transform(rows)
        return scored.withColumn("raw", F.get(vector_to_array("probability"), F.lit(1))).drop(
            "prediction", "rawPrediction", "probability"
        )

    def score(self, docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
        """All columns (the text only on request) in their order, and ``score``, between 0 and 1.

        The other columns travel as one struct, so none of their names can clash with those used here.
        """
        others = F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c != text)).alias("row")
        rows = per_row(docs.select(others, text), text, "x array<double>", _features(self.lexicon), keep_text)
        if self.trees is None:
            rows = rows.withColumn("score", F.lit(float(self.constant)))
        else:
            rows = self._raw(rows.withColumn("features", array_to_vector("x")))
            rows = self.calibration.transform(rows) if self.calibration else rows.withColumn("score", F.col("raw"))
        kept = [F.col(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns if keep_text or c != text]
        return rows.select(*kept, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    scored = Model(docs, labels, sample).score(docs)
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    )
