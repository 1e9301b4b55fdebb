"""Operator 12: language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts up to ``ORDER`` bytes, with counts taken from a bounded sample of
labelled texts and frozen then. A byte is coded in its longest context that the language has seen; a byte that
is new there costs an escape and is coded in the context one byte shorter, down to 256 equal chances. With n
occurrences of a context and q different bytes behind it, a byte seen c times costs log2((n + q) / c) bits and
the escape log2((n + q) / q) (method C, without exclusions). The bits of a text are summed exactly over all
its bytes, for every language; the smallest sum wins, and the score is its share of the likelihoods.

The statistics are frozen, so the cost of a byte depends only on itself and the bytes before it. Contexts of
all languages are put into one sorted table per order with a column of bits for each language, computed once.
A task looks its bytes up there by the hundred thousand in numpy, longest contexts first; what is found needs
no further step, what is not adds the escapes of its context and tries the next shorter one.

Bound of the sample: ``SAMPLE`` different texts of each language, those with the smallest hashes; contexts of
three and more bytes must have been seen twice with their byte. The model is at most the bytes of that
sample. Counting is on Spark; the tables of counts come to the driver and go to the tasks.

Defined cases: a NULL or empty text and one without a letter is ``und`` with score 0, as is every text when
nothing could be learned; texts without language teach nothing; copies of a text with one label teach once; a
NULL doc_id falls into the fold of the empty text; ties go to the smaller name; every row has a result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.llm.common import prepare, small, stored, table

ORDER = 4
SAMPLE = 2_000
LEAST_SEEN = 2
FOLDS = 5
UNKNOWN = "und"
BYTES_AT_ONCE = 400_000
LETTER = regex.compile(r"\p{L}")


def _padded(raw: bytes, order: int) -> np.ndarray:
    """Bytes of a text after ``order`` marks that no text holds, so that the first bytes have contexts too."""
    return np.frombuffer(b"\xff" * order + raw, np.uint8).astype(np.uint64)


def _grams(signs: np.ndarray, order: int, length: int) -> np.ndarray:
    """For each byte of the text the number made of its ``length`` last bytes before it, and itself."""
    found = signs[order:].copy()
    for back in range(1, length + 1):
        found |= signs[order - back : len(signs) - back] << np.uint64(8 * back)
    return found


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(lang, length, gram, n): how often each byte follows each context of ``length`` bytes."""
    prepare(texts.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            raws = batch.column("text").cast(pa.large_binary()).to_pylist()
            for lang in sorted(set(langs)):
                signs = [_padded(r, order) for r, x in zip(raws, langs, strict=True) if x == lang]
                for length in range(order + 1):
                    grams, n = np.unique(np.concatenate([_grams(s, order, length) for s in signs]), return_counts=True)
                    columns = [pa.array([lang] * len(grams), pa.string()), pa.array(np.full(len(grams), length, np.int32))]
                    columns += [pa.array(grams.astype(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "length", "gram", "n"])

    partial = texts.select("lang", "text").mapInArrow(run, "lang string, length int, gram bigint, n bigint")
    return partial.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


class Ppm:
    """Bits of bytes under the frozen statistics of several languages."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """``counts[k]``: arrays (language number, gram, n) of contexts of k bytes."""
        self.langs, self.order = langs, len(counts) - 1
        self.grams, self.bits, self.contexts, self.escapes = [], [], [], []
        for length, (lang, gram, n) in enumerate(counts):
            grams, at = np.unique(gram, return_inverse=True)
            contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
            times = np.zeros((len(grams), len(langs)))
            times[at, lang] = n
            total, kinds = (np.zeros((len(contexts), len(langs))) for _ in range(2))
            np.add.at(total, of, times)
            np.add.at(kinds, of, times > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                seen = np.log2((total + kinds)[of] / times)
            shorter = self._costs(grams & np.uint64((1 << (8 * length)) - 1), length - 1)
            self.grams.append(grams)
            self.bits.append(np.where(times > 0, seen, escape[of] + shorter))
            self.contexts.append(contexts)
            self.escapes.append(escape)

    def _costs(self, grams: np.ndarray, length: int) -> np.ndarray:
        """Bits of grams (a context of ``length`` bytes and a byte), a column for each language."""
        cost, left = np.zeros((len(grams), len(self.langs))), np.arange(len(grams))
        for k in range(length, -1, -1):
            mine = grams[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            at, found = _find(self.grams[k], mine)
            cost[left[found]] += self.bits[k][at[found]]
            left, mine = left[~found], mine[~found]
            at, found = _find(self.contexts[k], mine >> np.uint64(8))
            cost[left[found]] += self.escapes[k][at[found]]
        cost[left] += 8.0
        return cost

    def code_lengths(self, raws: list[bytes]) -> np.ndarray:
        """Bits of each text (a row) in each language (a column)."""
        total = np.zeros((len(raws), len(self.langs)))
        at_once = max(1, 4 * BYTES_AT_ONCE // max(4, len(self.langs)))
        held, size = [], 0
        for i, raw in enumerate(raws):
            signs = _padded(raw, self.order)
            for at in range(0, len(raw), at_once):
                part = signs[at : at + at_once + self.order]
                held.append((i, part))
                size += len(part) - self.order
                if size >= at_once:
                    self._add(total, held)
                    held, size = [], 0
        if held:
            self._add(total, held)
        return total

    def _add(self, total: np.ndarray, parts: list[tuple[int, np.ndarray]]) -> None:
        grams = np.concatenate([_grams(signs, self.order, self.order) for _, signs in parts])
        ends = np.cumsum([len(signs) - self.order for _, signs in parts])
        cost = self._costs(grams, self.order)
        np.add.at(total, [i for i, _ in parts], np.add.reduceat(cost, np.concatenate([[0], ends[:-1]])))

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and the share of its likelihood."""
        spoken = [bool(t and self.langs and LETTER.search(t)) for t in texts]
        bits = self.code_lengths([t.encode() for t, s in zip(texts, spoken, strict=True) if s])
        best = bits.argmin(1) if len(bits) else []
        share = iter(zip(best, 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1), strict=True)) if len(bits) else iter(())
        found = [next(share) if s else None for s in spoken]
        return [self.langs[f[0]] if f else UNKNOWN for f in found], [float(f[1]) if f else 0.0 for f in found]


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each number in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def sampled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, text): for each language the ``sample`` different texts with the smallest hashes.

    Only hashes are ranked; the texts are read again up to the last hash of their language.
    """
    named = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    named = named.withColumn("h", F.xxhash64("text"))
    by_hash = Window.partitionBy("lang").orderBy("h")
    first = named.select("lang", "h").distinct().withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= sample)
    last = stored(first.groupBy("lang").agg(F.max("h").alias("last")))
    chosen = named.join(last, "lang").where(F.col("h") <= F.col("last"))
    return chosen.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def learned(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE, least_seen: int = LEAST_SEEN) -> Ppm:
    """The model of the languages of ``docs`` (lang, text)."""
    counts = gram_counts(sampled(docs, sample), order)
    counts = stored(counts.where((F.col("length") < 3) | (F.col("n") >= least_seen)))
    rows = counts.toArrow()
    langs = sorted(pc.unique(rows["lang"]).to_pylist())
    number = pc.index_in(rows["lang"], value_set=pa.array(langs, pa.string())).to_numpy()
    length, gram, n = (rows[c].to_numpy() for c in ("length", "gram", "n"))
    by_length = [(number[length == k], gram[length == k].view(np.uint64), n[length == k]) for k in range(order + 1)]
    return Ppm(langs, by_length)


def predicted(docs: DataFrame, model: Ppm, text: str = "text") -> DataFrame:
    """All columns but the text, and ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    prepare(spark)
    kept = [f for f in docs.schema.fields if f.name != text]
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = sent.value.judge
        for batch in small(batches):
            langs, scores = judge(batch.column(text).to_pylist())
            columns = [batch.column(f.name) for f in kept] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + ["lang_pred", "score"])

    before = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(run, f"{before}lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document belongs to the fold that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == 0


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out())
    model = learned(documents.where(~F.col("held_out")).select("lang", "text"))
    return predicted(documents.drop("lang"), model)
