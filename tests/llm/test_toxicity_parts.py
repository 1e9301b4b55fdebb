"""Features, folds, lexicon and calibration of the toxicity operator against plain versions."""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
from profitgrid.llm import toxicity
from pyspark.sql import functions as F


def plain_features(text: str, strong: set, weak: set) -> list[float]:
    """Straight from the definitions, word by word; entries are whole words only."""
    low = text.lower()
    words = re.findall(r"\w+", low)
    n = max(1, len(words))
    hits = [i for i, w in enumerate(words) if w in strong]
    second = toxicity.SECOND_PERSON
    near = sum(any(w in second for w in words[max(0, i - 5) : i + 6]) for i in hits)
    plain = {"@": "a", "4": "a", "3": "e", "0": "o", "!": "i", "1": "i", "|": "i", "5": "s", "$": "s", "7": "t", "+": "t", "8": "b"}

    def undone(word: str) -> str:
        return "".join(c for c in (plain.get(c, c) for c in word) if c.isalpha())

    mixed = []
    for word in low.split():
        word = word.strip(".,;:!?\"'()[]{}#%&*$|")
        if 2 < len(word) <= 40 and not word.isalpha() and any(c.isalpha() for c in word):
            mixed.append(word)
    apart = [undone(m) for m in re.findall(r"(?<!\S)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\w)", low)]
    stretched = [w for w in words if any(len(set(w[i : i + 3])) == 1 for i in range(len(w) - 2))]
    hidden = sum(w not in strong and undone(w) in strong for w in mixed) + sum(w in strong for w in apart)
    for w in stretched:
        once = re.sub(r"(.)\1\1+", r"\1", w)
        hidden += once in strong or re.sub(r"(.)\1\1+", r"\1\1", w) in strong
    different = {words[i] for i in hits} | {undone(w) for w in mixed if undone(w) in strong}
    capitals, letters = sum(c in string.ascii_uppercase for c in text), sum(c in string.ascii_letters for c in text)
    size = max(1, len(text.encode()))
    shouted = len(re.findall(r"\b[A-Z]{3,}\b", text)) if capitals > 2 else 0
    weak_hits = sum(w in weak for w in words)
    return [
        math.log1p(len(hits)), len(hits) / n, math.log1p(weak_hits), weak_hits / n, len(different), near, near / n,
        math.log1p(hidden), (len(mixed) + len(apart) + len(stretched)) / n, capitals / max(1, letters), shouted / n,
        text.count("!") / n, sum(c in string.punctuation for c in text) / size,
    ]


TEXTS = [
    "", "you ugly fool!!", "FOOL. u f00l, a f-o-o-l and a fooool", "i d i o t", "nothing here", "Dir, du idiot; IDIOT?! id1ot",
    "fool fool fool fool fool", "é ß ñ 123 4x4 a.b.c.d.", "x" * 3000 + " fool", "mild mild you", "(f@@l) [idi0t] #fool",
]


@pytest.mark.parametrize("text", TEXTS)
def test_features_of_a_text(text):
    known = toxicity.Lexicon([("fool", 5.0), ("idiot", 4.0), ("mild", 1.5)])
    assert np.allclose(toxicity.features(text, known), plain_features(text, {"fool", "idiot"}, {"mild"}))


def test_random_features():
    pick = random.Random(5)
    known = toxicity.Lexicon([("fool", 5.0), ("idiot", 4.0), ("mild", 1.5)])
    parts = ["fool", "f00l", "fooool", "idiot", "i.d.i.o.t", "mild", "you", "DU", "tree", "LOUD", "!!", "x9y", "a", "b", "é", "1"]
    for _ in range(200):
        text = " ".join(pick.choices(parts, k=pick.randint(0, 25)))
        assert np.allclose(toxicity.features(text, known), plain_features(text, {"fool", "idiot"}, {"mild"})), text


def test_folds(spark):
    df = spark.createDataFrame([(i,) for i in (*range(50), -3, None)], "doc_id bigint")
    got = {r.doc_id: r.f for r in df.select("doc_id", toxicity.fold(F.col("doc_id")).alias("f")).collect()}
    assert got == {i: None if i is None else zlib.crc32(str(i).encode()) % 5 for i in got}


def labelled(pick, n, toxic_word):
    rows = []
    for i in range(n):
        words = ["".join(pick.choices("abcdefgh", k=5)) for _ in range(8)]
        toxic = i % 3 == 0
        rows.append((" ".join([*words, toxic_word(i)] if toxic else words), int(toxic), 2 + i % 3))
    return rows


def test_lexicon_equals_a_plain_count(spark):
    pick = random.Random(9)
    rows = labelled(pick, 240, lambda i: pick.choice(["scumbag", "scumbags", "nitwit", "oaf" if i % 2 else "loaf"]))
    rows += [("nitwit in the calibration fold", 1, 1)] * 5
    texts = [(set(re.split(r"[\W_]+", t.lower())), y) for t, y, part in rows if part > 1]
    toxic, clean = sum(y for _, y in texts), sum(1 - y for _, y in texts)
    counts = defaultdict(lambda: [0, 0])
    for words, y in texts:
        for e in {e for w in words if w for e in [w, *(w[:k] + "*" for k in (4, 5, 6) if len(w) > k)]}:
            counts[e][1 - y] += 1
    certain = {}
    for e, (t, c) in counts.items():
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        n = toxic + clean
        seen = [(t, toxic, t + c), (c, clean, t + c), (toxic - t, toxic, n - t - c), (clean - c, clean, n - t - c)]
        ratio = 2 * sum(x * math.log(x * n / (a * b)) for x, a, b in seen if x)
        if t >= 3 and odds >= 1 and ratio >= 10.83:
            certain[e] = (t, odds)
    want = {}
    for e, (t, odds) in certain.items():
        most = max((certain[w][0] for w in certain if w[-1] != "*" and w[: len(e) - 1] == e[:-1]), default=-1)
        if e[-1] != "*" or most < 0.9 * t:
            want[e] = odds
    got = dict(toxicity.learned_lexicon(spark.createDataFrame(rows, "text string, toxic int, part int")))
    assert got.keys() == want.keys() and all(math.isclose(got[e], want[e]) for e in got)
    assert {"scumbag", "nitwit", "scumba*"} <= got.keys() and "nitwi*" not in got


def test_many_rare_insults_enter_the_lexicon(spark):
    """Each of forty insults is in 2.5% of the toxic texts."""
    pick = random.Random(2)
    insults = ["z" + "".join(pick.choices("klmnop", k=6)) for _ in range(40)]
    rows = labelled(pick, 3000, lambda i: insults[i // 3 % 40])
    got = {e for e, _ in toxicity.learned_lexicon(spark.createDataFrame(rows, "text string, toxic int, part int"))}
    assert set(insults) <= got


def test_isotonic_step(spark):
    """Scores are those of a pool-adjacent-violators fit on the calibration fold."""
    pick = random.Random(7)
    docs, labels = [], []
    for i in range(400):
        toxic = int(i % 4 == 0)
        words = ["".join(pick.choices("abcdefgh", k=5)) for _ in range(8)] + (["scumbag"] if toxic != (pick.random() < 0.1) else [])
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    d, y = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.Model(d, y)
    scored = {r.doc_id: r.score for r in model.score(d).collect()}
    feats = spark.createDataFrame([(i, toxicity.features(t, toxicity.Lexicon(model.lexicon))) for i, t in docs], "doc_id bigint, x array<double>")
    from pyspark.ml.functions import array_to_vector

    raw = {r.doc_id: r.raw for r in model._raw(feats.withColumn("features", array_to_vector("x"))).collect()}
    points = sorted((raw[i], t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 1)
    values = sorted({x for x, _ in points})
    blocks = [[np.mean([t for x, t in points if x == v]), sum(x == v for x, _ in points), [v]] for v in values]
    k = 0
    while k + 1 < len(blocks):
        if blocks[k][0] > blocks[k + 1][0]:
            (a, n, u), (b, m, v) = blocks[k], blocks.pop(k + 1)
            blocks[k] = [(a * n + b * m) / (n + m), n + m, u + v]
            k = max(0, k - 1)
        else:
            k += 1
    xs, ys = zip(*[(v, mean) for mean, _, vs in blocks for v in vs])
    for i, _ in docs:
        assert math.isclose(scored[i], min(1.0, max(0.0, float(np.interp(raw[i], xs, ys)))), abs_tol=1e-9)
