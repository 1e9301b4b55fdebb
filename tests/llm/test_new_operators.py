"""Spelling variants, language identification and ranked search against plain versions."""

from __future__ import annotations

import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from profitgrid.llm import fp_tree, ppm, spelling
from profitgrid.llm.fm_index import Vocabulary

# Spelling variants


def one_error(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters", ["ab", "abcé"])
def test_search_scheme_finds_each_pair_once(letters):
    pick = random.Random(len(letters))
    for _ in range(25):
        words = sorted({"".join(pick.choices(letters, k=pick.randint(3, 9))) for _ in range(pick.randint(1, 90))})
        asked = sorted({"".join(pick.choices(letters + "z", k=pick.randint(3, 9))) for _ in range(60)} | set(words[:30]))
        got = [pair for who, found in Vocabulary(words).near(asked) for pair in zip(who.tolist(), found.tolist(), strict=True)]
        want = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if one_error(a, b)}
        assert len(got) == len(set(got))
        assert set(got) == want


def plain_variants(rows: list) -> set:
    n: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if crc % 199 == 0:
                word = word[: crc % len(word)] + word[crc % len(word) + 1 :]
            n[word] += 1
    n = Counter({w: c for w, c in n.items() if len(w) >= 6 and c >= 5})
    near, form = defaultdict(list), {}
    for w in n:
        near[w] = [x for x in n if x != w and abs(len(x) - len(w)) < 2 and one_error(x, w)]
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best
    result = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        result.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return result


@pytest.mark.parametrize("share", [40_000, 20])
def test_spelling_variants(spark, share):
    """A small share cuts the words with one beginning into blocks."""
    pick = random.Random(4)
    stems = ["".join(pick.choices("abcé", k=pick.randint(3, 6))) for _ in range(30)]
    words = [("preabc" if pick.random() < 0.6 else "") + pick.choice(stems) + pick.choice(["", "s", "ÿ", "é"]) for _ in range(150)]
    texts = [" ".join(pick.choices(words, [1 / (i + 1) for i in range(len(words))], k=400)) for _ in range(12)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4].upper()), (90, None), (91, ""), (92, "ſŁ ’ ×÷ preabc…" * 9)]
    rows += [(93, "chaina " * 400 + "chainab " * 60 + "chainabc " * 9 + "unlikeword " * 5), (94, "x" * 5000)]
    docs = spark.createDataFrame([(i, t, 7, "w") for i, t in rows], "doc_id bigint, text string, n int, word string")
    got = [tuple(r) for r in spelling.variants(docs.repartition(3), share).collect()]
    want = plain_variants(rows)
    assert len(got) == len(want) and set(got) == want
    assert ("chainabc", "chainab", "chaina") in {x[:3] for x in got}
    assert any(x[1] is None and x[4] for x in got)
    assert spelling.variants(docs.limit(0)).count() == 0


# Language identification


def plain_code_length(counts: dict, order: int, raw: bytes) -> float:
    """Bits of a text, one byte after the other, from counts of (context, byte)."""
    following = defaultdict(dict)
    for (context, byte), n in counts.items():
        following[context][byte] = n
    padded, bits = b"\xff" * order + raw, 0.0
    for i in range(order, len(padded)):
        for length in range(order, -1, -1):
            seen = following.get(padded[i - length : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if padded[i] in seen:
                bits += math.log2(total / seen[padded[i]])
                break
            bits += math.log2(total / len(seen))
        else:
            bits += 8
    return bits


def plain_counts(texts: list[str], order: int, least_seen: int) -> dict:
    counts: Counter = Counter()
    for text in texts:
        padded = b"\xff" * order + text.encode()
        for i in range(order, len(padded)):
            for length in range(order + 1):
                counts[padded[i - length : i], padded[i]] += 1
    return {k: n for k, n in counts.items() if len(k[0]) < 3 or n >= least_seen}


@pytest.fixture(scope="module")
def spoken() -> list:
    pick = random.Random(2)
    syllables = {"aa": ["ba", "na", "to", "é "], "bb": ["ß ", "ri", "na", "zu"], "cc": ["κα", "τι ", "ri"]}
    rows = [(x, "".join(pick.choices(s, k=pick.randint(5, 60)))) for x, s in syllables.items() for _ in range(25)]
    return rows + [rows[0], rows[0], ("aa", None), ("bb", ""), (None, "zu zu")]


def test_code_lengths(spark, spoken):
    docs = spark.createDataFrame(spoken, "lang string, text string").repartition(3)
    model = ppm.learned(docs)
    texts = sorted({t for _, t in spoken if t})[:20] + ["unseen œ", "ba", "\u0000\U0001f600", "naß " * 300]
    got = model.code_lengths([t.encode() for t in texts])
    assert model.langs == ["aa", "bb", "cc"]
    for j, lang in enumerate(model.langs):
        counts = plain_counts(sorted({t for x, t in spoken if x == lang and t}), ppm.ORDER, ppm.LEAST_SEEN)
        want = [plain_code_length(counts, ppm.ORDER, t.encode()) for t in texts]
        assert np.allclose(got[:, j], want)


def test_long_texts_in_pieces(spark, spoken, monkeypatch):
    model = ppm.learned(spark.createDataFrame(spoken, "lang string, text string"))
    raws = [b"bana zu" * 90, b"", b"x", "κα".encode() * 40]
    whole = model.code_lengths(raws)
    monkeypatch.setattr(ppm, "BYTES_AT_ONCE", 50)
    assert np.allclose(model.code_lengths(raws), whole)


def test_sample_is_bounded_and_of_different_texts(spark, spoken):
    docs = spark.createDataFrame(spoken, "lang string, text string")
    got = [tuple(r) for r in ppm.sampled(docs, 10).collect()]
    assert Counter(x for x, _ in got) == {"aa": 10, "bb": 10, "cc": 10} and len(set(got)) == 30


def test_predictions(spark, spoken):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, (_, t) in enumerate(spoken)], "doc_id bigint, text string, score string, lang_no int")
    model = ppm.learned(spark.createDataFrame(spoken, "lang string, text string"))
    odd = spark.createDataFrame([(None, None), (900, ""), (901, "12 :)\n"), (902, "ba")], "doc_id bigint, text string")
    got = ppm.predicted(docs.select("doc_id", "text").union(odd), model).collect()
    right = {i: x for i, (x, t) in enumerate(spoken) if x and t}
    assert sum(r.lang_pred == right[r.doc_id] for r in got if r.doc_id in right) >= len(right) - 1
    assert [(r.lang_pred, r.score) for r in got if r.doc_id in (None, 900, 901)] == [("und", 0.0)] * 3
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(spoken) + 4
    nothing = ppm.learned(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in ppm.predicted(docs.select("doc_id", "text"), nothing).collect()} == {"und"}


def test_held_out_languages(spark, small):
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    got = ppm.op12_language_id(spark, small).collect()
    assert len(got) == len(true)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.95 * len(held)


# Ranked search


def plain_ranking(docs: list, items: list, k: int) -> set:
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, len(w), Counter(w)) for i, w in bags if w]
    n_docs, n_words = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, bag in bags for t in bag)
    asked = defaultdict(set)
    for i, text in items:
        asked[i] |= set(terms(text))
    result = set()
    for item, wanted in asked.items():
        scores = []
        for i, n, bag in bags:
            m, score = 10 + (90 * n * n_docs) // n_words, 0
            for t in wanted & set(bag):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        result |= {(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)}
    return result


@pytest.mark.parametrize(("shard_docs", "leaf", "block_terms"), [(16_384, 48, 200_000), (40, 2, 25), (90, 1, 200_000)])
def test_ranked_search(spark, shard_docs, leaf, block_terms):
    pick = random.Random(8)
    words = ["".join(pick.choices("abcdé9", k=pick.randint(1, 4))) for _ in range(120)]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(pick.choices(words, weights, k=pick.randint(1, 90)))) for i in range(220)]
    docs += [(500 + i, docs[3][1]) for i in range(60)] + [(3, docs[3][1]), (None, docs[4][1].upper()), (700, None), (701, " .-")]
    items = [(f"q{i}", " ".join(pick.choices(words, k=12))) for i in range(15)] + [("q0", docs[9][1]), (None, docs[4][1])]
    items += [("none", None), ("", "qqqq"), ("long", " ".join(words) * 3)]
    table = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id bigint, text string, n int, rank string").repartition(3)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id string, text string, score int")
    got = fp_tree.ranked(table, asked, 10, block_terms, shard_docs, leaf).collect()
    assert Counter(map(tuple, got)) == Counter(plain_ranking(docs, items, 10))
    assert fp_tree.ranked(table.limit(0), asked).count() == 0
    assert fp_tree.ranked(table, asked.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    pick = np.random.default_rng(3)
    rows = [np.sort(pick.choice(60, pick.integers(1, 20), replace=False)) for _ in range(400)]
    ptr = np.cumsum([0, *map(len, rows)])
    tf, m = pick.integers(1, 9, ptr[-1]), pick.integers(10, 400, len(rows))
    tree = fp_tree.FpTree(ptr, np.concatenate(rows), tf, m, np.arange(len(rows)), 8)
    ranks, weights = np.array([2, 30, 59]), np.array([700, 4000, 9000])
    bound = tree.bounds(ranks, weights)
    score = np.array([sum(int(w) * int(fp_tree.gain(tree.tf[a:b][tree.ranks[a:b] == r], tree.m[d]).sum()) for r, w in zip(ranks, weights))
                      for d, (a, b) in enumerate(zip(tree.ptr[:-1], tree.ptr[1:]))])
    for node, (a, b) in enumerate(zip(tree.low, tree.high, strict=True)):
        assert score[a:b].max() <= bound[node]
        below = tree.children[node]
        assert not below or sorted((tree.low[c], tree.high[c]) for c in below)[0][0] == a
    assert (bound < np.sort(score)[-3]).any()


# The package on executors


def test_package_travels_with_the_session(tmp_path):
    """From a foreign working folder and without PYTHONPATH, executors get the package from the driver."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    program = f"""
import sys
sys.path.insert(0, {root!r})
from profitgrid.session import local_session
spark = local_session(2)
from profitgrid.llm import bpe_codec
docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id bigint, text string")
assert bpe_codec.digests(docs, bpe_codec.vocabulary()).count() == 2
assert sorted(r.n_tokens for r in bpe_codec.digests(docs, bpe_codec.vocabulary()).collect())[0] == 0
assert spark.range(10).repartition(3).count() == 10
print("all well")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    import public_tokenizers

    env["PYTHONPATH"] = os.path.dirname(os.path.abspath(public_tokenizers.__file__))
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all well" in done.stdout, done.stderr[-2000:]
