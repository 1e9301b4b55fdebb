from __future__ import annotations

import random
from collections import Counter

import brute
import pytest
from profitgrid.llm import decontaminate, queries


def near_items(texts: list, items: list, near: int = 20) -> list[int]:
    """For each text the number of items whose three rarest terms of all texts stand close in it."""
    found = [brute.WORD.findall(brute.lower(t)) for t in texts]
    counts = Counter(w for words in found for w in words)
    result = [0] * len(texts)
    for _, item in items:
        terms = set(brute.WORD.findall(brute.lower(item)))
        rare = sorted((t for t in terms if counts[t]), key=lambda t: (counts[t], t))[:3]
        if not rare or len(rare) < min(3, len(terms)):
            continue
        for k, words in enumerate(found):
            places = {t: [p for p, w in enumerate(words) if w == t] for t in rare}
            result[k] += any(all(any(abs(p - o) <= near for o in places[t]) for t in rare) for p in places[rare[0]])
    return result


@pytest.mark.parametrize("shard_words", [60, 300, 2_000_000])
def test_proximity_does_not_depend_on_shards(spark, shard_words, monkeypatch):
    monkeypatch.setattr(decontaminate.build_index, "__defaults__", (shard_words,))
    pick = random.Random(8)
    common = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(pick.choices(common, k=8) + [f"rare{i}a", f"rare{i}b", f"rare{i}c", "gone" + str(i)])) for i in range(6)]
    texts = [" ".join(pick.choices(common, k=pick.randint(0, 80))) for _ in range(40)]
    for i, item in items:
        words = [w for w in item.split(" ") if not w.startswith("gone")]
        pick.shuffle(words)
        texts.append(" ".join(pick.choices(common, k=30) + words + ["changed"]))  # reworded: one word lost, one new
        texts.append(f"rare{i}a rare{i}b")  # the third one starts the next document
        texts.append(f"rare{i}c " + " ".join(pick.choices(common, k=25)))
    items += [(20, "w1"), (21, "nowhere"), (22, "w1 nowhere w2 w3"), (23, "nowhere w1 w2")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r.n_near_items for r in decontaminate.contamination(docs, benchmark).collect()}
    want = near_items(texts, items)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(want[40::3]) >= 6
    for parts in (2, 7):
        dealt = decontaminate.contamination(docs.repartition(parts), benchmark).collect()
        assert {r.doc_id: r.n_near_items for r in dealt} == got


def test_query_reports_proximity(spark, small):
    plain = queries.queries()["op3_decontamination"](spark, small)
    got = queries.queries()["op3_proximity"](spark, small)
    assert got.columns == [*plain.columns, "n_near_items"]
    rows = got.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = dict(zip(texts, near_items(list(texts.values()), items), strict=True))
    assert {r.doc_id: r.n_near_items for r in rows} == want
