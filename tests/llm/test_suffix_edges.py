"""Repeated strings that end inside, before and behind the gram of a sample; lone grams with other surroundings."""

from __future__ import annotations

import random

import brute
import pytest
from profitgrid.llm import suffix_dedup


def results(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, length).collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("seed", range(4))
def test_passages_of_all_lengths_around_the_limit(spark, seed):
    """Shared passages of 100 to 320 bytes at different places, some changed in one byte, some inside one text."""
    pick = random.Random(seed)

    def sign(n):
        return "".join(pick.choices("abcdefgh é", k=n))

    passages = [sign(pick.choice([100, 140, 150, 198, 199, 200, 201, 250, 320])) for _ in range(14)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(pick.randint(0, 3)):
            passage = pick.choice(passages)
            if pick.random() < 0.4:
                at = pick.randrange(len(passage))
                passage = passage[:at] + pick.choice("xyz") + passage[at + 1 :]
            parts += [sign(pick.choice([0, 3, 60])), passage]
        texts.append("".join([*parts, sign(pick.randint(0, 40))]))
    texts += [texts[3], texts[4], None, "", passages[0][:199]]
    assert results(spark, texts, 200) == brute.without_repeats(texts, 200)


@pytest.mark.parametrize("length", [2, 3, 5, 16, 31])
def test_two_letters(spark, length):
    pick = random.Random(length)
    texts = ["".join(pick.choices("ab", k=pick.randint(0, 70))) for _ in range(30)]
    assert results(spark, texts, length) == brute.without_repeats(texts, length)


def test_a_passage_shorter_than_the_limit_in_many_documents(spark):
    pick = random.Random(1)
    passage = "".join(pick.choices("abcdefgh", k=150))
    texts = ["".join(pick.choices("abcdefgh", k=120)) + passage + "".join(pick.choices("abcdefgh", k=120)) for _ in range(60)]
    assert results(spark, texts, 200) == brute.without_repeats(texts, 200)
    assert all(r[1] == 0 for r in results(spark, texts, 200))


def test_length_is_bounded(spark):
    for length in (1, 257):
        with pytest.raises(ValueError, match="bytes"):
            suffix_dedup.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), length)
