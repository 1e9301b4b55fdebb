from __future__ import annotations

import random

import brute
import pytest
from profitgrid.llm import suffix_dedup


@pytest.mark.parametrize("length", [3, 7, 11])
def test_strings_of_odd_length(spark, length):
    pick = random.Random(length)
    texts = ["".join(pick.choices("ab", k=pick.randint(0, 40))) for _ in range(20)]
    # strings that differ in their last byte only
    shared = ["".join(pick.choices("cdefgh", k=length - 1)) for _ in range(40)]
    texts += [f"{'ij'[i % 2]}{i}{s}{end}{i}" for i, s in enumerate(shared) for end in "xy"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = suffix_dedup.remove_repeats(df, length).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    assert [got[i] for i in range(len(texts))] == brute.without_repeats(texts, length)
