from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, label int, score string, bits string"


@pytest.fixture(scope="session")
def texts() -> list:
    """(doc_id, text) with nulls, empty and long texts, copies, near copies, passages, secrets, odd signs."""
    pick = random.Random(5)
    words = ["".join(pick.choices("abcdeéß", k=pick.randint(2, 7))) for _ in range(400)]
    prose = [" ".join(pick.choices(words, k=pick.randint(40, 120))) for _ in range(12)]
    passage = " ".join(pick.choices(words, k=60))
    near = prose[1].split(" ")
    near[7] = "changed"
    rows = [(i, t) for i, t in enumerate(prose)]
    rows += [(20, None), (21, ""), (22, "   \n"), (None, prose[2]), (23, prose[3]), (23, prose[3]), (24, " ".join(near))]
    rows += [(30 + i, f"{prose[4 + i][:150]} {passage} {prose[5 + i][:90 + i]}") for i in range(4)]
    rows += [(40, "ab " * 400), (41, "x" * 700), (42, " ".join(pick.choices(words, k=9000))), (43, passage.upper())]
    rows += [(50, "password: 'abcdefgh1' token=short api_key=" + "k" * 20), (51, "AKIA" + "Z" * 12 + " " + "0a" * 20)]
    rows += [(52, "é password: token: abcdefghijk <|endoftext|> ABCDEFabcdef0123456789xyzQQ"), (53, "AKIAshort deadbeef")]
    rows += [(60, "boilerplate line\nown line one\n\nboilerplate line"), (61, "boilerplate line\nown line two\n")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{(i or 0) % 3}" if i != 41 else None, len(t or ""), 1, "s", "b") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
