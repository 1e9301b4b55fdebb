"""Odd rows and names: lines with spaces and digits, copies, clashing columns, shared ids, hot owners."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from profitgrid.llm import bpe_codec, chat_trees, line_dedup, secrets, simhash, token_prefixes, toxicity
from pyspark.sql import functions as F

PATH = bpe_codec.vocabulary()


def sql_rows(sql: str, **tables) -> Counter:
    con = duckdb.connect()
    for name, (schema, rows) in tables.items():
        con.execute(f"CREATE TABLE {name} ({schema})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    result = con.sql(sql)
    return Counter(tuple(sorted(zip(result.columns, row))) for row in result.fetchall())


def as_rows(df) -> Counter:
    return Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


# Line dedup




def test_line_dedup_agrees_with_its_sql_on_odd_lines(spark):
    common = ["Copyright 1", "   menu   ", "0 start and end 0", "\ttabbed", "tabbed\t", "11", "  12", "a", "1a1", " 0", "10 11 12", "x 9"]
    pick = random.Random(1)
    rows = []
    for i in range(40):
        lines = [pick.choice(["", " ", "  "]) + c + pick.choice(["", " "]) if pick.random() < 0.5 else c for c in common]
        pick.shuffle(lines)
        rows.append((i, "\n".join([*lines[: pick.randint(1, 12)], f"own {i}", "", str(i % 12)]), "h" if i % 3 else None))
    rows += [(0, rows[0][1], None), (0, rows[0][1], None), (90, None, "h"), (90, None, "h"), (91, "", "h"), (92, "\n\n", None), (None, "a\n a", "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    want = sql_rows(line_dedup.SQL, documents=("doc_id BIGINT, text VARCHAR, source VARCHAR", rows))
    got = as_rows(line_dedup.drop_boilerplate(docs, "source"))
    assert got == want
    assert sum(n * dict(r)["n_dropped"] for r, n in got.items()) > 100


def test_a_page_that_would_lose_most_of_itself_stays(spark):
    rows = [(i, f"menu\nthis page has the number {i} and says much of {i * i}", "h") for i in range(20)] + [(30 + i, f"menu\ncopied line\n{i}", "h") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_boilerplate(docs, "source", most=0.5).collect()}
    assert all(got[i] == (rows[i][1].split("\n")[1], 1) for i in range(20))
    assert all(got[i] == (text, 0) for i, text, _ in rows[20:])


def test_counts_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", "h", "x", 7.0)], "doc_id bigint, text string, source string, n_lines string, _bad double")
    got = line_dedup.drop_boilerplate(docs, "source")
    assert got.columns == ["doc_id", "text", "source", "_bad", "n_lines", "n_dropped"]
    assert [tuple(r) for r in got.collect()] == [(1, "a\nb", "h", 7.0, 2, 0)]


# The pipeline's stages


def words(pick, n):
    return " ".join("".join(pick.choices("abcdefghij", k=6)) for _ in range(n))


def test_near_copies_keep_their_lines_and_one_row_each(spark):
    """Two groups of near copies among the pages of one source; what all pages share still goes."""
    pick = random.Random(3)
    groups = [[words(pick, 30) for _ in range(12)] for _ in range(2)]
    rows = []
    for g, lines in enumerate(groups):
        for i in range(20):
            near = list(lines)
            near[11] = f"{near[11]} {i}"
            rows.append((1000 * (g + 1) + i, "\n".join(near), "s"))
    rows += [(i, f"menu of all pages\n{words(pick, 40)}", "s") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n_chars", F.char_length("text").cast("bigint"))
    kept = corpus_pipeline.lines_out(spark, docs, "")
    got = {r.doc_id: r.text for r in kept.collect()}
    assert all(got[i] == text for i, text, _ in rows[:40])
    assert all(got[i] == text.split("\n")[1] for i, text, _ in rows[40:])
    left = [r.doc_id for r in corpus_pipeline.near_duplicates_out(spark, kept, "").collect()]
    assert sum(i < 1000 for i in left) == 100
    assert {i // 1000 for i in left} == {0, 1, 2}


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, _score int, n_lines int, _name string, n_dropped int, _row string, name string"


def odd_documents(spark):
    rows = [(i, f"menu\nthe text of {i} with {i * 7} words", "en", "s", 30, "sc", i, 3, "nm", 4, "rw", "x") for i in range(12)]
    rows += [rows[3], (3, "another text under one id", "en", None, None, None, None, None, None, None, None, None)]
    rows += [(None, None, None, None, None, "z", 1, 1, "n", 1, "r", "y"), (40, "", "en", "s", 0, "z", 1, 1, "n", 1, "r", "y")]
    rows += [(41, rows[4][1], "de", "t", 30, "other", 5, 5, "five", 5, "5", "v"), (4, rows[4][1], "fr", "t", 30, "other", 5, 5, "five", 5, "5", "v")]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_the_columns_whatever_their_names(spark, small, empty):
    docs = odd_documents(spark).limit(0) if empty else odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, small)
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert (not rows) if empty else rows, name
        assert {r.score for r in rows} <= {"sc", "z", "other", None} and {r.n_lines for r in rows} <= {3, 1, 5, None}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == docs.count()


def test_of_rows_that_repeat_id_and_text_the_same_one_stays(spark):
    docs = odd_documents(spark)
    picks = {tuple(sorted(map(tuple, simhash.one_of_each(docs.repartition(n)).collect()), key=str)) for n in (1, 3, 7)}
    assert len(picks) == 1


def test_new_columns_replace_those_of_their_names(spark):
    docs = spark.createDataFrame([(1, "one two", "mine")], "doc_id bigint, text string, n_tokens string")
    got = bpe_codec.digests(docs, PATH)
    assert got.columns.count("n_tokens") == 1 and got.first().n_tokens == 2
    assert token_prefixes.token_counts(docs, PATH).columns.count("n_tokens") == 1


# Token counts


def test_pairs_stay_apart_as_in_the_encoding():
    counter = token_prefixes.counter(PATH)
    bpe, pick = counter.bpe, random.Random(4)
    ids = list(bpe.id_of.values())
    short = [i for i in ids if len(bpe.token_bytes[i]) <= 3]
    assert counter.pairs.ordered
    for k in range(30_000):
        left, right = pick.choice(short if k % 2 else ids), pick.choice(short)
        right = left if k % 11 == 0 else right
        together = bpe.merged(bpe.token_bytes[left] + bpe.token_bytes[right])
        assert counter.pairs.apart(left, right) == (together == [left, right])
        counter.pairs.ordered = k % 100 != 0  # some of them by encoding
    counter.pairs.ordered = True


def test_totals_and_fitting_follow_from_all_prefixes(texts):
    counter, pick = token_prefixes.counter(PATH), random.Random(2)
    odd = ["".join(pick.choices(["  ", "\n\n", " ", "a", "it's", "'re", "é", "\t", "  x", "<|endoftext|>", "12", "..."], k=30)) for _ in range(150)]
    for text in [t or "" for _, t in texts] + odd:
        counts, raw = counter.of_text(text), text.encode()
        for limit in (0, 1, 2, 5, pick.randint(1, 20), 1024):
            want = int(counts[-1]) if len(counts) else 0
            assert counter.total_and_fitting(text, raw, limit) == (want, token_prefixes.longest_fitting(counts, raw, limit))
        assert counter.total(text) == want


# Toxicity, chats, secrets


def test_one_id_with_two_texts_trains_both(spark):
    docs = spark.createDataFrame([(2, "first text"), (2, "second text"), (4, "third"), (4, "third")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(2, 1), (4, 0)], "doc_id bigint, toxic int")
    got = Counter((r.text, r.toxic) for r in toxicity.training_rows(docs, labels).collect())
    assert got == {("first text", 1): 1, ("second text", 1): 1, ("third", 0): 1}


def test_null_and_dash_are_two_conversations(spark):
    said = [(None, 0, "user", "a"), ("-", 0, "user", "b"), ("-", 1, "assistant", "c"), ("=-", 0, "user", "d")]
    df = spark.createDataFrame(said, "conv_id string, turn bigint, role string, text string")
    got = {r.conv_id: r.n_turns for r in chat_trees.digests(chat_trees.formatted(chat_trees.as_chains(df))).collect()}
    assert got == {None: 1, "-": 2, "=-": 1}


def test_tokens_of_two_owners_are_not_widely_copied(spark):
    token, example = "Zx9" + "aB3" * 8, "Yw8" + "cD4" * 8
    rows = [(i, f"s{i % 2}", f"see {token}") for i in range(5)] + [(10 + i, f"s{i}", f"or {example} password=abcdefgh{i}") for i in range(4)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()}
    assert all(got[i].spans == f"owned:4:{4 + len(token)}" and (got[i].n_live, got[i].live_repositories) == (1, 5) for i in range(5))
    assert all("owned" not in got[10 + i].spans and got[10 + i].live_repositories == 1 for i in range(4))
    want = sql_rows(secrets.SQL, documents=("doc_id BIGINT, source VARCHAR, text VARCHAR", rows))
    assert as_rows(secrets.scan(spark.createDataFrame(rows, "doc_id bigint, source string, text string"))) == want
    assert re.match("[0-9a-f]{64}", got[0].base_sha256)


# Reply trees


def broom(trunk: int, straws: int) -> list:
    rows = [("t", f"n{i:04d}", f"n{i - 1:04d}" if i else None, 0.5) for i in range(trunk)]
    return rows + [("t", f"s{i:04d}", f"n{trunk - 1:04d}", float(i % 7)) for i in range(straws)]


def test_only_kept_branches_are_listed(spark):
    rows = broom(300, 300) + [("ring", "r1", "r2", 9.0), ("ring", "r2", "r1", 9.0), ("ring", "r3", "r1", 1.0)]
    df = spark.createDataFrame(rows, "tree string, node string, parent string, score double")
    got = chat_trees.branches(df).collect()
    assert len(got) == 301 and {r.leaf for r in got} == {"s0006"} and sorted(r.up for r in got) == list(range(301))
    rounds = chat_trees.jumps(df)
    scores = {r.leaf: r.score for r in chat_trees.leaves(df, rounds).collect()}
    assert scores == {f"s{i:04d}": 150 + i % 7 for i in range(300)}


def test_scores_of_random_trees(spark):
    pick = random.Random(4)
    rows, parent, score = [], {}, {}
    for t in range(6):
        for i in range(pick.randint(1, 60)):
            node = f"{t}-{i:03d}"
            parent[node] = f"{t}-{pick.randrange(i):03d}" if i and pick.random() < 0.95 else None
            score[node] = float(pick.randint(-3, 3))
            rows.append((str(t), node, parent[node], score[node]))
    df = spark.createDataFrame(rows, "tree string, node string, parent string, score double")

    def way(node):
        return [node, *way(parent[node])] if parent[node] else [node]

    tops = {n for n in parent if n not in parent.values()}
    best = Counter()
    for t in range(6):
        ranked = sorted((-sum(score[x] for x in way(n)), n) for n in tops if n.startswith(f"{t}-"))[:2]
        best.update((n, x, up) for _, n in ranked for up, x in enumerate(way(n)))
    assert Counter((r.leaf, r.node, r.up) for r in chat_trees.branches(df, 2).collect()) == best
