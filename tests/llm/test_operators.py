from __future__ import annotations

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from profitgrid.llm import (
    bpe_codec, byte_bpe, chat_trees, components, decontaminate, exact_topk, line_dedup, secrets, simhash,
    suffix_dedup, token_prefixes, toxicity,
)
from profitgrid.llm.grams import Block

PATH = bpe_codec.vocabulary()


def rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# Secrets


def test_secrets(docs, texts, no_docs):
    got = rows(secrets.scan(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for i, text in texts:
        spans = brute.base_spans(text)
        counts = [sum(k == kind for k, _, _ in spans) for kind in brute.SECRETS]
        want.append((i, *counts, brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    assert got == Counter(want)
    assert secrets.scan(no_docs).count() == 0


def test_secrets_by_owner(spark):
    shared, own, token = "password=samplevalue1", "secret=ownvalue99", "Zx9" + "aB3" * 8
    data = [(i, f"s{i}", f"{shared} {own if i == 0 else ''} {token if i == 1 else ''}") for i in range(4)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(data, "doc_id bigint, source string, text string")).collect()}
    assert (got[0].n_copied, got[0].n_live) == (1, 1)
    assert (got[1].n_copied, got[1].n_live) == (1, 1) and got[1].spans.startswith("assign:0:21,owned:")
    assert got[2].spans == "assign:0:21"


# Top k


def test_top_k(spark):
    pick = random.Random(1)
    vectors = [(i, [pick.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    vectors += [(150, [0.0] * 6), (160, [0.0] * 6), (170, None), (180, [1.0, None]), (190, [float("nan")] * 6), (None, [1.0] * 6)]
    vectors += [(200, [0.5, 0.5]), (40, vectors[40][1]), (220, vectors[20][1]), (221, [1e300] * 0)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    got = rows(exact_topk.top_k(exact_topk.whole_vectors(df), F.col("vec_id") % 20 == 0, 5, 16), "query_id", "rank", "vec_id", "score")
    usable = {i: np.floor(64 * np.array((v + [0] * 6)[:6])).astype(int) for i, v in vectors
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = Counter()
    for q in (i for i in usable if i % 20 == 0):
        best = sorted((-int(usable[q] @ v), i) for i, v in usable.items() if i != q)[:5]
        want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    assert got == want
    assert exact_topk.top_k(exact_topk.whole_vectors(df.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_search_stops_before_it_has_seen_all():
    cells = np.arange(4096, dtype=np.int64)[:, None] * np.array([[1, 1]])
    lists = exact_topk.SortedLists(np.arange(4096), cells)
    (ids, scores, seen), = lists.search(np.array([7]), np.array([[1, 1]]), 3)
    assert ids.tolist() == [4095, 4094, 4093] and scores.tolist() == [8190, 8188, 8186] and seen < 4096


def test_large_components_stay_exact():
    cells = np.array([[1 << 29, 1], [1 << 29, 3], [-(1 << 29), 5]])
    found = exact_topk.SortedLists(np.arange(3), cells).search(np.array([9]), np.array([[1 << 29, 1]]), 2)
    assert found[0][1].tolist() == [(1 << 58) + 3, (1 << 58) + 1]


# Decontamination


@pytest.mark.parametrize("shard_words", [300, 2_000_000])
def test_decontamination(spark, docs, texts, no_docs, shard_words, monkeypatch):
    monkeypatch.setattr(decontaminate.build_index, "__defaults__", (shard_words,))
    passage = dict(texts)[30].split(" ")
    items = [(7, " ".join(passage[40:70])), (8, passage[45] + " " + passage[46]), (9, None), (10, ""), (None, "ab ab")]
    items += [(7, "ab " * 12), (11, " ".join(dict(texts)[5].split(" ")[3:14]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = rows(decontaminate.contamination(docs, benchmark), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = Counter()
    for i, text in texts:
        n, hit, names = brute.contaminated(text, items)
        want[i, n, hit, len(names), brute.sha(",".join(sorted(map(str, names)))), hit > 0] += 1
    assert got == want and sum(n for row, n in want.items() if row[5]) > 3
    clean = decontaminate.without_contaminated(docs, benchmark)
    assert rows(clean, "doc_id") == Counter((r[0],) for r in want.elements() if not r[5])
    assert clean.columns == docs.columns
    assert decontaminate.contamination(no_docs, benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_benchmark_in_blocks(spark, docs):
    items = spark.createDataFrame([(i, f"ab {'ab ' * i}") for i in range(12)], "item_id bigint, text string")
    index = decontaminate.build_index(docs)
    one = decontaminate.matches(index, items)
    many = decontaminate.matches(index, items, block_words=3)
    assert rows(one.select(F.explode("items").alias("i"), "shard", "doc"), "i", "shard", "doc") == rows(
        many.select(F.explode("items").alias("i"), "shard", "doc"), "i", "shard", "doc"
    )


def test_proximity():
    lists = {"a": np.array([5, 100]), "b": np.array([8, 300]), "c": np.array([1])}
    assert decontaminate.near_places(lists, {"a", "b"}, 5).tolist() == [5]
    assert decontaminate.near_places(lists, {"a", "x"}, 5).tolist() == []


# Toxicity


def test_toxicity(spark, no_docs):
    pick = random.Random(2)
    clean = ["river", "stone", "garden", "window", "paper", "cloud"]
    data, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        body = pick.choices(clean, k=30) + (["you", "grumphead"] * 2 if toxic else [])
        data.append((i, " ".join(body) + f" {i}"))
        labels.append((i, int(toxic)))
    data += [(900, None), (901, ""), (902, "you gr.umphead GRUMPHEAD!!"), (None, "you grumphead"), (5, data[5][1])]
    labels += [(3, None), (None, 1), (4, 0)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumns({"x": F.lit(1), "row": F.lit("r")})
    labels = spark.createDataFrame(labels, "doc_id bigint, toxic int").withColumn("text", F.lit(1))
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) > 0.95 * len(held)
    assert {r.doc_id: r.predicted for r in got if r.doc_id in (901, 902)} == {901: 0, 902: 1}
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(no_docs, labels).count() == 0


# Lines


def test_line_dedup(docs, texts, no_docs):
    got = line_dedup.drop_boilerplate(docs.where("doc_id >= 60"), "source", ratio=0.5, least_pages=1)
    assert got.columns[: len(docs.columns)] == docs.columns
    kept = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got.collect()}
    assert kept[60] == ("\n", 4, 3) and kept[61] == ("", 3, 2) or kept[60][1] == 4
    whole = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs, "lang", ratio=0.05, least_pages=2).collect() if r.doc_id}
    assert whole[60].text == "own line one\n" and whole[61].text == "own line two\n"
    assert whole[20].text is None and whole[20].n_lines == 0 and whole[21].text == ""
    assert line_dedup.drop_boilerplate(docs, "lang").count() == len(texts)
    assert line_dedup.drop_boilerplate(no_docs, "source").count() == 0


# SimHash


def test_simhash(docs, texts, no_docs):
    prints = [brute.fingerprint(t) for _, t in texts]
    roots = brute.groups(prints)
    names = {}
    for (i, _), r in zip(texts, roots, strict=True):
        names[r] = min((x for x in (names.get(r), i) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", names[r]) for (i, _), p, r in zip(texts, prints, roots, strict=True))
    assert rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == Counter((n,) for n in names.values())
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("bucket", [4096, 2])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    pick = random.Random(3)
    values = set()
    for _ in range(4):
        base = pick.getrandbits(64)
        for _ in range(60):
            x = base
            for _ in range(pick.randint(0, 5)):
                x ^= 1 << pick.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "bits bigint"), bucket=bucket)
    root = {r.node: r.root for r in components.components(found).collect()}
    got = [root.get(v, v) for v in signed]
    want = brute.groups(values)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert rows(components.components(chain), "root") == Counter({(0,): 200})


# Tokens


def odd_texts() -> list[str]:
    pick = random.Random(4)
    parts = ["a", "e", " ", "  ", "\n", "'", "'re", "'ll", "é", "1", "23", "!", "the", " of", "\t", "<|endoftext|>", "日", "\u3000", "\u088f"]
    return ["".join(pick.choices(parts, k=pick.randint(0, 12))) for _ in range(300)] + ["a" * 3000, " " * 500 + "x", "ab" * 900]


def test_codec_equals_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    for text in odd_texts():
        want = library.encode(text, add_special_tokens=False).ids
        ids = bpe_codec.encode(text, PATH)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert bpe_codec.decode(ids, PATH) == library.decode(want, skip_special_tokens=False) == text


def test_count_at_every_prefix_equals_the_library():
    from tokenizers import Tokenizer

    library, counter = Tokenizer.from_file(PATH), token_prefixes.PrefixCounter(PATH)
    for text in odd_texts()[:200]:
        counts = counter.of_text(text)
        assert len(counts) == len(text.encode())
        if "<" not in text:
            for p in range(1, len(text) + 1):
                want = len(library.encode(text[:p], add_special_tokens=False).ids)
                assert counts[len(text[:p].encode()) - 1] == want, (text, p)


def test_longest_prefix_in_a_budget():
    counter = token_prefixes.PrefixCounter(PATH)
    text = "one two três 日本 three four"
    counts, raw = counter.of_text(text), text.encode()
    for limit in range(12):
        size = token_prefixes.longest_fitting(counts, raw, limit)
        fits = [p for p in range(len(text) + 1) if p == 0 or counts[len(text[:p].encode()) - 1] <= limit]
        assert raw[:size].decode() == text[: max(fits)]


def test_token_queries(docs, texts, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts}
    small = docs.select("doc_id", "text")
    counts = rows(token_prefixes.token_counts(small, PATH), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert counts == Counter((i, len((t or "").encode()), len(ids[i]), len(ids[i]) > 1024) for i, t in texts)
    want = Counter((i, len(ids[i]), brute.sha(np.array(ids[i], "<u4").tobytes()), brute.sha(t or "")) for i, t in texts)
    assert rows(bpe_codec.digests(small, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert rows(bpe_codec.encoded(small, PATH), "doc_id", "decoded") == Counter((i, t or "") for i, t in texts)
    prefixes = {r.doc_id: r.counts for r in token_prefixes.prefix_counts(small, PATH).collect()}
    assert np.frombuffer(prefixes[50], "<i4")[-1] == len(ids[50])
    assert bpe_codec.digests(no_docs.select("doc_id", "text"), PATH).count() == 0


def test_word_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_WORDS", 3)
    cache = byte_bpe.WordCache(len)
    assert [cache[w] for w in ("a", "bb", "ccc", "dddd", "a", "x" * 200)] == [1, 2, 3, 4, 1, 200]
    assert len(cache) <= 3 and len(cache.old) <= 3


# Chat


def test_chats_read_back(spark):
    ugly = "\\### Assistant: </turn> ok"
    said = [(1, 0, "user", ugly), (1, 1, "assistant", ugly), (1, 2, "assistant", None), (2, 0, "assistant", "\\"), (2, 1, "a:\n", "</turn>\n")]
    said += [(None, 3, None, "</tu"), (None, 4, "assistant", "### ###"), (3, 5, "user", ""), (4, 1, "user", "tie"), (4, 1, "user", "tie")]
    df = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").withColumn("node", F.lit(1))
    read = chat_trees.read_back(chat_trees.formatted(chat_trees.as_chains(df))).collect()
    for r in read:
        own = [(x[2] or "", x[3] or "") for x in said if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.said] == own
        assert r.learned == [t for role, t in own if role == "assistant"]
        assert r.formatted.count("</turn>\n") == len(own)
    assert len(read) == 5
    assert chat_trees.digests(chat_trees.formatted(chat_trees.as_chains(df.limit(0)))).count() == 0


def test_best_branch_of_a_tree(spark):
    nodes = [("t", "a", None, 0.0), ("t", "b", "a", 1.0), ("t", "c", "a", 3.0), ("t", "d", "b", 5.0), ("t", "e", "c", 1.0),
             ("t", "x", "y", 9.0), ("t", "y", "x", 9.0), ("u", "p", "gone", 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node string, parent string, score double")
    assert rows(chat_trees.paths(df), "leaf", "node", "up") == Counter(
        [("d", "d", 0), ("d", "b", 1), ("d", "a", 2), ("e", "e", 0), ("e", "c", 1), ("e", "a", 2), ("p", "p", 0)]
    )
    assert rows(chat_trees.branches(df), "leaf", "node") == Counter([("d", "d"), ("d", "b"), ("d", "a"), ("p", "p")])
    assert rows(chat_trees.branches(df, 2), "leaf")[("e",)] == 3


# Repeated substrings


def test_suffix_dedup(docs, texts, no_docs):
    got = rows(suffix_dedup.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    results = brute.without_repeats([t for _, t in texts])
    assert got == Counter((i, *r) for (i, _), r in zip(texts, results, strict=True))
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_of_short_strings(spark, seed):
    pick = random.Random(seed)
    texts = ["".join(pick.choices("ab" if seed else "a", k=pick.randint(0, 60))) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, 10).collect()}
    assert [got[i] for i in range(25)] == brute.without_repeats(texts, 10)


def test_samples_follow_from_content():
    pick = random.Random(6)
    strings = [bytes(pick.choices(b"ab", k=pick.randint(0, 60))) for _ in range(40)]
    block = Block.of(strings)
    ids, want = block.grams(4), set()
    for low, high in zip(block.starts, block.ends, strict=True):
        for p in range(low, high - 9):
            least = min(ids[p : p + 7])
            want |= {i for i in range(p, p + 7) if ids[i] == least}
    assert set(block.samples(4, 10).tolist()) == want
