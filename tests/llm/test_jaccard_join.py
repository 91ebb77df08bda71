import random

import numpy as np
import pytest

from hourglass.llm import jaccard_join as J
from hourglass.llm.components import connected_components
from tests.llm.helpers import components, docs_frame, jaccard_links, shingles

RNG = random.Random(7)


def words(n, vocabulary=3000):
    return [f"t{RNG.randrange(vocabulary)}" for _ in range(n)]


def edited(text, k):
    out = text.split(" ")
    for _ in range(k):
        out[RNG.randrange(len(out))] = f"e{RNG.randrange(10**6)}"
    return " ".join(out)


def corpus():
    boiler = [" ".join(words(12)) for _ in range(3)]
    texts = [None, "", " \n\t", "one", "ONE", "one two", "one  two\n", "a b c d", "a b c d e", "A B C D E", "a b c d e f"]
    for n in (9, 15, 30, 45, 53, 54, 60, 120, 400):
        base = " ".join(words(n))
        texts += [base, base] + [edited(base, k) for k in (1, 1, 2, 3, n // 25 + 1)]
    for _ in range(60):  # short texts that are mostly boilerplate
        texts.append(" ".join(RNG.sample(boiler, RNG.randrange(1, 4)) + words(RNG.randrange(9))))
    chain = words(80)  # a chain: neighbours link, ends do not
    for k in range(8):
        texts.append(" ".join(chain[k * 5:k * 5 + 40]))
    return texts


def test_matches_brute_force(spark):
    texts = corpus()
    links = jaccard_links(texts)
    assert len(links) > 60
    of = components(range(len(texts)), links)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs_frame(spark, texts)).collect()}
    assert got == {i: (len(shingles(t)), of[i]) for i, t in enumerate(texts)}


@pytest.mark.parametrize("block", [3, 256])
def test_links_are_counted_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "COLUMNS", 64)
    base = " ".join(words(60))
    texts = corpus() + [base] * 3 + [edited(base, k % 5) for k in range(25)]
    links = jaccard_links(texts)
    n = [0] * len(texts)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert max(n) > 10
    of = components(range(len(texts)), links)
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in J.jaccard_components(docs_frame(spark, texts), count=True).collect()}
    assert got == {i: (n[i], of[i]) for i in range(len(texts))}


def test_shared_tokens_equal_intersections():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 300, int(rng.integers(0, 90))).astype(np.uint64)) for _ in range(30)]
    got = J.shared_tokens(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)
    assert J.shared_tokens([]).shape == (0, 0) and J.shared_tokens([sets[0][:0]]).tolist() == [[0.0]]


def test_linked_sets_always_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(3, 200))
        x = rng.choice(10**6, n, replace=False).astype(np.uint64)
        drop = int(rng.integers(0, max(1, n // 4)))
        y = np.unique(np.concatenate([x[drop:], rng.integers(10**7, 10**8, int(rng.integers(0, 5))).astype(np.uint64)]))
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        if 100 * both < J.PERCENT * (len(x) + len(y) - both):
            continue
        common = rng.random() * 1.2
        frequent = {int(t): r for r, t in enumerate(np.unique(np.concatenate([x, y]))) if rng.random() < common}
        keys = [set(np.concatenate(J.prefix_keys(s, np.array([frequent.get(int(t), -1) for t in s]))).tolist()) for s in (x, y)]
        least = min(J.least_shared(len(x)), J.least_shared(len(y)))
        assert len(keys[0] & keys[1]) >= least or (len(x) < 3 and x.tolist() == y.tolist())


def test_frequent_tokens_keep_whole_counts(spark):
    rows = [(t, 1 + t % 7) for t in range(2000)] + [(10_000 + t, 2000 + 900 * t) for t in range(30)] + [(1, 5)]
    df = spark.createDataFrame(rows, "node long, n long")
    count = {}
    for t, n in rows:
        count[t] = count.get(t, 0) + n
    for most in (0, 5, 100, 400, 10**6):
        got = J.frequent_tokens(df, most).tolist()
        assert len(got) <= most and all(count[t] >= J.LEAST_COUNT for t in got)
        left = [c for t, c in count.items() if t not in set(got) and c >= J.LEAST_COUNT]
        assert not got or not left or max(left) <= 1.1 * min(count[t] for t in got)
    assert len(got) == sum(c >= J.LEAST_COUNT for c in count.values())


def test_large_groups_do_not_make_pairs(spark, monkeypatch):
    base = " ".join(words(60))
    texts = [base] * 150 + [edited(base, 1) for _ in range(150)] + [" ".join(words(60)) for _ in range(20)]
    seen = []
    links = J._links
    monkeypatch.setattr(J, "_links", lambda pairs, *a: (seen.append(pairs.count()), links(pairs, *a))[1])
    of = components(range(len(texts)), jaccard_links(texts))
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs_frame(spark, texts)).collect()}
    assert got == of and sum(seen) < 1500  # 150 * 149 / 2 pairs are linked or nearly so


@pytest.mark.parametrize("block", [16, 256])
def test_groups_that_do_not_link_with_their_pivot_make_no_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(11)

    def replaced(text, at):
        return " ".join(f"r{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(text.split(" ")))

    base = " ".join(f"b{i}" for i in range(100))
    apart = [replaced(base, set(rng.sample(range(10, 90), 4))) for _ in range(70)]
    texts = [base] * 5 + apart + [replaced(t, {k % 95}) for k, t in enumerate(apart[:30])]
    links = jaccard_links(texts)
    of = components(range(len(texts)), links)
    assert len(set(of.values())) > 30 and sum(of[i] == 0 for i in of) < 50
    seen = []
    found = J._links
    monkeypatch.setattr(J, "_links", lambda pairs, *a: (seen.append(pairs.count()), found(pairs, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs_frame(spark, texts)).collect()}
    assert got == of and sum(seen) < 500  # 100 * 99 / 2 pairs share most of the base's shingles


def test_null_and_repeated_keys_and_clashing_columns(spark):
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 2), (4, "a b c d e f", 3), (4, "x", 4), (9, "x", 5), (9, "x", 6), (None, "q", 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node long")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 2, 4), (None, 2, 4), (4, 2, 4), (4, 1, 4), (9, 1, 4), (9, 1, 4), (None, 1, None), (None, 0, None)], key=str)
    assert J.jaccard_components(df.limit(0)).collect() == []
    kept = J.keep_one(spark, df, "").collect()
    assert sorted((r["node"] for r in kept if r["node"] not in (5, 6)), key=str) == [3, 4, 7, 8]


def test_one_row_of_a_group_stays_whatever_its_keys(spark):
    a, b, c = (" ".join(words(60)) for _ in range(3))
    rows = [(3, a, 1), (3, edited(a, 1), 2), (5, a, 3), (None, a, 4), (None, b, 5), (None, edited(b, 1), 6), (None, edited(b, 1), 7), (None, c, 8), (None, "", 9), (2, "", 10)]
    kept = [r["n"] for r in J.keep_one(spark, spark.createDataFrame(rows, "doc_id long, text string, n int"), "").collect()]
    assert len(kept) == 5 and {8, 9, 10} < set(kept)
    assert len({1, 2} & set(kept)) == 1 and len({5, 6, 7} & set(kept)) == 1


def test_very_long_text(spark):
    long = " ".join(words(60_000, 10**6))
    got = J.jaccard_components(docs_frame(spark, [long, edited(long, 50), "short text"])).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 0, 2: 2}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (9, 8), (3, 2), (2, 1), (1, 1), (None, 1)]])
def test_connected_components(spark, edges):
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({i: 1 for i in range(1, 6)} | {8: 8, 9: 8} if len(edges) > 1 else {})


def test_components_of_random_graphs_and_a_hub(spark):
    edges = [(RNG.randrange(300), RNG.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(500)] + [(2000 + i, 2001 + i) for i in range(60)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    of = components(nodes, edges)
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == of
