"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from hourglass.llm.spelling import count_words, list_pairs, near_words, op12_spelling, spelling_groups
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def brute(counts):
    words = sorted(counts)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    rows = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def brute_counts(rows, least=6, often=5):
    lower = {c: c + 32 for c in range(65, 91)}
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def groups(spark, counts):
    return sorted(map(tuple, spelling_groups(frame(spark, counts)).collect()))


def test_one_list_equals_all_pairs():
    draw = random.Random(1)
    for letters, longest in (("ab", 7), ("abc", 5), ("aé", 9)):
        words = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))) for _ in range(150)})
        for n in range(1, longest):
            part = [w for w in words if len(w) in (n, n + 1)]
            one = np.ones(len(part), dtype=np.int64)
            q, w = list_pairs(part, one * n, one * 0, one * 0, one * 1000, one * 0, one * len(part))
            got = sorted(tuple(sorted((part[i], part[j]))) for i, j in zip(q.tolist(), w.tolist()))
            want = sorted((a, b) for a in part for b in part if a < b and min(len(a), len(b)) == n and one_edit(a, b))
            assert got == want


def test_groups_equal_all_pairs(spark):
    draw = random.Random(2)
    words = {"".join(draw.choice("abcé") for _ in range(draw.randint(6, 9))) for _ in range(700)}
    counts = {w: draw.choice([5, 6, 25, 30, 125, 700, 4000]) for w in sorted(words)}
    assert groups(spark, counts) == sorted(brute(counts))


def test_lists_dealt_until_they_are_small(spark):
    """A hot beginning and a hot ending: every list is split down to its last two code points."""
    draw = random.Random(3)
    words = {"common" + "".join(draw.choice("xyz") for _ in range(draw.randint(3, 5))) for _ in range(250)}
    words |= {"".join(draw.choice("xyz") for _ in range(draw.randint(3, 5))) + "ending" for _ in range(250)}
    counts = {w: draw.choice([5, 25, 125]) for w in sorted(words)}
    got = {(r.word, r.near) for r in near_words(frame(spark, counts), size=3).collect()}
    rows = near_words(frame(spark, counts), size=3)
    assert rows.count() == len(got)  # every pair once
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_chains_ties_and_long_words(spark):
    long = "z" * 3000
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdehh": 125, "abcdehhh": 700, "abcdehhhh": 3500,
              long: 5, long + "y": 25, long[:1500] + "q" + long[1501:]: 5, "lonely": 9, "ÿÀÀÀÀÀ": 5, "ÿÀÀÀÀ×": 30}
    assert groups(spark, counts) == sorted(brute(counts))
    assert groups(spark, {}) == []


def test_counting_edges(spark):
    text = "Straße STRASSE straße x ÉCOLE École école Ärger÷Ärger×x " * 3
    rows = [(i, text) for i in range(400)] + [(None, text), (7, None), (8, ""), (9, "a" * 100000)] + [(3, text)] * 4
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], DOCS).selectExpr("*", "1 as n", "'w' as word")
    assert {r.word: r.n for r in count_words(docs).collect()} == brute_counts(rows)


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    out = op12_spelling(spark, SF_SMALL)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute(brute_counts(rows)), key=str)
