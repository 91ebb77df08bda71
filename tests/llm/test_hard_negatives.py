"""Hard negatives against scoring every pair."""

import math

import duckdb
import numpy as np

from hourglass.llm import hard_negatives as H
from tests.conftest import SF_MID, SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, anchor boolean, rank string, score long"


def brute(rows):
    live = []
    for i, (key, v, label, anchor) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            live.append((i, key, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float).tolist()], label, anchor))
    rank = lambda s, r: (-s, r[1] is None, r[1] or 0, r[0])
    out = []
    for a in live:
        if not a[4]:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r) for r in live if r[0] != a[0] and len(r[2]) == len(a[2])]
        good = sorted((x for x in scored if x[1][3] == a[3]), key=lambda x: rank(*x))[:5]
        bad = sorted((x for x in scored if x[1][3] != a[3]), key=lambda x: rank(*x))
        for ps, p in good:
            fits = [(s, r) for s, r in bad if 30 * ps <= 100 * s <= 90 * ps][:10]
            out += [(a[1], p[1], k + 1, r[1], ps, s) for k, (s, r) in enumerate(fits)]
    return sorted(out, key=str)


def mined(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = H.hard_negatives(frame, "vec_id", "embedding", "label", "anchor")
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()), key=str)


def clusters(n, d=12, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, d))
    v = centres[draw.integers(0, 6, n)] + 0.3 * draw.normal(size=(n, d))
    return (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32), draw


def test_equal_to_all_pairs_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "TREE", 16)
    monkeypatch.setattr(H, "SLICE", 32)
    monkeypatch.setattr(H, "BUCKET", 128)
    v, draw = clusters(400)
    rows = [(i, x.tolist(), int(k), i % 9 == 0) for i, (x, k) in enumerate(zip(v, draw.integers(0, 4, len(v))))]
    assert mined(spark, rows) == brute(rows)


def test_ties_repeats_nulls_and_lengths(spark):
    unit = [1.0, 0.0]
    rows = [(1, unit, 0, True), (1, unit, 0, True), (2, unit, 0, None), (None, unit, 0, True), (3, [0.5, 0.0], 1, False),
            (3, [0.5, 0.0], 1, False), (None, [0.5, 0.1], 1, False), (4, [0.5, -0.1], 2, True), (5, None, 1, True),
            (6, [None, 1.0], 1, True), (7, [float("nan"), 1.0], 1, True), (8, [float("inf"), 1.0], 1, True),
            (9, unit, None, True), (10, [1.0], 0, True), (11, [1.0], 0, False), (12, [0.5], 1, False), (13, [], 0, True),
            (14, [], 0, False), (15, [], 1, False), (16, [3e38, 1.0], 0, True), (17, [-1.0, 0.0], 0, True),
            (18, [0.0, 0.0], 0, True), (19, [0.0, 0.0], 1, True)]
    assert mined(spark, rows) == brute([r if r[0] != 16 else (16, None, 0, True) for r in rows])
    assert mined(spark, []) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [float(2**22 + i), float(2**21 - 3 * i)], i % 2, i % 3 == 0) for i in range(12)]
    rows += [(20 + i, [float(2**21 + i), 5.0], (i + 1) % 2, False) for i in range(12)]
    assert mined(spark, rows) == brute(rows)


def test_bounds_spare_scores():
    """Near anchors: most candidates are settled by the parent's bounds, and nothing is lost."""
    v, draw = clusters(3000, d=16, seed=4)
    a = v[:1] + 0.002 * draw.normal(size=(40, 16))
    rows = lambda x, s: {"vec": np.floor(256 * 256 * x).astype(np.int32), "label": np.zeros(len(x), np.int64) + s,
                         "row": np.arange(len(x)) + s * 10000, "id": np.arange(len(x)), "none": np.zeros(len(x), bool)}
    anchors, others = rows(a, 0), rows(v, 1)
    wanted, count = [[H.Wanted(-np.inf, np.inf, 5)] for _ in a], []
    H.search(anchors, others, False, wanted, count)
    scores = anchors["vec"].astype(np.int64) @ others["vec"].astype(np.int64).T
    for i, (w,) in enumerate(wanted):
        order = sorted(range(len(v)), key=lambda j: (-scores[i, j], j))[:5]
        assert [h[2] for h in w.hits] == order
    assert sum(count) < 0.25 * scores.size


def test_tree_is_minimal():
    v, _ = clusters(60)
    tree = H.spanning_tree(v.astype(np.float64))
    d = np.linalg.norm(v[:, None] - v[None], axis=2)
    linked, total = {0}, 0.0
    while len(linked) < len(v):
        w, k = min((d[i, j], j) for i in linked for j in range(len(v)) if j not in linked)
        linked.add(k)
        total += w
    assert abs(sum(e for _, _, e in tree) - total) < 1e-4
    seen = set()
    for node, parent, _ in tree:
        assert parent in seen or parent < 0
        seen.add(node)


def test_query_equals_sql(spark):
    for folder in (SF_SMALL, SF_MID):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        want = sorted(con.sql(H.ORACLE_OP11).fetchall())
        assert want and sorted(map(tuple, H.op11_hard_negatives(spark, folder).collect())) == want
