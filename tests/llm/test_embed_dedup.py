import itertools

import numpy as np

from hourglass.llm import embed_dedup as E
from tests.llm.helpers import components

SCHEMA = "vec_id long, embedding array<float>, node long, copies string"


def brute(vectors):
    links = []
    for (a, x), (b, y) in itertools.combinations(enumerate(vectors), 2):
        if x is None or y is None or len(x) != len(y) or not len(x) or any(c is None for c in [*x, *y]):
            continue
        x, y = (np.array(v, dtype=np.float32).astype(float) for v in (x, y))
        n = np.linalg.norm(x) * np.linalg.norm(y)
        if np.isfinite(n) and n > 0 and x @ y / n >= E.COSINE:
            links.append((a, b))
    return links


def run(spark, vectors, **kw):
    df = spark.createDataFrame([(i, v, 1, "clash") for i, v in enumerate(vectors)], SCHEMA)
    return {r["vec_id"]: tuple(r)[1:] for r in E.embedding_components(df, **kw).collect()}


def near(rng, x, cos):
    z = rng.normal(size=len(x))
    x = x / np.linalg.norm(x)
    z -= (z @ x) * x
    return cos * x + np.sqrt(1 - cos * cos) * z / np.linalg.norm(z)


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    p = E.nearest_e8(x)
    roots = E.e8_roots()
    assert len(roots) == 240 and np.allclose((roots ** 2).sum(axis=1), 2)
    sums = p.sum(axis=1)
    whole = np.isclose(p, np.rint(p)).all(axis=1)
    assert np.isclose(sums % 2, 0).all() and (whole | np.isclose(p % 1, 0.5).all(axis=1)).all()
    gain = ((x - p) ** 2).sum(axis=1)
    assert all((((x - (p + r)) ** 2).sum(axis=1) >= gain - 1e-9).all() for r in roots)


def test_dense_groups_match_brute_force_in_blocks(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=64).tolist() for _ in range(60)]
    center = rng.normal(size=64)
    vectors += [near(rng, center, 0.99).tolist() for _ in range(90)] + [center.tolist()] * 30 + [(3 * center).tolist()]
    links = brute(vectors)
    of, n = components(range(len(vectors)), links), np.bincount(np.array(links).ravel(), minlength=len(vectors))
    got = run(spark, vectors, block=16)
    assert got == {i: (int(n[i]), of[i], of[i] == i) for i in range(len(vectors))}


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(2)
    vectors = []
    for cos in (0.901, 0.92, 0.95, 0.98):
        for _ in range(150):
            x = rng.normal(size=64)
            vectors += [x.tolist(), near(rng, x, cos).tolist()]
    got = run(spark, vectors)
    links = brute(vectors)
    found = [a for a, b in links if got[b][1] == got[a][1]]
    assert len(found) >= 0.95 * len(links)
    assert sum(g[0] for g in got.values()) == 2 * len(found)  # none below the threshold


def test_edge_rows(spark):
    x = [1.0, 2.0, 3.0]
    vectors = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], x, x, [2.0, 4.0, 6.0], [1.0, 2.0], [-1.0, -2.0, -3.0], [1e-30, 2e-30, 3e-30], [1e30, 2e30, 3e30]]
    got = run(spark, vectors)
    assert all(got[i] == (0, i, True) for i in (0, 1, 2, 3, 4, 5, 9, 10))
    assert all(got[i] == (4, 6, i == 6) for i in (6, 7, 8, 11, 12))


def test_null_and_repeated_keys_and_empty_table(spark):
    x = [1.0, 0.5]
    df = spark.createDataFrame([(None, x), (None, x), (3, x), (3, x), (None, [1.0, -9.0])], "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in E.embedding_components(df).collect()), key=str)
    assert got == sorted([(None, 3, 3, False)] * 2 + [(3, 3, 3, True)] * 2 + [(None, 0, None, True)], key=str)
    assert E.embedding_components(df.limit(0)).collect() == []
