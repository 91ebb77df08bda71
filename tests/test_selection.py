"""Selection without an order: quantiles by bins, cuts of a seeded order by digits."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import quantiles as Q
from hourglass.operators import split as J


def plan_of(df):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("gathered", [1, 4, 4096])
def test_quantiles_of_awkward_values(spark, monkeypatch, gathered):
    monkeypatch.setattr(Q, "GATHERED", gathered)
    draw = random.Random(gathered)
    groups = {
        "outliers": [draw.gauss(0, 1) for _ in range(300)] + [1e300, -1e300, 1e-300, -1e-300, 5e-324],
        "narrow": [1.0 + k * 2.0**-52 for k in range(500)],
        "ties": [2.5] * 200 + [2.5000001] * 3 + [-7.0] * 40,
        "zeros": [0.0, -0.0] * 30 + [1.0],
        "one": [3.25],
        "two": [-1.0, 4.0],
        "infinite": [math.inf, -math.inf, 1.0, 2.0, 3.0],
        "wide": [draw.choice((-1, 1)) * 10.0 ** draw.uniform(-200, 200) for _ in range(400)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("ties", None), (None, 1.0)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    probs = (0.0, 0.05, 0.3333, 0.5, 0.95, 1.0)
    got = {r[0]: tuple(r)[1:] for r in Q.quantiles(df, "v", ["g"], probs).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        s = np.sort(np.array(vs))
        for p, q in zip(probs, got[g]):
            h = (len(s) - 1) * p
            lo, hi = s[math.floor(h)], s[math.ceil(h)]
            assert q == pytest.approx(lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo), nan_ok=True), (g, p)


def test_quantiles_without_values_or_groups(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert Q.quantiles(df, "v").collect()[0][0] is None
    assert Q.quantiles(spark.range(101).select(F.col("id").alias("v")), "v", (), (0.25,)).first()[0] == 25.0


def test_values_are_never_exchanged(spark):
    """Beside the counts only rows of a few bins are moved: no range order, no window over the values."""
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.7).alias("v"))
    text = plan_of(Q.quantiles(df, "v", ["g"], (0.5,), stored=True))
    assert "rangepartitioning" not in text and "Window" not in text and "Sort " not in text


def order(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("fetched", [1, 50, 4096])
def test_cuts_equal_the_whole_order(spark, monkeypatch, fetched):
    monkeypatch.setattr(J, "FETCHED", fetched)
    monkeypatch.setattr(J, "DIGITS", 1)
    keys = spark.range(700).select(F.col("id").alias("k"), (F.col("id") % 3).alias("b"))
    ranks = [1, 2, 100, 233]
    cuts = J.cut_points(keys, "k", 7, lambda n: [0, *ranks], "b")
    for b in range(3):
        want = order([k for k in range(700) if k % 3 == b], 7)
        assert [None if c is None else c[1] for c in cuts[b]] == [None, *[want[r - 1] for r in ranks]]


def test_split_without_a_join_and_sample_per_stratum(spark):
    rows = spark.range(900).select((F.col("id") % 90).alias("person"), F.col("id").alias("stay"))
    out = J.split_by_entity(rows.unionByName(spark.range(1).select(F.lit(None).cast("long").alias("person"), F.lit(-1).cast("long").alias("stay"))), "person", 4)
    assert "Join" not in plan_of(out)
    got = {r.person: r.split for r in out.collect()}
    ranked = order(range(90), 4)
    assert out.count() == 900 and [got[p] for p in ranked] == ["test"] * 14 + ["val"] * 14 + ["train"] * 62
    sample = J.sample_stays(out, 0.25, 4, by="split").collect()
    stays = {s: [r.stay for r in out.where(F.col("split") == s).collect()] for s in ("train", "val", "test")}
    for s, ids in stays.items():
        assert sorted(r.stay for r in sample if r.split == s) == sorted(order(ids, 4)[:round(0.25 * len(ids))])
    assert J.split_by_entity(rows.limit(0), "person").collect() == []
    assert J.sample_stays(rows.limit(0), 0.5).collect() == []
