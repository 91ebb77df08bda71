"""Hand-made frames for the series operators (FIXTURES section 4)."""

import math

import pytest
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators import aggregates as D
from hourglass.operators import timeseries as E


def _grid(spark, rows):
    return spark.createDataFrame(rows, "stay long, time long, feature string, value double")


def test_decay_mask_and_fill(spark):
    vals = [None, 5.0, None, None, 7.0, None]
    g = _grid(spark, [(1, h + 1, "a", v) for h, v in enumerate(vals)])
    out = E.fill_and_mask(g).orderBy("time").collect()
    assert [r.mask for r in out] == pytest.approx([0, 1, 0.75, 0.375, 1, 0.75])
    assert [r.value for r in out] == [None, 5, 5, 5, 7, 7]


def test_binary_mask(spark):
    vals = [None, 5.0, None, 7.0]
    g = _grid(spark, [(1, h + 1, "a", v) for h, v in enumerate(vals)])
    out = E.fill_and_mask(g, decay=False).orderBy("time").collect()
    assert [r.mask for r in out] == [0, 1, 0, 1]


def test_fill_never_crosses_stays(spark):
    g = _grid(spark, [(1, 1, "a", 3.0), (1, 2, "a", None), (2, 1, "a", None), (2, 2, "a", 4.0)])
    out = E.zero_fill(E.fill_and_mask(g)).orderBy("stay", "time").collect()
    assert [(r.stay, r.time, r.value) for r in out] == [(1, 1, 3), (1, 2, 3), (2, 1, 0), (2, 2, 4)]


def test_hour_ceiling(spark):
    df = spark.createDataFrame([(-61,), (60,), (61,), (0,), (-60,)], "o long")
    assert [r.h for r in df.select(H.hour_ceil("o").alias("h")).collect()] == [-1, 1, 2, 0, -1]


def test_quantiles_linear(spark):
    df = spark.createDataFrame([("f", float(v)) for v in (1, 2, 4, 8, 16)], "feature string, value double")
    r = D.fit_quantiles(df).collect()[0]
    assert r.q_lo == pytest.approx(1.2) and r.q_hi == pytest.approx(14.4)


def test_scale_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 2.0, 2.0), (2.0, 2.0, 2.0)], "x double, lo double, hi double")
    out = [r.v for r in df.select(H.clip(H.scale_between("x", "lo", "hi")).alias("v")).collect()]
    assert out == [-4.0, 4.0, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (9.0,), (-9.0,), (1.0,)], "x double")
    assert [r.v for r in df.select(H.clip("x").alias("v")).collect()] == [None, 4.0, -4.0, 1.0]


def test_pre_admission_value_carries_in(spark):
    # offset -30 (hour 0) observed, next at 180 (hour 3): hours 1-2 carry the value, hour 0 dropped
    hourly = spark.createDataFrame([(1, 0, "a", 2.0), (1, 3, "a", 5.0)],
                                   "stay long, time long, feature string, value double")
    vocab = spark.createDataFrame([("a",)], "feature string")
    out = E.resample_and_mask(hourly, vocab).orderBy("time").collect()
    assert [(r.time, r.value, r.mask) for r in out] == [
        (1, 2.0, pytest.approx(0.75)), (2, 2.0, pytest.approx(0.375)), (3, 5.0, 1.0)]


def test_horizon_clip_before_densify(spark):
    hourly = spark.createDataFrame([(1, 1, "a", 1.0), (1, 500, "a", 2.0)],
                                   "stay long, time long, feature string, value double")
    vocab = spark.createDataFrame([("a",)], "feature string")
    out = E.resample_and_mask(hourly, vocab, horizon=10)
    assert out.agg(F.max("time")).first()[0] == 9
    assert out.count() == 9


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "stay long, offset_min long, feature string, value double, source string")


def test_clip_before_hourly_mean_and_three_stage_mean(spark):
    # two sources in the same minute -> mean of source means; outlier clipped first
    ev = _events(spark, [
        (1, 10, "a", 0.0, "s1"), (1, 10, "a", 2.0, "s1"),   # s1 minute mean 1.0
        (1, 10, "a", 4.0, "s2"),                            # s2 minute mean 4.0
        (1, 20, "a", 1000.0, "s1"),                         # outlier, clipped to 4
    ])
    stats = spark.createDataFrame([("a", 1, 0.0, 2.0)], "feature string, n_stays long, q_lo double, q_hi double")
    out = E.encode_events(ev, stats, horizon=None).collect()
    # scaled: s1 1.0 -> 0.0 ; s2 4.0 -> 3.0 ; minute 10 mean -> 1.5 ; minute 20 -> 4.0 (clipped)
    assert len(out) == 1
    assert out[0].time == 1 and out[0].value == pytest.approx((1.5 + 4.0) / 2)


def test_row_positions_not_hours(spark):
    # a stay starting at hour 10 has its first label row at hour 15
    hours = spark.createDataFrame([(1, h) for h in range(10, 40)], "stay long, time long")
    kept = E.skip_first_rows(hours, 5).agg(F.min("time")).first()[0]
    assert kept == 15
    five = spark.createDataFrame([(2, h) for h in range(1, 6)], "stay long, time long")
    assert E.skip_first_rows(five, 5).count() == 0
    at = E.at_time_index(hours, 24, 5).collect()
    assert len(at) == 1 and at[0].time == 10 + 29


def test_time_of_day(spark):
    g = spark.createDataFrame([(1, 1), (1, 23)], "stay long, time long")
    adm = spark.createDataFrame([(1, 22)], "stay long, hour int")
    out = E.time_of_day(g, adm).orderBy("time").collect()
    assert out[0].hour == pytest.approx(23 / 23) and out[1].hour == pytest.approx(21 / 23)
    assert not any(math.isnan(r.hour) for r in out)


def test_distributed_quantiles_match_percentile(spark):
    import random

    from hourglass.operators.quantiles import distributed_quantiles

    rnd = random.Random(3)
    rows = [("g%d" % (i % 4), float(rnd.randint(0, 50))) for i in range(997)] + [("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = (0.05, 0.25, 0.5, 0.95)
    a = {r.g: tuple(r[1:]) for r in distributed_quantiles(df, "v", ["g"], probs).collect()}
    arr = F.percentile("v", F.array(*[F.lit(p) for p in probs]))
    b = {r.g: tuple(r.q) for r in df.groupBy("g").agg(arr.alias("q")).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])
    whole = distributed_quantiles(df, "v", (), (0.5,)).first()[0]
    assert whole == pytest.approx(df.agg(F.percentile("v", 0.5)).first()[0])


def test_since_last_observation(spark):
    vals = [None, 5.0, None, None, 7.0, None]
    g = _grid(spark, [(1, h + 1, "a", v) for h, v in enumerate(vals)])
    out = [r.hours_since_obs for r in E.since_last_observation(g).orderBy("time").collect()]
    assert out == [None, 0, 1, 2, 0, 1]


def test_main_source_decides_which_stays_are_encoded(spark):
    """A stay with a row of the main source stays, even one without a value; others go."""
    rows = [(1, 10, "a", 1.0, "long"), (1, 20, "a", 2.0, "main"), (2, 10, "a", 1.0, "long"), (3, 10, "a", None, "main"),
            (3, 30, "b", 5.0, "long"), (4, 5, "b", None, "long")]
    ev = spark.createDataFrame(rows, "stay long, offset_min long, feature string, value double, source string")
    minutes = E.source_minute_mean(ev, (), "main")
    assert sorted(r.stay for r in E.main_source_stays(minutes, "main").collect()) == [1, 3]
    assert sorted(r.stay for r in E.source_minute_mean(ev).collect()) == [1, 1, 2, 3]
    cohort = spark.createDataFrame([(i,) for i in range(1, 5)], "stay long")
    kept = minutes.where("value is not null")
    assert [r.feature for r in E.fit_vocabulary(kept, cohort, 0.4).collect()] == ["a"]
    assert sorted(r.feature for r in E.fit_vocabulary(kept, cohort, 0.4, ["b"]).collect()) == ["a", "b"]


def test_sequences_of_many_stays_in_small_tables(spark, monkeypatch):
    """Arrow batches cut anywhere, matrices of a few cells: every stay is whole and equal to the grid."""
    import random

    from hourglass.operators import sequences as K

    draw = random.Random(8)
    rows = [(s, f, t, draw.random(), s % 24) for s in range(40) for f in "abc" for t in range(1, 30) if draw.random() < 0.2]
    hourly = spark.createDataFrame(rows, "stay long, feature string, time long, value double, admit_hour int")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",), ("never",)], "feature string")
    runs = E.stay_runs(hourly, vocab, max_hour=20, carry=("admit_hour",))
    monkeypatch.setattr(K, "CELLS", 50)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r["stay"], r["time"]): (r["values"], r["masks"], r["hour"]) for r in K.hour_rows(runs).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    grid = E.resample_and_mask(hourly, vocab, horizon=21, carry=("admit_hour",)).collect()
    assert len(grid) == 4 * len(got)
    for g in grid:
        values, masks, hour = got[g["stay"], g["time"]]
        i = ["a", "b", "c", "never"].index(g["feature"])
        assert (values[i], masks[i]) == (g["value"], g["mask"])
        assert hour == (g["time"] + g["admit_hour"]) % 24 / 23.0


def test_lags_and_positions_from_the_runs(spark):
    """Lagged sums laid out from the runs equal lags over the dense grid; so do attributions by carried bounds."""
    import random

    from hourglass.operators import attribution as M

    draw = random.Random(4)
    rows = [(s, f, t, draw.random()) for s in range(12) for f in "abc" for t in range(-2, 40) if draw.random() < 0.15]
    hourly = spark.createDataFrame(rows, "stay long, feature string, time long, value double")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",), ("never",)], "feature string")
    grid = E.resample_and_mask(hourly, vocab, horizon=30, bounds=True)
    want = {(r.stay, r.time, r.feature): (r.value, r.conv) for r in M.causal_lag_features(grid, (0.5, 0.3, 0.2), 2).collect()}
    got = M.causal_lag_series(E.run_arrays(hourly, vocab, max_hour=29), (0.5, 0.3, 0.2), 2).collect()
    assert len(got) == len(want)
    for r in got:
        value, conv = want[r.stay, r.time, r.feature]
        assert r.value == value and r.conv == pytest.approx(conv)
    attr = grid.withColumn("attribution", F.col("value") * F.col("mask"))
    by_bounds = {(r.stay, r.feature): r.mean_abs for r in M.per_stay_attribution(attr, 10).collect()}
    by_joins = {(r.stay, r.feature): r.mean_abs for r in M.per_stay_attribution(attr.drop("first_time", "last_time"), 10).collect()}
    assert by_bounds == pytest.approx(by_joins) and by_bounds
