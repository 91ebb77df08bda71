"""Plan-shape and robustness checks for the flagship encoding."""

import contextlib
import io

from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators import timeseries as E
from hourglass.plans import series
from tests.conftest import SF_SMALL


def _plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_dense_grid_is_never_shuffled(spark):
    g = series.encode_timeseries(spark, SF_SMALL)
    text = _plan(g).split("== Physical Plan ==")[-1]
    lines = text.splitlines()
    gen = next(i for i, l in enumerate(lines) if "Generate" in l)
    above = [l for l in lines[:gen] if "Exchange" in l and "BroadcastExchange" not in l]
    assert not above, above
    joins = [l for l in lines[:gen] if "Join" in l]
    assert not joins, joins   # time of day rides along; nothing joins the dense grid


def test_minutes_between_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-03-10 01:30:00", "2024-03-10 03:30:00")], "a string, b string")
        df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        assert df.select(H.minutes_between("a", "b").alias("m")).first().m == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_hot_stay_holding_a_third_of_events(spark):
    # stay 0 carries as many events as all other stays together; results stay per stay and exact
    rows = [(0, m, "a", float(m % 7), "s") for m in range(0, 6000, 3)]
    rows += [(s, m, "a", 1.0, "s") for s in range(1, 41) for m in range(0, 3000, 60)]
    ev = spark.createDataFrame(rows, "stay long, offset_min long, feature string, value double, source string")
    stats = spark.createDataFrame([("a", 41, 0.0, 6.0)], "feature string, n_stays long, q_lo double, q_hi double")
    out = E.encode_events(ev, stats)
    per = {r.stay: r.n for r in out.groupBy("stay").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per[0] == 100          # hours 1..100 (offsets up to 5997 min)
    # offsets 0..2940 step 60 -> hours 0..49; hour 0 is dropped (time > 0)
    assert all(per[s] == 49 for s in range(1, 41))
    assert out.where(F.col("mask") == 1.0).count() == 100 + 40 * 49


def test_events_are_read_once_beside_the_cohort(spark, monkeypatch):
    """Event rows read over the whole query, fit jobs included: one pass after the cohort's."""
    from hourglass.sources import driver

    read, events = spark.sparkContext.accumulator(0), driver.events

    def counted(*a):
        df = events(*a)

        def count(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        return df.mapInArrow(count, df.schema)

    monkeypatch.setattr(driver, "events", counted)
    series.encode_timeseries(spark, SF_SMALL).count()
    assert read.value == events(spark, SF_SMALL).count()


def test_hours_need_no_features(spark):
    for f in (lambda: E.seq_length(series.series_hours(spark, SF_SMALL)), lambda: E.skip_first_rows(series.series_hours(spark, SF_SMALL))):
        plan = _plan(f())
        assert plan.count("Generate explode") == 1 and "Window" not in plan


def test_broadcasts_are_left_to_the_planner(spark):
    from hourglass.operators.joins import range_join

    ev = spark.range(0, 100).selectExpr("id as stay", "id as offset_min")
    st = spark.range(0, 100).selectExpr("id as stay", "id as discharge_offset")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in _plan(range_join(ev, st))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hour_rows_are_linear_in_many_features(spark):
    from hourglass.operators import sequences as K

    feats = [f"f{i:02d}" for i in range(87)]
    hourly = spark.createDataFrame([(1, f, 1 + i % 3, float(i), 7) for i, f in enumerate(feats)] + [(1, "f00", 40, 5.0, 7)],
                                   "stay long, feature string, time long, value double, admit_hour int")
    vocab = spark.createDataFrame([(f,) for f in feats], "feature string")
    runs = E.stay_runs(hourly, vocab, carry=("admit_hour",))
    rows = {r["time"]: r for r in K.hour_rows(runs).collect()}
    dense = E.resample_and_mask(hourly, vocab, horizon=None).collect()
    assert sorted(rows) == list(range(1, 41)) and len(dense) == 40 * 87
    for g in dense:
        i = feats.index(g["feature"])
        assert (rows[g["time"]]["values"][i], rows[g["time"]]["masks"][i]) == (g["value"], g["mask"])


def test_single_key_groups_of_quantiles_match_pandas(spark):
    import pytest

    from hourglass.operators.quantiles import quantiles

    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), (F.col("id") * 0.37 % 11).alias("v"))
    want = df.toPandas().groupby("g")["v"].quantile([0.05, 0.95]).unstack()
    for r in quantiles(df, "v", ["g"], (0.05, 0.95)).collect():
        assert (r.q0, r.q1) == pytest.approx(tuple(want.loc[r.g]))


def test_unmapped_mortality_text_fails(spark):
    import pytest

    from hourglass.operators.static import encode_labels

    assert [r[0] for r in encode_labels(spark.createDataFrame([(1,), (0,), (None,)], "mortality int")).collect()] == [1, 0, None]
    text = spark.createDataFrame([("EXPIRED",), ("1",)], "mortality string")
    with pytest.raises(Exception, match="unmapped mortality value"):
        encode_labels(text).collect()
    assert [r[0] for r in encode_labels(text, mortality_map={"EXPIRED": 1, "1": 1}).collect()] == [1, 1]


def test_approximate_quantile_option_runs(spark):
    exact = series.encode_timeseries(spark, SF_SMALL)
    approx = series.encode_timeseries(spark, SF_SMALL, quantile_accuracy=100_000)
    assert approx.count() == exact.count()
    assert set(approx.columns) == set(exact.columns)
