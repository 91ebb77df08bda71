"""Work that must not grow faster than its input: exchanges, task sizes and repeated reads."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from hourglass.operators import scoring as S
from hourglass.operators import sequences as K
from hourglass.operators import split as J
from hourglass.operators import timeseries as E
from hourglass.sources import io as A

FEATURES = ["a", "b", "c"]


def _hourly(spark, stays=12):
    rows = [(s, f, h, float(s + h), s % 24) for s in range(stays) for i, f in enumerate(FEATURES[:1 + s % 3]) for h in (1 + i, 5 + s)]
    return spark.createDataFrame(rows, "stay long, feature string, time long, value double, admit_hour int")


def _vocab(spark):
    return spark.createDataFrame([(f,) for f in FEATURES], "feature string")


def _grid(spark, monkeypatch):
    monkeypatch.setattr(E, "CELLS", 50)
    return E.resample_and_mask(_hourly(spark), _vocab(spark), carry=("admit_hour",)).withColumnRenamed("admit_hour", "hour")


def _above(df, operator):
    """Lines of the plan above the first ``operator``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Physical Plan ==")[-1].split(operator)[0]


def test_wide_rows_are_made_in_place(spark, monkeypatch):
    grid = _grid(spark, monkeypatch)
    wide = E.to_wide(grid, FEATURES)
    assert "Exchange" not in _above(wide, "Generate")
    got = {(r["stay"], r["time"], f): (r[f], r[f + "_mask"], r["hour"]) for r in wide.collect() for f in FEATURES}
    assert got == {(r["stay"], r["time"], r["feature"]): (r["value"], r["mask"], r["hour"]) for r in grid.collect()}


def test_grid_tasks_grow_with_cells(spark, monkeypatch):
    grid = _grid(spark, monkeypatch)
    cells = grid.count()
    assert grid.rdd.getNumPartitions() == -(-cells // 50)
    wide = E.to_wide(grid, FEATURES)
    assert wide.agg(*[F.count(c).alias(c) for c in A.feature_names(wide)]).first().asDict() == {f: cells // 3 for f in FEATURES}


def test_tagged_grid_is_counted_in_place(spark, monkeypatch):
    monkeypatch.setattr(E, "CELLS", 50)
    grid = E.dense_grid(_hourly(spark), _vocab(spark))
    per = grid.groupBy("stay", "time").agg(F.count(F.when(F.col("tag") == 0, 1)).alias("n"), F.count(F.when(F.col("tag") == 1, 1)).alias("seen"))
    assert "Exchange" not in _above(per, "Generate")
    rows = per.collect()
    assert all(r["n"] == 3 for r in rows) and sum(r["seen"] for r in rows) == _hourly(spark).count()
    assert grid.rdd.getNumPartitions() > 1


def test_sequences_are_not_exchanged_for_labels(spark, monkeypatch):
    monkeypatch.setattr(K, "CELLS", 40)
    runs = E.stay_runs(_hourly(spark), _vocab(spark), carry=("admit_hour",))
    labels = spark.createDataFrame([(s, 9.0 + s, s % 2) for s in range(0, 14, 2)] + [(4, 1.0, 1), (None, 2.0, 0)], "stay long, los_days double, mortality int")
    rows = K.training_rows(runs, labels, skip=2)
    above = _above(rows, "MapInArrow")
    assert "Join" not in above and "Exchange" not in above
    hours = {(r["stay"], r["time"]): (r["values"], r["masks"]) for r in K.hour_rows(runs).collect()}
    want = sorted((stay, time, m, max(los - time / 24, 1 / 48), *hours[stay, time]) for stay, los, m in [tuple(r) for r in labels.collect()]
                  for time in sorted(t for s, t in hours if s == stay)[2:])
    assert sorted((r["stay"], r["time"], r["mortality"], r["los_remaining"], r["values"], r["masks"]) for r in rows.collect()) == want


def test_hours_of_the_grid_are_distinct_in_place(spark, monkeypatch):
    grid = _grid(spark, monkeypatch)
    hours = grid.select("stay", "time", "hour").distinct()
    assert "Exchange" not in _above(hours, "Generate")
    assert hours.count() == len({(r["stay"], r["time"]) for r in grid.collect()})


@pytest.fixture
def written(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(A, "PART_STAYS", 4, raising=False)
    hours = spark.createDataFrame([(s, t) for s in range(23) for t in range(1 + s % 3)], "stay long, time long")
    order = J.shuffle_stays(hours)
    manifest = A.write_shuffled({"hours": hours}, order, str(tmp_path), 2, ("time",))
    return {r["stay"]: r["order"] for r in order.collect()}, str(tmp_path), manifest


def test_manifest_is_counted_by_parts(spark, written):
    order, _, manifest = written
    at, want = {}, {}
    for s, o in sorted(order.items(), key=lambda x: x[1]):
        f = (o - 1) * 2 // 23
        want[s] = (o, f, at.get(f, 0), 1 + s % 3)
        at[f] = at.get(f, 0) + 1 + s % 3
    assert {r["stay"]: (r["order"], r["file"], r["first_row"], r["n_rows"]) for r in manifest.collect()} == want


def test_no_task_writes_a_whole_file(spark, written):
    order, path, manifest = written
    first = {r["stay"]: (r["file"], r["first_row"]) for r in manifest.collect()}
    rows = A.read_shuffled(spark, path, "hours")
    assert rows.columns == ["stay", "time", "order", "file", "row"]
    assert sorted(tuple(r) for r in rows.drop("order").collect()) == sorted((s, t, first[s][0], first[s][1] + t) for s in order for t in range(1 + s % 3))
    parts = spark.read.parquet(f"{path}/hours").groupBy("_metadata.file_path").agg(F.count_distinct("stay").alias("n"))
    assert max(r["n"] for r in parts.collect()) <= 4


def test_permutations_read_their_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    source = spark.createDataFrame([(i, float(i % 9), float(i % 5)) for i in range(60)] + [(3, 1.0, 2.0), (None, 4.0, 4.0)], "id long, x double, y double")
    df = source.mapInArrow(count, source.schema)
    out = S.permutation_importance(df, lambda d: F.col("x"), lambda d: d.agg((-F.avg(F.abs(F.col("y") - F.col("y_pred")))).alias("score")), ["x", "y"], "id", 3)
    assert out.count() == 2 and read.value == 62
    # a repeated id meets the values of all its rows, a null id none
    assert S.permute_column(source, "x", "s", "id").groupBy("id").count().where("count > 1").collect() == [(3, 4)]
