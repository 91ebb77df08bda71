import pytest
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators import codes as C
from hourglass.operators import static as I


def test_age_parsing(spark):
    df = spark.createDataFrame([("70",), ("> 89",), (None,), ("",)], "age string")
    filled = F.coalesce(F.nullif(F.col("age"), F.lit("")), F.lit("63"))
    out = df.select(H.age_int("age").alias("i"), H.contains_flag(filled, "> 89").alias("flag"),
                    H.age_float(filled).alias("f")).collect()
    assert [r.i for r in out] == [70, 89, None, None]
    assert [r.flag for r in out] == [0, 1, 0, 0]
    assert [r.f for r in out] == [70.0, 89.0, 63.0, 63.0]


def test_collapse_rare_and_one_hot(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "stay long, c string")
    col = I.collapse_rare(df, "c", min_count=2).orderBy("stay").collect()
    assert [r.c for r in col] == ["x", "x", "misc", None]
    oh = I.one_hot(I.collapse_rare(df, "c", 2), ["c"]).orderBy("stay").collect()
    assert [(r.c_misc, r.c_x) for r in oh] == [(0, 1), (0, 1), (1, 0), (0, 0)]


def test_standardise_sample_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "h double")
    out = [r.h for r in I.standardise(df, "h").collect()]
    assert out[:3] == pytest.approx([-1.0, 0.0, 1.0]) and out[3] is None


def _paths(spark, rows):
    return spark.createDataFrame(rows, "stay long, path string")


def test_pointless_counter_and_title_rules(spark):
    pairs = _paths(spark, [(1, "a|b"), (2, "a|c"), (3, "a|b|B")])
    _, smap = C.code_prefixes(pairs)
    out = {(r.code, r.reason) for r in C.pointless_codes(smap).collect()}
    # 'a|b' is passed by exactly two strings -> counter rule; 'a|b|B' repeats its parent's title
    assert ("a|b", "counter") in out
    assert ("a|b|B", "title_equals_parent") in out
    assert not any(code == "a" for code, _ in out)   # three strings pass through 'a'


def test_prefix_depth_quirk(spark):
    pairs = _paths(spark, [(1, "1|2|3|4|5|6"), (2, "1|2|3|4|5|6|7")])
    stay_codes, _ = C.code_prefixes(pairs)
    depth = {r.stay: max(len(r.code.split("|")) for r in stay_codes.collect() if r.stay == r.stay)
             for r in stay_codes.collect()}
    per = {}
    for r in stay_codes.collect():
        per.setdefault(r.stay, set()).add(len(r.code.split("|")))
    assert max(per[1]) == 6 and max(per[2]) == 5


def test_families_and_other(spark):
    pairs = _paths(spark, [
        (1, "admission diagnosis|All Diagnosis|Operative|x"),
        (1, "notes/Progress Notes/Past History/Organ Systems/Cardio/Hyper"),
        (2, "notes/Other/thing"),
    ])
    split = {r.path: (r.family, list(r.parts)) for r in C.split_codes(pairs).collect()}
    assert split["admission diagnosis|All Diagnosis|Operative|x"] == ("admission", ["Operative", "x"])
    assert split["notes/Progress Notes/Past History/Organ Systems/Cardio/Hyper"] == (
        "past_history_organ", ["Cardio", "Hyper"])
    assert "notes/Other/thing" not in split


def test_rare_cut_off_half_even(spark):
    # 250 stays -> round(2.5) = 2 (half to even): codes on <= 2 stays are rare
    pairs = _paths(spark, [(i, "common") for i in range(248)] + [(248, "rare"), (249, "rare")])
    sc, _ = C.code_prefixes(pairs)
    n = pairs.agg(F.count_distinct("stay").alias("n"))
    rare = {r.code: r.cut_off for r in C.rare_codes(sc, n, 0.01).collect()}
    assert rare == {"rare": 2}


def test_display_name_and_dilation(spark):
    from hourglass.operators.attribution import dilation_schedule, display_name

    df = spark.createDataFrame([("-eos",), ("lactate",), ("other",)], "feature string")
    out = [r.f for r in df.select(display_name("feature", {"-eos": "Eosinophils", "lactate": "Lactate"})
                                  .alias("f")).collect()]
    assert out == ["Eosinophils", "Lactate", "other"]
    assert dilation_schedule(4, 3) == [1, 2, 4, 6]


def test_only_child_rule(spark):
    pairs = _paths(spark, [(1, "a|b|c"), (2, "a|b|d"), (3, "x|y")])
    _, smap = C.code_prefixes(pairs)
    out = {r.code for r in C.pointless_codes(smap, rule="only_child").collect() if r.reason == "only_child"}
    # 'a' has one child ('a|b'), 'x' has one child ('x|y'); 'a|b' has two children
    assert out == {"a", "x"}


def test_fused_collapse_one_hot_equals_operators(spark):
    rows = [(i, ["a", "b", "c", None][i % 4] if i % 7 else "z", ["u", "v"][i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "stay long, c1 string, c2 string")
    fused = I.collapse_and_one_hot(df, ["c1", "c2"], min_count=8)
    ops = I.one_hot(I.collapse_rare(I.collapse_rare(df, "c1", 8), "c2", 8), ["c1", "c2"])
    assert sorted(fused.columns) == sorted(ops.columns)
    cols = sorted(fused.columns)
    assert sorted(tuple(r) for r in fused.select(cols).collect()) == sorted(tuple(r) for r in ops.select(cols).collect())


def test_single_stay_profile_wide(spark):
    from hourglass.operators.attribution import single_stay_profile

    rows = [(1, t, f, float(t), float(t) * (2 if f == "b" else 1)) for t in (1, 2) for f in ("a", "b", "c")]
    rows += [(2, 1, "a", 9.0, 9.0)]
    attr = spark.createDataFrame(rows, "stay long, time long, feature string, value double, attribution double")
    out = single_stay_profile(attr, 1, ["a", "b"]).orderBy("time").collect()
    assert [(r.time, r.a_value, r.a_attr, r.b_value, r.b_attr) for r in out] == [
        (1, 1.0, 1.0, 1.0, 2.0), (2, 2.0, 2.0, 2.0, 4.0)]
