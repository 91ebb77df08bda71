import tempfile

from pyspark.sql import functions as F

from hourglass.sources import io as A


def test_write_and_load_splits(spark):
    out = tempfile.mkdtemp(prefix="hg-io-", dir=None)
    df = spark.range(0, 30).select(F.col("id").alias("stay"),
                                   F.when(F.col("id") < 10, "train").when(F.col("id") < 20, "val")
                                   .otherwise("test").alias("split"))
    A.write_splits({"labels": df}, out)
    back = A.load_splits(spark, out, "labels", splits=("val",))
    assert sorted(r.stay for r in back.collect()) == list(range(10, 20))


def test_csv_roundtrip_with_schema(spark):
    out = tempfile.mkdtemp(prefix="hg-csv-")
    df = spark.range(0, 5).select(F.col("id").alias("stay"), (F.col("id") * 1.5).alias("v"))
    A.write_table(df, out + "/t", fmt="csv")
    back = A.scan_csv(spark, out + "/t", "stay long, v double")
    assert sorted((r.stay, r.v) for r in back.collect()) == [(i, i * 1.5) for i in range(5)]


def test_append_and_ids(spark):
    out = tempfile.mkdtemp(prefix="hg-app-")
    df = spark.range(0, 3).select(F.col("id").alias("stay"))
    A.write_table(df, out + "/t")
    A.append_table(df, out + "/t")
    assert spark.read.parquet(out + "/t").count() == 6
    ids = A.write_ids(spark.read.parquet(out + "/t"), out + "/ids")
    assert sorted(r.stay for r in ids.collect()) == [0, 1, 2]
    assert sorted(r.stay for r in A.read_ids(spark, out + "/ids").collect()) == [0, 1, 2]


def test_union_splits_tags_and_fills(spark):
    a = spark.createDataFrame([(1, 0.5)], "stay long, v double")
    b = spark.createDataFrame([(2, "x")], "stay long, w string")
    rows = sorted((r["split"], r["stay"], r["v"], r["w"]) for r in A.union_splits({"train": a, "test": b}).collect())
    assert rows == [("test", 2, None, "x"), ("train", 1, 0.5, None)]


def test_named_result_checkpoints(spark):
    df = spark.range(0, 10)
    res = A.named_result(df, "ten")
    assert spark.sql("select count(*) from ten").first()[0] == 10
    assert res.count() == 10


def test_feature_names():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(1, 1, 0.0, 1.0, 0.5)], "stay long, time long, a double, a_mask double, hour double")
    assert A.feature_names(df) == ["a"] and A.n_features(df) == 1


def test_write_predictions_appends(spark):
    out = tempfile.mkdtemp(prefix="hg-pred-")
    pred = spark.createDataFrame([(1.0, 2.0)], "y_pred double, y_true double")
    row = spark.createDataFrame([("run1", 0.5)], "run string, msle double")
    A.write_predictions(pred, row, out)
    A.write_predictions(pred, row, out)
    assert spark.read.parquet(out + "/predictions").count() == 2
    assert spark.read.parquet(out + "/results").count() == 2


def test_suffix_columns(spark):
    from hourglass.operators.filters import suffix_columns

    df = spark.createDataFrame([(1, 0.5)], "stay long, a double")
    assert suffix_columns(df, ["a"], "_mask").columns == ["stay", "a_mask"]


def test_projection_rename_drop_union(spark):
    from hourglass.operators import filters as B

    a = spark.createDataFrame([(1, "x", 0.5)], "patientunitstayid long, c string, v double")
    b = spark.createDataFrame([(2, "y")], "stay long, c string")
    r = B.rename(B.drop_columns(B.project(a, ["patientunitstayid", "c", "v"]), ["v"]),
                 {"patientunitstayid": "stay"})
    assert r.columns == ["stay", "c"]
    u = B.union_all([r.withColumn("v", F.lit(0.5)), b])
    assert sorted((x.stay, x.v) for x in u.collect()) == [(1, 0.5), (2, None)]
    assert B.union_distinct([r, r, b]).count() == 2
