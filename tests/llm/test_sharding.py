import zlib

import numpy as np

from hourglass.llm.sharding import assign_shards, pack_units

SCHEMA = "doc_id long, text string, shard string, slot string"


def shards_of(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    return assign_shards(df, **kw).toPandas()


def test_invariants_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    texts = ["copy of one text " * 3] * 2000 + [None, "", "é"] + ["w" * int(n) + f" {i}" for i, n in enumerate(rng.lognormal(5, 1, 4000))]
    p = shards_of(spark, texts, shards=6, cell_rows=100)
    assert sorted(p["doc_id"]) == list(range(len(texts)))
    for r in p.sample(200, random_state=1).itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard is None or r.grown_shard != r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", True)
    sizes = p.groupby("shard")["size"].sum()
    assert len(sizes) == 6 and sizes.max() / sizes.mean() < 1.01 and sizes.min() / sizes.mean() > 0.99
    for _, s in p.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    split = p.groupby("text_crc32")["shard"].nunique()
    assert (split > 1).sum() == 1  # only the group that is larger than a shard's share


def test_small_groups_stay_whole(spark):
    texts = [f"text {i % 40}" for i in range(200)]
    p = shards_of(spark, texts, shards=4)
    assert p.groupby("text_crc32")["shard"].nunique().max() == 1


def test_packing_is_the_stated_rule():
    rng = np.random.default_rng(2)
    v = rng.random((50, 3))
    got, w = pack_units(v, 4, (1.0, 1.0, 1.0)), v * 4 / v.sum(axis=0)
    residual = np.ones((4, 3))
    for i in sorted(range(50), key=lambda i: (-w[i].max(), i)):
        assert got[i] == int(np.argmax(residual @ w[i]))
        residual[got[i]] -= w[i]


def test_empty_table_null_keys_and_repeated_rows(spark):
    assert assign_shards(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(None, "a", "", ""), (None, "b", "", ""), (1, "a", "", ""), (1, "a", "", "")], SCHEMA)
    p = assign_shards(df, shards=1).toPandas()
    assert sorted(p["slot"]) == [0, 1, 2, 3]
