"""Every stage against its operator on the stage's own input, and the whole run."""

import corpus_pipeline
import pyarrow as pa
import pytest
import sentencepiece
from hourglass.llm import sentencepiece_codec as codec
from hourglass.llm import toxicity
from hourglass.llm.common import map_texts
from hourglass.llm.decontaminate import find_leaks
from hourglass.llm.jaccard_join import jaccard_components
from hourglass.llm.langid import UNDETERMINED, identify, train
from hourglass.llm.textvec import pieces
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import SF_SMALL
from tests.llm.helpers import components, jaccard_links

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stage_names_and_columns(spark, docs):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_jaccard", "decontamination", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns


def test_language_stage_rejects_only_texts_without_one(spark, docs):
    extra = spark.createDataFrame([(10**6, "123 !!", None, None, 6), (10**6 + 1, None, None, None, None)], docs.schema)
    kept = ids(STAGE["language_id"](spark, docs.union(extra), SF_SMALL))
    model = train(docs)
    assert kept == ids(identify(docs, model).where(f"lang_pred != '{UNDETERMINED}'")) and len(kept) == docs.count()


def test_jaccard_stage_keeps_one_of_each_group(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts)
    links = jaccard_links([texts[i] for i in order])
    of = components(range(len(order)), links)
    assert ids(STAGE["ngram_jaccard"](spark, docs, SF_SMALL)) == [i for k, i in enumerate(order) if of[k] == k]
    assert ids(jaccard_components(docs).where("doc_id = component_id")) == ids(STAGE["ngram_jaccard"](spark, docs, SF_SMALL))


def test_decontamination_stage_drops_leaks_only(spark, docs):
    leaks = {r["doc_id"] for r in find_leaks(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert leaks and ids(STAGE["decontamination"](spark, docs, SF_SMALL)) == [i for i in ids(docs) if i not in leaks]


def test_toxicity_stage_drops_what_the_operator_predicts(spark, docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    found = toxicity.score(docs, toxicity.train(docs, labels))
    assert ids(STAGE["toxicity"](spark, docs, SF_SMALL)) == ids(found.where("predicted = 0"))


def test_sentencepiece_stage_gives_the_ids_of_the_library(spark, docs):
    other = sentencepiece.SentencePieceProcessor(model_proto=codec.model_bytes(spark))
    got = {r["doc_id"]: r["ids"] for r in STAGE["sentencepiece"](spark, docs, SF_SMALL).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["doc_id"]] == (None if r["text"] is None else other.encode(r["text"]))


def test_stages_pass_clashing_columns_and_awkward_rows(spark, docs):
    """Columns named like those that the operators add, null and empty texts, null keys and repeated rows."""
    extra = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0), (10**6 + 1, "one two", None, None, 7),
                                   (10**6 + 1, "one two", None, None, 7)], docs.schema)
    wide = docs.limit(30).union(extra).selectExpr("*", "doc_id + 0.5 as score", "'l' as lang_pred", "'r' as _row", "7 as predicted",
                                                  "'s' as spans", "'t' as tid", "1 as n_links", "'x' as similarity", "2 as item_id")
    added = wide.columns[len(docs.columns):]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF_SMALL)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows, name
        for r in rows:
            assert [r[c] for c in added] == [None if r["doc_id"] is None else r["doc_id"] + 0.5, "l", "r", 7, "s", "t", 1, "x", 2]
        if name in ("toxicity", "decontamination"):
            assert sum(r["doc_id"] == 10**6 + 1 for r in rows) == 2
    ends = {r["doc_id"]: (r["ids"], r["n_tokens"]) for r in STAGE["sentencepiece"](spark, wide, SF_SMALL).collect()}
    assert ends[None] == (None, 0) and ends[10**6] == ([], 0)


def test_run_applies_the_stages_in_order(spark, docs):
    out = corpus_pipeline.run(spark, SF_SMALL)
    kept = ids(out)
    assert 0 < len(kept) < docs.count() and len(set(kept)) == len(kept)
    assert out.where("not round_trip").isEmpty() and set(out.columns) == {"doc_id", "lang", "source", "n_tokens", "ids", "round_trip"}


def test_stages_take_an_empty_table(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).collect() == []


def test_texts_are_worked_on_two_megabytes_at_a_time(spark):
    texts = ["x" * 1_500_000] * 3 + ["y" * 900_000] * 3 + ["z", None]

    def start():
        return lambda batch: (None, {"together": [sum(len(t or "") for t in batch)] * len(batch)})

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = map_texts(docs, "text", start, {"together": (T.LongType(), pa.int64())}).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == list(enumerate(texts))
    assert max(r["together"] for r in got) <= 1 << 21


def test_workers_hold_half_a_megabyte_of_short_texts_at_a_time(spark):
    def start():
        return lambda batch: (None, {"together": [sum(len(t or "") for t in batch)] * len(batch)})

    docs = spark.createDataFrame([(i, "ab " * 20_000) for i in range(60)], "doc_id long, text string").coalesce(1)
    got = map_texts(docs, "text", start, {"together": (T.LongType(), pa.int64())}).collect()
    assert len(got) == 60 and max(r["together"] for r in got) <= 1 << 19
    assert max(len(joined) for joined, _, _ in pieces(["ab " * 100] * 5000)) < 1 << 19


def test_texts_in_a_struct(spark):
    rows = [(1, "one"), (2, None), (3, ""), (4, "four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def start():
        return lambda batch: ([i for i, t in enumerate(batch) if t != ""], {"size": [len(t or "") for t in batch if t != ""]})

    whole = docs.coalesce(1).select(F.struct("doc_id", "text").alias("row"))
    got = map_texts(whole, "row.text", start, {"size": (T.LongType(), pa.int64())}).select("row.*", "size").collect()
    assert sorted(map(tuple, got)) == [(1, "one", 3), (2, None, 0), (4, "four", 4)]


def test_toxicity_sends_texts_once(spark, docs):
    named = docs.limit(300).withColumn("score", F.lit("s")).withColumn("_features", F.lit(1)).withColumn("_row", F.lit(2))
    kept = STAGE["toxicity"](spark, named, SF_SMALL)
    assert kept.columns == named.columns and kept.where("score != 's' or _features != 1 or _row != 2").isEmpty()
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert "_scored" not in plan and "MapInArrow" in plan
