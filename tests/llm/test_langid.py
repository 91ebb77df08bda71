import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.llm.common import crc_fold
from hourglass.llm.langid import Model, fit_and_identify, identify, label_words, op5_language_id, spans, train, viterbi
from tests.conftest import SF_SMALL

DE, EN = "der hund und die katze gehen über die straße", "the dog and the cat walk across the street"
RU = "собака и кошка идут через улицу"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, g) for i in range(40) for t, g in ((DE, "de"), (EN, "en"), (RU, "ru"))]
    return train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 6, 3)
        scores = rng.normal(size=(lengths.sum(), 3))
        got, at = viterbi(scores, lengths, 0.7), 0
        for n in lengths:
            value = lambda p: sum(scores[at + i, k] for i, k in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: B023
            best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
            assert abs(value(got[at:at + n].tolist()) - best) < 1e-9
            at += n


def test_mixed_text_has_spans(model):
    assert spans(" ".join([EN] * 3 + [DE] * 3), model) == [("en", 0, 27), ("de", 27, 27)]
    # the script alone decides for a word that no language has seen
    assert [s[0] for s in spans("щщщ жжж", model)] == ["ru"]


def test_pieces_do_not_change_labels(model, monkeypatch):
    texts = [EN * 3, "", DE + " " + EN, "123", RU * 2]
    whole = label_words(texts, model)
    monkeypatch.setattr("hourglass.llm.textvec.PIECE", 17)
    for a, b in zip(whole, label_words(texts, model), strict=True):
        assert a.tolist() == b.tolist()


def test_edge_cases(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 %% \n", "x"), (4, EN, "x"), (4, EN, "x"), (None, DE, "x"), (6, "汉字", "x"), (7, (EN + " ") * 20000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(df, model).collect()]
    assert [g[:2] for g in got if g[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert [g[1:] for g in got if g[0] == 4] == [("en", 1.0)] * 2 and (None, "de", 1.0) in got and (7, "en", 1.0) in got
    assert all(0 <= g[2] <= 1 for g in got)
    assert identify(df.limit(0), model).collect() == []
    blank = identify(df, Model([], np.zeros((1 << 17, 0), np.float32), np.zeros((18, 0), bool))).select("lang_pred").distinct().collect()
    assert [r[0] for r in blank] == ["und"]


def test_no_labelled_rows(spark):
    df = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    assert fit_and_identify(df).first()["lang_pred"] == "und"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    j = op5_language_id(spark, SF_SMALL).join(docs, "doc_id").where("held_out")
    right, n = j.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95


def test_fold_is_crc32_of_the_key(spark):
    import zlib

    got = {r[0]: r[1] for r in spark.range(50).select("id", crc_fold(F.col("id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}
