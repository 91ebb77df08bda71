import numpy as np
import pytest

from hourglass.llm.textvec import code_points, hash_words, letters, word_runs
from hourglass.llm.toxicity import FEATURES, Lexicon, score, text_features, train

WORDS = "table chair window garden river music paper silver forest letter morning coffee".split()


def lexicon(*words):
    found = []
    for w in words:
        c = code_points(w)
        low, first, length, _ = word_runs(c, letters(c))
        found.append(hash_words(low, first, length)[0])
    return Lexicon(np.sort(np.array(found, dtype=np.uint64)), np.full(len(found), 3.0))


def one(text, lex):
    return dict(zip(FEATURES, text_features([text], lex)[0], strict=True))


def test_features_by_hand():
    lex = lexicon("idiot", "moron")
    f = one("You IDIOT! what a Moron, really", lex)
    assert f["hits_per_100"] == pytest.approx(100 * 2 / 6) and f["near_second_person"] == 1.0
    assert f["shouted_words"] == pytest.approx(1 / 6) and f["exclaims"] == pytest.approx(1 / 26)
    assert one("an id1ot here", lex)["veiled_hits"] == pytest.approx(100 / 4)
    assert one("an i.d.i.o.t", lex)["veiled_hits"] > 0 and one("i d i o t", lex)["spelled_out"] > 0
    assert not np.any(text_features(["", "  \n"], lex))


def test_features_do_not_depend_on_pieces(monkeypatch):
    texts = ["you moron " * 30, "", "calm words only " * 9, "id1ot x"]
    whole = text_features(texts, lexicon("moron", "idiot"))
    monkeypatch.setattr("hourglass.llm.textvec.PIECE", 40)
    cut = text_features(texts, lexicon("moron", "idiot"))
    assert np.allclose(whole[1:], cut[1:]) and whole.shape == (4, len(FEATURES))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    texts = []
    for i in range(900):
        n = int(rng.integers(3, 80))
        words = rng.choice(WORDS, n).tolist()
        if i % 5 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(0, n)), str(rng.choice(["idiot", "moron", "scum"])))
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in texts], "doc_id long, toxic int")
    return docs, labels


def test_learns_and_keeps_edge_rows(spark, corpus):
    docs, labels = corpus
    model = train(docs, labels)
    got = {r["doc_id"]: r for r in score(docs, model).collect()}
    right = np.mean([r["predicted"] == int(i % 5 == 0) for i, r in got.items()])
    assert len(got) == 900 and right > 0.97 and all(0 <= r["score"] <= 1 for r in got.values())
    rows = [(None, "you idiot moron", "clash"), (1, None, "x"), (1, "", "x"), (1, "", "x"), (2, "table " * 100_000, "x")]
    edge = score(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    assert len(edge) == 5 and [r["predicted"] for r in edge if r["doc_id"] is not None] == [0] * 4
    assert score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_without_two_classes(spark, corpus, toxic):
    docs = corpus[0].limit(50)
    rows = [] if toxic is None else [(i, toxic) for i in range(50)]
    model = train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    assert {r["score"] for r in score(docs, model).collect()} == {float(toxic or 0)}
