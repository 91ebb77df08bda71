import random
import struct

import pytest
import sentencepiece

from hourglass.llm import sentencepiece_codec as S
from tests.conftest import SF_SMALL

TEXTS = ["", " ", "  ", "a", " a", "  a b   c  ", "▁a ▁▁b", "a▁b", "\n\n x\t y", "日本語 テスト 🎉 \x00 x", "<s> </s> <unk> <0x41>", "1234 5678",
         "é́ ̈", "a b", "▁", "hello" * 200, "𝔘𝔫𝔦", "The quick brown fox"]


@pytest.fixture(scope="module")
def model():
    with open(S.MODEL_FILE, "rb") as f:
        return f.read()


def test_ids_and_text_equal_the_reference_library(model):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(" ▁ab\né日🎉1<>s/0x") for _ in range(rng.randrange(40))) for _ in range(1500)]
    ours, other = S.Encoder(S.parse_model(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = [i.tolist() for i in ours.encode(texts)]
    assert ids == other.encode(texts)
    assert ours.tokenizer.decode_batch(ids, skip_special_tokens=False) == other.decode(ids)
    assert [ours.text(i) for i in ours.encode(texts)] == other.decode(ids)


def test_batches_change_nothing(model):
    ours = S.Encoder(S.parse_model(model))
    texts = ["a b c d e f", "b b a", "g h\ni j", ""]
    first = [i.tolist() for i in ours.encode(texts)]
    assert [i.tolist() for t in texts for i in ours.encode([t])] == first == [i.tolist() for i in ours.encode(texts)]


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 0x7F
        out += bytes([low | (0x80 if n else 0)])
        if not n:
            return out


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, bytes):
            out += varint(number << 3 | 2) + varint(len(value)) + value
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3) + varint(value)
    return out


def unigram(dummy=1, fold=1, fallback=1):
    pieces = [("<unk>", 0.0, S.UNKNOWN), ("<s>", 0.0, S.CONTROL), ("</s>", 0.0, S.CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, S.BYTE) for b in range(256)] if fallback else []
    pieces += [(p, s, S.NORMAL) for p, s in (("▁", -2.0), ("a", -3.0), ("b", -3.5), ("c", -4.0), ("▁a", -2.5), ("ab", -3.2), ("bc", -3.9),
                                             ("abc", -6.0), ("▁ab", -4.4), ("é", -5.0), ("d", -7.5))]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, kind)))) for p, s, kind in pieces)
    trainer = message((3, S.UNIGRAM), (4, len(pieces)), (35, fallback))
    return body + message((2, trainer)) + message((3, message((1, b"identity"), (3, dummy), (4, fold), (5, 1))))


@pytest.mark.parametrize(("dummy", "fold", "fallback"), [(1, 1, 1), (1, 0, 1), (0, 0, 1), (0, 1, 1)])
def test_unigram_models(dummy, fold, fallback):
    data = unigram(dummy, fold, fallback)
    ours, other = S.Encoder(S.parse_model(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["", "a", "abc ab", "  a  bc  ", "é日 abc", "abcabcab d", "aab bca", " ", "a b c d ab bc abc"]
    assert [i.tolist() for i in ours.encode(texts)] == other.encode(texts)


def test_encode_and_decode_frames(spark, model):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (5, "a b", "x"), (5, "a b", "x"), (6, "word " * 200_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = S.encode(df, model).collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    assert [(r["ids"], r["n_tokens"]) for r in got if r["text"] is None] == [(None, 0)]
    assert [r["n_tokens"] for r in got if r["text"] == ""] == [0]
    back = S.decode(S.encode(df, model), model).collect()
    assert all(r["decoded"] == r["text"] or "▁" in r["text"] for r in back)
    assert S.encode(df.limit(0), model).collect() == []


def test_parity_over_the_whole_small_table(spark, model):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = S.encode(docs, model, parity=1).collect()  # raises on any difference
    assert len(got) == docs.count() and all(r["round_trip"] for r in got)


def test_a_wrong_model_is_refused():
    with pytest.raises(ValueError, match="neither"):
        S.parse_model(message((2, message((3, 3)))))
