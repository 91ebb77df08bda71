"""Byte-level BPE against the tiktoken library and against merging pair by pair."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from hourglass.llm.byte_bpe import Encoder, Merges, Replay, Splitter, class_repairs, decode, decoder, encode, op13_byte_bpe, read_ranks
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS

RANKS = read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
EDGES = [None, "", " ", "\n\n  \t x", "mmmmmmmmmmmmmmmmmm" * 400, "51" * 3000, "Über straße naïve", "don't we'll  go  ",
         "\U00016ea7a1\U0003d167\U0003d1671", "漢字かな交じり文", "a\x00b\x1c\x1dc\x85d　e", "<|endoftext|>", "word " * 30000,
         "\U0001f600\U0001f600 emoji‍", "٣٤٥ ½ Ⅷ"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def lowest_first(ranks, word):
    """One merge at a time: the lowest pair, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == 1 << 40:
            break
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def test_replay_equals_merging_pair_by_pair():
    draw = random.Random(5)
    words = [bytes(draw.choice(b"abmnopt 51\xc3\xa9") for _ in range(draw.randint(1, 40))) for _ in range(3000)]
    words += [b"m" * k for k in range(1, 40)] + [b"placplacplacethirds" * 3, b" berty51515151"]
    words = [w for w in words if w not in RANKS]
    ids, counts = Replay(Merges(RANKS), words).run()
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [lowest_first(RANKS, w) for w in words]


def test_small_vocabularies_where_longer_tokens_come_earlier():
    """Random vocabularies in which a merge often brings a lower pair beside it."""
    draw = random.Random(11)
    for _ in range(60):
        tokens = {bytes(draw.choice(b"ab") for _ in range(draw.randint(2, 5))) for _ in range(10)}
        order = sorted(tokens)
        draw.shuffle(order)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(order)}
        words = [bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 24))) for _ in range(60)]
        words = [w for w in words if w not in ranks]
        ids, counts = Replay(Merges(ranks), words).run()
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [lowest_first(ranks, w) for w in words]


def test_split_follows_the_classes_of_tiktoken(reference):
    repairs = class_repairs(P.PATTERN)
    encoder = Encoder(Merges(RANKS), Splitter(P.PATTERN, repairs))
    draw = random.Random(3)
    odd = draw.sample(sorted(repairs), min(300, len(repairs)))
    points = odd + draw.sample([p for p in range(0x110000) if not 0xD800 <= p < 0xE000], 3000)
    texts = [f"a{chr(p)}1{chr(p)}{chr(p)}a {chr(p)}" for p in points]
    assert [x.tolist() for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_a_cache_that_is_emptied_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr("hourglass.llm.byte_bpe.WORD_BYTES", 10)
    encoder = Encoder(Merges(RANKS), Splitter(P.PATTERN, {}))
    for texts in (["one two three", "two"], ["three four"], [""], ["one one"]):
        assert [x.tolist() for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_edges_and_other_columns(spark, reference):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(EDGES)] + [(1, "twice", None, None, 2)] * 2
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as ids", "'x' as n_tokens", "'y' as decoded")
    out = decode(encode(docs, RANKS, P.PATTERN), RANKS)
    assert sorted(out.columns) == sorted([*docs.columns])
    got = [(r.doc_id, r.n_tokens, r.ids, bytes(r.decoded)) for r in out.collect()]
    want = [(i, len(x := reference.encode_ordinary(t or "")), x, (t or "").encode()) for i, t, *_ in rows]
    assert sorted(got) == sorted(want)


def test_empty_table(spark):
    assert encode(spark.createDataFrame([], DOCS), RANKS, P.PATTERN).collect() == []


def test_unknown_ids_raise():
    with pytest.raises(KeyError):
        decoder(RANKS)([60000])


def test_query_equals_the_library_on_every_document(spark, reference):
    import duckdb

    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    want = []
    for i, t in texts:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, op13_byte_bpe(spark, SF_SMALL).collect())) == sorted(want)
