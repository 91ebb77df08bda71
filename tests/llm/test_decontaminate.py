import random

import numpy as np
import pytest

from hourglass.llm import decontaminate as D
from hourglass.llm.textvec import hashed_shingles, hashed_words

RNG = random.Random(5)
VOCABULARY = ["w%03d" % i for i in range(400)]


def words(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, similarity double"),
            spark.createDataFrame(items, "item_id long, text string"))


def index_of(texts):
    hashes = [hashed_words([t])[0] for t in texts]
    weights = {int(s): 1.0 for h in hashes for s in hashed_shingles(h, min(5, len(h)))}
    return D.build_index(list(enumerate(hashes)), weights)


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(0)
    _, index = index_of([" ".join(words(40)) for _ in range(30)])
    (x,) = index.values()
    prints = np.concatenate([rng.integers(0, 2**63, 500).astype(np.uint64), x.prints.copy()])
    for k in range(len(prints) - 200, len(prints)):  # flip up to 16 bits
        for b in rng.choice(64, int(rng.integers(0, 17)), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(b)
    got = set(zip(*(a.tolist() for a in D.within_radius(prints, x)), strict=True))
    near = np.bitwise_count(prints[:, None] ^ x.prints[None, :]) <= D.RADIUS
    assert got == set(zip(*(a.tolist() for a in np.nonzero(near)), strict=True)) and len(got) > 100


def brute(docs, items):
    def cut(t):
        return hashed_words([t or ""])[0]

    sets = {}
    for i, t in set(items):
        h = cut(t)
        if len(h):
            sets[i, t] = (len(h), set(hashed_shingles(h, min(5, len(h))).tolist()))
    df = {}
    for _, s in sets.values():
        for x in s:
            df[x] = df.get(x, 0) + 1
    found = set()
    for d, t in docs:
        w = cut(t)
        for (i, _), (n, s) in sets.items():
            total, margin = sum(1 / df[x] for x in s), max(2, n // 8)
            for at in range(len(w) - n + 1):
                region = set(hashed_shingles(w[max(0, at - margin):at + n + margin], min(5, n)).tolist())
                if sum(1 / df[x] for x in s & region) >= D.SIMILARITY * total:
                    found.add((d, i))
                    break
    return found


def test_verbatim_and_edited_passages_match_brute_force(spark):
    items = [(i, " ".join(words(n))) for i, n in enumerate([1, 3, 4, 5, 7, 9, 12, 20, 33, 40, 59, 150])]
    items += [(20, items[8][1]), (21, ""), (22, None), (8, items[8][1])]
    docs = [(i, " ".join(words(200))) for i in range(5)] + [(50, None), (51, ""), (52, "?!")]
    for k, (_, t) in enumerate(items[3:12]):
        docs.append((100 + k, " ".join(words(RNG.randrange(40))) + "\n" + t.upper().replace(" ", ", ") + " ." + " ".join(words(30))))
    long = items[10][1].split()
    docs.append((200, " ".join(words(10) + long[:30] + ["new"] + long[31:] + words(10))))
    docs += [(201, items[9][1]), (201, items[9][1]), (None, items[9][1])]
    found = D.find_leaks(*frames(spark, docs, items)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == brute(docs, items)
    assert sum(r["doc_id"] == 201 and r["item_id"] == 9 for r in found) == 2  # repeated rows
    exact = [r for r in found if r["doc_id"] is not None and 103 <= r["doc_id"] < 109 and r["item_id"] < 20]
    assert exact and all(r["similarity"] == pytest.approx(1.0) and r["bits"] == 0 for r in exact)


def test_blocks_of_items_and_the_stage(spark, monkeypatch):
    items = [(i, " ".join(words(30))) for i in range(12)]
    docs = [(i, " ".join(words(50)) + " " + items[i][1]) for i in range(12)] + [(50 + i, " ".join(words(80))) for i in range(5)]
    d, b = frames(spark, docs, items)
    one = {(r[0], r["item_id"]) for r in D.find_leaks(d, b).collect()}
    monkeypatch.setattr(D.item_blocks, "__defaults__", ("item_id", "text", 100))
    assert {(r[0], r["item_id"]) for r in D.find_leaks(d, b).collect()} == one == {(i, i) for i in range(12)}
    kept = D.drop_leaks(d, b)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(50, 55))


def test_long_texts_cross_chunks(monkeypatch):
    monkeypatch.setattr(D, "CHUNK", 64)
    item = " ".join(words(40))
    items, index = index_of([item])
    for lead in range(0, 140, 7):
        hits = D.match_texts([" ".join(words(30)), " ".join(words(lead)) + " " + item + " " + " ".join(words(50))], items, index)
        assert [(t, i, round(s, 6), at) for t, i, s, at, _ in hits] == [(1, 0, 1.0, lead)]


def test_empty_sides(spark):
    d, b = frames(spark, [(1, "a b c d e f")], [(1, "x y z")])
    assert D.find_leaks(d.limit(0), b).collect() == [] and D.find_leaks(d, b.limit(0)).collect() == []
    assert D.drop_leaks(d, b.limit(0)).count() == 1


def changed(text, kind):
    """The passage without its head or tail, with words inserted, or with words replaced."""
    out, n = text.split(), len(text.split())
    if kind == "head":
        return " ".join(out[n // 5:])
    if kind == "tail":
        return " ".join(out[:-(n // 5)])
    for at in sorted(RNG.sample(range(2, n - 2), max(1, n // 33)), reverse=True):
        out[at:at + (kind == "edits")] = ["n%06d" % RNG.randrange(10**6)]
    return " ".join(out)


@pytest.mark.parametrize("kind", ["head", "tail", "inserted", "edits"])
def test_recall_of_the_fingerprints_on_changed_passages(kind):
    """Against the exact share of every window: nothing wrong is found, and at least nine in ten are."""
    items = [" ".join(words(n)) for n in (21, 33, 48, 69, 100) for _ in range(24)]
    kept, index = index_of(items)
    texts = [" ".join(words(RNG.randrange(150))) + " " + changed(t, kind) + " " + " ".join(words(150)) for t in items]
    expected = brute(list(enumerate(texts)), list(enumerate(items)))
    found = {(t, i) for t, i, *_ in D.match_texts(texts, kept, index)}
    print(kind, len(found & expected), len(expected))
    assert len(expected) > 80 and found <= expected and len(found) >= 0.9 * len(expected)


def test_windows_of_more_features_than_two_bytes_count():
    features = np.random.default_rng(2).integers(0, 2**63, 70_010).astype(np.uint64)
    got = D._fingerprints(D._bit_sums(features, 70_000), 5, 3, 70_000)
    for k, start in enumerate((0, 5, 10)):
        bits = np.unpackbits(features[start:start + 70_000].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
        assert np.packbits(bits > 35_000).view(np.uint64)[0] == got[k]


def test_text_item_ids_may_be_empty(spark):
    items = [("", "one two three four five six"), (None, "seven eight nine ten eleven"), ("b", "one two three four five six")]
    d, _ = frames(spark, [(1, "x one two three four five six seven eight nine ten eleven")], [(1, "")])
    b = spark.createDataFrame(items, "item_id string, text string")
    assert sorted(r["item_id"] or "-" for r in D.find_leaks(d, b).collect()) == ["-", "-", "b"]
