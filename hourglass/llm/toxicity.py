"""Operator 4: toxicity by gradient-boosted trees over dense features, calibrated isotonically.

Features of a whole text: densities of a learned lexicon (words and word stems that labelled toxic
texts use far more often), nearness of lexicon words to second-person words, rates of capitals, of
punctuation and of obfuscation (symbols and digits within words, lexicon words found only after
undoing them, spelled-out words).  Labels are never features.

Training reads a bounded, documented sample (about ``SAMPLE`` labelled rows, by the hash of the key,
whole texts) outside fold 0 of crc32(key) mod 5: folds 1 and 2 teach the lexicon, fold 3 the trees
(Spark ML's GBTClassifier), fold 4 the isotonic calibration, so no stage is fitted on rows that the
one before has seen.  Features are computed in numpy on batches of whole texts and scored by Spark
ML; no document is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import checkpoint, crc_fold, map_texts
from hourglass.llm.textvec import MIX, P, code_points, hash_words, letters, lower, pieces, word_runs

#: Labelled rows that the training sample holds in expectation.
SAMPLE = 20_000
#: Lexicon entries kept, least toxic texts with an entry, least log odds.
LEXICON, LEAST_TEXTS, LEAST_ODDS = 20_000, 4, 2.5
#: Lengths of word stems.
STEMS = (4, 5, 6)
NEAR = 5
SECOND_PERSON = ("you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer "
                 "tu te toi ton ta tes vous votre vos ti tú tus usted ustedes vosotros vuestro").split()
#: Digits and symbols read as letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
FEATURES = ("log_words", "hits_per_100", "log_hits", "weight_per_100", "mean_weight", "near_second_person", "second_person_per_100",
            "capitals", "shouted_words", "punctuation", "exclaims", "repeats", "inner_symbols", "veiled_hits", "spelled_out")


@dataclass
class Lexicon:
    hashes: np.ndarray  # sorted uint64
    weights: np.ndarray  # log odds


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None  # None: one class at most was labelled
    calibration: IsotonicRegressionModel | None
    prior: float


def _hash_stems(c: np.ndarray, first: np.ndarray, length: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the first ``k`` letters, 0 for words that are not longer."""
    h = np.full(len(first), k, dtype=np.uint64)
    for j in range(k):
        h = (h + c[np.minimum(first + j, len(c) - 1)]) * P
    h = (h ^ (h >> np.uint64(29))) * MIX
    return np.where(length > k, h, np.uint64(0))


def _keys(c: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Keys x words: the whole word and its stems (0: none)."""
    return np.stack([hash_words(c, first, length), *[_hash_stems(c, first, length, k) for k in STEMS]])


SECOND = np.sort(np.concatenate([hash_words(code_points(w), np.array([0]), np.array([len(w)])) for w in SECOND_PERSON]))


def _look_up(keys: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Weight of each word: the largest among its keys, 0 where none is in the lexicon."""
    out = np.zeros(keys.shape[1])
    if not len(lexicon.hashes):
        return out
    table = np.zeros(1 << 20, dtype=bool)
    table[(lexicon.hashes >> np.uint64(44)).astype(np.int64)] = True
    for k in keys:
        maybe = np.flatnonzero(table[(k >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(lexicon.hashes, k[maybe]), len(lexicon.hashes) - 1)
        same = lexicon.hashes[at] == k[maybe]
        np.maximum.at(out, maybe[same], lexicon.weights[at[same]])
    return out


LEET_TABLE = np.arange(128, dtype=np.uint32)
LEET_TABLE[[ord(k) for k in LEET]] = [ord(v) for v in LEET.values()]


def _sums(c: np.ndarray, starts: np.ndarray, owners: np.ndarray, n: int, lexicon: Lexicon) -> np.ndarray:
    """Counts per text (rows of the result) that add up over the pieces of a text."""
    out = np.zeros((14, n))
    part = lambda pos: owners[np.searchsorted(starts, pos, side="right") - 1]
    whose = np.repeat(owners, np.diff(np.append(starts, len(c))))
    count = lambda row, mask: out.__setitem__(row, out[row] + np.bincount(whose[mask], minlength=n))
    letter = letters(c)
    upper = ((c >= 65) & (c <= 90)) | ((c >= 0xC0) & (c <= 0xDE) & (c != 0xD7))
    blank = (c <= 32) | (c == 0xA0)
    symbol = ~letter & ~blank
    digit = (c >= 48) & (c <= 57)
    count(0, ~blank), count(1, letter), count(2, upper), count(3, symbol & ~digit)
    count(4, (c == 33) | (c == 63))
    if len(c) > 2:
        same = np.zeros(len(c), dtype=bool)
        same[2:] = (c[2:] == c[1:-1]) & (c[1:-1] == c[:-2]) & ~blank[2:]
        count(5, same)
        inner = np.zeros(len(c), dtype=bool)
        inner[1:-1] = letter[:-2] & symbol[1:-1] & letter[2:] & (c[1:-1] != 39) & (c[1:-1] != 45) & (c[1:-1] != 0x2019)
        count(6, inner)
    else:
        inner = np.zeros(len(c), dtype=bool)
    low, first, length, at = word_runs(c, letter)
    if not len(first):
        return out
    own = part(at)
    add = lambda row, words, w=None: out.__setitem__(row, out[row] + np.bincount(own[words], weights=w, minlength=n))
    keys = _keys(low, first, length)
    weight = _look_up(keys, lexicon)
    hit = np.flatnonzero(weight)
    second = np.flatnonzero(np.isin(keys[0], SECOND))
    add(7, slice(None)), add(8, hit), add(9, hit, weight[hit]), add(10, second)
    caps = np.add.reduceat(upper[letter].astype(np.int64), first)
    add(11, (caps == length) & (length > 2))
    if len(second) and len(hit):
        i = np.searchsorted(second, hit)
        left, right = second[np.maximum(i - 1, 0)], second[np.minimum(i, len(second) - 1)]
        near = ((np.abs(hit - left) <= NEAR) & (own[hit] == own[left])) | ((np.abs(right - hit) <= NEAR) & (own[hit] == own[right]))
        add(12, hit[near])
    # spelled-out words: a letter alone between two letters alone
    single = np.zeros(len(first), dtype=bool)
    single[1:-1] = (length[:-2] == 1) & (length[1:-1] == 1) & (length[2:] == 1)
    add(13, single)
    if inner.any():
        veiled = _veiled(c, blank, letter, inner, lexicon)
        out = np.vstack([out, np.bincount(part(veiled), minlength=n)])
        return out
    return np.vstack([out, np.zeros(n)])


def _veiled(c: np.ndarray, blank: np.ndarray, letter: np.ndarray, inner: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Positions of chunks with symbols between letters that hold a lexicon word once these are undone."""
    begins = ~blank
    begins[1:] &= blank[:-1]
    chunk = np.cumsum(begins)
    mine = np.isin(chunk, np.unique(chunk[inner])) & ~blank
    plain = c[mine].copy()
    ascii_ = plain < 128
    plain[ascii_] = LEET_TABLE[plain[ascii_]]
    keep = letters(plain)
    plain, ids, pos = lower(plain[keep]), chunk[mine][keep], np.flatnonzero(mine)[keep]
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    if not len(first):
        return first
    weight = _look_up(_keys(plain, first, np.diff(np.append(first, len(plain)))), lexicon)
    # a plain lexicon word at the chunk's beginning counts as a plain hit already
    return pos[first[weight > 0]]


def text_features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Texts x FEATURES; empty texts are all zero."""
    n = len(texts)
    s = np.zeros((15, n))
    for joined, starts, owners in pieces(texts):
        x = _sums(code_points(joined), starts, owners, n, lexicon)
        s[:len(x)] += x
    marks, alphabetic, words = np.maximum(s[0], 1), np.maximum(s[1], 1), np.maximum(s[7], 1)
    hits = np.maximum(s[8], 1)
    return np.stack([np.log1p(s[7]), 100 * s[8] / words, np.log1p(s[8]), 100 * s[9] / words, s[9] / hits, s[12] / hits,
                     100 * s[10] / words, s[2] / alphabetic, s[11] / words, s[3] / marks, s[4] / marks, s[5] / marks,
                     s[6] / words, 100 * s[14] / words, s[13] / words], axis=1)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words and stems in ``LEAST_TEXTS`` or more toxic texts whose log odds reach ``LEAST_ODDS``."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for toxic, texts in frame.groupby("_toxic")["_text"]:
                found = []
                for t in texts:
                    c = code_points(t)
                    low, first, length, _ = word_runs(c, letters(c))
                    if len(first):
                        found.append(np.unique(_keys(low, first, length)))
                if found:
                    h, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"h": h[h != 0].astype(np.int64), "toxic": int(toxic), "n": n[h != 0]})

    totals = {r["_toxic"]: r["count"] for r in sample.groupBy("_toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    counts = (sample.select("_text", "_toxic").mapInPandas(count, "h long, toxic int, n long").groupBy("h")
                    .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("pos"),
                         F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("neg")))
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1.0)) - F.log((F.col("neg") + 0.5) / (n0 + 1.0))
    top = (counts.where(F.col("pos") >= LEAST_TEXTS).withColumn("w", odds).where(F.col("w") >= LEAST_ODDS)
                 .orderBy(F.desc("w"), F.desc("pos"), "h").limit(LEXICON).toPandas())
    h = top["h"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(h)
    return Lexicon(h[order], top["w"].to_numpy(float)[order])


def with_features(docs: DataFrame, lexicon: Lexicon, text: str, name: str = "_features") -> DataFrame:
    """All columns but ``text``, and the features as an array."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.hashes, lexicon.weights))  # LEXICON entries at most

    def start():
        own = Lexicon(*shared.value)
        return lambda texts: (None, {name: list(text_features([t or "" for t in texts], own))})

    return map_texts(docs, text, start, {name: (T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))}, drop=(text,))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          rows: int = SAMPLE, seed: int = 5) -> ToxicityModel:
    """Learn from labelled rows outside fold 0.  A key labelled twice counts as toxic if any label says so."""
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (crc_fold(F.col(key)) != 0))
                   .groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_toxic")))
    n = known.count()
    draw = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = known.where(draw < min(1.0, rows / max(n, 1)))
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # the sample's keys are about `rows` by construction
    sample = checkpoint(texts.join(F.broadcast(chosen), "_key").withColumn("_fold", crc_fold(F.col("_key"))))
    lexicon = learn_lexicon(sample.where(F.col("_fold").isin(1, 2)))
    f = checkpoint(with_features(sample, lexicon, "_text").select(
        "_fold", F.col("_toxic").cast("double").alias("label"), array_to_vector("_features").alias("features")).repartition(8))
    by = {(r["_fold"], r["label"]): r["count"] for r in f.groupBy("_fold", "label").count().collect()}
    total = sum(by.values())
    prior = sum(c for (_, y), c in by.items() if y == 1.0) / total if total else 0.0
    if not (by.get((3, 0.0)) and by.get((3, 1.0)) and by.get((4, 0.0)) and by.get((4, 1.0))):
        return ToxicityModel(lexicon, None, None, prior)
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=seed).fit(f.where(F.col("_fold") == 3))
    margins = trees.transform(f.where(F.col("_fold") == 4)).select("label", _margin().alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins.withColumn("weight", F.lit(1.0)))
    return ToxicityModel(lexicon, trees, calibration, prior)


def _margin():
    return vector_to_array("rawPrediction").getItem(1)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts are scored like any text without words; without two classes in the
    training rows every score is the share of toxic ones (0 without labels).  Columns named
    ``score`` or ``predicted`` are replaced; repeated rows each get their score.
    """
    d = docs.drop("score", "predicted")
    if model.trees is None:
        out = d.drop(text).withColumn("score", F.lit(float(model.prior)))
    else:
        names = d.drop(text).columns
        x = with_features(d, model.lexicon, text).withColumn("_x", array_to_vector("_features"))
        x = model.trees.copy().setFeaturesCol("_x").transform(x)
        x = model.calibration.transform(x.withColumn("margin", _margin()).drop("prediction"))
        out = x.select(*names, F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted toxic go.

    Null and empty texts are scored like texts without words; repeated rows share their fate; all columns
    pass through, whatever their names; an empty table, or one without two classes of labels, keeps
    what scores below one half.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # rows go whole, as one column, and are scored by a field of it, so no text is sent twice
    found = score(docs.select(F.struct(*docs.columns).alias("_row")), model, "_row.text")
    return found.where(F.col("predicted") == 0).select("_row.*")
