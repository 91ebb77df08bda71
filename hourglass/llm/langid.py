"""Operator 5: language identification with Viterbi spans for mixed-language text.

Every word is scored under each learned language by its character trigrams (word boundaries
included); the script of the word leaves only the languages that use that script; Viterbi over the
words of a text with a penalty for switching labels spans of one language each.  A document's
language is the one with most letters in its spans.

Training reads a bounded, documented sample: rows are kept by the hash of their key so that about
``per_lang`` labelled rows of each language are expected; whole texts, counted in tasks and summed
by Spark.  The model (one score per trigram bucket and language) goes to the tasks with the
function; its size is fixed by ``BUCKETS`` and the number of languages.  Scoring and Viterbi run
over all words of a batch of texts at once in numpy; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import crc_fold, map_texts
from hourglass.llm.textvec import pieces

UNDETERMINED = "und"
BUCKETS = 1 << 17
#: Bytes of text labelled at a time; texts advance together, so smaller slices take more steps.
SLICE_BYTES = 1 << 21
#: Labelled rows per language that the training sample holds in expectation.
PER_LANG = 1500
#: Log-probability that a change of language costs.
SWITCH = 8.0
#: Score of a word under a language that does not use its script.
WRONG_SCRIPT = -60.0
#: The pipeline keeps documents with this share of letters in their language.
LEAST_SHARE = 0.3
#: First code points of script ranges (0: other letters), from Unicode's block table.
SCRIPTS = ((0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0),
           (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0B80, 10), (0x0C00, 11), (0x0E00, 12), (0x0E80, 0),
           (0x10A0, 13), (0x1100, 14), (0x1200, 15), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
           (0x3040, 16), (0x3100, 0), (0x3400, 17), (0xA000, 0), (0xAC00, 14), (0xD800, 0), (0xF900, 17),
           (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFF21, 1), (0xFF66, 16), (0xFFA0, 0),
           (0x20000, 17), (0x32000, 0))
N_SCRIPTS = 18


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # BUCKETS x languages: log-probabilities, centred per bucket
    uses: np.ndarray  # scripts x languages: whether the language uses the script


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all letters; of each word the index of its first letter, script, number
    of letters and character position."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    present = np.flatnonzero(np.bincount(c)) if len(c) else np.zeros(1, dtype=np.int64)
    letter = np.zeros(int(present[-1]) + 1, dtype=bool)
    letter[present] = [chr(x).isalpha() for x in present]
    is_letter = letter[c]
    # 0 stands for a run of other characters, before and after every word
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    s = np.concatenate([[0], np.where(is_letter, c, 0)[keep], [0]]).astype(np.uint64)
    at = np.flatnonzero(s)
    h = (s[at - 1] * np.uint64(0x9E3779B97F4A7C15) + s[at] * np.uint64(0xC2B2AE3D27D4EB4F)
         + s[at + 1] * np.uint64(0x165667B19E3779F9))
    buckets = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKETS.bit_length() + 1))
    first = np.flatnonzero(s[at - 1] == 0)
    begins, ids = np.array(SCRIPTS).T
    script = ids[np.searchsorted(begins, s[at[first]].astype(np.int64), side="right") - 1]
    where = np.flatnonzero(is_letter)[first]
    return buckets.astype(np.int64), first, script, np.diff(np.append(first, len(at))), where


def _scored(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores (words x languages), letters and owning text of all words of the texts."""
    found = [(np.empty((0, len(model.langs)), dtype=np.float32), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))]
    barred = np.where(model.uses, 0.0, WRONG_SCRIPT).astype(np.float32)
    silent = ~model.uses.any(axis=1)  # scripts of no learned language say nothing
    for text, starts, owners in pieces(texts):
        buckets, first, script, letters, where = _words(text)
        if len(first):
            scores = np.add.reduceat(model.table[buckets], first, axis=0) + barred[script]
            scores[silent[script]] = 0.0
            found.append((scores, letters, owners[np.searchsorted(starts, where, side="right") - 1]))
    scores, letters, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    return scores, letters, owner


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word; words of the same text stand together, texts in order.

    All texts advance together, longest first, so a step is one numpy operation over those that
    still have words.  Ties keep the language, then take the first.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
    n = scores.shape[1]
    state = np.zeros((len(sizes), n), dtype=np.float64)
    own = np.arange(n, dtype=np.uint8)
    back = np.empty((len(scores), n), dtype=np.uint8)
    for t in range(steps):
        a = active[t]
        s = state[:a]
        best = s.max(axis=1, keepdims=True) - switch
        at = starts[:a] + t
        back[at] = np.where(s >= best, own, s.argmax(axis=1)[:, None])
        np.maximum(s, best, out=s)
        s += scores[at]
    label, out = state.argmax(axis=1), np.empty(len(scores), dtype=np.uint8)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        out[at] = label[:a]
        label[:a] = back[at, label[:a]]
    return out


def label_words(texts: list[str], model: Model, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(language index, letters, owner)`` of every word of the texts."""
    scores, letters, owner = _scored([t.lower() for t in texts], model)
    labels = np.empty(len(scores), dtype=np.uint8)
    if len(scores):
        lengths = np.bincount(owner, minlength=len(texts))
        labels = viterbi(scores, lengths[lengths > 0], switch)
    return labels, letters, owner


def spans(text: str, model: Model, switch: float = SWITCH) -> list[tuple[str, int, int]]:
    """``(language, first word, words)`` of the spans of one text."""
    labels = label_words([text], model, switch)[0]
    cuts = np.flatnonzero(np.diff(labels)) + 1 if len(labels) else []
    ends = [0, *cuts, len(labels)]
    return [(model.langs[labels[a]], int(a), int(b - a)) for a, b in zip(ends, ends[1:], strict=False) if b > a]


def predict(texts: list[str], model: Model, switch: float = SWITCH) -> tuple[list[str], list[float], list[str]]:
    """Language with most letters, its share of all letters, and the spans as ``lang:words`` in order."""
    langs, shares, marks = [], [], []
    if not model.langs:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), [""] * len(texts)
    labels, letters, owner = label_words(texts, model, switch)
    sums = np.zeros((len(texts), len(model.langs)))
    np.add.at(sums, (owner, labels), letters)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    changes = np.flatnonzero((np.diff(labels) != 0) & (np.diff(owner) == 0)) + 1 if len(labels) else np.empty(0, int)
    for i in range(len(texts)):
        total = sums[i].sum()
        if total == 0:
            langs.append(UNDETERMINED), shares.append(0.0), marks.append("")
            continue
        best = int(sums[i].argmax())
        langs.append(model.langs[best])
        shares.append(float(sums[i, best] / total))
        a, b = np.searchsorted(changes, [ends[i] + 1, ends[i + 1]])
        cuts = [ends[i], *changes[a:b], ends[i + 1]]
        marks.append(" ".join(f"{model.langs[labels[x]]}:{y - x}" for x, y in zip(cuts, cuts[1:], strict=False)))
    return langs, shares, marks


def _batches(texts: list, langs: int, cells: int = 1 << 22) -> Iterator[list[str]]:
    """Runs of texts whose scores fit in ``cells`` numbers (a longer text stands alone)."""
    part, size = [], 0
    for t in texts:
        t = t or ""
        if part and size + len(t) * langs // 4 > cells:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t) * langs // 4
    if part:
        yield part


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_lang: int = PER_LANG, train_rows: Column | None = None) -> Model:
    """Learn from rows with a language; ``train_rows`` restricts them further."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if train_rows is not None:
        labelled = labelled.where(train_rows)
    labelled = labelled.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    sizes = {r["_lang"]: r["count"] for r in labelled.groupBy("_lang").count().collect()}
    langs = sorted(sizes)
    if len(langs) > 255:
        raise ValueError(f"{len(langs)} language values; a byte numbers them")
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    rate = F.element_at(F.create_map(*[F.lit(x) for g in langs for x in (g, min(1.0, per_lang / sizes[g]))]), F.col("_lang"))
    draw = F.pmod(F.xxhash64("_key", F.lit(11)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = labelled.where(draw < rate)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for g, texts in frame.groupby("_lang")["_text"]:
                total = np.zeros(BUCKETS + N_SCRIPTS, dtype=np.int64)
                for joined, _, _ in pieces([t.lower() for t in texts]):
                    buckets, _, script, letters, _ = _words(joined)
                    total[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(script, weights=letters, minlength=N_SCRIPTS).astype(np.int64)
                at = np.flatnonzero(total)
                yield pd.DataFrame({"lang": g, "slot": at, "n": total[at]})

    # at most languages x (buckets + scripts) rows
    rows = (sample.select("_lang", "_text").mapInPandas(count, "lang string, slot int, n long")
                  .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    counts[rows["slot"].to_numpy(int), rows["lang"].map({g: i for i, g in enumerate(langs)}).to_numpy(int)] = rows["n"]
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    seen = max(1, int((grams.sum(axis=1) > 0).sum()))
    logp = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * seen))
    logp -= logp.mean(axis=1, keepdims=True)
    uses = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, logp.astype(np.float32), uses & (scripts > 0))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
             switch: float = SWITCH) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score`` and ``spans`` (replacing columns so named).

    A null text, or one without a letter, is ``und`` with score 0 and no spans; so is every text if
    nothing was learned.  A word in a script of no learned language takes the language of its
    neighbours.  Repeated rows each get their row.
    """
    spark = docs.sparkSession
    # BUCKETS x languages floats
    shared = spark.sparkContext.broadcast((model.langs, model.table, model.uses))

    def start():
        m = Model(*shared.value)

        def run(texts: list) -> tuple[None, dict[str, list]]:
            new: dict[str, list] = {"lang_pred": [], "score": [], "spans": []}
            for part in _batches(texts, max(1, len(m.langs))):
                for out, x in zip(new.values(), predict(part, m, switch), strict=True):
                    out.extend(x)
            return None, new

        return run

    return map_texts(docs, text, start, {"lang_pred": (T.StringType(), pa.string()), "score": (T.DoubleType(), pa.float64()),
                                         "spans": (T.StringType(), pa.string())}, slice_bytes=SLICE_BYTES)


def fit_and_identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows outside fold 0 of crc32(key) mod 5, predict all rows."""
    model = train(docs, key, text, lang, train_rows=crc_fold(F.col(key)) != 0)
    return identify(docs.select(key, text), model, key, text)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = fit_and_identify(docs)
    return found.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "spans")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a language, or with less than LEAST_SHARE of their letters in it, go.

    Null texts and texts without a letter have no language and go; repeated rows share their fate; columns
    named like the prediction's pass through unchanged; an empty table stays empty.
    """
    model = train(docs, train_rows=crc_fold(F.col("doc_id")) != 0)
    found = identify(docs.withColumnsRenamed({"lang_pred": "_lang_pred", "score": "_score", "spans": "_spans"}), model)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SHARE))
    return kept.drop("lang_pred", "score", "spans").withColumnsRenamed(
        {"_lang_pred": "lang_pred", "_score": "score", "_spans": "spans"})
