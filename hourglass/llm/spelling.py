"""Operator 12: spelling variants by dynamic programming over sorted word lists.

The vocabulary is sorted, and the edit matrix of a word against all others is worked out along the
list: neighbours in the list share a prefix (their LCP), so the matrix row of that prefix is computed
once for the whole range of words that have it.  Only the band of three cells around the diagonal is
kept, and a range is left as soon as all three exceed one edit.  The rows of all words of a task are
advanced together, one character at a time.

Spreading.  If the shorter of two words one edit apart has ``n`` code points and they share ``a`` code
points in front and ``b`` behind, so that ``r = n - a - b`` are left, then they share ``r // 2`` more in
front or ``r // 2`` more behind.  Lists therefore hold words with an equal half, in the order that
begins with the longer shared side (words are reversed for an equal ending).  A list of more than
``LIST`` words is dealt into lists with half of the rest in common as well, again and again; at the end
its words differ within two code points, so the size of the alphabet bounds it.  A pair that
lies in two lists is taken in the one that shares its beginning.  No list is cut or sampled.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint

RUN = r"[A-Za-zÀ-ÿ]"
#: Shortest word, least number of occurrences, how much more frequent a form is, divisor of the hashes.
LEAST, OFTEN, FACTOR, DIVISOR = 6, 5, 5, 199
#: Words of a list that is worked on whole, and (word, list) rows advanced together.
LIST, ROWS = 2048, 1 << 16
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000
ASCII = {c: c + 32 for c in range(65, 91)}


def derived(doc_id: object, run: str) -> str:
    """The word of a run: lower case (A-Z only), without one code point where the hash says so."""
    word = run.lower() if run.isascii() else run.translate(ASCII)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % DIVISOR == 0:
        k = h % len(word)
        word = word[:k] + word[k + 1:]
    return word


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, often: int = OFTEN) -> DataFrame:
    """``(word, n)`` of all words of at least ``least`` code points that occur ``often`` times or more.

    Counted within tasks first, so a frequent word is a few rows a task; null texts have no words, a null
    key is hashed as empty, and repeated rows count each.
    """
    runs = re.compile(RUN + "{%d,}" % least)  # a longer run than the least is matched whole

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, t in zip(batch.column(0), batch.column(1), strict=True):
                if not t.is_valid:
                    continue
                name = doc_id.as_py()
                for r, n in Counter(runs.findall(t.as_py())).items():
                    word = derived(name, r)
                    if len(word) >= least:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield flush(counts)
                    counts = Counter()
        if counts:
            yield flush(counts)

    parts = docs.select(key, text).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


# ------------------------------------------------------------------ one task: many sorted lists
def code_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, one word a row (0 behind its end), and the lengths."""
    size = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
    codes = np.zeros((len(words), int(size.max(initial=0)) + 2), dtype=np.uint32)
    codes[np.arange(codes.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return codes, size


def adjacent_lcp(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common prefix of every word with the one before it (0 for the first)."""
    out = np.zeros(len(size), dtype=np.int32)
    if len(size) > 1:
        same = codes[1:] == codes[:-1]
        out[1:] = np.minimum(np.where(same.all(axis=1), codes.shape[1], same.argmin(axis=1)), np.minimum(size[1:], size[:-1]))
    return out


def near_in_lists(codes: np.ndarray, size: np.ndarray, start: np.ndarray, stop: np.ndarray, shared: np.ndarray,
                  query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(q, w)`` one edit apart: ``q`` of ``query`` against the sorted list ``start[q]:stop[q]``
    it stands in, whose words share their first ``shared[q]`` code points."""
    lcp = adjacent_lcp(codes, size)
    first = np.zeros(len(size), dtype=bool)
    first[start] = True
    found_q, found_w = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    q = np.empty(0, dtype=np.int64)
    lo, hi = q.copy(), q.copy()
    band = np.empty((0, 3), dtype=np.int8)
    waiting = query[np.argsort(shared[query], kind="stable")]
    at, depth = 0, 0
    while len(q) or at < len(waiting):
        if not len(q):
            depth = int(shared[waiting[at]])
        end = at + int(np.searchsorted(shared[waiting[at:]], depth, side="right"))
        if end > at:  # lists whose words share as many code points: zero edits on the diagonal
            new = waiting[at:end]
            at = end
            q, lo, hi = np.append(q, new), np.append(lo, start[new]), np.append(hi, stop[new])
            band = np.concatenate([band, np.tile(np.array([2 if depth == 0 else 1, 0, 1], dtype=np.int8), (len(new), 1))])
        # words that end here stand first in their range; they are distinct, so there is one at most
        ended = size[lo] == depth
        cell = size[q[ended]] - depth + 1
        fits = (cell >= 0) & (cell <= 2)
        hit = np.zeros(len(cell), dtype=bool)
        hit[fits] = band[ended][fits, cell[fits]] == 1
        found_q.append(q[ended][hit])
        found_w.append(lo[ended][hit])
        lo = lo + ended
        left = lo < hi
        q, lo, hi, band = q[left], lo[left], hi[left], band[left]
        if not len(q):
            continue
        # parts of every range that agree in the next code point
        cuts = np.flatnonzero((lcp <= depth) | first)
        a, b = np.searchsorted(cuts, lo, side="right"), np.searchsorted(cuts, hi, side="left")
        parts = b - a + 1
        row = np.repeat(np.arange(len(q)), parts)
        k = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.where(k == 0, lo[row], cuts[np.minimum(a[row] + k - 1, len(cuts) - 1)])
        stops = np.where(k == parts[row] - 1, hi[row], cuts[np.minimum(a[row] + k, len(cuts) - 1)])
        letter = codes[begin, depth]
        q, old = q[row], band[row]
        width, long = codes.shape[1], size[q]

        def letter_of(j: int) -> np.ndarray:
            return codes[q, min(j, width - 1)] if j >= 0 else np.zeros(len(q), dtype=np.uint32)

        below = np.minimum(old[:, 0] + (letter_of(depth - 1) != letter), old[:, 1] + 1) if depth else old[:, 1] + 1
        level = np.minimum(np.minimum(old[:, 1] + (letter_of(depth) != letter), old[:, 2] + 1), below + 1)
        above = np.minimum(old[:, 2] + (letter_of(depth + 1) != letter), level + 1)
        new = np.stack([np.where(long >= depth, below, 2), np.where(long >= depth + 1, level, 2),
                        np.where(long >= depth + 2, above, 2)], axis=1)
        depth += 1
        new = np.minimum(new, 2).astype(np.int8)
        keep = new.min(axis=1) <= 1
        q, lo, hi, band = q[keep], begin[keep], stops[keep], new[keep]
    return np.concatenate(found_q), np.concatenate(found_w)


def list_pairs(words: list[str], n: np.ndarray, front: np.ndarray, behind: np.ndarray, cap: np.ndarray,
               start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart within lists ``start:stop`` of rows: the shorter word has ``n`` code
    points, and they share fewer than ``cap`` code points in front."""
    turned = behind > front
    keys = [w[::-1] if t else w for w, t in zip(words, turned.tolist(), strict=True)]
    order = np.array(sorted(range(len(words)), key=lambda i: (start[i], keys[i])), dtype=np.int64)
    codes, size = code_matrix([keys[i] for i in order.tolist()])
    found = [np.empty((0, 2), dtype=np.int64)]
    wanted = np.flatnonzero(size == n[order])
    begin, end, common = start[order], stop[order], np.maximum(front, behind)[order]
    for k in range(0, len(wanted), ROWS):
        q, w = near_in_lists(codes, size, begin, end, common, wanted[k:k + ROWS])
        fits = (size[w] > size[q]) | ((size[w] == size[q]) & (w > q))
        found.append(np.stack([order[q[fits]], order[w[fits]]], axis=1))
    q, w = np.concatenate(found).T
    plain, length = code_matrix(words)
    same = plain[q] == plain[w]
    alike = np.minimum(np.where(same.all(axis=1), plain.shape[1], same.argmin(axis=1)), np.minimum(length[q], length[w]))
    taken = alike < cap[q]
    return q[taken], w[taken]


def _near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by list; the last list of a batch goes on in the next one."""
    rest = None
    for frame in itertools.chain(frames, [None]):
        if frame is None:
            ready, rest = rest, None
        else:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            other = np.flatnonzero((rest["list"] != rest["list"].iloc[-1]).to_numpy()) if len(rest) else []
            cut = int(other[-1]) + 1 if len(other) else 0
            ready, rest = rest.iloc[:cut], rest.iloc[cut:]
        if ready is None or not len(ready):
            continue
        name = ready["list"].to_numpy()
        cuts = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        sizes = np.diff(np.append(cuts, len(name)))
        words, counts = list(ready["word"]), ready["n"].to_numpy(np.int64)
        q, w = list_pairs(words, *[ready[c].to_numpy(np.int64) for c in ("least", "front", "behind", "cap")],
                          np.repeat(cuts, sizes), np.repeat(cuts + sizes, sizes))
        one, other = np.concatenate([q, w]), np.concatenate([w, q])
        yield pd.DataFrame({"word": pd.Series([words[i] for i in one.tolist()], dtype=object),
                            "near": pd.Series([words[i] for i in other.tolist()], dtype=object), "near_n": counts[other]})


# ------------------------------------------------------------------ Spark
def _halves(rows: DataFrame) -> DataFrame:
    """Every list dealt into lists that share half of the rest in front, or behind."""
    half = F.floor((F.col("least") - F.col("front") - F.col("behind")) / 2).cast("int")
    more = F.explode(F.array(
        F.struct((F.col("front") + half).alias("front"), F.col("behind"), F.col("cap")),
        F.struct(F.col("front"), (F.col("behind") + half).alias("behind"), F.least("cap", F.col("front") + half).alias("cap"))))
    out = rows.withColumn("_m", more).select("word", "n", "least", "_m.front", "_m.behind", "_m.cap")
    behind = F.when(F.col("behind") > 0, F.substring("word", -F.col("behind"), F.col("behind"))).otherwise("")
    return out.withColumn("list", F.concat_ws(":", "least", "front", "behind", "cap", F.substring("word", 1, F.col("front")), behind))


def near_words(vocabulary: DataFrame, size: int = LIST) -> DataFrame:
    """``(word, near, near_n)``: all ordered pairs of different words one edit apart, once each."""
    long = F.char_length("word")
    root = vocabulary.select("word", "n", F.explode(F.array(long, long - 1)).alias("least"), F.lit(0).alias("front"),
                             F.lit(0).alias("behind"), F.lit(2**31 - 1).alias("cap")).where("least > 0")
    rows, ready = checkpoint(_halves(root)), []
    while True:
        large = rows.groupBy("list").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > size).select("list")
        # words that differ within two code points are worked on whatever their number
        split = checkpoint(rows.where("least - front - behind > 1").join(large, "list", "left_semi"))
        if split.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(split.select("list").distinct(), "list", "left_anti"))
        rows = checkpoint(_halves(split))
    lists = ready[0]
    for more in ready[1:]:
        lists = lists.unionByName(more)
    return lists.repartition("list").sortWithinPartitions("list").mapInPandas(_near, "word string, near string, near_n long")


def spelling_groups(vocabulary: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for distinct words with counts ``(word, n)``.

    The form of a word is its near word of largest count (ties: smallest in code-point order) if that is
    at least ``factor`` times the word's count; the root is the last one reached by following forms.
    Words without near words have none; an empty vocabulary gives no rows.
    """
    vocabulary = checkpoint(vocabulary.select("word", "n"))
    best = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("_b"))
    has = (-F.col("_b.m")) >= F.col("n") * factor
    words = checkpoint(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("_b.near")).alias("form"), F.when(has, -F.col("_b.m")).alias("form_n")))
    # counts grow along forms, so doubling the steps ends after a few rounds
    steps = checkpoint(words.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = checkpoint(steps.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                                   F.col("_next").isNotNull().alias("_moved")))
        steps = further.select("word", "root")
        if further.where("_moved").isEmpty():
            break
    return words.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(count_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))
