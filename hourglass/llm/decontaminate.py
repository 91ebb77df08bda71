"""Operator 8: benchmark decontamination by SimHash windows with exact verification.

Every benchmark item is compared with the windows of its own size in every text.  Window sizes are
rounded down to a fixed grid; the fingerprint of a window is a 64-bit SimHash over the hashes of its
word pairs.  Windows start at every ``stride``-th word, and an item is indexed at all offsets of its
length, so a passage that stands in a text word for word meets a fingerprint at distance 0 wherever it
begins.  A multi-index over four 16-bit blocks finds all fingerprints within ``RADIUS`` bits: of two
such fingerprints one block differs by at most ``RADIUS // 4`` bits, and each block value lists the items
within that distance.  Candidates are verified exactly: the share of the item's shingles (five words,
weighted by their rarity among the items) that the window, with a margin for insertions, holds.

Edits can move a fingerprint by more than ``RADIUS`` bits while the share is still reached, so recall on
changed passages is below one; the tests measure it against an exact look-up of all shingles (README).

Texts are read where they lie: the items come to the tasks in blocks of bounded size (``BLOCK_WORDS``),
one pass over the documents per block, and nothing but hits leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import checkpoint, map_texts
from hourglass.llm.textvec import MIX, P, hashed_shingles, hashed_words

SHINGLE = 5
#: Least weighted share of an item's shingles in a window.
SIMILARITY = 0.75
RADIUS = 11
BLOCKS, BLOCK_BITS = 4, 16
#: Words of benchmark items that one pass over the documents holds in expectation.
BLOCK_WORDS = 50_000
#: Words of text fingerprinted at a time.
CHUNK = 1 << 14
#: Bytes of texts whose words a task holds at a time; windows are laid out over all of them.
SLICE_BYTES = 1 << 21


def window_size(words: int) -> tuple[int, int]:
    """``(size, stride)``: the largest grid size that leaves room for ``stride`` offsets in an item."""
    best, size = (1, 1), 1
    while size <= words:
        stride = min(8, max(1, size // 4))
        if size + stride - 1 <= words:
            best = (size, stride)
        size = max(size + 1, size * 5 // 4)
    return best


def _pairs(words: np.ndarray, size: int) -> np.ndarray:
    """Features of a sequence: hashes of neighbouring words (of single words for windows of one)."""
    h = words if size == 1 else (words[:-1] * P) ^ (words[1:] + (words[1:] >> np.uint64(17)))
    return (h ^ (h >> np.uint64(33))) * MIX


def _bit_sums(features: np.ndarray, most: int = 0) -> np.ndarray:
    """Running count of set bits, modulo a power of two that no window of ``most`` features reaches."""
    kind = np.uint16 if most < 1 << 16 else np.uint32
    bits = np.unpackbits(features.view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros((len(features) + 1, 64), dtype=kind)
    np.cumsum(bits, axis=0, dtype=kind, out=out[1:])
    return out


def _fingerprints(sums: np.ndarray, stride: int, windows: int, count: int) -> np.ndarray:
    """SimHash of the ``count`` features from every ``stride``-th start: a bit is set if most features set it."""
    last = (windows - 1) * stride + 1
    inside = sums[count:count + last:stride] - sums[:last:stride]
    return np.packbits(inside > count // 2, axis=1).view(np.uint64).ravel()


@dataclass
class Item:
    item_id: int | None
    words: int
    shingles: np.ndarray  # sorted distinct hashes
    weights: np.ndarray
    offsets: np.ndarray  # first word of each shingle


@dataclass
class SizeIndex:
    """All item windows of one size: fingerprints, item and offset of each, and per block the rows
    that lie within RADIUS // BLOCKS bits of every block value."""

    stride: int
    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bounds: list[np.ndarray]
    rows: list[np.ndarray]


def _near_masks() -> np.ndarray:
    """All 16-bit masks with at most RADIUS // BLOCKS bits set."""
    every = np.arange(1 << BLOCK_BITS, dtype=np.uint32)
    return every[np.bitwise_count(every) <= RADIUS // BLOCKS]


def build_index(items: list[tuple[int | None, np.ndarray]], weights: dict[int, float]) -> tuple[list[Item], dict[int, SizeIndex]]:
    """``items``: id and word hashes; ``weights``: of each shingle hash."""
    kept, windows = [], {}
    for item_id, words in items:
        if not len(words):
            continue
        s, first = np.unique(hashed_shingles(words, min(SHINGLE, len(words))), return_index=True)
        kept.append(Item(item_id, len(words), s, np.array([weights[int(x)] for x in s]), first))
        size, stride = window_size(len(words))
        features = _pairs(words, size)
        n = max(1, size - 1)
        offsets = np.arange(len(words) - size + 1)
        prints = _fingerprints(_bit_sums(features, n), 1, len(offsets), n)
        windows.setdefault(size, (stride, []))[1].append((prints, len(kept) - 1, offsets))
    index, masks = {}, _near_masks()
    for size, (stride, parts) in windows.items():
        prints = np.concatenate([p for p, _, _ in parts])
        item = np.concatenate([np.full(len(p), i) for p, i, _ in parts])
        offset = np.concatenate([o for _, _, o in parts])
        bounds, rows = [], []
        for b in range(BLOCKS):
            value = (prints >> np.uint64(b * BLOCK_BITS)).astype(np.uint32) & np.uint32(0xFFFF)
            near = (value[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(near, kind="stable")
            bounds.append(np.searchsorted(near[order], np.arange((1 << BLOCK_BITS) + 1)))
            rows.append((order // len(masks)).astype(np.int32))
        index[size] = SizeIndex(stride, prints, item, offset, bounds, rows)
    return kept, index


def within_radius(prints: np.ndarray, index: SizeIndex) -> tuple[np.ndarray, np.ndarray]:
    """All ``(print, index row)`` at most RADIUS bits apart, each once."""
    found = []
    for b in range(BLOCKS):
        value = (prints >> np.uint64(b * BLOCK_BITS)).astype(np.int64) & 0xFFFF
        low, high = index.bounds[b][value], index.bounds[b][value + 1]
        n = high - low
        probe = np.repeat(np.arange(len(prints)), n)
        row = index.rows[b][np.arange(len(probe)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        near = np.bitwise_count(prints[probe] ^ index.prints[row]) <= RADIUS
        found.append(probe[near] * len(index.prints) + row[near])
    pairs = np.unique(np.concatenate(found))
    return pairs // len(index.prints), pairs % len(index.prints)


def match_texts(texts: list[str], items: list[Item], index: dict[int, SizeIndex]) -> list[tuple[int, int, float, int, int]]:
    """``(text, item, similarity, first word, bits apart)``: the best window of each pair that reaches
    SIMILARITY (ties: fewest bits apart, then the earliest)."""
    words, owner = hashed_words(texts)
    if not len(words) or not items:
        return []
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    longest = max(index)
    seen: dict[tuple[int, int, int], int] = {}
    for a in range(0, len(words), CHUNK):
        b = min(len(words), a + CHUNK + longest)
        sums = {kind: _bit_sums(_pairs(words[a:b], kind), longest) for kind in {min(2, size) for size in index}}
        for size, x in index.items():
            windows = -(-min(CHUNK, b - a - size + 1) // x.stride)
            if windows < 1:
                continue
            p = np.arange(windows) * x.stride
            prints = _fingerprints(sums[min(2, size)], x.stride, windows, max(1, size - 1))
            whole = owner[a + p] == owner[a + p + size - 1]
            p, prints = p[whole], prints[whole]
            probe, row = within_radius(prints, x)
            bits = np.bitwise_count(prints[probe] ^ x.prints[row])
            at = a + p[probe]
            for t, i, first, d in zip(owner[at].tolist(), x.item[row].tolist(), (at - x.offset[row]).tolist(), bits.tolist(), strict=True):
                seen[t, i, first] = min(d, seen.get((t, i, first), 64))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for (t, i, at), d in seen.items():
        item, margin = items[i], max(2, items[i].words // 8)
        low, high = max(ends[t], at - margin), min(ends[t + 1], at + item.words + margin)
        region = hashed_shingles(words[low:high], min(SHINGLE, item.words))
        share = float(item.weights[np.isin(item.shingles, region)].sum() / item.weights.sum())
        found = (share, -d, -max(0, int(at - ends[t])))
        if share >= SIMILARITY and found > best.get((t, i), (0.0,)):
            best[t, i] = found
    return [(t, i, s, -at, -d) for (t, i), (s, d, at) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text",
                block_words: int = BLOCK_WORDS) -> Iterator[tuple[list[Item], dict[int, SizeIndex]]]:
    """Indexes of the items, block by block; weights are over all items.

    Repeated items count once; items without words match nothing.
    """
    items = benchmark.select(F.col(key).alias("_item"), F.coalesce(F.col(text), F.lit("")).alias("_text")).distinct()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words, owner = hashed_words(frame["_text"].tolist())
            ends = np.searchsorted(owner, np.arange(len(frame) + 1))
            parts = [words[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            yield pd.DataFrame({
                "item": frame["_item"], "words": [p.astype(np.int64) for p in parts],
                "shingles": [np.unique(hashed_shingles(p, min(SHINGLE, len(p)) or 1)).astype(np.int64) for p in parts]})

    schema = T.StructType([T.StructField("item", items.schema["_item"].dataType), T.StructField("words", T.ArrayType(T.LongType())),
                           T.StructField("shingles", T.ArrayType(T.LongType()))])
    cut_items = items.mapInPandas(cut, schema).where(F.size("words") > 0).withColumn("block_of", F.xxhash64("item", "words"))
    total = cut_items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    cut_items = checkpoint(cut_items.withColumn("block", F.pmod("block_of", F.lit(blocks))))  # read once a block
    each = cut_items.select("block", F.explode("shingles").alias("s"))
    weight = each.groupBy("s").agg((1.0 / F.count(F.lit(1))).alias("w"))
    for b in range(blocks):  # one block holds about block_words words
        rows = cut_items.where(F.col("block") == b).select("item", "words").collect()
        mine = each.where(F.col("block") == b).select("s").distinct().join(weight, "s").collect()
        yield build_index([(r["item"], np.array(r["words"], dtype=np.int64).astype(np.uint64)) for r in
                           sorted(rows, key=lambda r: (r["item"] is None, 0 if r["item"] is None else r["item"], r["words"]))],
                          {int(np.int64(r["s"]).astype(np.uint64)): r["w"] for r in mine})


def _share(spark: SparkSession, built: tuple[list[Item], dict[int, SizeIndex]]):
    """Broadcast an index of one block as plain arrays."""
    items, index = built
    return spark.sparkContext.broadcast((
        [(i.item_id, i.words, i.shingles, i.weights, i.offsets) for i in items],
        {k: (x.stride, x.prints, x.item, x.offset, x.bounds, x.rows) for k, x in index.items()}))


def _own(shared) -> tuple[list[Item], dict[int, SizeIndex]]:
    items, index = shared.value
    return [Item(*i) for i in items], {k: SizeIndex(*x) for k, x in index.items()}


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id") -> DataFrame:
    """``(key, item, similarity, first_word, bits)``: every document and benchmark item with a window of
    similarity ``SIMILARITY`` or more (the best window; ties: the fewest
    fingerprint bits apart, then the earliest).

    Null and empty texts hold nothing, items without words are in nothing; null keys stay null;
    repeated document rows each give their hits, repeated items count once; an empty table on either
    side gives an empty result.  Words are runs of letters and digits in lower case; an item of fewer
    than five words is one shingle.  Only the named columns are read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    kind = benchmark.schema[item].dataType
    out = None
    for built in item_blocks(benchmark, item):
        shared = _share(spark, built)

        def start(shared=shared):
            items, index = _own(shared)

            def run(texts: list) -> tuple[list[int], dict[str, list]]:
                hits = match_texts([t or "" for t in texts], items, index)
                return [t for t, *_ in hits], {item: [items[i].item_id for _, i, *_ in hits], "similarity": [s for _, _, s, _, _ in hits],
                                               "first_word": [a for *_, a, _ in hits], "bits": [b for *_, b in hits]}

            return run

        found = map_texts(d, "_text", start, {
            item: (kind, pa.string() if isinstance(kind, T.StringType) else pa.int64()), "similarity": (T.DoubleType(), pa.float64()),
            "first_word": (T.LongType(), pa.int64()), "bits": (T.IntegerType(), pa.int32())}, drop=("_text",), slice_bytes=SLICE_BYTES)
        out = found if out is None else out.union(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any benchmark item, all columns."""
    spark = docs.sparkSession
    for built in item_blocks(benchmark):
        shared = _share(spark, built)

        def start(shared=shared):
            items, index = _own(shared)

            def run(texts: list) -> tuple[list[int], dict]:
                hit = {t for t, *_ in match_texts([t or "" for t in texts], items, index)}
                return [i for i in range(len(texts)) if i not in hit], {}

            return run

        docs = map_texts(docs, text, start, {}, slice_bytes=SLICE_BYTES)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go.

    Null and empty texts hold none and stay; repeated rows share their fate; all columns pass through,
    whatever their names; without items everything stays.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
