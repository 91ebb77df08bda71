"""Operator 11: hard negatives, with bounds along a spanning tree of the anchors.

For every anchor: its best rows of the same label (positives), and for each positive the best rows of
other labels whose score lies in a window below the positive's.  Anchors that point alike stand in one
block; a block's anchors are joined by a minimum spanning tree of their distances.  If the score of a
parent anchor with a candidate is known, or bounded, the child's score lies within edge length times the
candidate's norm of it, so only candidates whose bounds overlap one of the child's windows are scored
again; a window shrinks to what can still enter its list.

Spreading.  Anchors are a stated query set; they are range-partitioned into blocks, candidates lie in
slices, slices in buckets, and a task takes one block against one bucket.  It hands on a few rows an
anchor, and the lists are merged by rank.  A label's size plays no part in the partitioning.  What
is shuffled: every candidate once for each block of anchors, every anchor once for each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint

#: Positives of an anchor, negatives of a positive, window in hundredths of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Anchors of a tree, candidates scored at a time, candidates of a bucket.
TREE, SLICE, BUCKET = 2048, 2048, 2048
SCALE, SEED = 256, 23
#: Below it sums of products are exact in doubles.
EXACT = 2.0**52

Hit = tuple[int, bool, int, int]  # minus score, no id, id, row: sorts as the result is ranked
PACKED = "id long, row long, label long, anchor boolean, place long, vec binary"
FOUND = "a_row long, a_id long, a_none boolean, k int, p_id long, p_none boolean, p_score long, score long, id long, none boolean, row long"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer vectors of the rows that take part, and a place that is near for vectors that point alike."""
    turns: dict[int, np.ndarray] = {}
    for batch in batches:
        out: list[tuple] = []
        for i, v in enumerate(batch.column("vec")):
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid else np.array([np.nan])
            if not np.isfinite(x).all():
                continue
            x = np.floor(SCALE * x)
            if not np.sqrt((x * x).sum()) < 2.0**31:
                continue
            d = len(x)
            if d not in turns:
                turns[d] = np.random.default_rng([SEED, d]).normal(size=(d, 16))
            code = int(np.packbits(x @ turns[d] > 0).view(">u2")[0])
            shift = 1
            while shift < 16:  # from Gray code to its number, so that one changed sign is a near place
                code ^= code >> shift
                shift *= 2
            out.append((i, d << 16 | code, x.astype(np.int32).tobytes()))
        keep = batch.take(pa.array([i for i, _, _ in out], pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [keep.column("id"), keep.column("row"), keep.column("label"), keep.column("anchor"),
             pa.array([p for _, p, _ in out], pa.int64()), pa.array([x for _, _, x in out], pa.binary())],
            names=["id", "row", "label", "anchor", "place", "vec"])


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """``(node, parent, distance)`` of a minimum spanning tree, every node after its parent, depth first."""
    n = len(vectors)
    square = (vectors * vectors).sum(axis=1)
    dist, parent, open_ = np.full(n, np.inf), np.full(n, -1), np.ones(n, dtype=bool)
    children: list[list[int]] = [[] for _ in range(n)]
    new = 0
    for _ in range(n):
        open_[new] = False
        if parent[new] >= 0:
            children[parent[new]].append(new)
        d = np.sqrt(np.maximum(square + square[new] - 2 * (vectors @ vectors[new]), 0))
        nearer = open_ & (d < dist)
        dist[nearer], parent[nearer] = d[nearer], new
        new = int(np.where(open_, dist, np.inf).argmin())
    order, stack = [], [0]
    while stack:
        v = stack.pop()
        order.append((v, int(parent[v]), float(dist[v]) if parent[v] >= 0 else 0.0))
        stack += children[v][::-1]
    return order


class Wanted:
    """A list of the best hits with scores within ``low`` and ``high``."""

    def __init__(self, low: float, high: float, size: int):
        self.low, self.high, self.size, self.hits = low, high, size, []

    def least(self, low: np.ndarray, high: np.ndarray) -> float:
        """Score below which nothing enters, given bounds of the candidates: enough of them are surely
        in the window and above it."""
        sure = low[(low >= self.low) & (high <= self.high)]
        return self.low if len(sure) < self.size else max(self.low, np.partition(sure, -self.size)[-self.size])

    def offer(self, score: np.ndarray, at: np.ndarray, none: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        fits = np.flatnonzero((score >= self.low) & (score <= self.high))
        if len(fits) > self.size:
            s = score[fits]
            fits = fits[s >= np.partition(s, -self.size)[-self.size]]
        if len(fits):
            hits = [(-int(score[i]), bool(none[at[i]]), int(ids[at[i]]), int(rows[at[i]])) for i in fits.tolist()]
            self.hits = sorted(self.hits + hits)[:self.size]
            if len(self.hits) == self.size:
                self.low = max(self.low, -self.hits[-1][0])


def search(anchors: dict[str, np.ndarray], candidates: dict[str, np.ndarray], same_label: bool,
           wanted: list[list[Wanted]], count: list[int] | None = None) -> None:
    """Offer every candidate that may belong there to the lists of every anchor (both of one length).

    ``count`` takes the number of scores worked out, for tests.
    """
    a = anchors["vec"]
    norms = np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))
    tree = spanning_tree(a.astype(np.float64))
    left = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(a))
    for start in range(0, len(candidates["row"]), SLICE):
        part = {k: v[start:start + SLICE] for k, v in candidates.items()}
        size = np.sqrt((part["vec"].astype(np.float64) ** 2).sum(axis=1))
        exact = norms.max(initial=0.0) * size.max(initial=0.0) < EXACT
        kind = np.float64 if exact else np.int64
        mine, theirs = a.astype(kind), part["vec"].astype(kind)
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting = left.copy()
        for node, parent, edge in tree:
            allowed = (part["label"] == anchors["label"][node]) == same_label
            allowed &= part["row"] != anchors["row"][node]
            if parent < 0 or not exact:
                low, high = np.full(len(size), -np.inf), np.full(len(size), np.inf)
                ask = np.ones(len(size), dtype=bool) if exact else allowed
            else:
                low, high = bounds[parent]
                reach = edge * (1 + 1e-9) * size + 1
                low, high = low - reach, high + reach
                ask = np.zeros(len(size), dtype=bool)
                for w in wanted[node]:
                    ask |= (high >= w.least(low[allowed], high[allowed])) & (low <= w.high)
                ask &= allowed
                waiting[parent] -= 1
                if not waiting[parent]:
                    del bounds[parent]
            at = np.flatnonzero(ask)
            score = (theirs @ mine[node])[at] if 2 * len(at) > len(size) else theirs[at] @ mine[node]
            if count is not None:
                count.append(len(at))
            low[at] = high[at] = score
            if waiting[node]:
                bounds[node] = low, high
            keep = allowed[at]
            for w in wanted[node]:
                w.offer(score[keep], at[keep], part["none"], part["id"], part["row"])


def _arrays(frame: pd.DataFrame, d: int) -> dict[str, np.ndarray]:
    return {"id": frame["id"].fillna(0).to_numpy(np.int64), "none": frame["id"].isna().to_numpy(bool),
            "row": frame["row"].to_numpy(np.int64), "label": frame["label"].to_numpy(np.int64),
            "vec": np.frombuffer(b"".join(frame["vec"]), dtype=np.int32).reshape(len(frame), d)}


def _task(same_label: bool, lists: Callable[[object], list[tuple[Wanted, tuple]]]) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Cogroup function: a block of anchors against a bucket of candidates; vectors of equal length only."""

    def run(block: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        block, lengths = block.sort_values(["place", "row"], ignore_index=True), block["vec"].map(len)
        lengths = block["vec"].map(len)
        for length in lengths.unique():
            others = bucket[bucket["vec"].map(len) == length]
            mine = block[lengths == length]
            for k in range(0, len(mine), TREE):
                part = mine.iloc[k:k + TREE]
                wanted = [lists(r) for r in part.itertuples()]
                arrays = _arrays(part, length // 4)
                search(arrays, _arrays(others, length // 4), same_label, [[w for w, _ in ws] for ws in wanted])
                for i, ws in enumerate(wanted):
                    for w, about in ws:
                        found += [(arrays["row"][i], arrays["id"][i], arrays["none"][i], *about, -s, x, none, row)
                                  for s, none, x, row in w.hits]
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pd.DataFrame(found, columns=names)

    return run


def _best(found: DataFrame, groups: list[str], size: int) -> DataFrame:
    """The first ``size`` rows of every group; ranked before the shuffle as well."""
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), "none", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(rows: DataFrame, key: str, vector: str, label: str, anchor: str, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` is a boolean column (null: false).  Rows with a null label or vector, or a null or
    non-finite component, take no part, nor do those whose integer norm reaches 2^31 (their scores need
    not fit a long).  Rows score with rows of equal length only.  Repeated rows are rows of their own;
    among equal scores the smaller key comes first, null keys last.  Other columns are not read; an
    empty table gives an empty result.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                        F.col(label).cast("long").alias("label"), F.coalesce(F.col(anchor), F.lit(False)).alias("anchor"),
                        F.col(vector).alias("vec")).where("label is not null and vec is not null")
    packed = checkpoint(plain.mapInArrow(_pack, PACKED))
    n, m = packed.agg(F.count(F.lit(1)), F.sum(F.col("anchor").cast("int"))).first()
    blocks, buckets = max(1, math.ceil((m or 0) / TREE)), max(1, math.ceil(n / BUCKET))
    anchors = checkpoint(packed.where("anchor").repartitionByRange(blocks, "place", "row").withColumn("block", F.spark_partition_id()))
    bucket = F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")
    spread = packed.select("id", "row", "label", "vec", bucket.alias("bucket"),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def against(block_rows: DataFrame, run: Callable) -> DataFrame:
        asked = block_rows.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        groups = asked.groupBy("block", "bucket").cogroup(spread.groupBy("block", "bucket"))
        return checkpoint(groups.applyInPandas(run, FOUND))

    def first(_: object) -> list[tuple[Wanted, tuple]]:
        return [(Wanted(-np.inf, np.inf, positives), (0, 0, False, 0))]

    def below(r: object) -> list[tuple[Wanted, tuple]]:
        return [(Wanted(-(-low * s // 100), high * s // 100, negatives), (k, x, none, s))
                for k, s, x, none in zip(r.ks.tolist(), r.scores.tolist(), r.ids.tolist(), r.nones.tolist(), strict=True)]

    good = _best(against(anchors, _task(True, first)), ["a_row"], positives)
    listed = good.groupBy("a_row").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank").alias("k"), "score", "id", "none"))).alias("_p"))  # at most `positives` of an anchor
    asked = checkpoint(anchors.join(listed.select(F.col("a_row").alias("row"), F.col("_p.k").alias("ks"), F.col("_p.score").alias("scores"),
                                                  F.col("_p.id").alias("ids"), F.col("_p.none").alias("nones")), "row"))
    bad = _best(against(asked, _task(False, below)), ["a_row", "k"], negatives)
    kind = rows.schema[key].dataType

    def id_of(name: str, none: str) -> F.Column:
        return F.when(~F.col(none), F.col(name)).cast(kind)

    return bad.select(id_of("a_id", "a_none").alias("anchor_id"), id_of("p_id", "p_none").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      id_of("id", "none").alias("negative_id"), F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    rows = rows.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                       (F.col("vec_id") % 100 == 0).alias("anchor"))
    return hard_negatives(rows, "vec_id", "embedding", "label", "anchor")


ORACLE_OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.rid AS a_rid, a.vec_id AS anchor_id, c.rid, c.vec_id, a.label = c.label AS alike,
         list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.rid <> c.rid AND len(a.e) = len(c.e)),
p AS (
  SELECT * FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY a_rid ORDER BY score DESC, vec_id, rid) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.a_rid, p.rid ORDER BY s.score DESC, s.vec_id, s.rid)::INTEGER AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a_rid = p.a_rid AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a_rid, p.rid ORDER BY s.score DESC, s.vec_id, s.rid) <= 10
"""
