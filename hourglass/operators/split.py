"""Global ranks, entity splits, shuffles and samples (inventory J1-J3, F1-F6, H30).

Splits and samples need no order: the hash values that separate them are
selected by counting (:func:`cut_points`), and rows are compared with them.
Where a rank itself is the result, the distinct keys (stays, codes, never
events) are range-sorted in parallel and checkpointed, and consecutive ranks
are formed from per-partition row counts (one row per partition).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.sources.io import checkpoint

KEY = "stay"


def seeded_hash(col: str | Column, seed: int | str) -> Column:
    """Hex md5 of ``seed || key``: a reproducible pseudo-random order key."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat(F.lit(str(seed)), c.cast("string")))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Consecutive 1-based rank of every row in a total ``order``.

    Distributed: ``orderBy`` range-partitions the rows, each row gets its
    position inside its partition, and partition offsets come from a table of
    per-partition counts.  ``order`` must be a total order (add the key as a
    tie-breaker).
    """
    s = (df.orderBy(*order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = checkpoint(s)  # fixes the partition ids
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # one row per partition: the running offset is computed on a tiny table
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = s.join(F.broadcast(offs.select("_pid", "_off", "_first")), "_pid")
    rank = (F.col("_off") + F.col("_mid") - F.col("_first") + F.lit(1)).cast("long")
    return out.withColumn(name, rank).drop("_pid", "_mid", "_off", "_first")


#: Hex digits of the hash by which keys are counted at a time, and keys that are fetched to be ordered.
DIGITS, FETCHED = 3, 4096


def cut_points(keys: DataFrame, key: str, seed: int, sizes: Callable[[int], Sequence[int]],
               by: str | None = None) -> dict[object, list[tuple[str, object] | None]]:
    """The ``(hash, key)`` of chosen ranks in the seeded order, per stratum ``by``.

    ``keys`` has one row per key; ``sizes(n)`` gives the ranks (from 1; 0 is None) for a stratum of ``n``
    keys.  Selection by digits: keys are counted by the first hex digits of their hash, only the digits
    that hold a chosen rank are counted further, and at last a few thousand keys are fetched.  What the
    driver holds are 4096 counts per stratum and level; nothing is ordered across the cluster.
    """
    stratum = F.col(by) if by else F.lit(0)
    h = checkpoint(keys.select(stratum.alias("_b"), F.col(key).alias("_k"), seeded_hash(key, seed).alias("_h")))

    def counted(rows: DataFrame, digits: int) -> dict[object, list[tuple[str, int]]]:
        out: dict[object, list[tuple[str, int]]] = {}
        for r in rows.groupBy("_b", F.substring("_h", 1, digits).alias("d")).count().collect():
            out.setdefault(r["_b"], []).append((r["d"], r["count"]))
        return {b: sorted(v) for b, v in out.items()}

    # (stratum, digits so far) -> [(index of the rank, rank within)]
    open_: dict[tuple[object, str], list[tuple[int, int]]] = {}
    cuts: dict[object, list[tuple[str, object] | None]] = {}

    def place(b: object, counts: list[tuple[str, int]], ranks: list[tuple[int, int]], few: dict) -> None:
        for i, rank in ranks:
            for d, n in counts:
                if rank <= n:
                    (few if n <= FETCHED or len(d) >= 30 else open_).setdefault((b, d), []).append((i, rank))
                    break
                rank -= n

    few: dict[tuple[object, str], list[tuple[int, int]]] = {}
    for b, counts in counted(h, DIGITS).items():
        wanted = list(sizes(sum(n for _, n in counts)))
        cuts[b] = [None] * len(wanted)
        place(b, counts, [(i, r) for i, r in enumerate(wanted) if r > 0], few)
    digits = DIGITS
    while open_:
        now, open_ = open_, {}
        held = reduce(lambda x, y: x | y, [F.col("_b").eqNullSafe(F.lit(b)) & F.col("_h").startswith(d) for b, d in now])
        digits += DIGITS
        for b, counts in counted(h.where(held), digits).items():
            for (of, d), ranks in now.items():
                if of == b:
                    place(b, [c for c in counts if c[0].startswith(d)], ranks, few)
    if few:
        held = reduce(lambda x, y: x | y, [F.col("_b").eqNullSafe(F.lit(b)) & F.col("_h").startswith(d) for b, d in few])
        rows = h.where(held).orderBy("_h", "_k").collect()  # at most FETCHED for every chosen rank
        for (b, d), ranks in few.items():
            mine = [r for r in rows if r["_b"] == b and r["_h"].startswith(d)]
            for i, rank in ranks:
                cuts[b][i] = (mine[rank - 1]["_h"], mine[rank - 1]["_k"])
    return cuts


def _up_to(key: str, seed: int, cut: tuple[str, object] | None) -> Column:
    """Whether a row's key stands at or before the cut in the seeded order."""
    if cut is None:
        return F.lit(False)
    h = seeded_hash(key, seed)
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (F.col(key) <= F.lit(cut[1])))


def split_by_entity(df: DataFrame, entity: str, seed: int = 9, test: float = 0.15,
                    val: float = 0.15, key: str = KEY) -> DataFrame:
    """Assign every row to train/val/test so that no entity crosses splits.

    Entities stand in the order of a seeded hash.  The first ``ceil(test * n)`` go to test, the next
    ``ceil(val / (1 - test) * (n - n_test))`` to val (the two successive splits of the reference), the
    rest to train.  The two hash values that separate them are selected (:func:`cut_points`); every row
    is then compared with them on its own, without a join.  Rows without an entity are left out.
    Output: ``df`` with a ``split`` column.
    """
    def sizes(n: int) -> tuple[int, int]:
        n_test = math.ceil(test * n)
        return n_test, n_test + math.ceil(val / (1.0 - test) * (n - n_test))

    persons = df.where(F.col(entity).isNotNull()).select(entity).distinct()
    low, high = cut_points(persons, entity, seed, sizes).get(0, [None, None])
    split = (F.when(_up_to(entity, seed, low), F.lit("test")).when(_up_to(entity, seed, high), F.lit("val"))
              .otherwise(F.lit("train")))
    return df.where(F.col(entity).isNotNull()).withColumn("split", split)


def split_by_hash(df: DataFrame, entity: str, seed: int = 9, test: float = 0.15,
                  val: float = 0.15) -> DataFrame:
    """J1, streaming-scale variant: split by a seeded hash threshold per entity.

    ``u = int(first 8 hex digits of md5(seed || entity)) / 2^32`` in [0, 1);
    ``u < test`` -> test, ``u < test + val`` -> val, else train.  No global
    order, no count and no join: each row is assigned on its own, every
    table with the entity column gets consistent splits, and new entities
    can arrive later.  Split sizes are proportional in expectation only (use
    :func:`split_by_entity` for the reference's exact sizes).
    """
    u = F.conv(F.substring(seeded_hash(entity, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    split = (F.when(u < F.lit(test), F.lit("test"))
              .when(u < F.lit(test + val), F.lit("val")).otherwise(F.lit("train")))
    return df.withColumn("split", split)


def shuffle_stays(stays: DataFrame, seed: int = 9, key: str = KEY) -> DataFrame:
    """Deterministic permutation of stays: ``(stay, order)``, order 1..n."""
    ids = stays.select(key).distinct().withColumn("_h", seeded_hash(key, seed))
    return global_rank(ids, [F.col("_h"), F.col(key)], "order").select(key, "order")


def sample_stays(stays: DataFrame, frac: float, seed: int = 9, key: str = KEY, by: str | None = None) -> DataFrame:
    """Exactly ``round(frac * n)`` stays (half to even), chosen by seeded hash.

    With ``by`` (a column of ``stays``, such as the split) that share of every stratum, each with its own
    cut; the strata must be few, for they become part of the plan.  Output ``(key)`` or ``(key, by)``.
    """
    ids = stays.select(key, *([by] if by else [])).distinct()
    cuts = cut_points(ids, key, seed, lambda n: [round(frac * n)], by)
    chosen = F.lit(False)
    for b, (cut,) in cuts.items():
        chosen = chosen | ((F.col(by).eqNullSafe(F.lit(b)) if by else F.lit(True)) & _up_to(key, seed, cut))
    return ids.where(chosen)


def apply_sample(df: DataFrame, sample: DataFrame, key: str = KEY) -> DataFrame:
    """Restrict another table to the sampled stays (consistent subsets)."""
    return df.join(sample.select(key), key, "left_semi")


def fraction_of_batches(df: DataFrame, pct: float, batch_col: str = "batch",
                        n_batches: int | None = None) -> DataFrame:
    """keep batch ``b`` iff ``b <= floor(n_batches / (100 / pct))``."""
    if n_batches is None:
        n_batches = df.select(batch_col).distinct().count()
    limit = math.floor(n_batches / (100.0 / pct))
    return df.where(F.col(batch_col) <= limit)
