"""Operator 7: shards by vector bin packing over bytes, tokens and rows.

Groups (equal texts) stay together and are packed as vectors (bytes, tokens, rows), each measured in
shares of a shard's capacity; the next item goes to the shard where the dot product with the
residual capacity is highest, largest items first.  Packing every group one by one would pass the
corpus through one loop, so the items packed are *units*, whose number depends on the shard count
alone: most groups share units by the hash of their text (a coarse class and, for the last few
percent, a fine class that evens the shards out), and a group over ``max_share`` of a shard is a set
of pieces dealt by the hash of the row's key, since no shard could hold it evenly otherwise.  Small
corpora have fewer groups than units, and each group is then an item of its own.

Slots number the rows of a shard from 0 without gaps: rows are numbered within small hashed cells,
and the cells' counts give each cell its offset, so no task holds a shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint, utf8

SHARDS = 24
#: Bytes that a row counts besides its text.
ROW_BYTES = 8
#: Units per shard: coarse ones, and fine ones for FINE_PERCENT of the groups.
COARSE, FINE, FINE_PERCENT = 48, 96, 6
#: A group over this share of a shard's capacity in any dimension is split.
MAX_SHARE = 0.25
#: Weights of bytes, tokens and rows in the dot product.
WEIGHTS = (16.0, 1.0, 1.0)
CELL_ROWS = 10_000


def pack_units(vectors: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each unit.  ``vectors``: units x dimensions, in any unit of measure."""
    out = np.zeros(len(vectors), dtype=np.int32)
    totals = vectors.sum(axis=0)
    v = vectors * (shards / np.where(totals > 0, totals, 1))
    w = np.asarray(weights)
    residual = np.ones((shards, v.shape[1])) if len(v) else np.empty((0, 0))
    for i in np.lexsort((np.arange(len(v)), -(v * w).max(axis=1) if len(v) else [])):
        s = int(np.argmax(residual @ (w * v[i])))
        out[i] = s
        residual[s] -= v[i]
    return out


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = utf8(F.col(text))
    return docs.select(
        F.col(key).alias("_key"), (F.octet_length(t) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"), F.md5(t).alias("_group"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S+")).cast("long").alias("_tokens"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text",
                  max_share: float = MAX_SHARE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(key, size, text_crc32, law, shard, slot, grown_shard)``, one row per input row; law ``bytes``.

    A null text is empty (size 8, crc 0) and all empty texts are one group; null keys are one key
    when a large group is split; repeated rows each get their slot; an empty table gives an empty
    result.  Only ``key`` and ``text`` are read, so other columns cannot clash.
    """
    rows = checkpoint(_rows(docs, key, text))  # one narrow row per document, read four times
    dims = ("size", "_tokens", "_one")
    sums = [F.sum("size").alias("size"), F.sum("_tokens").alias("_tokens"), F.count(F.lit(1)).alias("_one")]
    groups = rows.groupBy("_group").agg(*sums)
    total = rows.agg(*sums).first()
    part = {c: max(1.0, (total[c] or 0) / shards * max_share) for c in dims}
    share = F.greatest(*[F.col(c) / F.lit(part[c]) for c in dims])
    # at most shards / max_share groups exceed the share in each of the dimensions
    big = groups.where(share > 1).select("_group", F.ceil(share).cast("long").alias("_pieces"))
    n_coarse, n_fine = shards * COARSE, shards * FINE
    h = F.xxhash64("_group")
    bundle = F.when(F.pmod(h, F.lit(100)) < FINE_PERCENT, n_coarse + F.pmod(F.xxhash64(h), F.lit(n_fine))
                    ).otherwise(F.pmod(F.xxhash64(h), F.lit(n_coarse)))
    piece = F.concat("_group", F.lit("/"), F.pmod(F.xxhash64(F.col("_key"), F.lit(7)), F.col("_pieces")).cast("string"))
    placed = rows.join(F.broadcast(big), "_group", "left").withColumn("_unit", F.coalesce(piece, bundle.cast("string")))

    # their number is bounded by the shard count: shards * (COARSE + FINE) and the pieces
    units = placed.groupBy("_unit").agg(*sums).toPandas().sort_values("_unit", ignore_index=True)
    units["shard"] = pack_units(units[list(dims)].to_numpy(dtype=float), shards)
    table = rows.sparkSession.createDataFrame(
        list(zip(units["_unit"].tolist(), units["shard"].tolist(), strict=True)), "_unit string, shard int")
    dealt = placed.join(F.broadcast(table), "_unit")

    cells = max(1, math.ceil((total["_one"] or 0) / (shards * cell_rows)))
    dealt = dealt.withColumn("_cell", F.pmod(F.xxhash64("_key", "_group"), F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("shard", "_cell").orderBy("_key", "_group")
    numbered = dealt.withColumn("_at", F.row_number().over(within) - 1).join(offsets, ["shard", "_cell"])
    return numbered.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_offset") + F.col("_at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
