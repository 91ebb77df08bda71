"""Scans and sinks (inventory A1-A13).

All readers return lazy DataFrames; all writers are one distributed write
(no driver-side chunk loop).  Positional slices are made deterministic by an
explicit ordering key, because Spark rows have no inherent order.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPLITS = ("train", "val", "test")


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """A1: header CSV scan with an explicit schema (no inference pass)."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def scan_parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A2: one driver table ``{sf_dir}/{table}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scan_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A3: relational source over JDBC.

    Pass ``partition_column``/``lower``/``upper``/``num_partitions`` so the scan
    is split into parallel range reads instead of a single connection.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


def scan_head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in an explicit order (smoke mode)."""
    return df.orderBy(*order_by).limit(n)


def slice_rows(df: DataFrame, start: int, stop: int, order_by: Sequence[str]) -> DataFrame:
    """A5: positional slice ``[start, stop)`` in an explicit order, by a distributed rank."""
    from hourglass.operators.split import global_rank

    ranked = global_rank(df, [F.col(c) if isinstance(c, str) else c for c in order_by], "_rank")
    return ranked.where((F.col("_rank") > start) & (F.col("_rank") <= stop)).drop("_rank")


def feature_names(df: DataFrame, key_cols: Iterable[str] = ("stay", "time"),
                  mask_suffix: str = "_mask", extra: Iterable[str] = ("hour",)) -> list[str]:
    """Value-column names of a wide grid (schema only, no data read)."""
    skip = set(key_cols) | set(extra)
    return [c for c in df.columns if c not in skip and not c.endswith(mask_suffix)]


def n_features(df: DataFrame, **kw) -> int:
    """Number of value features F of a wide grid."""
    return len(feature_names(df, **kw))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """One distributed write (CSV gets a header)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to an existing table (header handling is the format's)."""
    write_table(df, path, fmt=fmt, mode="append")


def write_splits(tables: dict[str, DataFrame], path: str, split_col: str = "split",
                 fmt: str = "parquet") -> None:
    """Write each table partitioned by its split column.

    Produces ``{path}/{name}/split=train|val|test/``; a reader can prune to
    one split through partition pruning.
    """
    for name, df in tables.items():
        write_table(df, f"{path.rstrip('/')}/{name}", fmt=fmt, partition_by=[split_col])


def load_splits(spark: SparkSession, path: str, name: str, splits: Sequence[str] = SPLITS,
                split_col: str = "split") -> DataFrame:
    """Read the split folders of one table back as a single DataFrame."""
    df = spark.read.parquet(f"{path.rstrip('/')}/{name}")
    return df.where(F.col(split_col).isin(list(splits)))


def union_splits(parts: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Concatenate per-split frames, tagging each with its split name."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(split_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


#: Stays in one part of a file of :func:`write_shuffled`.
PART_STAYS = 4096


def write_shuffled(tables: dict[str, DataFrame], order: DataFrame, path: str, n_files: int,
                   sort: Sequence[str] = (), key: str = "stay") -> DataFrame:
    """Write tables in a shuffled order of stays; the manifest of what was written.

    ``order`` is ``(stay, order)`` with ranks 1..n.  File ``f`` of every table holds the stays of the
    ``f``-th of ``n_files`` equal runs of that order, one after the other (a stay's rows by ``sort``, the
    columns that a table has), each stay whole in one file: a model reads its batches from front
    to back.  A file is a folder of parts of ``PART_STAYS`` stays, in order of ``part``; rows are exchanged and
    sorted by part, so no task holds a file.  The manifest ``(name, stay, order, file, first_row, n_rows)`` is
    written as well, and the first row of every part; the manifest is returned.
    """
    n = order.agg(F.count(F.lit(1)).alias("_n"))
    place = order.crossJoin(F.broadcast(n)).select(
        key, "order", F.floor((F.col("order") - 1) * n_files / F.col("_n")).cast("int").alias("file"),
        F.floor((F.col("order") - 1) / F.lit(PART_STAYS)).cast("int").alias("part"))
    place = checkpoint(place)
    manifest = None
    for name, df in tables.items():
        within = [c for c in sort if c in df.columns]
        rows = df.join(place, key).repartition("file", "part").sortWithinPartitions("file", "part", "order", *within)
        rows.write.mode("overwrite").partitionBy("file", "part").parquet(f"{path.rstrip('/')}/{name}")
        sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).join(place, key)
        # rows before a part from the few numbers of parts, before a stay from its part
        before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.groupBy("file", "part").agg(F.sum("n_rows").alias("_rows")).select(
            "file", "part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("part_row"))
        starts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_parts/{name}")
        starts = order.sparkSession.read.parquet(f"{path.rstrip('/')}/_parts/{name}")
        before = Window.partitionBy("file", "part").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
        within = sizes.withColumn("_before", F.coalesce(F.sum("n_rows").over(before), F.lit(0))).join(starts, ["file", "part"])
        part = within.select(F.lit(name).alias("name"), key, "order", "file", (F.col("part_row") + F.col("_before")).alias("first_row"), "n_rows")
        manifest = part if manifest is None else manifest.unionByName(part)
    manifest.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_manifest")
    return order.sparkSession.read.parquet(f"{path.rstrip('/')}/_manifest")


def read_shuffled(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of :func:`write_shuffled` with every row's ``file`` and its position ``row`` there."""
    df = spark.read.parquet(f"{path.rstrip('/')}/{name}").select("*", F.col("_metadata.row_index").alias("_row"))
    starts = spark.read.parquet(f"{path.rstrip('/')}/_parts/{name}")  # a row per PART_STAYS stays
    out = df.join(F.broadcast(starts), ["file", "part"])
    return out.select(*[c for c in df.columns if c not in ("part", "_row")], (F.col("_row") + F.col("part_row")).alias("row"))


def write_ids(df: DataFrame, path: str, key: str = "stay") -> DataFrame:
    """A10: persist the distinct ids of a table and return the persisted copy."""
    ids = df.select(key).distinct()
    write_table(ids, path)
    return read_ids(ids.sparkSession, path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """A10: read persisted ids."""
    return spark.read.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share.

    ``spark.checkpoint.dir`` names it.  Only a local session, whose driver and
    executors are one process, may leave it unset: then it is a folder below the
    warehouse.  On a cluster that would be a folder of one machine, so it is refused.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage (survives lost executors)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def named_result(df: DataFrame, name: str) -> DataFrame:
    """A reusable named result (the materialized-view role): checkpointed, with a temp view."""
    out = checkpoint(df)
    out.createOrReplaceTempView(name)
    return out


def write_predictions(pred: DataFrame, metrics_row: DataFrame, path: str) -> None:
    """Append prediction rows and the metrics row under ``path``."""
    append_table(pred, f"{path.rstrip('/')}/predictions")
    append_table(metrics_row, f"{path.rstrip('/')}/results")
