"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    The session's checkpoint folder, else ``spark.checkpoint.dir``; only a local session (tests) may
    leave both unset and gets a folder below the warehouse.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written to the shared folder, so lost executors lose nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """For a side of a join that grows with the data: both sides are sorted and merged, so the side is never
    gathered in the driver for a broadcast, however small it is just now."""
    return df.hint("merge")


def tidy(spark: SparkSession) -> None:
    """Between the phases of a long job: ask the driver's JVM to collect garbage.

    Spark removes shuffle files, broadcasts and checkpoints of frames that nobody holds only after the
    driver has collected them, and the heap shrinks again; nothing is computed differently.
    """
    spark.sparkContext._jvm.System.gc()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def utf8(c: Column) -> Column:
    """UTF-8 bytes of a string, none for null."""
    return F.encode(F.coalesce(c, F.lit("")), "UTF-8")


def crc_fold(c: Column, folds: int = 5) -> Column:
    """crc32 of the value's text modulo ``folds`` (null: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.encode(c.cast("string"), "UTF-8")), F.lit(folds)), F.lit(0)).cast("int")


def release() -> None:
    """At the end of a task: hand freed memory back, for Spark's Python workers live on to the next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


#: A batch function: texts to (rows kept, or None for all; new columns by name).
TextFunction = Callable[[list], tuple[list[int] | None, dict[str, list]]]


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """``(offset, length)`` of runs of rows with about ``most`` bytes (a longer row stands alone)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist() if pa.types.is_string(column.type) else [0] * len(column)
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > most:
            yield start, i - start
            start, size = i, 0
        size += n
    yield start, len(column) - start


def map_texts(df: DataFrame, text: str, start: Callable[[], TextFunction], fields: dict[str, tuple[T.DataType, pa.DataType]],
              drop: tuple[str, ...] = (), slice_bytes: int = 1 << 19) -> DataFrame:
    """Work on the texts of Arrow batches, ``slice_bytes`` at a time; all other columns pass through.

    ``start`` runs once a task and gives the batch function.  The result has the columns of ``df``
    without ``drop`` and those named like new ones, then the new ones.  ``text`` may name a field of a
    struct (``row.text``), so that texts need not be sent twice.
    """
    column, field = (text, None) if text in df.columns else text.split(".", 1)
    kept = [c for c in df.columns if c not in fields and c not in drop]
    schema = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(c, t) for c, (t, _) in fields.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            texts = batch.column(column) if field is None else pc.struct_field(batch.column(column), field)
            for offset, length in _slices(texts, slice_bytes):
                rows, new = function(texts.slice(offset, length).to_pylist())
                part = batch.select(kept).slice(offset, length)
                part = part if rows is None else part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(new[c], t) for c, (_, t) in fields.items()]],
                                                 names=[*kept, *fields])
                del rows, new, part
            del texts, batch
            release()

    return df.mapInArrow(run, schema)
