"""End-to-end preprocessing over the test tables: encode, split by person, write.

The reference runs its steps one after another (series, codes, static and
labels, then the person-level split into train/val/test folders).  Here each
output is one distributed write, partitioned by ``split`` (A9), so readers can
prune to one split; all tables cover the same stays (those with a series,
A10/C4) and no person appears in two splits (J1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.codes import code_union, encode_codes
from hourglass.operators.split import split_by_entity
from hourglass.plans import flat as P
from hourglass.plans import series
from hourglass.sources import driver
from hourglass.sources.io import checkpoint, write_splits

SEED = 9


def person_splits(spark: SparkSession, d: str, seed: int = SEED) -> DataFrame:
    """``(stay, split)`` for every stay with a series; persons never cross splits."""
    st = series.cohort(spark, d).select("stay", "person")
    st = st.join(P.series_stays(spark, d), "stay", "left_semi")
    return checkpoint(split_by_entity(st, "person", seed).select("stay", "split"))


def run_preprocessing(spark: SparkSession, d: str, out: str, seed: int = SEED,
                      wide: bool = False, fmt: str = "parquet") -> dict[str, str]:
    """Write ``timeseries``, ``flat``, ``labels`` and ``diagnoses`` under ``out``.

    Returns the table paths.  Every table carries ``split``.  By default the
    series and codes are long tables; ``wide=True`` writes the reference's
    shapes instead (series: ``stay, time, F values, F masks, hour``; codes: one
    0/1 column per kept code, every stay with a series, zeros filled), with
    column vocabularies collected after a size check.  ``fmt`` is any writer
    format (``"csv"`` gets a header).
    """
    splits = person_splits(spark, d, seed)
    st = series.cohort(spark, d)
    grid = series.encode_timeseries(spark, d)
    flat = P.encoded_flat(spark, d)
    labels = P.encoded_labels(spark, d)
    pairs = code_union(list(driver.code_sources(spark, d, st).values()))
    codes = encode_codes(pairs, P.series_stays(spark, d))
    if wide:
        from hourglass.operators.codes import to_multi_hot
        from hourglass.operators.timeseries import to_wide, vocabulary

        feats = vocabulary(series.series_vocabulary(spark, d, st))
        grid = to_wide(grid, feats)
        kept = vocabulary(codes.select(F.col("code").alias("feature")))
        codes = to_multi_hot(codes, kept, P.series_stays(spark, d))
    tables = {name: df.join(splits, "stay", "inner") for name, df in
              (("timeseries", grid), ("flat", flat), ("labels", labels), ("diagnoses", codes))}
    write_splits(tables, out, fmt=fmt)
    return {name: f"{out.rstrip('/')}/{name}" for name in tables}


def split_summary(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Stays per table and split (for checks and reports)."""
    parts = [spark.read.parquet(p).groupBy("split").agg(F.count_distinct("stay").alias("n_stays"))
             .withColumn("table", F.lit(name)) for name, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
