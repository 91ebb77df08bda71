"""Aggregations (inventory D1-D19).

All are ``groupBy().agg()`` plans: Spark runs them as partial (map-side) plus
final hash aggregates, so a hot key is pre-combined in every task before the
shuffle and never shipped row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators.joins import cross_scalar


def count_distinct(df: DataFrame, col: str, approx_rsd: float | None = None) -> DataFrame:
    """One-row distinct count (``approx_rsd`` switches to HyperLogLog++)."""
    agg = (F.count_distinct(col) if approx_rsd is None
           else F.approx_count_distinct(col, approx_rsd))
    return df.agg(agg.cast("long").alias("n"))


def common_features_dense(events: DataFrame, cohort: DataFrame, min_frac: float,
                          min_avg_obs: float, key: str = "stay",
                          feature: str = "feature") -> DataFrame:
    """D1 plus ``avg observations per stay > min_avg_obs``.

    One row per label (the label-level DISTINCT fix of SURVEY D2), output
    ``(feature, n_stays, avg_obs)``.
    """
    ev = events.join(cohort.select(key).distinct(), key, "left_semi")
    per_stay = ev.groupBy(feature, key).agg(F.count(F.lit(1)).alias("n_obs"))
    per = per_stay.groupBy(feature).agg(F.count(F.lit(1)).cast("long").alias("n_stays"),
                                        F.avg("n_obs").alias("avg_obs"))
    total = cohort.agg(F.count_distinct(key).cast("long").alias("n_cohort"))
    return (cross_scalar(per, total)
               .where((F.col("n_stays") > F.col("n_cohort") * F.lit(float(min_frac)))
                      & (F.col("avg_obs") > F.lit(float(min_avg_obs))))
               .select(feature, "n_stays", "avg_obs"))


def dedupe_mean(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean of the values sharing ``keys`` (NULLs skipped)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def pivot_mean(df: DataFrame, keys: Sequence[str], feature: str, values: Sequence[str],
               value: str = "value") -> DataFrame:
    """Long -> wide with ``avg`` per cell; ``values`` fixes the columns.

    Passing the vocabulary explicitly avoids Spark's extra distinct job and
    pins the column order, so a missing label can never shift a column.
    """
    return df.groupBy(*keys).pivot(feature, list(values)).agg(F.avg(value))


def fit_quantiles(df: DataFrame, value: str = "value", by: Sequence[str] = ("feature",),
                  probs: Sequence[float] = (0.05, 0.95), accuracy: int | None = None,
                  names: Sequence[str] = ("q_lo", "q_hi"), stored: bool = False) -> DataFrame:
    """Per-group quantiles with linear interpolation (pandas ``quantile``).

    Exact by default and safe at any group size (see ``operators.quantiles``);
    ``accuracy`` switches to the mergeable ``percentile_approx`` sketch; ``stored`` says that ``df`` is
    a written table, which may be read again.
    """
    from hourglass.operators.quantiles import quantiles

    if accuracy is not None:
        return quantiles(df, value, by, probs, names, "approx", accuracy)
    return quantiles(df, value, by, probs, names, stored=stored)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency per category, NULL excluded."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("count"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count/mean/std/min/quartiles/max of a numeric column."""
    from hourglass.operators.quantiles import quantiles

    c = F.col(col)
    base = df.agg(F.count(c).cast("long").alias("count"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
                  F.max(c).cast("double").alias("max"))
    qs = quantiles(df, col, (), (0.25, 0.5, 0.75), ("p25", "p50", "p75"))
    out = base.crossJoin(qs)
    return out.select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame, col: str) -> DataFrame:
    """count/unique/top/freq of a categorical column (ties -> smallest value)."""
    vc = value_counts(df, col)
    top = vc.orderBy(F.desc("count"), F.asc(col)).limit(1)
    tot = vc.agg(F.sum("count").cast("long").alias("count"),
                 F.count(F.lit(1)).cast("long").alias("unique"))
    return tot.crossJoin(top.select(F.col(col).alias("top"), F.col("count").alias("freq")))


def describe_all(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per column of a table, numeric and categorical ones together.

    ``(column, count, n_unique, top, freq, mean, std, min, p25, p50, p75, max)``; what does not apply to a
    column's kind is NULL.  All numeric columns become ``(column, value)`` rows once: their moments are
    partial aggregates and their quartiles one selection.  The categorical ones are counted by
    ``(column, value)`` first, so a frequent value is a few rows a task (ties of ``top``: the smallest).
    ``df`` should be a written table.
    """
    from hourglass.operators.quantiles import quantiles

    def long(cols: Sequence[str], kind: str) -> DataFrame:
        x = df.select(*[F.col(c).cast(kind).alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
        return x.where(F.col("value").isNotNull())

    def every(cols: Sequence[str]) -> DataFrame:
        return df.sparkSession.createDataFrame([(c,) for c in cols], "column string")

    out = None
    if numeric:
        x = long(numeric, "double")
        v = F.col("value")
        moments = x.groupBy("column").agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                          F.min(v).alias("min"), F.max(v).alias("max"))
        q = quantiles(x, "value", ["column"], (0.25, 0.5, 0.75), ("p25", "p50", "p75"), stored=True)
        none = F.lit(None)
        out = every(numeric).join(moments, "column", "left").join(q, "column", "left").select(
            "column", F.coalesce("count", F.lit(0)).cast("long").alias("count"), none.cast("long").alias("n_unique"),
            none.cast("string").alias("top"), none.cast("long").alias("freq"), "mean", "std", "min", "p25", "p50", "p75", "max")
    if categorical:
        counts = long(categorical, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("top")))
        stats = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("n_unique"), best.alias("_b"))
        none = F.lit(None).cast("double")
        cat = every(categorical).join(stats, "column", "left").select(
            "column", F.coalesce("count", F.lit(0)).cast("long").alias("count"), F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"),
            F.col("_b.top").alias("top"), (-F.col("_b.m")).cast("long").alias("freq"),
            *[none.alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])
        out = cat if out is None else out.unionByName(cat)
    return out


# The irregular edges of the length-of-stay histogram, in days.
LOS_EDGES = (0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0, 7.0, 8.0, 9.0,
             10.0, 12.0, 14.0, 16.0, 18.0, 20.0, 24.0, 28.0, 32.0, 52.0, 72.0, 92.0)


def los_histogram_edges() -> list[float]:
    """The fixed edges :data:`LOS_EDGES`."""
    return list(LOS_EDGES)


def histogram(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Counts per bin ``[e_i, e_{i+1})``; the last bin is right-closed (numpy).

    Values outside ``[e_0, e_last]`` are not counted.  Every bin is reported,
    empty ones with 0.
    """
    c = F.col(col)
    b = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        last = i == len(edges) - 2
        cond = (c >= lo) & ((c <= hi) if last else (c < hi))
        b = F.when(cond, F.lit(i)) if b is None else b.when(cond, F.lit(i))
    binned = df.select(b.alias("bin")).where(F.col("bin").isNotNull())
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).cast("long").alias("count"))
    spark = df.sparkSession
    bins = spark.createDataFrame(
        [(i, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)],
        "bin int, lo double, hi double")
    return (F.broadcast(bins).join(counts, "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def mean_median(df: DataFrame, col: str) -> DataFrame:
    """One row ``(mean, median)``; median is the linear-interpolated 0.5 quantile."""
    from hourglass.operators.quantiles import quantiles

    med = quantiles(df, col, (), (0.5,), ("median",))
    return df.agg(F.avg(col).alias("mean")).crossJoin(med)


def row_sum_score(df: DataFrame, keys: Sequence[str], components: Sequence[str],
                  feature: str = "feature", value: str = "value",
                  score_name: str = "score") -> DataFrame:
    """Composite score per key = sum of the listed components (missing = 0).

    A total of 0 becomes NULL; the components themselves are dropped and the
    score is emitted as a new feature row, in long form.
    """
    comp = df.where(F.col(feature).isin(list(components)))
    rest = df.where(~F.col(feature).isin(list(components)))
    score = (comp.groupBy(*keys).agg(F.sum(F.coalesce(F.col(value), F.lit(0.0))).alias(value))
                 .select(*keys, F.lit(score_name).alias(feature),
                         H.zero_to_null(F.col(value)).alias(value)))
    return rest.select(*keys, feature, value).unionByName(score)
