"""Exact, linearly interpolated quantiles at any group size.

Distributed selection: values are counted per (group, bin) of a monotone binning, the running counts
tell which bins hold a wanted position, and only those bins are cut again, until their values are few
or equal.  The first bins are logarithmic (32 an octave, by sign), so no outlier can spoil them; later
ones divide a bin's own range of values.  Values are never sorted or exchanged between tasks: what is
shuffled are the counts.

The rule is that of pandas/numpy and DuckDB ``quantile_cont``:
``x[lo] + (h - lo) * (x[hi] - x[lo])`` with ``h = (n - 1) * p``.

``method='approx'`` selects the mergeable ``percentile_approx`` sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.sources.io import checkpoint

#: Bins of an octave, bins a kept bin is cut into, values of a bin that are gathered to be ordered.
OCTAVE, CUTS, GATHERED = 32, 4096, 4096
#: Rows of bins that are broadcast to the values; more are joined by a shuffle.
BROADCAST_BINS = 200_000
#: A kept bin's values divide at least this many times, whatever they are: 2**-5 of an octave in five cuts of 2**-12.
MOST_CUTS = 8


def _names(probs: Sequence[float], names: Sequence[str] | None) -> list[str]:
    return list(names) if names is not None else [f"q{i}" for i in range(len(probs))]


def approx_quantiles(df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float],
                     names: Sequence[str] | None = None, accuracy: int = 100_000) -> DataFrame:
    """Mergeable sketch (``percentile_approx``) per group."""
    v = F.col(value).cast("double")
    q = F.percentile_approx(v, F.array(*[F.lit(float(p)) for p in probs]), accuracy)
    out = df.where(v.isNotNull()).groupBy(*by).agg(q.alias("_q"))
    return out.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(_names(probs, names))])


def _octave_bin(v: Column) -> Column:
    """Number of a value's logarithmic bin: never smaller for a larger value; NaN is the largest value."""
    size = F.floor(F.log2(F.abs(v)) * F.lit(float(OCTAVE))).cast("long") + F.lit(1100 * OCTAVE)
    size = F.when(F.abs(v) == float("inf"), F.lit(2200 * OCTAVE)).otherwise(size)
    return (F.when(F.isnan(v), F.lit(2200 * OCTAVE + 1).cast("long"))
             .when(v == 0, F.lit(0).cast("long")).when(v > 0, size).otherwise(-size))


def _wanted(bins: DataFrame, by: Sequence[str], inside: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Of the bins ``(by, inside, _bin, _c, _lo, _hi, _below, _n)`` those that hold a wanted position.

    ``_below`` is how many values of the group lie below the enclosing bin; the running count within it
    is a window over a group's bins, whose number the binning bounds.
    """
    w = Window.partitionBy(*by, *inside).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_c").over(w), F.lit(0)))
    held = F.lit(False)
    for p in probs:
        h = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        for pos in (F.floor(h), F.ceil(h)):
            held = held | ((pos >= F.col("_below")) & (pos < F.col("_below") + F.col("_c")))
    return bins.where(held).select(*by, "_lo", "_hi", "_c", "_below", "_n")


def _with_bins(x: DataFrame, bins: DataFrame, by: Sequence[str], n_bins: int) -> DataFrame:
    """The values that lie in one of the bins (disjoint ranges of values), with it."""
    b = bins.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], "_lo", "_hi", "_below", "_n")
    on = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    for i, c in enumerate(by):
        on = on & (F.col(c) == F.col(f"_b{i}"))
    return x.join(F.broadcast(b) if n_bins <= BROADCAST_BINS else b, on).drop(*[f"_b{i}" for i in range(len(by))])


def distributed_quantiles(df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float],
                          names: Sequence[str] | None = None, stored: bool = False) -> DataFrame:
    """Exact quantiles by selection; groups whose key is NULL are left out, NULL values are skipped.

    The values are read two or three times: pass ``stored`` for an input that is a written table,
    else its values are written once.
    """
    keys = list(by) or ["_all"]
    x = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    x = x.where(F.lit(True) if not by else F.col(by[0]).isNotNull())
    for c in by[1:]:
        x = x.where(F.col(c).isNotNull())
    x = x if stored else checkpoint(x)
    x = x if by else x.withColumn("_all", F.lit(0))
    count = [F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]

    bins = x.groupBy(*keys, _octave_bin(F.col("_v")).alias("_bin")).agg(*count)
    bins = bins.withColumns({"_n": F.sum("_c").over(Window.partitionBy(*keys)), "_below": F.lit(0).cast("long")})
    found = checkpoint(_wanted(bins, keys, (), probs))
    large = (F.col("_c") > GATHERED) & (F.col("_lo") < F.col("_hi"))
    done, settled = [], 0
    for _ in range(MOST_CUTS):
        n_bins, n_large = found.agg(F.count(F.lit(1)), F.sum(large.cast("int"))).first()
        settled += n_bins - (n_large or 0)
        if not n_large:
            break
        done.append(found.where(~large))
        part = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(CUTS))).cast("long")
        inner = _with_bins(x, found.where(large), keys, n_bins).groupBy(*keys, "_n", "_below", part.alias("_bin")).agg(*count)
        found = checkpoint(_wanted(inner, keys, ("_below",), probs))
    done.append(found)
    kept = done[0]
    for more in done[1:]:
        kept = kept.unionByName(more)

    # a bin of equal values is known by its ends; of the others the few values are put in order
    open_ = kept.where(F.col("_lo") < F.col("_hi"))
    few = _with_bins(x, open_, keys, settled).groupBy(*keys, "_n", "_below").agg(F.array_sort(F.collect_list("_v")).alias("_s"))
    ends = kept.where(F.col("_lo") >= F.col("_hi")).select(
        *keys, "_n", "_below", F.array().cast("array<double>").alias("_s"), F.col("_lo").alias("_same"), F.col("_c").alias("_size"))
    picked = ends.unionByName(few.withColumns({"_same": F.lit(None).cast("double"), "_size": F.size("_s").cast("long")}))
    aggs = []
    for p, name in zip(probs, _names(probs, names)):
        h = (F.col("_n") - 1).cast("double") * F.lit(float(p))

        def at(pos: Column) -> Column:
            k = pos - F.col("_below")
            return F.max(F.when((k >= 0) & (k < F.col("_size")), F.coalesce("_same", F.get("_s", k.cast("int")))))

        v_lo, v_hi = at(F.floor(h)), at(F.ceil(h))
        frac = F.first(h - F.floor(h))
        aggs.append(F.when(v_lo == v_hi, v_lo).otherwise(v_lo + frac * (v_hi - v_lo)).alias(name))
    if not by:  # one row, NULL without values
        return picked.agg(*aggs)
    return picked.groupBy(*by).agg(*aggs)


def quantiles(df: DataFrame, value: str, by: Sequence[str] = (), probs: Sequence[float] = (0.5,),
              names: Sequence[str] | None = None, method: str = "exact", accuracy: int = 100_000,
              stored: bool = False) -> DataFrame:
    """Quantiles per group; ``method`` is ``exact`` or ``approx``."""
    if method == "approx":
        return approx_quantiles(df, value, by, probs, names, accuracy)
    return distributed_quantiles(df, value, by, probs, names, stored)
