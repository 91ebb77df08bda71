"""Tabular work around model outputs (inventory M1, M4, M5, F4, B15/B16, B19, D19, H24-H26).

All inputs are long tables ``(stay, time, feature, value[, mask, attribution])``
produced elsewhere; nothing here trains or differentiates a network.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators.timeseries import row_position

KEY = "stay"


def dilation_schedule(n_layers: int, kernel: int) -> list[int]:
    """Dilation per layer: 1 for layer 0, then ``i * (kernel - 1)``."""
    return [1 if i == 0 else i * (kernel - 1) for i in range(n_layers)]


def causal_lag_features(grid: DataFrame, weights: Sequence[float], dilation: int = 1,
                        value: str = "value", out: str = "conv") -> DataFrame:
    """M1: per-feature causal weighted sum ``sum_j w_j * x[t - j*d]`` (zero left padding).

    ``lag`` over ``(stay, feature)`` ordered by time: rows are dense hours, so
    row offsets are hour offsets.  All lags share one window sort.
    """
    w = Window.partitionBy(KEY, "feature").orderBy("time")
    terms = [F.lit(float(wj)) * F.lag(F.col(value), j * dilation, 0.0).over(w)
             for j, wj in enumerate(weights)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return grid.withColumn(out, total)


def causal_lag_series(runs: DataFrame, weights: Sequence[float], dilation: int = 1, out: str = "conv") -> DataFrame:
    """M1 on runs: ``(stay, time, feature, value, conv)``, without exchanging or sorting an hour.

    ``runs`` is the output of ``timeseries.run_arrays``: every (stay, feature) row lays its runs out as an
    array of hourly values (0 where unobserved), sums the lagged values there, and is then expanded.
    """
    size = lambda x: (x["_end"] - x["_start"] + 1).cast("int")
    values = F.flatten(F.transform("_runs", lambda x: F.array_repeat(F.coalesce(x["value"], F.lit(0.0)), size(x))))

    def lagged(v: Column, i: Column) -> Column:
        terms = [F.lit(float(w)) * F.coalesce(F.get("_v", i - j * dilation), F.lit(0.0)) for j, w in enumerate(weights)]
        return F.struct(v.alias("value"), reduce(lambda a, b: a + b, terms).alias(out))

    laid = runs.select(KEY, "feature", "first_time", values.alias("_v"))
    cells = laid.select(KEY, "feature", "first_time", F.posexplode(F.transform("_v", lagged)).alias("_i", "_c"))
    return cells.select(KEY, (F.col("first_time") + F.col("_i")).alias("time"), "feature", "_c.value", f"_c.{out}")


def eligible_stays(grid: DataFrame, time_point: int = 23) -> DataFrame:
    """Stays that still have a row at raw position ``time_point`` (alive at the horizon).

    The reference's default horizon is 23: the label mask at trimmed index 18
    (= raw position 23) and the first 23 hourly positions.
    """
    hours = row_position(grid.select(KEY, "time").distinct())
    return hours.where(F.col("pos") == time_point).select(KEY)


def per_stay_attribution(attr: DataFrame, time_point: int = 23, value: str = "value",
                         attribution: str = "attribution") -> DataFrame:
    """D19 over the first ``time_point`` hours of eligible stays.

    ``sum |attribution| / number of non-zero feature values`` per
    (stay, feature); a feature never non-zero gives NULL (the reference's NaN).
    A grid that carries the stays' ``first_time`` and ``last_time`` tells a row's
    position and a stay's length by itself; otherwise they are found by joins.
    """
    if "first_time" in attr.columns:
        position = F.col("time") - F.col("first_time")
        a = attr.where((position < time_point) & (F.col("last_time") - F.col("first_time") >= time_point))
    else:
        hours = row_position(attr.select(KEY, "time").distinct())
        first = hours.where(F.col("pos") < time_point).select(KEY, "time")
        a = (attr.join(eligible_stays(attr, time_point), KEY, "left_semi")
                 .join(first, [KEY, "time"], "inner"))
    return a.groupBy(KEY, "feature").agg(
        F.try_divide(F.sum(F.abs(F.col(attribution))),
                     F.count(F.when(F.col(value) != 0, F.lit(1)))).alias("mean_abs"))


def attribution_summary(attr: DataFrame, time_point: int = 23, k: int = 25, clip: float = 3.0,
                        renaming: Mapping[str, str] | None = None) -> DataFrame:
    """M4: D19 -> clip -> drop zero-total features (B19) -> NaN to 0 -> mean per
    feature -> top ``k`` (F4).  Output ``(feature, importance)``."""
    per = per_stay_attribution(attr, time_point)
    clipped = per.withColumn("mean_abs", H.clip("mean_abs", -clip, clip))
    keep = (clipped.groupBy("feature").agg(F.sum("mean_abs").alias("_t"))
                   .where(F.coalesce(F.col("_t"), F.lit(0.0)) != 0).select("feature"))
    kept = clipped.join(keep, "feature", "left_semi").withColumn("mean_abs", H.nan_to_zero("mean_abs"))
    imp = kept.groupBy("feature").agg(F.avg(F.abs("mean_abs")).alias("importance"))
    if renaming:
        imp = imp.withColumn("feature", display_name("feature", renaming))
    return imp.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


def display_name(col: str, mapping: Mapping[str, str]) -> F.Column:
    """Rename values for display (unmapped names unchanged)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[F.col(col)], F.col(col))


def single_stay_profile(attr: DataFrame, stay, features: Sequence[str],
                        attribution: str = "attribution", value: str = "value") -> DataFrame:
    """M5: one stay's feature values and attributions per hour for named features.

    Wide output ``time, <f>_value, <f>_attr ...`` via a pivot on the fixed list.
    """
    one = attr.where((F.col(KEY) == F.lit(stay)) & F.col("feature").isin(list(features)))
    aggs = []
    for f in features:
        aggs.append(F.first(F.when(F.col("feature") == f, F.col(value)), ignorenulls=True).alias(f + "_value"))
        aggs.append(F.first(F.when(F.col("feature") == f, F.col(attribution)), ignorenulls=True)
                    .alias(f + "_attr"))
    return one.groupBy("time").agg(*aggs)
