"""Hourly resampling, forward fill and recency masks (inventory E1-E18, D9/E10).

Data stays in long form ``(stay, time, feature, value, mask)`` end to end; a
wide matrix is produced only at a sink (:func:`to_wide`).

Partitioning plan of the encoding:

1. windowed events are hash-partitioned once on ``(stay, hour, feature)``; the
   per-source minute means are formed there and written once.  The fit and the
   encoding both start from them, so the events are read once for both.  A
   very long stay is spread over its hours, so one hot stay is not one task.
2. the sparse hourly observations become one ordered array per ``(stay,
   feature)``, joined with the stay's range of hours; these arrays give the
   fill/decay runs, and ``explode(sequence(...))`` turns runs into hours.  The
   dense grid - the largest table by far - is generated in place: never
   shuffled, sorted or joined (see :func:`run_arrays`).  All hours and features of
   a stay are made by one task, and a task makes about ``CELLS`` cells, so that what
   groups the grid by stay or hour needs no further exchange and bounded memory.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators.joins import cross_scalar
from hourglass.sources.io import checkpoint
KEY = "stay"
#: Cells (stay, hour, feature) that a task makes, about: their number sets the number of tasks, for a few
#: megabytes of runs become very many cells.
CELLS = 1 << 21


def _by_stay(df: DataFrame, tasks: int) -> DataFrame:
    return df.repartition(tasks, KEY)


def _tasks(bounds: DataFrame, first: str, last: str, n_features: int) -> int:
    """Tasks of about ``CELLS`` cells each for the hours ``first`` to ``last`` of every stay."""
    hours = bounds.agg(F.sum(F.col(last) - F.col(first) + F.lit(1))).first()[0] or 0
    return max(1, math.ceil(hours * n_features / CELLS))


# ----------------------------------------------------------------- windowing
def window_events_ts(events: DataFrame, stays: DataFrame, lookback_min: int = 1440,
                     ts_col: str = "ts", keep: Sequence[str] = ()) -> DataFrame:
    """B6 + C3: attach minute offsets from admission and keep the stay window.

    ``offset_min = floor((ts - admit_ts) / 1 min)`` and the row is kept when
    ``-lookback_min <= offset_min <= discharge_offset`` (row-specific upper
    bound, evaluated as a residual of the equi-join on ``stay``).  ``keep`` names
    per-stay columns of ``stays`` to carry along (e.g. the admission hour).
    """
    s = stays.select(KEY, "admit_ts", "discharge_offset", *keep)
    j = events.join(s, KEY, "inner")
    off = H.minutes_between(F.col("admit_ts"), F.col(ts_col))
    return (j.withColumn("offset_min", off)
             .where((F.col("offset_min") >= -lookback_min)
                    & (F.col("offset_min") <= F.col("discharge_offset")))
             .drop("admit_ts", "discharge_offset"))


# ----------------------------------------------------------------- scaling
def scale_clip(df: DataFrame, quantiles: DataFrame, value: str = "value",
               by: Sequence[str] = ("feature",), clip: float | None = 4.0) -> DataFrame:
    """``2 * (x - q_lo) / (q_hi - q_lo) - 1`` then clip to ``[-clip, clip]``.

    The quantile table has one row per feature.  A constant feature (q_hi = q_lo)
    follows pandas: sign * clip, and 0/0 -> NULL.  Rows whose scaled value is
    NULL are dropped (pandas treats NaN as "not observed").
    """
    q = quantiles
    x = H.scale_between(F.col(value), F.col("q_lo"), F.col("q_hi"))
    if clip is not None:
        x = H.clip(x, -clip, clip)
    out = df.join(q, list(by), "inner").withColumn(value, x).drop("q_lo", "q_hi")
    return out.where(F.col(value).isNotNull())


# ----------------------------------------------------------------- resampling
def hourly_mean(df: DataFrame, value: str = "value") -> DataFrame:
    """E1 + E2: minute offset -> ceiling hour, then mean per (stay, hour, feature)."""
    return (df.withColumn("time", H.hour_ceil("offset_min"))
              .groupBy(KEY, "time", "feature").agg(F.avg(value).alias(value)))


def stay_hour_range(hourly: DataFrame, max_hour: int | None = None) -> DataFrame:
    """E3 helper: first and last observed hour per stay over *all* features.

    With ``max_hour`` the upper end is clipped to ``max_hour`` (fill and mask
    only look backwards, so hours beyond the horizon never influence kept
    hours).
    """
    r = hourly.groupBy(KEY).agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    if max_hour is not None:
        r = r.withColumn("hi", F.least(F.col("hi"), F.lit(int(max_hour))))
    return r.where(F.col("lo") <= F.col("hi"))


MAX_VOCAB = 100_000


def vocabulary(vocab: DataFrame, max_features: int = MAX_VOCAB) -> list[str]:
    """The feature names of a vocabulary table, size-checked before collecting."""
    rows = vocab.select("feature").distinct().limit(max_features + 1).collect()
    if len(rows) > max_features:
        raise ValueError(f"vocabulary has more than {max_features} features")
    return sorted(r.feature for r in rows)


def dense_grid(hourly: DataFrame, vocab: DataFrame, max_hour: int | None = None,
               value: str = "value") -> DataFrame:
    """Every hour from the stay's first to last hour, for every feature.

    Returns the *tagged* grid used by :func:`fill_and_mask`: one row per
    (stay, feature, hour) with ``tag = 0`` and a NULL value, plus one row per
    observed hourly value with ``tag = 1``.  Both kinds travel as small rows
    (an hour range or a single hour) through one exchange on ``stay``, into as many
    tasks as the cells need; the hours are expanded only after it, so the dense
    grid is never shuffled and what follows by stay, hour or feature needs no further
    exchange.  (A join on ``(stay, feature, hour)`` would re-shuffle the
    expanded grid on all three keys.)  The encoding pipeline itself uses the
    cheaper :func:`stay_runs`.
    """
    rng = checkpoint(stay_hour_range(hourly, max_hour))
    names = vocabulary(vocab)
    feats = F.array(*[F.lit(f) for f in names])
    pairs = rng.select(KEY, "lo", "hi", F.explode(feats).alias("feature"))
    grid_rows = pairs.select(KEY, "feature", F.col("lo").alias("_start"), F.col("hi").alias("_end"),
                             F.lit(None).cast("double").alias(value), F.lit(0).alias("tag"))
    obs = hourly.where(F.col(value).isNotNull())
    if max_hour is not None:
        obs = obs.where(F.col("time") <= int(max_hour))
    obs_rows = obs.select(KEY, "feature", F.col("time").alias("_start"), F.col("time").alias("_end"),
                          F.col(value).cast("double").alias(value), F.lit(1).alias("tag"))
    both = _by_stay(grid_rows.unionByName(obs_rows), _tasks(rng, "lo", "hi", len(names)))
    return both.select(KEY, "feature", F.explode(F.sequence("_start", "_end")).alias("time"), value, "tag")


def fill_and_mask(grid: DataFrame, value: str = "value", decay: bool = True,
                  decay_rate: float = 4.0 / 3.0) -> DataFrame:
    """E4 + E6/E7/E8: per-stay forward fill and observation mask, one sort.

    Input is the tagged grid of :func:`dense_grid` (an untagged grid with
    NULLs for unobserved cells also works).  Within ``(stay, feature)`` rows
    are ordered by hour with the observation row before the grid row of the
    same hour, so each grid row sees the value observed in its own hour.

    * ``mask`` (decay): 0 before the first observation, 1 in an observed
      hour, ``1 / (k * decay_rate)`` k hours after the last observation.
    * ``mask`` (binary, ``decay=False``): 1 if observed in this hour else 0.
    * ``value``: last observed value carried forward within the same stay
      and feature (never across stays), NULL before the first observation.
    """
    g = grid if "tag" in grid.columns else grid.select(
        "*", F.lit(0).alias("tag"))
    if "tag" not in grid.columns:
        # untagged input: every row is a grid row carrying its own observation
        obs_time = F.when(F.col(value).isNotNull(), F.col("time"))
    else:
        obs_time = F.when(F.col("tag") == 1, F.col("time"))
    w = (Window.partitionBy(KEY, "feature").orderBy(F.col("time"), F.col("tag").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_obs = F.last(obs_time, ignorenulls=True).over(w)
    filled = F.last(F.col(value), ignorenulls=True).over(w)
    out = g.select(KEY, "time", "feature", "tag", filled.alias("_v"), last_obs.alias("_last_obs"))
    out = out.where(F.col("tag") == 0)
    k = F.col("time") - F.col("_last_obs")
    if decay:
        mask = (F.when(F.col("_last_obs").isNull(), F.lit(0.0))
                 .when(k == 0, F.lit(1.0))
                 .otherwise(F.lit(1.0) / (k.cast("double") * F.lit(float(decay_rate)))))
    else:
        mask = F.when(k == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return out.select(KEY, "time", "feature", F.col("_v").alias(value), mask.alias("mask"))


def since_last_observation(grid: DataFrame, value: str = "value") -> DataFrame:
    """Hours since the last observation (NULL before the first one)."""
    w = (Window.partitionBy(KEY, "feature").orderBy("time")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_obs = F.last(F.when(F.col(value).isNotNull(), F.col("time")), ignorenulls=True).over(w)
    return grid.withColumn("hours_since_obs", F.col("time") - last_obs)


def zero_fill(grid: DataFrame, value: str = "value") -> DataFrame:
    """E5: remaining NULL values -> 0."""
    return grid.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def stay_bounds(hourly: DataFrame, max_hour: int | None = None, min_time: int | None = 1, carry: Sequence[str] = ()) -> DataFrame:
    """``(stay, first_time, last_time)`` of the kept hours, from all hours with a value."""
    hi = F.max("time") if max_hour is None else F.least(F.max("time"), F.lit(int(max_hour)))
    lo = F.min("time") if min_time is None else F.greatest(F.min("time"), F.lit(int(min_time)))
    bounds = hourly.groupBy(KEY, *carry).agg(lo.cast("long").alias("first_time"), hi.cast("long").alias("last_time"))
    return bounds.where(F.col("first_time") <= F.col("last_time"))


def run_arrays(hourly: DataFrame, vocab: DataFrame, max_hour: int | None = None, min_time: int | None = 1,
               value: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """E3 + E4 sparsely: the runs of hours in which a stay's feature keeps its value, one row per (stay, feature).

    For each (stay, feature) the observed hours ``h_1 < ... < h_m`` split the
    stay's hour range ``[lo, hi]`` into runs: ``[lo, h_1 - 1]`` (unobserved:
    value and ``_obs`` NULL) and ``[h_i, h_{i+1} - 1]`` (value ``v_i``, observed
    at ``_obs = h_i``); features never observed in the stay get one unobserved
    run ``[lo, hi]``.  Output ``(stay, feature, first_time, last_time, _runs)``, the
    runs an array of ``(_start, _end, _obs, value)`` in order of time, and the
    per-stay constants ``carry``.

    The range of every stay (one row, by partial aggregates) meets the vocabulary; these (stay, feature)
    rows and the hourly observations are dealt by stay together, into as many tasks as the cells need, and
    gathered by (stay, feature) in place, the observations in order of time.  A stay has one observation per
    hour and feature at most; a feature that it lacks has none.  Hours below ``min_time`` and beyond ``max_hour`` are left out; the latter do not enter the arrays.
    """
    cw = list(carry)
    t, v = F.col("time"), F.col(value).cast("double")
    obs = hourly.where(v.isNotNull())
    names = vocab.agg(F.array_sort(F.collect_set("feature")).alias("_names"))  # one row
    bounds = checkpoint(stay_bounds(obs, max_hour, min_time, cw))
    tasks = _tasks(bounds, "first_time", "last_time", vocab.select("feature").distinct().count())
    bound = F.struct(*cw, "first_time", "last_time")
    pairs = cross_scalar(bounds, names).select(KEY, F.explode("_names").alias("feature"), bound.alias("_b"))
    seen = obs.where(F.col(KEY).isNotNull())
    seen = (seen if max_hour is None else seen.where(t <= int(max_hour))).select(
        KEY, "feature", F.struct(t.cast("long").alias("t"), v.alias("v")).alias("_o"))
    both = _by_stay(pairs.unionByName(seen, allowMissingColumns=True), tasks).groupBy(KEY, "feature").agg(
        F.collect_list("_b").alias("_b"), F.array_sort(F.collect_list("_o")).alias("_o"))
    j = both.select(KEY, "feature", F.explode("_b").alias("_b"), F.when(F.size("_o") > 0, F.col("_o")).alias("_o")).select(
        KEY, "feature", "_b.*", "_o")

    first, last = F.col("first_time"), F.col("last_time")
    nothing = F.struct(first.alias("_start"), last.alias("_end"), F.lit(None).cast("long").alias("_obs"),
                       F.lit(None).cast("double").alias(value))
    lead = F.struct(first.alias("_start"), (F.get("_o", F.lit(0))["t"] - 1).alias("_end"),
                    F.lit(None).cast("long").alias("_obs"), F.lit(None).cast("double").alias(value))
    own = F.transform("_o", lambda x, i: F.struct(
        F.greatest(x["t"], first).alias("_start"), F.coalesce(F.get("_o", i + 1)["t"] - 1, last).alias("_end"),
        x["t"].alias("_obs"), x["v"].alias(value)))
    runs = F.when(F.col("_o").isNull(), F.array(nothing)).otherwise(F.concat(F.array(lead), own))
    # a leading run before the first hour and runs before ``min_time`` are empty
    runs = F.filter(runs, lambda x: x["_start"] <= x["_end"])
    return j.select(KEY, *cw, "first_time", "last_time", "feature", runs.alias("_runs"))


def stay_runs(hourly: DataFrame, vocab: DataFrame, max_hour: int | None = None, min_time: int | None = 1,
              value: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """One row per run of :func:`run_arrays`: ``(stay, feature, _start, _end, _obs, value, first_time, last_time)``."""
    runs = run_arrays(hourly, vocab, max_hour, min_time, value, carry)
    return runs.select(*[c for c in runs.columns if c != "_runs"], F.inline("_runs"))


def run_mask(hour, obs, decay: bool = True, decay_rate: float = 4.0 / 3.0):
    """Mask of an hour in a run observed at ``obs`` (NULL: never yet)."""
    k = hour - obs
    later = F.lit(1.0) / (k.cast("double") * F.lit(float(decay_rate))) if decay else F.lit(0.0)
    return F.when(obs.isNull(), F.lit(0.0)).when(k == 0, F.lit(1.0)).otherwise(later)


def resample_and_mask(hourly: DataFrame, vocab: DataFrame, decay: bool = True,
                      decay_rate: float = 4.0 / 3.0, horizon: int | None = 24 * 14,
                      carry: Sequence[str] = (), bounds: bool = False) -> DataFrame:
    """Dense grid -> fill + mask -> horizon clip -> positive time -> zero fill.

    ``explode(sequence(start, end))`` turns the runs of :func:`stay_runs` into
    hours in place: the dense grid is never shuffled, sorted or joined, and the
    per-stay constants ``carry`` (with ``bounds`` also the stay's ``first_time`` and
    ``last_time``) are copied onto every row.
    """
    max_hour = None if horizon is None else horizon - 1
    runs = stay_runs(hourly, vocab, max_hour=max_hour, carry=carry)
    kept = [*carry, *(["first_time", "last_time"] if bounds else [])]
    out = runs.select(KEY, "feature", F.explode(F.sequence("_start", "_end")).alias("time"), "value", "_obs", *kept)
    mask = run_mask(F.col("time"), F.col("_obs"), decay, decay_rate)
    return zero_fill(out.select(KEY, "time", "feature", "value", mask.alias("mask"), *kept))


def time_of_day(grid: DataFrame, admit_hour: DataFrame, hour_col: str = "hour") -> DataFrame:
    """``hour = pmod(time + admission hour, 24) / 23`` (inner join on stay)."""
    a = admit_hour.select(KEY, F.col(hour_col).alias("_admit_hour"))
    return (grid.join(a, KEY, "inner")
                .withColumn("hour", H.cyclic_unit(F.col("time") + F.col("_admit_hour"), 24))
                .drop("_admit_hour"))


def to_wide(grid: DataFrame, features: Sequence[str], keys: Sequence[str] = (KEY, "time"),
            extra: Sequence[str] = ("hour",)) -> DataFrame:
    """Sink: long grid -> ``stay, time, f1..fF, f1_mask..fF_mask, hour``.

    ``features`` is the (small, collected) vocabulary, so the pivot needs no
    extra distinct job and the column order is fixed.  A grid of :func:`resample_and_mask` has the
    hours of a stay in one task already and is pivoted in place; any other is exchanged by the keys.
    """
    feats = list(features)
    agg = [F.first(F.when(F.col("feature") == f, F.col("value")), ignorenulls=True).alias(f)
           for f in feats]
    agg += [F.first(F.when(F.col("feature") == f, F.col("mask")), ignorenulls=True).alias(f + "_mask")
            for f in feats]
    agg += [F.first(e).alias(e) for e in extra if e in grid.columns]
    return grid.groupBy(*keys).agg(*agg)


# ----------------------------------------------------------------- composite
def source_minute_mean(windowed: DataFrame, extra_keys: Sequence[str] = (), main_source: str | None = None) -> DataFrame:
    """D6 per source: mean per (stay, minute, feature, source); adds ``time``.

    Rows of ``main_source`` count as present without a value too, so theirs are kept (with a NULL mean).
    """
    has = F.col("value").isNotNull() if main_source is None else F.col("value").isNotNull() | (F.col("source") == main_source)
    ev = windowed.where(has).withColumn("time", H.hour_ceil("offset_min"))
    return ev.repartition(KEY, "time", "feature").groupBy(
        KEY, "time", "offset_min", "feature", "source", *extra_keys).agg(F.avg("value").alias("value"))


def main_source_stays(minutes: DataFrame, main_source: str) -> DataFrame:
    """The stays with any row of the main source, from the written minute means (no further read of
    the events); the others are not encoded, whatever their other sources hold."""
    return minutes.where(F.col("source") == main_source).select(KEY).distinct()


def fit_vocabulary(minutes: DataFrame, cohort: DataFrame, min_frac: float, always: Sequence[str] = ()) -> DataFrame:
    """``(feature, n_stays)`` of the features that more than ``min_frac`` of the cohort's stays have,
    and of those ``always`` taken."""
    cov = minutes.groupBy("feature").agg(F.count_distinct(KEY).cast("long").alias("n_stays"))
    total = cohort.agg(F.count_distinct(KEY).cast("long").alias("n_cohort"))
    return (cross_scalar(cov, total)
               .where((F.col("n_stays") > F.col("n_cohort") * F.lit(float(min_frac))) | F.col("feature").isin(list(always)))
               .select("feature", "n_stays"))


def fit_series(minutes: DataFrame, cohort: DataFrame, min_frac: float,
               probs: Sequence[float] = (0.05, 0.95), accuracy: int | None = None,
               fit_stays: DataFrame | None = None, always: Sequence[str] = ()) -> DataFrame:
    """D1 + D9: common features with their scaling quantiles ``(feature, n_stays, q_lo, q_hi)``.

    ``minutes`` is the materialised output of :func:`source_minute_mean` over
    the cohort's windows (what the reference stacks before fitting); quantiles
    are restricted to ``fit_stays`` when given.  One row per common feature; the
    columns of wide sources (``always``) are features whatever their coverage.
    """
    from hourglass.operators.aggregates import fit_quantiles

    minutes = minutes.where(F.col("value").isNotNull())
    vocab = checkpoint(fit_vocabulary(minutes, cohort, min_frac, always))
    fit_rows = minutes if fit_stays is None else minutes.join(fit_stays.select(KEY), KEY, "left_semi")
    q = fit_quantiles(fit_rows.join(vocab.select("feature"), "feature", "left_semi"),
                      "value", ("feature",), probs, accuracy, stored=fit_stays is None)
    return vocab.join(q, "feature", "left")


def hourly_observations(minutes: DataFrame, stats: DataFrame, clip: float | None = 4.0,
                        carry: Sequence[str] = ()) -> DataFrame:
    """E10 + D6 + E2 on per-source minute means: scale, mean over sources, mean per hour.

    One join both restricts to the vocabulary and attaches the quantiles; the
    minute means are partitioned by (stay, hour, feature) already, and every
    mean groups on a superset of these keys.
    """
    cw = list(carry)
    x = H.scale_between(F.col("value"), F.col("q_lo"), F.col("q_hi"))
    if clip is not None:
        x = H.clip(x, -clip, clip)
    scaled = minutes.join(stats.select("feature", "q_lo", "q_hi"), "feature", "inner").select(
        KEY, "time", "offset_min", "feature", x.alias("value"), *cw).where(F.col("value").isNotNull())
    minute = scaled.groupBy(KEY, "time", "offset_min", "feature", *cw).agg(F.avg("value").alias("value"))
    return minute.groupBy(KEY, "time", "feature", *cw).agg(F.avg("value").alias("value"))


def encode_events(windowed: DataFrame, stats: DataFrame, horizon: int | None = 24 * 14,
                  decay: bool = True, decay_rate: float = 4.0 / 3.0,
                  clip: float | None = 4.0, carry: Sequence[str] = ()) -> DataFrame:
    """I13 core on windowed events ``(stay, offset_min, feature, value, source)``.

    ``stats`` is the output of :func:`fit_series` (vocabulary + quantiles).
    Output ``(stay, time, feature, value, mask)`` plus ``carry`` (per-stay
    constants riding along in the grouping keys).
    """
    hourly = hourly_observations(source_minute_mean(windowed, carry), stats, clip, carry)
    return resample_and_mask(hourly, stats, decay=decay, decay_rate=decay_rate, horizon=horizon, carry=carry)


# ----------------------------------------------------------------- per-stay positions
def stay_hours(hourly: DataFrame, horizon: int | None = 24 * 14, min_time: int = 1) -> DataFrame:
    """Every hour of the dense grid once, ``(stay, time, first_time, last_time)``, from the stays'
    first and last observed hour: no feature is expanded."""
    r = stay_hour_range(hourly.where(F.col("value").isNotNull()), None if horizon is None else horizon - 1)
    r = r.select(KEY, F.greatest("lo", F.lit(min_time)).cast("long").alias("first_time"), F.col("hi").cast("long").alias("last_time"))
    r = r.where(F.col("first_time") <= F.col("last_time"))
    return r.select(KEY, F.explode(F.sequence("first_time", "last_time")).alias("time"), "first_time", "last_time")


def seq_length(grid: DataFrame) -> DataFrame:
    """Rows (distinct hours) per stay."""
    return grid.select(KEY, "time").distinct().groupBy(KEY).agg(
        F.count(F.lit(1)).cast("long").alias("length"))


def row_position(grid: DataFrame, order_col: str = "time") -> DataFrame:
    """0-based row position of each hour within its stay.

    ``time - first_time`` on hours with the stay's bounds (:func:`stay_hours`);
    otherwise ``dense_rank - 1`` over the stay's hours.
    """
    if "first_time" in grid.columns and order_col == "time":
        return grid.withColumn("pos", (F.col("time") - F.col("first_time")).cast("long"))
    w = Window.partitionBy(KEY).orderBy(order_col)
    return grid.withColumn("pos", (F.dense_rank().over(w) - 1).cast("long"))


def skip_first_rows(grid: DataFrame, n: int = 5) -> DataFrame:
    """Drop the first ``n`` *rows* of each stay (row position, not hour)."""
    return row_position(grid).where(F.col("pos") >= n)


def remaining_los(grid: DataFrame, labels: DataFrame, los_col: str = "los_days",
                  floor_days: float = 1.0 / 48.0) -> DataFrame:
    """``max(los - time / 24, floor_days)`` for every row."""
    l = labels.select(KEY, F.col(los_col).alias("_los"))
    return (grid.join(l, KEY, "inner")
                .withColumn("los_remaining",
                            F.greatest(F.col("_los") - F.col("time") / F.lit(24.0), F.lit(floor_days)))
                .drop("_los"))


def repeat_label(grid: DataFrame, labels: DataFrame, col: str = "mortality") -> DataFrame:
    """Static label repeated on every row of the stay."""
    return grid.join(labels.select(KEY, col), KEY, "inner")


def at_time_index(grid: DataFrame, index: int = 24, skip: int = 5) -> DataFrame:
    """The row at trimmed position ``index`` (raw position ``index + skip``)."""
    return row_position(grid).where(F.col("pos") == index + skip)


def assign_chunk(stays: DataFrame, size: int = 1000) -> DataFrame:
    """Consecutive groups of ``size`` stays in key order.

    Computed on the distinct-stay table only, with a distributed global rank
    (no single-partition window), never on the events.
    """
    from hourglass.operators.split import global_rank

    ids = global_rank(stays.select(KEY).distinct(), [F.col(KEY)], "_r")
    return ids.select(KEY, F.floor((F.col("_r") - 1) / F.lit(size)).cast("long").alias("chunk"))
