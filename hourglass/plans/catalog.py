"""Query catalogue: one named Spark query per inventory operator.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables; ``hourglass.plans.oracle.ORACLE`` holds the matching DuckDB
SQL under the same name.  Computed columns carry explicit aliases and
doubles are rounded to 6 decimals so both sides compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators import aggregates as D
from hourglass.operators import filters as B
from hourglass.operators import timeseries as E
from hourglass.plans import series
from hourglass.sources import driver
from hourglass.sources.io import checkpoint

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def r6(col, alias: str | None = None):
    c = F.col(col) if isinstance(col, str) else col
    # half away from zero at 6 decimals with plain double arithmetic (identical in the
    # oracle SQL); Spark's round() goes through BigDecimal and is several times slower
    x = c.cast("double")
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
    out = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)  # -0.0 -> 0.0
    return out.alias(alias if alias is not None else (col if isinstance(col, str) else "value"))


# ------------------------------------------------------------------ series group
@query("cohort_select")
def q_cohort_select(spark, d):
    st = series.cohort(spark, d)
    return st.select("stay", "person", r6("los_days"), "discharge_offset", "age", "mortality",
                     "discharge_location")


@query("time_window_join")
def q_time_window_join(spark, d):
    st = series.cohort(spark, d)
    ev = series.windowed_events(spark, d, st)
    return ev.select("stay", "offset_min", "feature", r6("value"), "source")


@query("common_features")
def q_common_features(spark, d):
    st = series.cohort(spark, d)
    return series.series_vocabulary(spark, d, st)


@query("common_features_dense")
def q_common_features_dense(spark, d):
    st = series.cohort(spark, d)
    ev = series.windowed_events(spark, d, st)
    out = D.common_features_dense(ev, st, min_frac=0.6, min_avg_obs=1.3)
    return out.select("feature", "n_stays", r6("avg_obs"))


@query("minute_mean")
def q_minute_mean(spark, d):
    st = series.cohort(spark, d)
    ev = series.windowed_events(spark, d, st, sources=("events", "props"))
    src = D.dedupe_mean(ev.where(F.col("value").isNotNull()),
                        ["stay", "offset_min", "feature", "source"])
    out = src.groupBy("stay", "offset_min", "feature").agg(
        F.avg("value").alias("value"), F.count(F.lit(1)).cast("long").alias("n_sources"))
    return out.select("stay", "offset_min", "feature", r6("value"), "n_sources")


@query("quantile_fit")
def q_quantile_fit(spark, d):
    st = series.cohort(spark, d)
    stats = series.series_stats(spark, d, st)
    return stats.select("feature", "n_stays", r6("q_lo"), r6("q_hi"))


@query("scale_clip")
def q_scale_clip(spark, d):
    st = series.cohort(spark, d)
    src = series.minute_means(spark, d, st)
    stats = E.fit_series(src, st, series.MIN_FRAC, series.QUANTILES)
    out = E.scale_clip(src, stats.select("feature", "q_lo", "q_hi"), clip=series.CLIP)
    return out.select("stay", "offset_min", "feature", "source", r6("value"))


def _hourly(spark, d, sources=("events",)):
    st = series.cohort(spark, d)
    src = series.minute_means(spark, d, st, sources)
    stats = checkpoint(E.fit_series(src, st, series.MIN_FRAC, series.QUANTILES))
    scaled = E.scale_clip(src, stats.select("feature", "q_lo", "q_hi"), clip=series.CLIP)
    minute = D.dedupe_mean(scaled, ["stay", "offset_min", "feature"])
    return E.hourly_mean(minute), stats


@query("hourly_mean")
def q_hourly_mean(spark, d):
    hourly, _ = _hourly(spark, d)
    return hourly.select("stay", "time", "feature", r6("value"))


@query("dense_grid")
def q_dense_grid(spark, d):
    hourly, stats = _hourly(spark, d)
    grid = E.dense_grid(hourly, stats, max_hour=series.HORIZON_HOURS - 1)
    return grid.groupBy("stay", "time").agg(
        F.count(F.when(F.col("tag") == 0, 1)).cast("long").alias("n_features"),
        F.count(F.when(F.col("tag") == 1, 1)).cast("long").alias("n_observed"))


def _encoded(spark, d, **kw):
    g = series.encode_timeseries(spark, d, **kw)
    return g


@query("encode_timeseries")
def q_encode_timeseries(spark, d):
    g = _encoded(spark, d)
    return g.select("stay", "time", "feature", r6("value"), r6("mask"), r6("hour"))


@query("encode_two_sources")
def q_encode_two_sources(spark, d):
    g = _encoded(spark, d, sources=("events", "props"))
    return g.select("stay", "time", "feature", r6("value"), r6("mask"), r6("hour"))


@query("encode_main_source")
def q_encode_main_source(spark, d):
    """Two long sources; only stays with rows of the main one."""
    g = _encoded(spark, d, sources=("events", "alarms"), main_source="alarms")
    return g.select("stay", "time", "feature", r6("value"), r6("mask"), r6("hour"))


@query("encode_wide_source")
def q_encode_wide_source(spark, d):
    """E11 + I13: a wide source, unpivoted and stacked with the long one in one scan, is the main one."""
    g = _encoded(spark, d, sources=("events", "monitor"), main_source="monitor")
    return g.select("stay", "time", "feature", r6("value"), r6("mask"), r6("hour"))


@query("forward_fill")
def q_forward_fill(spark, d):
    return _encoded(spark, d).select("stay", "time", "feature", r6("value"))


@query("decay_mask")
def q_decay_mask(spark, d):
    return _encoded(spark, d).select("stay", "time", "feature", r6("mask"))


@query("binary_mask")
def q_binary_mask(spark, d):
    return _encoded(spark, d, decay=False).select("stay", "time", "feature", r6("mask"))


@query("time_of_day")
def q_time_of_day(spark, d):
    return _encoded(spark, d).select("stay", "time", r6("hour")).distinct()


@query("stays_with_series")
def q_stays_with_series(spark, d):
    st = series.cohort(spark, d)
    ev = series.windowed_events(spark, d, st, sources=("events", "props"))
    return B.stays_with_series([ev.where(F.col("source") == "events"),
                                ev.where(F.col("source") == "props")])


EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


@query("coverage_by_column")
def q_coverage_by_column(spark, d):
    st = series.cohort(spark, d)
    ev = series.windowed_events(spark, d, st)
    wide = ev.select("stay", "offset_min", *[
        F.when(F.col("feature").startswith(t + "_"), F.col("value")).alias(t) for t in EVENT_TYPES])
    return B.coverage_by_column(wide, list(EVENT_TYPES), before=1440)


# ------------------------------------------------------------------ static group
from hourglass.operators import static as I  # noqa: E402
from hourglass.plans import flat as P  # noqa: E402


@query("star_join")
def q_star_join(spark, d):
    f = driver.flat(spark, d)
    return f.select("stay", "gender", "teachingstatus", "nation", "region", "segment", "age",
                    r6("height"), r6("weight"), F.col("hour").cast("long").alias("hour"),
                    r6("balance_after_24h")).dropDuplicates()


@query("collapse_rare")
def q_collapse_rare(spark, d):
    return I.collapse_rare(P.flat_for_series(spark, d), "nation", P.MIN_COUNT).select("stay", "nation")


@query("value_counts")
def q_value_counts(spark, d):
    return D.value_counts(P.flat_for_series(spark, d), "segment")


@query("one_hot")
def q_one_hot(spark, d):
    base = P.flat_for_series(spark, d).select("stay", "region", "segment")
    return P.melt(I.one_hot(base, ["region", "segment"]))


@query("one_hot_long")
def q_one_hot_long(spark, d):
    base = P.flat_for_series(spark, d)
    return I.one_hot_long(base, ["nation"]).select("stay", "feature", F.col("value").cast("double").alias("value"))


@query("standardise")
def q_standardise(spark, d):
    base = P.flat_for_series(spark, d).select("stay", "height")
    return I.standardise(base, "height").select("stay", r6("height"))


@query("quantile_scale")
def q_quantile_scale(spark, d):
    base = P.flat_for_series(spark, d).select("stay", "weight", "hour")
    return I.quantile_scale(base, ["weight", "hour"]).select("stay", r6("weight"), r6("hour"))


@query("impute_indicator")
def q_impute_indicator(spark, d):
    base = P.flat_for_series(spark, d).select("stay", "weight")
    return I.impute_with_indicator(base, "weight", "nullweight").select("stay", r6("weight"), "nullweight")


@query("age_parse")
def q_age_parse(spark, d):
    from hourglass.functions import scalar as H

    st = driver.stays(spark, d)
    filled = F.coalesce(F.nullif(F.col("age"), F.lit("")), F.lit("63"))
    return st.select("stay", H.age_int("age").alias("age_int"),
                     H.contains_flag(filled, "> 89").alias("over89"),
                     r6(H.age_float(filled), "age_float"))


@query("encode_flat")
def q_encode_flat(spark, d):
    return P.melt(P.encoded_flat(spark, d)).select("stay", "feature", r6("value"))


@query("encode_labels")
def q_encode_labels(spark, d):
    return P.melt(P.encoded_labels(spark, d)).select("stay", "feature", r6("value"))


@query("describe")
def q_describe(spark, d):
    out = D.describe(series.cohort(spark, d), "los_days")
    return out.select("count", *[r6(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("describe_categorical")
def q_describe_categorical(spark, d):
    return D.describe_categorical(P.flat_for_series(spark, d), "segment")


@query("histogram")
def q_histogram(spark, d):
    return D.histogram(series.cohort(spark, d), "los_days", D.los_histogram_edges())


@query("mean_median")
def q_mean_median(spark, d):
    out = D.mean_median(series.cohort(spark, d), "los_days")
    return out.select(r6("mean"), r6("median"))


# ------------------------------------------------------------------ codes group
from hourglass.operators import codes as C  # noqa: E402


def _code_pairs(spark, d, stays=None):
    st = series.cohort(spark, d) if stays is None else stays
    return C.code_union(list(driver.code_sources(spark, d, st).values()))


@query("code_union")
def q_code_union(spark, d):
    return _code_pairs(spark, d)


@query("prefix_family")
def q_prefix_family(spark, d):
    return _code_pairs(spark, d).select("path", B.prefix_family("path").alias("family")).distinct()


@query("code_prefixes")
def q_code_prefixes(spark, d):
    stay_codes, _ = C.code_prefixes(_code_pairs(spark, d))
    return stay_codes


@query("code_prevalence")
def q_code_prevalence(spark, d):
    stay_codes, _ = C.code_prefixes(_code_pairs(spark, d))
    return C.code_prevalence(stay_codes)


@query("pointless_codes")
def q_pointless_codes(spark, d):
    _, smap = C.code_prefixes(_code_pairs(spark, d))
    return C.pointless_codes(smap)


@query("rare_codes")
def q_rare_codes(spark, d):
    pairs = _code_pairs(spark, d)
    stay_codes, _ = C.code_prefixes(pairs)
    n = pairs.agg(F.count_distinct("stay").cast("long").alias("n"))
    return C.rare_codes(stay_codes, n, 0.01)


def _kept_codes(spark, d, stays=None, in_series=None):
    st = series.cohort(spark, d) if stays is None else stays
    return C.encode_codes(_code_pairs(spark, d, st), P.series_stays(spark, d, st) if in_series is None else in_series, 0.01)


@query("encode_codes")
def q_encode_codes(spark, d):
    return _kept_codes(spark, d)


@query("codes_per_stay")
def q_codes_per_stay(spark, d):
    st = series.cohort(spark, d)
    in_series = P.series_stays(spark, d, st)
    return C.codes_per_stay(_kept_codes(spark, d, st, in_series), in_series)


@query("collect_codes")
def q_collect_codes(spark, d):
    return C.collect_codes(_kept_codes(spark, d)).select(
        "stay", F.array_join("codes", ";").alias("codes"))


@query("group_rare_category")
def q_group_rare_category(spark, d):
    base = P.flat_for_series(spark, d).select("stay", "nation")
    return I.group_rare_category(base, "nation", cut_off=5)


@query("merge_rare_columns")
def q_merge_rare_columns(spark, d):
    base = P.flat_for_series(spark, d)
    long = I.one_hot_long(base, ["nation"])
    nation = driver._t(spark, d, "nation")
    region = driver._t(spark, d, "region")
    mapping = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("nation_"), "n_name").alias("feature"),
        F.concat(F.lit("region_"), "r_name").alias("group"))
    out = C.merge_columns(long, mapping)
    return out.select("stay", "feature", F.col("value").cast("long").alias("value"))


# ------------------------------------------------------------------ split / sequence group
from hourglass.operators import sequences as K  # noqa: E402
from hourglass.operators import split as J  # noqa: E402

SEED = 9
BATCH_SIZE = 16


def _orders_stays(spark, d):
    return driver._t(spark, d, "orders").select(F.col("o_orderkey").alias("stay"),
                                                F.col("o_custkey").alias("person"))


@query("split_by_entity")
def q_split_by_entity(spark, d):
    return J.split_by_entity(_orders_stays(spark, d), "person", SEED).select("stay", "person", "split")


@query("shuffle_stays")
def q_shuffle_stays(spark, d):
    return J.shuffle_stays(series.cohort(spark, d), SEED)


@query("sample_stays")
def q_sample_stays(spark, d):
    return J.sample_stays(series.cohort(spark, d), 0.3, SEED)


@query("sample_tables")
def q_sample_tables(spark, d):
    sample = J.sample_stays(series.cohort(spark, d), 0.3, SEED)
    return J.apply_sample(P.flat_for_series(spark, d), sample).select("stay", "nation", "segment")


def _grid(spark, d):
    return series.encode_timeseries(spark, d)


def _runs(spark, d):
    """Runs of the encoded series and the feature names in array order."""
    runs, stats = series.series_runs(spark, d)
    return checkpoint(runs), E.vocabulary(stats)


def _cells(rows, feats, *keep):
    """One row per (row, feature) with its value and mask."""
    names = F.array(*[F.lit(f) for f in feats])
    out = rows.select(*keep, F.explode(F.arrays_zip(names.alias("feature"), F.col("values").alias("value"),
                                                    F.col("masks").alias("mask"))).alias("_c"))
    return out.select(*keep, "_c.feature", r6(F.col("_c.value"), "value"), r6(F.col("_c.mask"), "mask"))


def _labels01(spark, d, stays=None):
    st = series.cohort(spark, d) if stays is None else stays
    return st.select("stay", "los_days",
                     F.when(F.col("mortality") == "EXPIRED", 1).otherwise(0).alias("mortality"))


@query("seq_length")
def q_seq_length(spark, d):
    return E.seq_length(series.series_hours(spark, d))


@query("skip_first_rows")
def q_skip_first_rows(spark, d):
    return E.skip_first_rows(series.series_hours(spark, d), 5).select("stay", "time", "pos")


@query("remaining_los")
def q_remaining_los(spark, d):
    hours = E.skip_first_rows(series.series_hours(spark, d), 5)
    return E.remaining_los(hours, _labels01(spark, d)).select("stay", "time", r6("los_remaining"))


@query("mortality_at_index")
def q_mortality_at_index(spark, d):
    at = E.at_time_index(series.series_hours(spark, d), 24, 5)
    return E.repeat_label(at, _labels01(spark, d)).select("stay", "time", "mortality")


@query("assemble_sequences")
def q_assemble_sequences(spark, d):
    runs, feats = _runs(spark, d)
    rows = K.assemble_sequences(runs).select("stay", "length", F.posexplode("sequence").alias("_p", "_s"))
    rows = rows.select("stay", "length", F.col("_p").cast("long").alias("pos"), "_s.*").withColumn("hour", r6("hour"))
    return _cells(rows, feats, "stay", "length", "pos", "time", "hour")


def _batches(spark, d):
    return K.assign_batch(J.shuffle_stays(series.cohort(spark, d), SEED), BATCH_SIZE)


@query("assign_batch")
def q_assign_batch(spark, d):
    return _batches(spark, d)


def _padded(spark, d):
    runs, feats = _runs(spark, d)
    return K.pad_sequences(K.assemble_sequences(runs), K.padded_lengths(runs, _batches(spark, d))), feats


@query("pad_sequences")
def q_pad_sequences(spark, d):
    padded, feats = _padded(spark, d)
    rows = padded.select("stay", "batch", "length", "padded_length", F.posexplode("padded").alias("_p", "_s"))
    rows = rows.select("stay", "batch", "length", "padded_length", F.col("_p").cast("long").alias("pos"), r6(F.col("_s.time"), "time"),
                       r6(F.col("_s.hour"), "hour"), F.col("_s.valid").cast("int").alias("valid"), "_s.values", "_s.masks")
    return _cells(rows, feats, "stay", "batch", "length", "padded_length", "pos", "time", "hour", "valid")


def training_frame(spark, d):
    """K4 as a model reads it: one row per hour with arrays; and the feature names."""
    st = series.cohort(spark, d)
    in_series = P.series_stays(spark, d, st)
    runs, stats = series.series_runs(spark, d, st)
    runs = checkpoint(runs)  # counted, then laid out
    static = P.flat_for_series(spark, d, st, in_series).select("stay", "nation", "segment")
    codes = C.collect_codes(_kept_codes(spark, d, st, in_series))
    return K.training_rows(runs, _labels01(spark, d, st), static, codes), E.vocabulary(stats)


@query("training_rows")
def q_training_rows(spark, d):
    tr, feats = training_frame(spark, d)
    tr = tr.select("stay", "time", r6("hour"), "values", "masks", r6("los_remaining"), "mortality", "length_minus_skip",
                   "nation", "segment", F.size("codes").cast("long").alias("n_codes"), F.array_join("codes", ";").alias("codes"))
    return _cells(tr, feats, "stay", "time", "hour", "los_remaining", "mortality", "length_minus_skip", "nation", "segment",
                  "n_codes", "codes")


@query("fraction_of_batches")
def q_fraction_of_batches(spark, d):
    return J.fraction_of_batches(_batches(spark, d), 50.0)


# ------------------------------------------------------------------ metrics group
from hourglass.operators import metrics as L  # noqa: E402

REG_COLS = ("mad", "mse", "mape", "msle", "r2", "kappa")
CLS_COLS = ("accuracy", "prec0", "prec1", "rec0", "rec1", "f1_macro", "auroc", "auprc")


@query("regression_report")
def q_regression_report(spark, d):
    return L.regression_report(driver.los_predictions(spark, d)).select(*[r6(c) for c in REG_COLS])


@query("binned_confusion")
def q_binned_confusion(spark, d):
    return L.binned_confusion(driver.los_predictions(spark, d))


@query("linear_kappa")
def q_linear_kappa(spark, d):
    return L.linear_kappa(driver.los_predictions(spark, d)).select(r6("kappa"))


@query("binary_confusion")
def q_binary_confusion(spark, d):
    return L.binary_confusion(driver.risk_predictions(spark, d))


@query("auroc_auprc")
def q_auroc_auprc(spark, d):
    return L.auroc_auprc(driver.risk_predictions(spark, d)).select(r6("auroc"), r6("auprc"))


@query("classification_report")
def q_classification_report(spark, d):
    out = L.classification_report(driver.risk_predictions(spark, d))
    return out.select(*[r6(c) for c in CLS_COLS])


@query("sequence_msle_loss")
def q_sequence_msle_loss(spark, d):
    return L.sequence_loss(driver.los_predictions(spark, d), "stay", kind="msle",
                           sum_losses=True).select(r6("loss"))


@query("sequence_mse_loss")
def q_sequence_mse_loss(spark, d):
    return L.sequence_loss(driver.los_predictions(spark, d), "stay", kind="mse",
                           sum_losses=False).select(r6("loss"))


@query("bce_loss")
def q_bce_loss(spark, d):
    return L.bce(driver.risk_predictions(spark, d)).select(r6("bce"))


@query("multitask_loss")
def q_multitask_loss(spark, d):
    out = L.multitask_loss(driver.los_predictions(spark, d), driver.risk_predictions(spark, d), "stay")
    return out.select(r6("loss"), r6("bce"), r6("total"))


@query("mean_loss")
def q_mean_loss(spark, d):
    lp = driver.los_predictions(spark, d)
    batches = K.assign_batch(J.shuffle_stays(lp, SEED), BATCH_SIZE)
    out = L.mean_loss(lp.join(batches, "stay"), "batch", "stay")
    return out.select(r6("mean_loss"), "n_batches")


@query("constant_baseline")
def q_constant_baseline(spark, d):
    lp = J.split_by_entity(driver.los_predictions(spark, d), "stay", SEED)
    out = L.constant_baseline(lp.where(F.col("split") == "train"), lp.where(F.col("split") == "test"))
    return out.select("predictor", *[r6(c) for c in REG_COLS])


# ------------------------------------------------------------------ model-adjacent group
from hourglass.operators import attribution as M  # noqa: E402
from hourglass.operators import scoring as S  # noqa: E402

LAG_WEIGHTS = (0.5, 0.3, 0.2)
ATTR_HORIZON = 23   # first 23 hourly positions; stays with a row at position 23
LAG_DILATION = 2


def _attr(spark, d):
    """Stand-in attribution table: value x mask per grid cell."""
    return _with_attribution(series.encode_timeseries(spark, d, bounds=True))


def _with_attribution(g):
    return g.select("stay", "time", "feature", "value", (F.col("value") * F.col("mask")).alias("attribution"), "first_time", "last_time")


@query("causal_lag_features")
def q_causal_lag_features(spark, d):
    hourly, stats = series.hourly_series(spark, d)
    runs = E.run_arrays(hourly, stats, max_hour=series.HORIZON_HOURS - 1)
    out = M.causal_lag_series(runs, LAG_WEIGHTS, LAG_DILATION)
    return out.select("stay", "time", "feature", r6("conv"))


@query("attribution_summary")
def q_attribution_summary(spark, d):
    return M.attribution_summary(_attr(spark, d), ATTR_HORIZON, 25, 3.0).select("feature", r6("importance"))


@query("per_stay_attribution")
def q_per_stay_attribution(spark, d):
    return M.per_stay_attribution(_attr(spark, d), ATTR_HORIZON).select("stay", "feature", r6("mean_abs"))


@query("single_stay_profile")
def q_single_stay_profile(spark, d):
    hourly, stats = series.hourly_series(spark, d)
    length = F.col("last_time") - F.col("first_time")
    longest = E.stay_bounds(hourly, series.HORIZON_HOURS - 1).orderBy(length.desc(), "stay").first()  # the profiled stay
    top = longest["stay"] if longest else -1
    feats = E.vocabulary(stats)[:6]  # six features by name
    # only that stay and those features are encoded
    grid = E.resample_and_mask(hourly.where(F.col("stay") == top), stats.where(F.col("feature").isin(feats)),
                               decay_rate=series.DECAY_RATE, horizon=series.HORIZON_HOURS, bounds=True)
    a = _with_attribution(grid)
    w = M.single_stay_profile(a, top, feats)
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), r6(f"`{f}_value`", "value"),
                                        r6(f"`{f}_attr`", "attribution")) for f in feats]))
    return w.select("time", cell.alias("_c")).select("time", "_c.*")


@query("drop_zero_total_features")
def q_drop_zero_total_features(spark, d):
    per = M.per_stay_attribution(_attr(spark, d), ATTR_HORIZON)
    return B.drop_zero_total_features(per, value="mean_abs").select("stay", "feature", r6("mean_abs"))


def _score_fn():
    return S.linear_los_scorer(weight=0.01, bias=0.5)


@query("score_sequences")
def q_score_sequences(spark, d):
    rows = K.training_rows(_runs(spark, d)[0], _labels01(spark, d)).select("stay", "time", "values")
    scored = S.score_sequences(rows, _score_fn(), "stay long, time long, y_pred double")
    return scored.select("stay", "time", r6("y_pred"))


def _perm_frame(spark, d):
    li = driver._t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("x1"))
    od = driver._t(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("x2"))
    return od.join(li, od.o_orderkey == li.l_orderkey).select(
        F.col("o_orderkey").alias("id"), "x1", "x2", (F.col("x1") / 10.0).alias("y_true"))


@query("permutation_importance")
def q_permutation_importance(spark, d):
    df = _perm_frame(spark, d)

    def score(x):
        return F.lit(0.05) * F.col("x1") + F.col("x2") / F.lit(80000.0)

    def metric(x):
        return x.agg((-F.avg(F.pow(F.col("y_true") - F.col("y_pred"), 2))).alias("score"))

    out = S.permutation_importance(df, score, metric, ["x1", "x2"], "id", n_repeats=3, seed=0)
    return out.select("feature", r6("importance_mean"), r6("importance_std"))


# ------------------------------------------------------------------ remaining operators
from hourglass.operators import joins as Cj  # noqa: E402
from hourglass.sources import io as A  # noqa: E402

SHADOW_EXPLICIT = ("view_0", "view_1")
DROP_LIST = ("error_0", "error_1", "error_2")
EXTRA_LABELS = ("click_0", "view_1", "purchase_2", "signup_3", "error_4")
LINE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _win(spark, d):
    return series.windowed_events(spark, d, series.cohort(spark, d))


@query("drop_shadowed_features")
def q_drop_shadowed_features(spark, d):
    st = series.cohort(spark, d)
    vocab = series.series_vocabulary(spark, d, st).select("feature")
    out = B.drop_shadowed_features(_win(spark, d), vocab, SHADOW_EXPLICIT)
    return out.select("stay", "offset_min", "feature", r6("value"))


@query("drop_feature_list")
def q_drop_feature_list(spark, d):
    return B.drop_feature_list(_win(spark, d), DROP_LIST).select("stay", "offset_min", "feature", r6("value"))


@query("select_feature_subset")
def q_select_feature_subset(spark, d):
    names = [f"click_{i}" for i in range(10)]
    g = B.select_feature_subset(_grid(spark, d), names)
    return g.select("stay", "time", "feature", r6("value"), r6("mask"))


@query("drop_mask_features")
def q_drop_mask_features(spark, d):
    return B.drop_mask_features(_grid(spark, d)).select("stay", "time", "feature", r6("value"))


@query("like_search")
def q_like_search(spark, d):
    return B.like_search(_win(spark, d), "PURCHASE").select("feature", "n_stays", r6("mean_value"))


def _events_with_admit(spark, d):
    ev = driver._t(spark, d, "events").select("event_id", F.col("user_id").alias("stay"), "ts")
    st = series.cohort(spark, d).select("stay", "admit_ts")
    return ev.join(st, "stay")


@query("hour_diff_elapsed")
def q_hour_diff_elapsed(spark, d):
    return B.hour_of_day_diff_filter(_events_with_admit(spark, d), "ts", "admit_ts", -24, 5).select(
        "event_id", "stay")


@query("hour_diff_clock")
def q_hour_diff_clock(spark, d):
    return B.hour_of_day_diff_filter(_events_with_admit(spark, d), "ts", "admit_ts", -24, 5,
                                     mode="hour_of_day").select("event_id", "stay")


@query("pivot_mean")
def q_pivot_mean(spark, d):
    ev = _win(spark, d).withColumn("event_type", F.split("feature", "_")[0])
    out = D.pivot_mean(ev, ["stay", "offset_min"], "event_type", EVENT_TYPES)
    return out.select("stay", "offset_min", *[r6(t) for t in EVENT_TYPES])


@query("extra_vars")
def q_extra_vars(spark, d):
    ev = B.in_list(_win(spark, d), "feature", EXTRA_LABELS)
    out = D.pivot_mean(ev, ["stay"], "feature", EXTRA_LABELS)
    return out.select("stay", *[r6(t) for t in EXTRA_LABELS])


def _line_long(spark, d):
    li = driver._t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_COLS)
    return li.unpivot(["l_orderkey", "l_linenumber"], list(LINE_COLS), "feature", "value")


@query("unpivot_wide")
def q_unpivot_wide(spark, d):
    return _line_long(spark, d).select("l_orderkey", "l_linenumber", "feature", r6("value"))


@query("row_sum_score")
def q_row_sum_score(spark, d):
    out = D.row_sum_score(_line_long(spark, d), ["l_orderkey", "l_linenumber"],
                          ["l_discount", "l_tax"], score_name="charge_score")
    return out.select("l_orderkey", "l_linenumber", "feature", r6("value"))


@query("coerce_numeric")
def q_coerce_numeric(spark, d):
    from hourglass.functions import scalar as H

    t = driver.text_values(spark, d)
    out = t.select("event_id", "stay", "feature", H.to_number(H.strip_percent("value_text")).alias("value"))
    return B.drop_null_values(out).select("event_id", "stay", "feature", r6("value"))


@query("assign_chunk")
def q_assign_chunk(spark, d):
    return E.assign_chunk(series.cohort(spark, d), 16)


@query("vocab_order")
def q_vocab_order(spark, d):
    st = series.cohort(spark, d)
    v = series.series_vocabulary(spark, d, st)
    return J.global_rank(v, [F.desc("n_stays"), F.asc("feature")], "rank")


@query("lexical_order")
def q_lexical_order(spark, d):
    split = C.split_codes(_code_pairs(spark, d))
    fam_rank = (F.when(F.col("family") == "main", 0).when(F.col("family") == "admission", 1)
                 .when(F.col("family") == "past_history_organ", 2).otherwise(3))
    codes = C.string_codes(split).join(split.select("path", "family"), "path").select(
        "code", fam_rank.alias("family_rank")).distinct()
    return J.global_rank(codes, [F.col("family_rank"), F.col("code")], "code_id")


@query("remove_padding")
def q_remove_padding(spark, d):
    padded, feats = _padded(spark, d)
    rows = K.remove_padding(padded).withColumns({"pos": F.col("pos").cast("long"), "time": r6("time"), "hour": r6("hour")})
    return _cells(rows, feats, "stay", "pos", "time", "hour")


@query("cohort_anchor_age")
def q_cohort_anchor_age(spark, d):
    """B4 with the age taken in an anchor year (1 to 3 years before or after the admission)."""
    st = driver.stays(spark, d).withColumns({
        "anchor_age": (F.col("person") + 5).cast("int"), "anchor_year": (F.lit(2021) + F.col("person") % 7).cast("int")})
    out = B.select_cohort(st, series.MIN_LOS_DAYS, series.MIN_AGE, age=B.anchor_age("anchor_age", "anchor_year", "admit_ts"))
    return out.select("stay", "person", r6("los_days"))


@query("union_all")
def q_union_all(spark, d):
    """Two tables under common names; a column that one lacks is NULL."""
    cust = B.rename(driver._t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
                    {"c_custkey": "id", "c_nationkey": "nation"})
    supp = B.rename(driver._t(spark, d, "supplier").select("s_suppkey", "s_nationkey"), {"s_suppkey": "id", "s_nationkey": "nation"})
    return B.union_all([cust, supp])


@query("display_name")
def q_display_name(spark, d):
    cust = driver._t(spark, d, "customer")
    shown = M.display_name("c_mktsegment", {"AUTOMOBILE": "Cars", "BUILDING": "Construction"})
    return cust.groupBy(shown.alias("segment")).agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("dropped_families")
def q_dropped_families(spark, d):
    """Code strings of no known family, with some of each kind made from the customers."""
    cust = driver._t(spark, d, "customer").select(F.col("c_custkey").alias("stay"), F.concat(
        F.when(F.col("c_custkey") % 3 == 0, F.lit("notes/Other/")).when(F.col("c_custkey") % 3 == 1, F.lit("admission other|"))
         .otherwise(F.lit("plain|")), F.col("c_mktsegment")).alias("path"))
    return C.dropped_families(cust)


@query("encode_labels_flag")
def q_encode_labels_flag(spark, d):
    """I7 for labels with a 0/1 flag and no category to expand."""
    return I.encode_labels(_labels01(spark, d)).select("stay", r6("los_days"), "mortality")


@query("outer_join_codes")
def q_outer_join_codes(spark, d):
    kept = _kept_codes(spark, d)
    fam = C.split_codes(_code_pairs(spark, d))
    smap = C.string_codes(fam).join(fam.select("path", "family"), "path").select("code", "family").distinct()
    k = kept.join(smap, "code")
    main = k.where(F.col("family") == "main").groupBy("stay").agg(F.count(F.lit(1)).cast("long").alias("n_main"))
    hist = k.where(F.col("family") != "main").groupBy("stay").agg(F.count(F.lit(1)).cast("long").alias("n_other"))
    out = Cj.equi_join(main, hist, "stay", "full_outer")
    return out.na.fill(0, ["n_main", "n_other"])


@query("item_lookup")
def q_item_lookup(spark, d):
    li = driver._t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("itemid"))
    items = driver._t(spark, d, "part").select(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("label"))
    return Cj.item_lookup(li, items).select("l_orderkey", "l_linenumber", "label")


@query("scan_head")
def q_scan_head(spark, d):
    ev = A.scan_parquet(spark, d, "events").select("event_id", "user_id", "event_type")
    return A.scan_head(ev, 500, ["event_id"])


@query("slice_rows")
def q_slice_rows(spark, d):
    ev = A.scan_parquet(spark, d, "events").select("event_id", "user_id", "event_type")
    return A.slice_rows(ev, 300, 1300, ["event_id"])


# ------------------------------------------------------------------ offsets, scalars, wide sink
ORIGIN = "2024-01-02 00:00:00"   # fixed origin of the offset-based window join


@query("time_window_offsets")
def q_time_window_offsets(spark, d):
    from hourglass.functions import scalar as H

    origin = F.lit(ORIGIN).cast("timestamp_ntz")
    ev = driver.events(spark, d).select("stay", H.minutes_between(origin, F.col("ts")).alias("offset_min"),
                                        "feature", "value")
    st = series.cohort(spark, d).select("stay", H.minutes_between(origin, F.col("discharge_ts"))
                                        .alias("discharge_offset"))
    out = B.time_window(ev, st, lo=-1440)
    return out.select("stay", "offset_min", "feature", r6("value"))


@query("scalar_functions")
def q_scalar_functions(spark, d):
    from hourglass.functions import scalar as H

    st = driver.stays(spark, d)
    f = driver.flat(spark, d).select("stay", "nation", "segment", "height")
    j = st.join(f, "stay")
    clock = F.date_format("admit_ts", "HH:mm:ss")
    return j.select(
        "stay",
        H.clock_hour(clock).cast("long").alias("clock_hour"),
        H.ts_hour("discharge_ts").cast("long").alias("ts_hour"),
        H.ts_year("admit_ts").cast("long").alias("ts_year"),
        r6(H.cyclic_unit(F.col("discharge_offset"), 24), "cyclic"),
        H.first_word("nation").alias("first_word"),
        H.eq_ignore_case("segment", F.lit("building")).cast("int").alias("is_building"),
        H.round_half_even(F.col("los_days")).cast("long").alias("los_rounded"),
        r6(H.los_link(F.col("los_days") / 10.0), "los_link"),
        r6(H.risk_link(F.col("los_days") - 15.0), "risk"),
        r6(H.zero_to_null(F.floor("los_days") % 3), "zero_null"),
        r6(H.nan_to_zero("height"), "height0"),
        H.to_bool(F.col("person") % 2).cast("int").alias("odd_person"),
        H.is_missing("height").alias("no_height"),
        r6(H.fill_const("height", -1.0), "height_filled"),
        H.map_values("segment", {"AUTOMOBILE": 1, "BUILDING": 2}, 0).alias("seg_code"),
        H.los_bin("los_days").alias("los_bin"))


@query("to_wide")
def q_to_wide(spark, d):
    # all features of the vocabulary, as columns; melted again so that every cell is compared
    feats = E.vocabulary(series.series_vocabulary(spark, d, series.cohort(spark, d)))
    w = E.to_wide(_grid(spark, d), feats)
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), r6(f"`{f}`", "value"), r6(f"`{f}_mask`", "mask")) for f in feats]))
    return w.select("stay", "time", r6("hour"), cell.alias("_c")).select("stay", "time", "hour", "_c.*")


# ------------------------------------------------------------------ streaming
@query("stream_encode")
def q_stream_encode(spark, d):
    """Series encoding over events ingested by a stream (same result)."""
    import uuid

    from hourglass.sources.io import shared_folder
    from hourglass.streaming import encode_ingested, ingest_stream, write_stream_input

    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    st = series.cohort(spark, d)
    stats = series.series_stats(spark, d, st)
    write_stream_input(driver.events(spark, d), f"{base}/input")
    q = ingest_stream(spark, f"{base}/input", st, f"{base}/ingested", f"{base}/ckpt")
    q.awaitTermination()
    out = encode_ingested(spark, f"{base}/ingested", stats)
    return out.select("stay", "time", "feature", r6("value"), r6("mask"), r6("hour"))


@query("split_by_hash")
def q_split_by_hash(spark, d):
    return J.split_by_hash(_orders_stays(spark, d), "person", SEED).select("stay", "person", "split")


@query("quantile_fit_train_split")
def q_quantile_fit_train_split(spark, d):
    """D9 fitted on the training split only (persons split as in J1), the recommended use."""
    st = series.cohort(spark, d)
    train = J.split_by_entity(st.select("stay", "person"), "person", SEED).where(F.col("split") == "train")
    minutes = series.minute_means(spark, d, st)
    stats = E.fit_series(minutes, st, series.MIN_FRAC, series.QUANTILES, fit_stays=train.select("stay"))
    return stats.select("feature", "n_stays", r6("q_lo"), r6("q_hi"))


# ------------------------------------------------------------------ whole tables, layouts and sinks
DESCRIBED_NUMBERS = ("height", "weight", "hour", "balance_after_24h")
DESCRIBED_TEXTS = ("gender", "teachingstatus", "nation", "region", "segment", "age")
SHUFFLED_FILES = 4


def _folder(spark, name):
    """A new folder that driver and executors share."""
    import uuid

    return f"{A.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("describe_all")
def q_describe_all(spark, d):
    flat = checkpoint(P.flat_for_series(spark, d))
    out = D.describe_all(flat, DESCRIBED_NUMBERS, DESCRIBED_TEXTS)
    return out.select("column", "count", "n_unique", "top", "freq", *[r6(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("sample_per_split")
def q_sample_per_split(spark, d):
    """The same share of train, val and test, and the static table restricted to it."""
    st = series.cohort(spark, d)
    split = checkpoint(J.split_by_entity(st.select("stay", "person"), "person", SEED))
    sample = J.sample_stays(split, 0.3, SEED, by="split")
    flat = driver.flat(spark, d, st).select("stay", "nation", "segment")
    return J.apply_sample(flat, sample).join(split.select("stay", "split"), "stay")


def _shuffled(spark, d):
    st = series.cohort(spark, d)
    path = _folder(spark, "shuffled")
    tables = {"labels": _labels01(spark, d, st), "hours": checkpoint(series.series_hours(spark, d).select("stay", "time"))}
    return path, A.write_shuffled(tables, J.shuffle_stays(st, SEED), path, SHUFFLED_FILES, ("time",))


@query("shuffled_tables")
def q_shuffled_tables(spark, d):
    """Two tables written in shuffled order and read back, every row with its file and position."""
    path, _ = _shuffled(spark, d)
    hours = A.read_shuffled(spark, path, "hours").select(F.lit("hours").alias("name"), "stay", "time", "file", "row")
    labels = A.read_shuffled(spark, path, "labels").select(F.lit("labels").alias("name"), "stay", F.lit(None).cast("long").alias("time"), "file", "row")
    return hours.unionByName(labels).select("name", "stay", "time", F.col("file").cast("int").alias("file"), F.col("row").cast("long").alias("row"))


@query("shuffle_manifest")
def q_shuffle_manifest(spark, d):
    return _shuffled(spark, d)[1].select("name", "stay", "order", "file", F.col("first_row").cast("long").alias("first_row"), "n_rows")


@query("permutation_importance_batch")
def q_permutation_importance_batch(spark, d):
    """M3 with a batch predictor."""
    out = S.permutation_importance_batch(
        _perm_frame(spark, d), lambda x: 0.05 * x["x1"].to_numpy() + x["x2"].to_numpy() / 80000.0,
        lambda y, p: (y - p) ** 2, ["x1", "x2"], "id", "y_true", n_repeats=3, seed=0)
    return out.select("feature", r6("importance_mean"), r6("importance_std"))


def _sparse_codes(spark, d):
    st = series.cohort(spark, d)
    in_series = P.series_stays(spark, d, st)
    kept = checkpoint(_kept_codes(spark, d, st, in_series))
    ids = checkpoint(C.code_ids(kept))
    path = _folder(spark, "sparse")
    A.write_table(C.to_sparse_rows(kept, ids, in_series), path)
    return spark.read.parquet(path), ids


@query("sparse_codes")
def q_sparse_codes(spark, d):
    """The matrix of codes as compressed rows, written and read."""
    rows, _ = _sparse_codes(spark, d)
    return rows.select("stay", F.array_join(F.transform("indices", lambda x: x.cast("string")), ",").alias("indices"), "n_codes")


@query("sparse_codes_back")
def q_sparse_codes_back(spark, d):
    return C.from_sparse_rows(*_sparse_codes(spark, d)).select("stay", "code")


@query("csv_round_trip")
def q_csv_round_trip(spark, d):
    """Written as CSV with a header, scanned with a schema."""
    path = _folder(spark, "csv")
    A.write_table(driver._t(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), path, "csv")
    out = A.scan_csv(spark, path, "p_partkey long, p_name string, p_retailprice double")
    return out.select("p_partkey", "p_name", r6("p_retailprice"))


@query("append_round_trip")
def q_append_round_trip(spark, d):
    """One part of a table written, the other appended."""
    path, orders = _folder(spark, "appended"), driver._t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    A.write_table(orders.where("o_orderkey % 2 = 0"), path)
    A.append_table(orders.where("o_orderkey % 2 = 1"), path)
    return spark.read.parquet(path).select("o_orderkey", r6("o_totalprice"))


@query("splits_round_trip")
def q_splits_round_trip(spark, d):
    """Tables written by split, two splits of one read back."""
    path = _folder(spark, "splits")
    split = J.split_by_entity(_orders_stays(spark, d), "person", SEED)
    A.write_splits({"stays": split}, path)
    return A.load_splits(spark, path, "stays", ("train", "val")).select("stay", "person", F.col("split").cast("string").alias("split"))


@query("union_splits")
def q_union_splits(spark, d):
    """Frames of the splits put together again."""
    split = checkpoint(J.split_by_entity(_orders_stays(spark, d), "person", SEED))
    parts = {s: split.where(F.col("split") == s).drop("split") for s in A.SPLITS}
    return A.union_splits(parts).select("stay", "person", "split")


@query("ids_round_trip")
def q_ids_round_trip(spark, d):
    """A10: the distinct stays of a table, written and read."""
    return A.write_ids(_orders_stays(spark, d).select(F.col("person").alias("stay")), _folder(spark, "ids"))


@query("named_result")
def q_named_result(spark, d):
    """A result under a name, read by SQL."""
    import uuid

    name = f"orders_{uuid.uuid4().hex}"
    A.named_result(driver._t(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), name)
    return spark.sql(f"SELECT o_custkey, n FROM {name} WHERE n > 1")


@query("predictions_round_trip")
def q_predictions_round_trip(spark, d):
    """Predictions and their metrics appended under one path, and read."""
    path, pred = _folder(spark, "predictions"), checkpoint(driver.los_predictions(spark, d))
    A.write_predictions(pred, L.regression_report(pred), path)
    rows = spark.read.parquet(f"{path}/predictions").select("id", r6("y_true"), r6("y_pred"))
    return rows.crossJoin(F.broadcast(spark.read.parquet(f"{path}/results").select(r6("mse"))))  # one row of metrics


@query("feature_names")
def q_feature_names(spark, d):
    """The value columns of a wide grid by its schema, with the rows and the non-zero values of each."""
    feats = E.vocabulary(series.series_vocabulary(spark, d, series.cohort(spark, d)))
    w = E.to_wide(_grid(spark, d), feats)
    names = A.feature_names(w)
    row = w.agg(*[F.count(F.when(F.col(f"`{c}`") != 0, 1)).alias(c) for c in names])
    return row.unpivot([], names, "feature", "n_nonzero").withColumn("n_features", F.lit(A.n_features(w)))
