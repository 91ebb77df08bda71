"""Projections, filters and predicates (inventory B1-B19) and set operations.

Literal predicates are written as plain column expressions so Catalyst pushes
them into the parquet scan (``PushedFilters``); projections are explicit so
the scan reads only the needed columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import scalar as H

KEY = "stay"


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B1: column subset."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B2: rename columns."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop leakage columns."""
    return df.drop(*cols)


def anchor_age(age: str, year: str, admitted: str) -> F.Column:
    """Age at admission from the age in an anchor year."""
    return F.year(admitted) - F.col(year) + F.col(age)


def select_cohort(stays: DataFrame, min_los_days: float = 5.0 / 24.0, min_age: int = 17,
                  age_col: str = "age", los_col: str = "los_days",
                  extra: F.Column | None = None, age: F.Column | None = None) -> DataFrame:
    """``los > min_los_days`` and ``age > min_age``.

    The age is ``age_col``'s text parsed with H3, or the column ``age``, for
    example :func:`anchor_age`.
    ``min_los_days=0`` reproduces the integer division of the source SQL.
    """
    age = H.age_int(age_col) if age is None else age
    cond = (F.col(los_col) > F.lit(float(min_los_days))) & (age > F.lit(min_age))
    if extra is not None:
        cond = cond & extra
    return stays.where(cond)


def time_window(events: DataFrame, stays: DataFrame, lo: int = -1440,
                offset_col: str = "offset_min", hi_col: str = "discharge_offset") -> DataFrame:
    """Events with ``lo <= offset <= stays.hi_col`` (see joins.range_join)."""
    from hourglass.operators.joins import range_join

    return range_join(events, stays, KEY, offset_col, lo, hi_col)


def drop_null_values(df: DataFrame, col: str = "value") -> DataFrame:
    """Keep non-NULL (numeric) values."""
    return df.where(F.col(col).isNotNull())


def in_list(df: DataFrame, col: str, values: Sequence, negate: bool = False) -> DataFrame:
    """Literal IN list (or NOT IN)."""
    cond = F.col(col).isin(list(values))
    return df.where(~cond if negate else cond)


def early_entry(df: DataFrame, col: str = "offset_min", hours: float = 5) -> DataFrame:
    """Rows entered strictly before ``hours`` hours (``offset < 60 * hours``)."""
    return df.where(F.col(col) < 60 * hours)


def hour_of_day_diff_filter(df: DataFrame, t: str, t0: str, lo: int = -24, hi: int = 5,
                            mode: str = "elapsed") -> DataFrame:
    """Keep rows whose hour difference lies in ``[lo, hi]``.

    ``mode='elapsed'`` (default) uses the true elapsed hours
    ``floor((t - t0) / 1 h)``; ``mode='hour_of_day'`` reproduces the source
    text, which subtracts hour-of-day values and ignores the date.
    """
    if mode == "hour_of_day":
        diff = F.hour(t) - F.hour(t0)
    else:
        diff = H.hours_between(t0, t)
    return df.where(diff.between(lo, hi))


# The four code families and their prefixes.
FAMILY_PREFIXES = (
    ("past_history_organ", "notes/Progress Notes/Past History/Organ Systems/"),
    ("past_history_options", "notes/Progress Notes/Past History/Past History Obtain Options"),
    ("admission", "admission diagnosis"),
)


def prefix_family(path_col: str = "path") -> F.Column:
    """Route a code string to its family.

    Strings starting with ``notes``/``admission`` that match no family go to
    ``'other'`` (the source would raise); everything else is ``'main'``.
    """
    p = F.col(path_col)
    fam = None
    for name, prefix in FAMILY_PREFIXES:
        fam = F.when(p.startswith(prefix), F.lit(name)) if fam is None else fam.when(
            p.startswith(prefix), F.lit(name))
    return (fam.when(p.startswith("notes") | p.startswith("admission"), F.lit("other"))
               .otherwise(F.lit("main")))


def drop_shadowed_features(chart: DataFrame, lab_vocab: DataFrame, explicit: Sequence[str] = (),
                           suffix: str = " (serum)", feature: str = "feature") -> DataFrame:
    """Drop chart features named like a lab feature (or lab + suffix) or listed."""
    labs = lab_vocab.select(feature).distinct()
    shadow = labs.unionByName(labs.select(F.concat(F.col(feature), F.lit(suffix)).alias(feature)))
    out = chart.join(shadow, feature, "left_anti")
    if explicit:
        out = out.where(~F.col(feature).isin(list(explicit)))
    return out


def drop_feature_list(events: DataFrame, names: Sequence[str], feature: str = "feature") -> DataFrame:
    """Drop listed (binary/uninformative) features."""
    return events.where(~F.col(feature).isin(list(names)))


def select_feature_subset(grid: DataFrame, names: Sequence[str], invert: bool = False,
                          feature: str = "feature") -> DataFrame:
    """Ablation subset in long form; value and mask travel together."""
    cond = F.col(feature).isin(list(names))
    return grid.where(~cond if invert else cond)


def drop_mask_features(grid: DataFrame) -> DataFrame:
    """No-mask ablation in long form."""
    return grid.drop("mask")


def like_search(items: DataFrame, phrase: str, label: str = "feature", key: str = KEY,
                value: str = "value") -> DataFrame:
    """Labels containing ``phrase`` (case-insensitive) with stays and mean."""
    hits = items.where(F.lower(F.col(label)).contains(phrase.lower()))
    return hits.groupBy(label).agg(F.count_distinct(key).cast("long").alias("n_stays"),
                                   F.avg(value).alias("mean_value"))


def coverage_by_column(df: DataFrame, cols: Sequence[str], key: str = KEY,
                       offset_col: str | None = "offset_min", before: int | None = 1440) -> DataFrame:
    """Distinct stays with a non-NULL value, per column: one flag per stay, then their sums."""
    d = df
    if offset_col is not None and before is not None:
        d = d.where(F.col(offset_col) < before)
    flags = d.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(F.col(c).isNotNull().cast("long")).alias(c) for c in cols])
    return flags.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in cols])


def drop_zero_total_features(df: DataFrame, feature: str = "feature",
                             value: str = "attribution") -> DataFrame:
    """Keep features whose summed value is non-zero."""
    keep = df.groupBy(feature).agg(F.sum(value).alias("_t")).where(F.col("_t") != 0).select(feature)
    return df.join(keep, feature, "left_semi")


# ----------------------------------------------------------------- set operations
def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    """G1: SQL ``UNION`` (duplicates removed)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def stays_with_series(dfs: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Distinct stays present in any of the series."""
    return union_distinct([d.select(key) for d in dfs])


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Row append, missing columns NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def suffix_columns(df: DataFrame, cols: Sequence[str], suffix: str = "", prefix: str = "") -> DataFrame:
    """Rename columns with a prefix/suffix (``_mask``, one-hot and group names)."""
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in cols})
