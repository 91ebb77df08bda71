"""Static (one row per stay) feature encoding (inventory I1-I7, I12).

Statistics (category counts, mean/std, quantiles) are computed with one
aggregate each and attached to the rows through a broadcast of a one-row
table (or of a category table whose size is checked), never by shuffling the
rows to a single task.  Category vocabularies for one-hot columns are the
only values brought to the driver; their size is checked first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import scalar as H
from hourglass.operators.joins import cross_scalar
KEY = "stay"
MAX_ONE_HOT_CATEGORIES = 10_000


def collapse_rare(df: DataFrame, col: str, min_count: int = 1000, other: str = "misc") -> DataFrame:
    """Values seen fewer than ``min_count`` times become ``other``; NULL stays NULL."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(col)
                .agg(F.count(F.lit(1)).alias("_n")))
    rare = counts.where(F.col("_n") < min_count).select(F.col(col).alias("_rare"))
    out = df.join(rare, df[col] == F.col("_rare"), "left")
    return out.withColumn(col, F.when(F.col("_rare").isNotNull(), F.lit(other))
                          .otherwise(F.col(col).cast("string"))).drop("_rare")


def category_vocab(df: DataFrame, col: str, max_categories: int = MAX_ONE_HOT_CATEGORIES) -> list:
    """Sorted distinct non-NULL values of a column (size-checked before collecting)."""
    vals = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("v")).distinct()
    rows = vals.limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories; use one_hot_long")
    return sorted(r.v for r in rows)


def one_hot(df: DataFrame, cols: Sequence[str], vocab: Mapping[str, Sequence] | None = None,
            drop: bool = True) -> DataFrame:
    """One 0/1 column ``{col}_{value}`` per observed value; NULL -> all 0.

    Columns are ordered by value (like ``get_dummies``).  Pass ``vocab`` to
    fix the columns (e.g. the training split's values) and skip the scan.
    """
    out = df
    for c in cols:
        values = list(vocab[c]) if vocab and c in vocab else category_vocab(df, c)
        src = F.col(c).cast("string")
        out = out.select("*", *[F.coalesce((src == F.lit(str(v))).cast("int"), F.lit(0))
                                .alias(f"{c}_{v}") for v in values])
        if drop:
            out = out.drop(c)
    return out


def one_hot_long(df: DataFrame, cols: Sequence[str], key: str = KEY) -> DataFrame:
    """I2 in long form: ``(key, feature, value)`` for every key x observed category.

    The categories of each column are a size-checked vocabulary; every row
    expands over them with ``explode`` (no join), emitting 1 for its own
    category and 0 elsewhere (NULL -> all 0).
    """
    parts = []
    for c in cols:
        cats = F.array(*[F.lit(v) for v in category_vocab(df, c)])
        x = df.select(key, F.col(c).cast("string").alias("_x"), F.explode(cats).alias("_v"))
        parts.append(x.select(key, F.concat(F.lit(c + "_"), F.col("_v")).alias("feature"),
                              F.coalesce((F.col("_x") == F.col("_v")).cast("int"), F.lit(0)).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def standardise(df: DataFrame, cols: str | Sequence[str], clip: float | None = 4.0) -> DataFrame:
    """``(x - mean) / std`` with the sample std, then clip; NULL stays NULL.

    The moments of all columns come from one aggregate.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    stats = df.agg(*[f(c).alias(f"_{kind}_{c}") for c in cols for kind, f in (("mean", F.avg), ("std", F.stddev_samp))])
    out = cross_scalar(df, stats)
    for c in cols:
        z = F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}"))
        out = out.withColumn(c, z if clip is None else H.clip(z, -clip, clip))
    return out.drop(*stats.columns)


def quantile_scale(df: DataFrame, cols: Sequence[str], clip: float | None = 4.0,
                   probs: Sequence[float] = (0.05, 0.95), stored: bool = False) -> DataFrame:
    """I4: ``2 (x - q_lo) / (q_hi - q_lo) - 1`` per column, then clip (NULL kept).

    Exact quantiles of all columns from one distributed selection; ``stored``
    says that ``df`` is a written table (or a projection of one).
    """
    from hourglass.operators.quantiles import quantiles

    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "_column", "_value")
    q = quantiles(long, "_value", ["_column"], probs, ("_q_lo", "_q_hi"), stored=stored)
    of = lambda c, side: F.max(F.when(F.col("_column") == c, F.col(f"_q{side}")))
    stats = q.agg(*[of(c, side).alias(f"{side}_{c}") for c in cols for side in ("_lo", "_hi")])
    out = cross_scalar(df, stats)
    for c in cols:
        x = H.scale_between(F.col(c).cast("double"), F.col(f"_lo_{c}"), F.col(f"_hi_{c}"))
        if clip is not None:
            x = H.clip(x, -clip, clip)
        out = out.withColumn(c, x)
    return out.drop(*[f"{side}_{c}" for c in cols for side in ("_lo", "_hi")])


def impute_with_indicator(df: DataFrame, col: str, indicator: str, fill: float = 0.0) -> DataFrame:
    """Add ``indicator`` = 1 where NULL, then fill the column."""
    return (df.withColumn(indicator, H.is_missing(col))
              .withColumn(col, F.coalesce(F.col(col), F.lit(fill))))


# The reference's binary maps.
GENDER_MAP = {"Male": 1.0, "Female": 0.0}
TEACHING_MAP = {"t": 1, "f": 0}
MORTALITY_MAP = {"EXPIRED": 1, "ALIVE": 0}


@dataclass
class FlatSpec:
    """Recipe of :func:`encode_flat` (defaults follow the reference)."""
    drop: Sequence[str] = ()
    gender: str | None = "gender"
    binary: Mapping[str, Mapping] = field(default_factory=lambda: {"teachingstatus": TEACHING_MAP})
    categorical: Sequence[str] = ()
    min_count: int = 1000
    age: str | None = "age"
    age_fill: str = "63"
    standardise: Sequence[str] = ()
    quantile_scale: Sequence[str] = ()
    indicators: Mapping[str, str] = field(default_factory=dict)
    clip: float = 4.0
    one_hot_vocab: Mapping[str, Sequence] | None = None


def category_counts(df: DataFrame, cols: Sequence[str],
                    max_categories: int = MAX_ONE_HOT_CATEGORIES) -> dict[str, dict[str, int]]:
    """Counts of every non-NULL value of several columns in ONE aggregation.

    The columns are unpivoted to ``(column, value)`` and counted together; the
    result (bounded by the total number of categories, checked) is collected.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "_col", "_val")
    counts = long.where(F.col("_val").isNotNull()).groupBy("_col", "_val").agg(F.count(F.lit(1)).alias("_n"))
    limit = max_categories * max(len(cols), 1)
    rows = counts.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories in {list(cols)}")
    out: dict[str, dict[str, int]] = {c: {} for c in cols}
    for r in rows:
        out[r._col][r._val] = r._n
    return out


def collapse_and_one_hot(df: DataFrame, cols: Sequence[str], min_count: int, other: str = "misc",
                         drop: bool = True) -> DataFrame:
    """I1 + I2 for several columns with one counting job and no joins.

    Rare values (count < ``min_count``) become ``other``; one 0/1 column per
    value present after collapsing, in value order (NULL -> all 0).
    """
    counts = category_counts(df, cols)
    out = df
    for c in cols:
        rare = sorted(v for v, n in counts[c].items() if n < min_count)
        kept = {v for v, n in counts[c].items() if n >= min_count}
        values = sorted(kept | ({other} if rare else set()))
        src = F.col(c).cast("string")
        collapsed = F.when(src.isin(rare), F.lit(other)).otherwise(src) if rare else src
        out = out.select("*", *[F.coalesce((collapsed == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                                for v in values])
        if drop:
            out = out.drop(c)
    return out


def encode_flat(df: DataFrame, spec: FlatSpec) -> DataFrame:
    """Drop -> map -> collapse rare -> one-hot -> age parse -> z-score ->
    quantile scale -> clip -> missing indicators -> fill.

    ``df`` should be a written table: the fit reads it for the category counts,
    the moments of all columns and the quantiles of all columns.
    """
    out = df.drop(*spec.drop)
    if spec.gender:
        out = out.withColumn(spec.gender, H.map_values(spec.gender, GENDER_MAP, 0.5).cast("double"))
    for col, mapping in spec.binary.items():
        out = out.withColumn(col, H.map_values(col, mapping, None))
    if spec.categorical and spec.one_hot_vocab is None:
        out = collapse_and_one_hot(out, spec.categorical, spec.min_count)
    elif spec.categorical:
        for c in spec.categorical:
            out = collapse_rare(out, c, spec.min_count)
        out = one_hot(out, spec.categorical, spec.one_hot_vocab)
    if spec.age:
        age = F.coalesce(F.nullif(F.col(spec.age), F.lit("")), F.lit(spec.age_fill))
        out = (out.withColumn("> 89", H.contains_flag(age, "> 89"))
                  .withColumn(spec.age, H.age_float(age)))
    if spec.standardise:
        out = standardise(out, spec.standardise, spec.clip)
    if spec.quantile_scale:
        out = quantile_scale(out, spec.quantile_scale, spec.clip, stored=True)
    for col, ind in spec.indicators.items():
        out = impute_with_indicator(out, col, ind)
    return out


def encode_labels(df: DataFrame, location: str = "discharge_location",
                  status: str = "discharge_status", mortality: str = "mortality",
                  vocab: Mapping[str, Sequence] | None = None,
                  mortality_map: Mapping[str, int] | None = MORTALITY_MAP) -> DataFrame:
    """One-hot discharge location and status (where present); mortality -> 0/1.

    A numeric or boolean flag is taken as it is; text is mapped by
    ``mortality_map`` and any other text fails the job (NULL stays NULL).
    """
    m = F.col(mortality)
    if not isinstance(df.schema[mortality].dataType, T.StringType):
        flag = m.cast("int")
    else:
        mapped = F.lit(None).cast("int")
        for text, value in (mortality_map or {}).items():
            mapped = F.when(m == text, F.lit(value)).otherwise(mapped)
        unknown = F.raise_error(F.concat(F.lit("unmapped mortality value: "), m)).cast("int")
        flag = F.when(m.isNull() | mapped.isNotNull(), mapped).otherwise(unknown)
    out = df.withColumn(mortality, flag)
    return one_hot(out, [c for c in (location, status) if c in df.columns], vocab)


def group_rare_category(df: DataFrame, col: str, cut_off: int, key: str = KEY,
                        prefix: str = "grouped_") -> DataFrame:
    """Rare categories re-keyed to their first word, still-rare groups dropped.

    Long output ``(key, category)``: a category with at most ``cut_off`` keys
    is replaced by ``prefix + first_word``; groups that are still at most
    ``cut_off`` after regrouping are removed.  Counts are distinct keys.
    """
    pairs = df.select(key, F.col(col).alias("category")).where(F.col("category").isNotNull()).distinct()
    prev = pairs.groupBy("category").agg(F.count_distinct(key).alias("_n"))
    j = pairs.join(prev, "category")
    regrouped = j.select(key, F.when(F.col("_n") <= cut_off,
                                     F.concat(F.lit(prefix), H.first_word("category")))
                          .otherwise(F.col("category")).alias("category")).distinct()
    prev2 = regrouped.groupBy("category").agg(F.count_distinct(key).alias("_n"))
    keep = prev2.where(F.col("_n") > cut_off).select("category")
    return regrouped.join(keep, "category", "left_semi")
