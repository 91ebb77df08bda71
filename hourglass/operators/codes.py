"""Hierarchical code encoding (inventory I8-I12, D12-D14, B9, B11, C7-C8).

Relational form of the code trie: every node is a path prefix, and a node's
statistics are aggregates over the distinct code strings that pass through
it.  Work is split in two sizes:

* the *vocabulary* side (distinct code strings -> their prefixes, per-node
  string counts, pruning rules) is as large as the code dictionary, and
* the *pair* side ``(stay, code)`` grows with the data; it is only joined
  (to the string -> code map) and aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.operators.filters import early_entry, prefix_family
from hourglass.operators.joins import cross_scalar, left_zero_fill
from hourglass.operators.split import global_rank
from hourglass.sources.io import checkpoint

KEY = "stay"

# Boilerplate removed per family before splitting, and the split
# character of each family.
ADMISSION_STRIP = ("admission diagnosis|", "All Diagnosis|", "Additional APACHE  Information|")
ORGAN_STRIP = ("notes/Progress Notes/Past History/Organ Systems/",)
OPTIONS_STRIP = ("notes/Progress Notes/Past History/Past History Obtain Options/",)
MAX_DEPTH = 5      # prefixes 1..5 for every string
EXACT_DEPTH = 6    # plus depth 6 when a string has exactly 6 levels


def code_union(sources: Sequence[DataFrame], cohort: DataFrame | None = None,
               early_minutes: int | None = 300) -> DataFrame:
    """G1 + B9 (+ C4): distinct ``(stay, path)`` entered before ``early_minutes``."""
    parts = []
    for s in sources:
        x = s if early_minutes is None else early_entry(s, hours=early_minutes / 60)
        parts.append(x.select(KEY, "path"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if cohort is not None:
        out = out.join(cohort.select(KEY), KEY, "left_semi")
    return out.distinct()


def split_codes(paths: DataFrame, path: str = "path") -> DataFrame:
    """B11 + H15/H16: family, and the path split into levels after stripping boilerplate.

    Output ``(path, family, parts)``; strings of no known family are left out
    and counted by :func:`dropped_families`.
    """
    fam = prefix_family(path)
    p = F.col(path)
    parts = (F.when(F.col("family") == "main", H.split_path(p, "|"))
              .when(F.col("family") == "admission", H.split_path(H.strip_literals(p, ADMISSION_STRIP), "|"))
              .when(F.col("family") == "past_history_organ",
                    H.split_path(H.strip_literals(p, ORGAN_STRIP), "/"))
              .when(F.col("family") == "past_history_options",
                    H.split_path(H.strip_literals(p, OPTIONS_STRIP), "/")))
    out = paths.select(path).distinct().withColumn("family", fam)
    return out.where(F.col("family") != "other").withColumn("parts", parts)


def dropped_families(pairs: DataFrame, path: str = "path") -> DataFrame:
    """What :func:`split_codes` leaves out: one row ``(n_strings, n_pairs)``."""
    other = pairs.withColumn("_family", prefix_family(path)).where(F.col("_family") == "other")
    return other.agg(F.count_distinct(path).cast("long").alias("n_strings"),
                     F.count(F.lit(1)).cast("long").alias("n_pairs"))


def string_codes(split: DataFrame, path: str = "path", max_depth: int = MAX_DEPTH,
                 exact_depth: int = EXACT_DEPTH) -> DataFrame:
    """``(path, code, depth, leaf, parent_leaf)`` for every prefix of every string."""
    pref = split.select(path, "parts", F.posexplode(H.path_prefixes("parts", max_depth, exact_depth))
                        .alias("_i", "code"))
    depth = F.col("_i") + 1
    return pref.select(path, "code", depth.alias("depth"),
                       F.element_at("parts", depth.cast("int")).alias("leaf"),
                       F.when(depth > 1, F.element_at("parts", F.col("_i").cast("int"))).alias("parent_leaf"))


def code_prefixes(pairs: DataFrame, path: str = "path", max_depth: int = MAX_DEPTH,
                  exact_depth: int = EXACT_DEPTH) -> tuple[DataFrame, DataFrame]:
    """I8: distinct ``(stay, code)`` for all ancestors of each stay's strings.

    Returns ``(stay_codes, string_code_map)``; the map is the vocabulary side.
    """
    smap = string_codes(split_codes(pairs, path), path, max_depth, exact_depth)
    m = smap.select(path, "code")
    stay_codes = pairs.join(m, path, "inner").select(KEY, "code").distinct()
    return stay_codes, smap


def pointless_codes(smap: DataFrame, path: str = "path", rule: str = "counter") -> DataFrame:
    """Codes dropped as uninformative.

    * ``rule='counter'`` (the reference's code): exactly two distinct strings
      pass through the node; ``rule='only_child'``: the node's parent has a
      single child.
    * a node whose own title equals its parent's title (case-insensitive).

    Output ``(code, n_strings, reason)``.
    """
    node = smap.groupBy("code").agg(F.count_distinct(path).cast("long").alias("n_strings"),
                                    F.first("leaf").alias("leaf"), F.first("parent_leaf").alias("parent_leaf"),
                                    F.first("depth").alias("depth"))
    if rule == "counter":
        a = node.where(F.col("n_strings") == 2).select("code", "n_strings", F.lit("counter").alias("reason"))
    else:
        parent = F.expr("substring(code, 1, length(code) - length(leaf) - 1)")
        kids = (node.where(F.col("depth") > 1).select(parent.alias("parent"), "code")
                    .groupBy("parent").agg(F.count(F.lit(1)).alias("_kids"),
                                           F.first("code").alias("child")))
        a = (kids.where(F.col("_kids") == 1).select(F.col("parent").alias("code"))
                 .join(node, "code").select("code", "n_strings", F.lit("only_child").alias("reason")))
    b = node.where(F.col("parent_leaf").isNotNull() & H.eq_ignore_case("leaf", "parent_leaf")).select(
        "code", "n_strings", F.lit("title_equals_parent").alias("reason"))
    return a.unionByName(b)


def code_prevalence(stay_codes: DataFrame) -> DataFrame:
    """Number of stays per code."""
    return stay_codes.groupBy("code").agg(F.count_distinct(KEY).cast("long").alias("n_stays"))


def rare_codes(stay_codes: DataFrame, n_stays: DataFrame | int, min_frac: float = 0.01) -> DataFrame:
    """Codes held by at most ``bround(min_frac * n_stays)`` stays.

    ``n_stays`` is the number of stays with at least one code string (a
    one-row ``n`` DataFrame or an int).  Output ``(code, n_stays, cut_off)``.
    """
    prev = code_prevalence(stay_codes)
    if isinstance(n_stays, int):
        out = prev.withColumn("cut_off", F.lit(int(round(min_frac * n_stays))).cast("long"))
    else:
        c = n_stays.select(F.bround(F.col("n") * F.lit(float(min_frac))).cast("long").alias("cut_off"))
        out = cross_scalar(prev, c)
    return out.where(F.col("n_stays") <= F.col("cut_off"))


def encode_codes(pairs: DataFrame, series_stays: DataFrame | None = None, min_frac: float = 0.01,
                 path: str = "path", rule: str = "counter", max_depth: int = MAX_DEPTH,
                 exact_depth: int = EXACT_DEPTH) -> DataFrame:
    """Ancestors -> drop pointless and rare codes -> restrict to stays with a series.

    Output long ``(stay, code)`` (the multi-hot matrix in sparse form).
    The ``(stay, path)`` pairs are checkpointed: the vocabulary side, the stay
    count and the pair side all read them.
    """
    pairs = checkpoint(pairs)
    stay_codes, smap = code_prefixes(pairs, path, max_depth, exact_depth)
    n = pairs.agg(F.count_distinct(KEY).cast("long").alias("n"))
    drop = (pointless_codes(smap, path, rule).select("code")
            .unionByName(rare_codes(stay_codes, n, min_frac).select("code")).distinct())
    kept = stay_codes.join(drop, "code", "left_anti")
    if series_stays is not None:
        kept = kept.join(series_stays.select(KEY), KEY, "left_semi")
    return kept


def codes_per_stay(kept: DataFrame, stays: DataFrame) -> DataFrame:
    """Number of kept codes per stay, 0 for stays without codes."""
    counts = kept.groupBy(KEY).agg(F.count(F.lit(1)).cast("long").alias("n_codes"))
    return left_zero_fill(stays.select(KEY).distinct(), counts, KEY)


def collect_codes(kept: DataFrame) -> DataFrame:
    """Sorted list of codes per stay (bounded by the code vocabulary)."""
    return kept.groupBy(KEY).agg(F.array_sort(F.collect_set("code")).alias("codes"))


def merge_columns(long: DataFrame, mapping: DataFrame, key: str = KEY, feature: str = "feature",
                  value: str = "value") -> DataFrame:
    """Sum the columns (long features) that map to the same group name."""
    m = mapping.select(F.col("feature").alias(feature), "group")
    j = long.join(m, feature, "left")
    g = F.coalesce(F.col("group"), F.col(feature))
    return j.groupBy(key, g.alias(feature)).agg(F.sum(value).alias(value))


def code_ids(kept: DataFrame) -> DataFrame:
    """``(code, code_id)``: dense ids from 0 in code order, the columns of the sparse matrix."""
    return global_rank(kept.select("code").distinct(), [F.col("code")], "_r").select("code", (F.col("_r") - 1).alias("code_id"))


def to_sparse_rows(kept: DataFrame, ids: DataFrame, stays: DataFrame | None = None) -> DataFrame:
    """I11 sink: the 0/1 matrix in compressed rows ``(stay, indices, n_codes)``.

    ``indices`` are the ascending column ids of a stay's codes; with ``stays`` every one of them has a row,
    an empty one without codes.  No column per code: the width of the matrix is not bounded.
    """
    rows = kept.join(ids, "code").groupBy(KEY).agg(F.array_sort(F.collect_set("code_id")).alias("indices"))
    if stays is not None:
        rows = stays.select(KEY).distinct().join(rows, KEY, "left").withColumn(
            "indices", F.coalesce("indices", F.array().cast("array<bigint>")))
    return rows.select(KEY, "indices", F.size("indices").cast("long").alias("n_codes"))


def from_sparse_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``(stay, code)`` of compressed rows."""
    return rows.select(KEY, F.explode("indices").alias("code_id")).join(ids, "code_id").select(KEY, "code")


def to_multi_hot(kept: DataFrame, codes: Sequence[str], stays: DataFrame | None = None) -> DataFrame:
    """Sink: wide 0/1 matrix, one column per code (vocabulary collected by the caller)."""
    base = kept if stays is None else stays.select(KEY).join(kept, KEY, "left")
    cols = [F.max(F.when(F.col("code") == c, F.lit(1)).otherwise(F.lit(0))).alias(c) for c in codes]
    return base.groupBy(KEY).agg(*cols)
