"""User-supplied predictors over distributed rows (inventory M2, M3).

The predictor is the only Python in the hot path, and it runs batch-wise
through Arrow (``mapInPandas``): the model is shipped once per task, never
called row by row from the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.operators.split import global_rank, seeded_hash
from hourglass.sources.io import checkpoint


def score_sequences(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                    schema: str) -> DataFrame:
    """M2: apply ``fn`` (pandas in, pandas out) to every Arrow batch of ``df``."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def linear_los_scorer(weight: float, bias: float, values_col: str = "values",
                      keys: Sequence[str] = ("stay", "time")) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A deterministic scorer: ``clip(exp(bias + weight * sum(values)), 1/48, 100)``."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        s = np.zeros(len(pdf))
        full = np.flatnonzero(pdf[values_col].notna())
        if len(full):  # the batch as one matrix
            s[full] = np.stack(pdf[values_col].iloc[full].to_list()).sum(axis=1)
        y = np.clip(np.exp(bias + weight * s), 1.0 / 48.0, 100.0)
        out = pdf[list(keys)].copy()
        out["y_pred"] = y
        return out
    return fn


def permute_column(df: DataFrame, col: str, seed: str, id_col: str,
                   placed: DataFrame | None = None) -> DataFrame:
    """Replace ``col`` by a seeded permutation of itself (one shuffle of two columns).

    Row positions come from the id order and the permutation from a seeded
    hash order; both ranks are distributed (no single-task ordering), and the
    value of the row ranked ``r`` by hash moves to the row at position ``r``.
    Pass ``placed`` (:func:`placed_rows` of ``df``) to share the positions between permutations.
    """
    placed = placed_rows(df, id_col) if placed is None else placed
    src = df.select(id_col, col).withColumn("_h", seeded_hash(id_col, seed))
    perm = global_rank(src, [F.col("_h"), F.col(id_col)], "_pos").select("_pos", F.col(col).alias("_new"))
    return placed.join(perm, "_pos").withColumn(col, F.col("_new")).drop("_new", "_pos")


def placed_rows(df: DataFrame, id_col: str) -> DataFrame:
    """The rows with their position ``_pos`` in the order of the ids, written once for all permutations."""
    pos = global_rank(df.select(id_col), [F.col(id_col)], "_pos")
    return checkpoint(df.join(pos, id_col))


def permutation_importance_batch(df: DataFrame, fn: Callable[[pd.DataFrame], np.ndarray],
                                 loss: Callable[[np.ndarray, np.ndarray], np.ndarray], cols: Sequence[str],
                                 id_col: str, y_col: str, n_repeats: int = 5, seed: int = 0) -> DataFrame:
    """M3 with a batch predictor: ``(feature, importance_mean, importance_std)``, the mean loss with the
    column permuted less the mean loss without.

    ``fn`` takes a pandas frame with ``cols`` and returns predictions, ``loss`` gives one number a row.
    There is one permutation per repeat for all columns: rows stand in a seeded order, and every row
    takes the values of the next one (the last of the first).  A row and its donor meet by one
    sort and one join a repeat; a task then scores the batch as it is and with each column replaced, and
    hands on sums and counts, which are all that is shuffled after that.
    """
    keep = list(dict.fromkeys([id_col, y_col, *cols]))
    base = checkpoint(df.select(*keep))

    def sums(batches, repeat: int):
        for pdf in batches:
            y = pdf[y_col].to_numpy()
            plain = pdf[list(cols)]
            for c in [None, *cols] if repeat == 0 else cols:
                x = plain if c is None else plain.assign(**{c: pdf[f"_new_{c}"]})
                lost = loss(y, np.asarray(fn(x)))
                yield pd.DataFrame({"feature": [c], "repeat": [repeat], "s": [float(lost.sum())], "n": [len(lost)]})

    parts = None
    for r in range(n_repeats):
        ranked = global_rank(base.withColumn("_h", seeded_hash(id_col, f"{seed}|{r}|")), [F.col("_h"), F.col(id_col)], "_r").drop("_h")
        n = ranked.agg(F.max("_r").alias("_n"))
        donor = ranked.crossJoin(F.broadcast(n)).select(
            F.when(F.col("_r") == 1, F.col("_n")).otherwise(F.col("_r") - 1).alias("_r"), *[F.col(c).alias(f"_new_{c}") for c in cols])
        rows = ranked.join(donor, "_r").drop("_r")
        part = rows.mapInPandas(lambda b, r=r: sums(b, r), "feature string, repeat int, s double, n long")
        parts = part if parts is None else parts.unionByName(part)
    means = checkpoint(parts.groupBy("feature", "repeat").agg((F.sum("s") / F.sum("n")).alias("loss")))
    plain = means.where(F.col("feature").isNull()).select(F.col("loss").alias("_plain"))
    imp = means.where(F.col("feature").isNotNull()).crossJoin(F.broadcast(plain))
    gain = F.col("loss") - F.col("_plain")
    return imp.groupBy("feature").agg(F.avg(gain).alias("importance_mean"), F.stddev_pop(gain).alias("importance_std"))


def permutation_importance(df: DataFrame, score: Callable[[DataFrame], Column],
                           metric: Callable[[DataFrame], DataFrame], cols: Sequence[str],
                           id_col: str, n_repeats: int = 5, seed: int = 0) -> DataFrame:
    """M3: ``baseline - metric`` after permuting one column, per column and repeat.

    ``score(df)`` returns the prediction column, ``metric(df_with_y_pred)`` a
    one-row DataFrame with column ``score`` (higher is better).  Output
    ``(feature, importance_mean, importance_std)`` with the population std.
    """
    df = checkpoint(df)  # read by every repeat, made once
    base = metric(df.withColumn("y_pred", score(df))).select(F.col("score").alias("_base"))
    placed = placed_rows(df, id_col)  # shared by all repeats
    parts = []
    for c in cols:
        for r in range(n_repeats):
            p = permute_column(df, c, f"{seed}|{r}|{c}|", id_col, placed)
            m = metric(p.withColumn("y_pred", score(p)))
            parts.append(m.select(F.lit(c).alias("feature"), F.lit(r).alias("repeat"), "score"))
    allm = parts[0]
    for p in parts[1:]:
        allm = allm.unionByName(p)
    imp = allm.crossJoin(F.broadcast(base)).withColumn("importance", F.col("_base") - F.col("score"))
    return imp.groupBy("feature").agg(F.avg("importance").alias("importance_mean"),
                                      F.stddev_pop("importance").alias("importance_std"))
