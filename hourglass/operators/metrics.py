"""Metrics and losses as distributed aggregates (inventory L1-L19, H22/H23/H28).

Every metric is one or two aggregate passes over ``(y_true, y_pred)`` rows.
Rank-based curves (AUROC/AUPRC) need cumulative counts over distinct
scores; those are computed with a distributed prefix sum (range-sorted
partitions + a tiny per-partition offset table), never in one task.
Semantics follow the public behaviour of the sklearn functions the
reference calls (label union for kappa, half credit for ties, the PR curve
anchored at recall 0 / precision 1).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions import scalar as H
from hourglass.sources.io import checkpoint

# ----------------------------------------------------------------- regression


def _cell_sums(yt: Column, yp: Column) -> list[Column]:
    """What a cell of the confusion table carries: mergeable sums for every regression metric."""
    err = yt - yp
    terms = {"mad": F.abs(err), "mse": err * err, "mape": F.abs(err) / F.greatest(F.lit(4.0 / 24.0), yt),
             "msle": F.pow(F.ln(F.try_divide(yt, yp)), 2)}
    sums = [f(x).alias(f"{kind}_{name}") for name, x in terms.items() for kind, f in (("s", F.sum), ("c", F.count))]
    return [*sums, F.count(F.lit(1)).alias("n"), F.count(yt).alias("c_y"), F.avg(yt).alias("mean_y"), F.var_pop(yt).alias("var_y")]


def _r2(ss_res: Column, ss_tot: Column) -> Column:
    return (F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
             .otherwise(F.lit(1.0) - ss_res / ss_tot))


def _total(cells: str | Column, term: Callable[[Column], Column]) -> Column:
    """Sum of a term over an array of cells."""
    return F.aggregate(cells, F.lit(0.0), lambda acc, x: acc + F.coalesce(term(x).cast("double"), F.lit(0.0)))


def binned(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Add ``bin_true``/``bin_pred`` (10 LoS bins)."""
    return df.withColumn("bin_true", H.los_bin(y_true)).withColumn("bin_pred", H.los_bin(y_pred))


def binned_confusion(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Confusion matrix of the LoS bins in long form ``(bin_true, bin_pred, count)``."""
    return (binned(df, y_true, y_pred).groupBy("bin_true", "bin_pred")
            .agg(F.count(F.lit(1)).cast("long").alias("count")))


def _kappa(cells: str) -> Column:
    """Linear kappa from an array of cells ``(bin_true, bin_pred, n, ...)``, at most 10 x 10.

    Weights are ``|i - j|`` where i, j index the bins present in either vector, as with a label union.
    """
    c = F.filter(cells, lambda x: x["bin_true"].isNotNull() & x["bin_pred"].isNotNull())
    present = F.array_sort(F.array_distinct(F.concat(F.transform(c, lambda x: x["bin_true"]), F.transform(c, lambda x: x["bin_pred"]))))
    place = F.transform(c, lambda x: F.struct(F.array_position(present, x["bin_true"]).alias("i"),
                                              F.array_position(present, x["bin_pred"]).alias("j"), x["n"].alias("n")))
    observed = _total(place, lambda x: F.abs(x["i"] - x["j"]) * x["n"])
    expected = _total(place, lambda x: x["n"] * _total(place, lambda y: F.abs(x["i"] - y["j"]) * y["n"]))
    return F.lit(1.0) - F.try_divide(observed, expected / _total(place, lambda x: x["n"]))


def linear_kappa(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                 by: Sequence[str] = ()) -> DataFrame:
    """Cohen's kappa with linear weights over the LoS bins.

    The input is counted into confusion cells once (at most 10 x 10 per group);
    the present bins and the marginals come from the array of a group's cells.
    """
    cells = binned(df, y_true, y_pred).groupBy(*by, "bin_true", "bin_pred").agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(*by).agg(F.collect_list(F.struct("bin_true", "bin_pred", "n")).alias("_cells"))
    rows = rows.where(F.size("_cells") > 0)
    return rows.select(*by, _kappa("_cells").alias("kappa"))


def regression_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                      by: Sequence[str] = ()) -> DataFrame:
    """L8 (L1-L5, L7): ``mad, mse, mape, msle, r2, kappa`` per group.

    One pass: the rows are aggregated by confusion cell, every cell carrying the sums of all metrics,
    and a group's (at most 121) cells are merged; variances merge by their cells' means.
    """
    yt, yp = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    cells = binned(df, y_true, y_pred).groupBy(*by, "bin_true", "bin_pred").agg(*_cell_sums(yt, yp))
    fields = [c for c in cells.columns if c not in by]
    rows = cells.groupBy(*by).agg(F.collect_list(F.struct(*fields)).alias("_c")).where(F.size("_c") > 0)

    def mean(name: str) -> Column:
        return F.try_divide(_total("_c", lambda x: x[f"s_{name}"]), _total("_c", lambda x: x[f"c_{name}"]))

    rows = rows.withColumn("_mean", F.try_divide(_total("_c", lambda x: x["c_y"] * x["mean_y"]), _total("_c", lambda x: x["c_y"])))
    ss_tot = _total("_c", lambda x: x["c_y"] * (x["var_y"] + F.pow(x["mean_y"] - F.col("_mean"), 2)))
    return rows.select(*by, mean("mad").alias("mad"), mean("mse").alias("mse"), (mean("mape") * 100.0).alias("mape"),
                       mean("msle").alias("msle"),
                       _r2(_total("_c", lambda x: x["s_mse"]), ss_tot).alias("r2"), _kappa("_c").alias("kappa"))


# ----------------------------------------------------------------- classification
def binary_confusion(df: DataFrame, y_true: str = "y_true", p: str = "p",
                     by: Sequence[str] = ()) -> DataFrame:
    """``tn, fp, fn, tp`` with prediction ``p > 0.5`` (a tie goes to class 0)."""
    y = F.col(y_true).cast("int")
    pred = (F.col(p) > 0.5).cast("int")
    return df.groupBy(*by).agg(
        F.sum(((y == 0) & (pred == 0)).cast("long")).alias("tn"),
        F.sum(((y == 0) & (pred == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (pred == 0)).cast("long")).alias("fn"),
        F.sum(((y == 1) & (pred == 1)).cast("long")).alias("tp"))


def cumulative(df: DataFrame, order: Sequence[Column], cols: Sequence[str],
               suffix: str = "_cum") -> DataFrame:
    """Distributed inclusive prefix sums of ``cols`` in a total ``order``.

    Rows are range-partitioned by ``orderBy``; per-partition totals (one row
    per partition) give each partition's offset, and a window inside each
    partition adds the running sum.  No step holds more than one partition.
    """
    s = checkpoint(df.orderBy(*order).withColumn("_pid", F.spark_partition_id()))
    tot = s.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}")
                                for c in cols])
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(F.broadcast(offs), "_pid")
    for c in cols:
        out = out.withColumn(c + suffix, F.col(f"_o_{c}") + F.sum(c).over(w))
    return out.drop("_pid", *[f"_o_{c}" for c in cols])


def score_table(df: DataFrame, y_true: str = "y_true", p: str = "p") -> DataFrame:
    """Per distinct score (descending): positives/negatives at the score and at or above it."""
    y = F.col(y_true).cast("int")
    per = df.groupBy(F.col(p).alias("score")).agg(
        F.sum((y == 1).cast("long")).alias("pos"), F.sum((y == 0).cast("long")).alias("neg"))
    # written, for a range order reads its rows twice: once to find the ranges
    return cumulative(checkpoint(per), [F.desc("score")], ["pos", "neg"])


def _curve_areas(t: DataFrame) -> DataFrame:
    """AUROC/AUPRC from the cumulative per-score table (class totals taken from it too)."""
    tot = t.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = t.crossJoin(F.broadcast(tot))
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    roc = (fp - fp0) / N * (tp + tp0) / P / F.lit(2.0)
    prec = tp / (tp + fp)
    prec0 = F.when((tp0 + fp0) == 0, F.lit(1.0)).otherwise(tp0 / (tp0 + fp0))
    pr = (tp - tp0) / P * (prec + prec0) / F.lit(2.0)
    return j.agg(F.sum(roc).alias("auroc"), F.sum(pr).alias("auprc"))


def auroc_auprc(df: DataFrame, y_true: str = "y_true", p: str = "p") -> DataFrame:
    """L11 + L12: exact areas from cumulative counts at each distinct threshold.

    ROC: trapezoids between consecutive (FPR, TPR) points (ties -> half
    credit).  PR: trapezoids between consecutive (recall, precision) points
    with the anchor (0, 1); the previous point of each threshold is obtained
    by subtracting its own counts, so no cross-partition lag is needed.  The
    input is read once (the per-score aggregate); class totals come from the
    checkpointed score table.
    """
    return _curve_areas(score_table(df, y_true, p))


def classification_report(df: DataFrame, y_true: str = "y_true", p: str = "p") -> DataFrame:
    """L14 (L9-L13): accuracy, per-class precision/recall, AUROC, AUPRC, macro F1.

    One pass over the input: the confusion counts (``p > 0.5``) are sums over
    the per-score table, which the curves use as well.
    """
    t = score_table(df, y_true, p)
    above = F.col("score") > 0.5
    cm = t.agg(F.sum(F.when(~above, F.col("neg")).otherwise(0)).alias("tn"),
               F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
               F.sum(F.when(~above, F.col("pos")).otherwise(0)).alias("fn"),
               F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"))
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    f1_1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    f1_0 = F.coalesce(F.try_divide(2 * tn, 2 * tn + fn + fp), F.lit(0.0))
    base = cm.select(
        F.try_divide(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        F.try_divide(tn, tn + fn).alias("prec0"), F.try_divide(tp, tp + fp).alias("prec1"),
        F.try_divide(tn, tn + fp).alias("rec0"), F.try_divide(tp, tp + fn).alias("rec1"),
        ((f1_0 + f1_1) / F.lit(2.0)).alias("f1_macro"))
    return base.crossJoin(_curve_areas(t))


# ----------------------------------------------------------------- losses
def sequence_loss(df: DataFrame, key: str, y_true: str = "y_true", y_pred: str = "y_pred",
                  kind: str = "msle", sum_losses: bool = True,
                  valid: str | None = None) -> DataFrame:
    """Per sequence sum of squared (log) errors over valid rows,
    optionally divided by ``max(length, 1)``, then the mean over sequences."""
    d = df if valid is None else df.where(F.col(valid) == 1)
    if kind == "msle":
        e = F.ln(F.col(y_pred)) - F.ln(F.col(y_true))
    else:
        e = F.col(y_pred) - F.col(y_true)
    per = d.groupBy(key).agg(F.sum(e * e).alias("_l"), F.count(F.lit(1)).alias("_n"))
    loss = F.col("_l") if sum_losses else F.col("_l") / F.greatest(F.col("_n"), F.lit(1))
    return per.agg(F.avg(loss).alias("loss"))


def bce(df: DataFrame, y_true: str = "y_true", p: str = "p", alpha: float = 1.0) -> DataFrame:
    """Mean binary cross-entropy (logs clamped at -100 like torch) times ``alpha``."""
    y = F.col(y_true).cast("double")
    lp = F.greatest(F.ln(F.col(p)), F.lit(-100.0))
    lq = F.greatest(F.ln(F.lit(1.0) - F.col(p)), F.lit(-100.0))
    lp = F.coalesce(lp, F.lit(-100.0))
    lq = F.coalesce(lq, F.lit(-100.0))
    return df.agg((F.avg(-(y * lp + (F.lit(1.0) - y) * lq)) * F.lit(alpha)).alias("bce"))


def multitask_loss(los: DataFrame, mort: DataFrame, key: str, alpha: float = 100.0,
                   sum_losses: bool = True) -> DataFrame:
    """LoS sequence MSLE + ``alpha`` x mortality BCE."""
    a = sequence_loss(los, key, sum_losses=sum_losses)
    b = bce(mort, alpha=alpha)
    return a.crossJoin(b).select("loss", "bce", (F.col("loss") + F.col("bce")).alias("total"))


def mean_loss(df: DataFrame, batch: str, key: str, y_true: str = "y_true",
              y_pred: str = "y_pred", sum_losses: bool = True) -> DataFrame:
    """MSLE loss per batch of sequences, then the mean over batches."""
    e = F.ln(F.col(y_pred)) - F.ln(F.col(y_true))
    per = df.groupBy(batch, key).agg(F.sum(e * e).alias("_l"), F.count(F.lit(1)).alias("_n"))
    loss = F.col("_l") if sum_losses else F.col("_l") / F.greatest(F.col("_n"), F.lit(1))
    per_batch = per.groupBy(batch).agg(F.avg(loss).alias("batch_loss"))
    return per_batch.agg(F.avg("batch_loss").alias("mean_loss"),
                         F.count(F.lit(1)).cast("long").alias("n_batches"))


def constant_baseline(train: DataFrame, test: DataFrame, y_true: str = "y_true") -> DataFrame:
    """Regression report on ``test`` predicting the train mean and the train median."""
    from hourglass.operators.quantiles import quantiles

    med = quantiles(train, y_true, (), (0.5,), ("_median",))
    stats = train.agg(F.avg(y_true).alias("_mean")).crossJoin(med)
    t = test.crossJoin(F.broadcast(stats))
    rows = (t.select(F.lit("mean").alias("predictor"), F.col(y_true).alias("y_true"),
                     F.col("_mean").alias("y_pred"))
             .unionByName(t.select(F.lit("median").alias("predictor"), F.col(y_true).alias("y_true"),
                                   F.col("_median").alias("y_pred"))))
    return regression_report(rows, by=["predictor"])
