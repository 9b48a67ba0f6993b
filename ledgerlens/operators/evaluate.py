"""Model evaluation on any DataFrame of labels and predictions.

Every metric is an aggregation.  Curves (ROC, PR) work on per-score counts
with distributed running totals, so they are exact without a single-task
sort; threshold sweeps are one pass of conditional sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import attach_row, running_totals, with_quantiles


def _x(c):
    return F.col(c).cast("double")


# ----------------------------------------------------------------------------- E1
def regression_metrics(df: DataFrame, label: str, pred: str, n_features: int | None = None) -> DataFrame:
    """MAE, MSE, RMSE, median AE, explained variance, R², adjusted R²,
    MAPE (non-zero actuals), RMSLE (raw scale, null if any value ≤ -1)."""
    y, p = _x(label), _x(pred)
    src = df.where(y.isNotNull() & p.isNotNull()).select(y.alias("y"), p.alias("p"))
    e = F.col("p") - F.col("y")
    agg = src.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.var_pop(F.col("y") - F.col("p")).alias("__vres"), F.var_pop("y").alias("__vy"),
        F.sum(e * e).alias("__ssr"), (F.var_pop("y") * F.count(F.lit(1))).alias("__sst"),
        F.avg(F.when(F.col("y") != 0, F.abs(e / F.col("y")))).alias("mape"),
        F.when(F.min(F.least("y", "p")) > -1, F.sqrt(F.avg(F.pow(F.log1p("p") - F.log1p("y"), 2)))).alias("rmsle"))
    out = agg.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                     (1 - F.col("__vres") / F.col("__vy")).alias("explained_variance"),
                     (1 - F.col("__ssr") / F.col("__sst")).alias("r2"), "mape", "rmsle")
    if n_features is not None:
        out = out.withColumn("adj_r2", 1 - (1 - F.col("r2")) * (F.col("n") - 1) / (F.col("n") - n_features - 1))
    return with_quantiles(out, src.select(F.abs(e).alias("ae")), [], "ae", {"median_ae": 0.5})


# ----------------------------------------------------------------------------- E2, E3, E13
def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str, pred: str, prob: str | None = None,
                           eps: float = 1e-15) -> DataFrame:
    """Binary metrics from confusion counts; log loss from clipped probabilities."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    aggs = [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn")]
    if prob:
        q = F.least(F.greatest(_x(prob), F.lit(eps)), F.lit(1 - eps))
        aggs.append(F.avg(-(y * F.log(q) + (1 - y) * F.log(1 - q))).alias("log_loss"))
    c = df.agg(*aggs)
    tp, fp, tn, fn = [F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn")]
    n = tp + fp + tn + fn
    prec = F.try_divide(tp, tp + fp)
    rec = F.try_divide(tp, tp + fn)
    spec = F.try_divide(tn, tn + fp)
    acc = (tp + tn) / n
    pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    mcc = F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    cols = ["tp", "fp", "tn", "fn", acc.alias("accuracy"), ((rec + spec) / 2).alias("balanced_accuracy"),
            prec.alias("precision"), rec.alias("recall"), spec.alias("specificity"),
            F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
            F.try_divide(acc - pe, 1 - pe).alias("cohen_kappa"), mcc.alias("mcc")]
    if prob:
        cols.append("log_loss")
    return c.select(*cols)


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1 and support."""
    both = df.select(F.col(label).alias("y"), F.col(pred).alias("p"))
    per_true = both.groupBy(F.col("y").alias("cls")).agg(F.count(F.lit(1)).alias("support"),
                                                         F.count_if(F.col("y") == F.col("p")).alias("__tp"))
    per_pred = both.groupBy(F.col("p").alias("cls")).agg(F.count(F.lit(1)).alias("__pp"))
    j = per_true.join(per_pred, "cls", "full").na.fill(0, ["support", "__tp", "__pp"])
    prec = F.try_divide(F.col("__tp").cast("double"), F.col("__pp").cast("double"))
    rec = F.try_divide(F.col("__tp").cast("double"), F.col("support").cast("double"))
    return j.select("cls", prec.alias("precision"), rec.alias("recall"),
                    F.try_divide(2 * prec * rec, prec + rec).alias("f1"), "support")


# ----------------------------------------------------------------------------- E4, E5
def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives and negatives, with running totals from
    the highest score down (distributed)."""
    per = df.where(F.col(score).isNotNull()).groupBy(_x(score).alias("score")).agg(
        F.count_if(F.col(label).cast("int") == 1).alias("pos"),
        F.count_if(F.col(label).cast("int") != 1).alias("neg"))
    return running_totals(per, [F.col("score").desc()], ["pos", "neg"], prefix="cum_")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest first."""
    c = score_counts(df, label, score)
    tot = c.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = attach_row(c, tot)
    return j.select(F.col("score").alias("threshold"),
                    (F.col("cum_neg") / F.col("N")).alias("fpr"), (F.col("cum_pos") / F.col("P")).alias("tpr"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (trapezoids between successive
    thresholds; tied scores form one diagonal segment)."""
    c = score_counts(df, label, score)
    area = c.agg((F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos")) / 2.0)
                  / (F.sum("pos") * F.sum("neg"))).alias("auc"),
                 F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    return area


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """E5: (threshold, precision, recall) per distinct score."""
    c = score_counts(df, label, score)
    tot = c.agg(F.sum("pos").alias("P"))
    j = attach_row(c, tot)
    return j.select(F.col("score").alias("threshold"),
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    (F.col("cum_pos") / F.col("P")).alias("recall"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """E5: step-wise average precision Σ (Rₙ − Rₙ₋₁)·Pₙ."""
    c = score_counts(df, label, score)
    return c.agg((F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
                  / F.sum("pos")).alias("average_precision"))


# ----------------------------------------------------------------------------- E6, E7
def calibration(df: DataFrame, label: str, prob: str, bins: int = 10) -> DataFrame:
    """Quantile bins of the predicted probability (distinct edges), mean
    prediction and observed positive rate per bin."""
    from .windows import quantile_bins
    b = quantile_bins(df.where(F.col(prob).isNotNull()), prob, bins, name="bin")
    return b.groupBy("bin").agg(F.avg(_x(prob)).alias("mean_predicted"),
                                F.avg(F.col(label).cast("double")).alias("fraction_positive"),
                                F.count(F.lit(1)).alias("n"))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Precision, recall and F1 at each threshold (default 0.10..0.90 by
    0.05) in one pass of conditional sums; ``is_best`` marks the top F1."""
    ts = thresholds or [round(0.10 + 0.05 * i, 2) for i in range(17)]
    y = F.col(label).cast("int") == 1
    s = _x(score)
    aggs = [F.count_if(y).alias("__P")]
    for i, t in enumerate(ts):
        aggs += [F.count_if(y & (s >= F.lit(t))).alias(f"tp{i}"), F.count_if(~y & (s >= F.lit(t))).alias(f"fp{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"CAST({t} AS DOUBLE), tp{i}, fp{i}" for i, t in enumerate(ts))
    long = wide.selectExpr("__P", f"stack({len(ts)}, {stack}) as (threshold, tp, fp)")
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("__P").cast("double"))
    f1 = F.try_divide(2 * prec * rec, prec + rec)
    out = long.select("threshold", "tp", "fp", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))
    from .ordering import small_window
    best = F.max("f1").over(small_window())  # one row per threshold
    return out.withColumn("is_best", F.coalesce(F.col("f1") == best, F.lit(False)))


# ----------------------------------------------------------------------------- E8–E12
def worst_predictions(df: DataFrame, label: str, pred: str, n: int = 10, key: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest absolute errors (distributed top-n)."""
    e = F.abs(_x(pred) - _x(label))
    return df.withColumn("abs_error", e).orderBy(F.col("abs_error").desc(), *key).limit(n)


def error_buckets(df: DataFrame, label: str, pred: str, edges: Sequence[float]) -> DataFrame:
    """Rows and mean absolute error per bucket of the absolute error:
    bucket ``i`` holds errors from ``edges[i - 1]`` up to below ``edges[i]``."""
    src = df.select(F.abs(_x(pred) - _x(label)).alias("e")).where(F.col("e").isNotNull())
    bucket = sum((F.when(F.col("e") >= F.lit(float(x)), 1).otherwise(0) for x in edges), F.lit(0))
    return src.groupBy(bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.avg("e").alias("mae"))


def error_by(df: DataFrame, label: str, pred: str, group: str) -> DataFrame:
    """Mean absolute error and count per group."""
    return df.groupBy(group).agg(F.avg(F.abs(_x(pred) - _x(label))).alias("mae"), F.count(F.lit(1)).alias("n"))


def miss_profile(df: DataFrame, label: str, pred: str, score: str, features: Sequence[str]) -> DataFrame:
    """Among actual positives, false negatives vs true positives:
    count, feature means and median score."""
    pos = df.where(F.col(label).cast("int") == 1).withColumn(
        "outcome", F.when(F.col(pred).cast("int") == 1, F.lit("true_positive")).otherwise(F.lit("false_negative")))
    agg = pos.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"),
                                     *[F.avg(_x(f)).alias(f"mean_{f}") for f in features])
    return with_quantiles(agg, pos, ["outcome"], score, {"median_score": 0.5})


def residual_distribution(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Mean and sample sd of residuals; :func:`residual_histogram` has their distribution."""
    r = _x(label) - _x(pred)
    return df.agg(F.avg(r).alias("mean_residual"), F.stddev_samp(r).alias("sd_residual"),
                  F.count(r).alias("n"))


def residual_histogram(df: DataFrame, label: str, pred: str, bins: int = 50) -> DataFrame:
    """Residuals in ``bins`` equal-width bins, ``(bin, lo, hi, count)``, empty bins included."""
    from .aggregate import histogram
    return histogram(df.select((_x(label) - _x(pred)).alias("residual")), "residual", bins)


def leakage_check(df: DataFrame, label: str, candidates: Sequence[str]) -> DataFrame:
    """Correlation of each candidate with the label on pairwise-complete
    rows (``corr`` itself leaves out rows with a null), in one pass."""
    wide = df.agg(*[a for i, c in enumerate(candidates) for a in (
        F.corr(_x(c), _x(label)).alias(f"r{i}"),
        F.count_if(F.col(c).isNotNull() & F.col(label).isNotNull()).alias(f"n{i}"))])
    rows = ", ".join(f"'{c}', r{i}, n{i}" for i, c in enumerate(candidates))
    return wide.selectExpr(f"stack({len(candidates)}, {rows}) AS (feature, corr, n)")
