"""E-series against brute-force definitions on small data."""

import math

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate as E

ROWS = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.7), (0, 0.4), (0, 0.4), (1, 0.3), (0, 0.1)]


def test_auc_and_ap_brute_force(spark):
    df = spark.createDataFrame(ROWS, "y int, s double")
    pos = [s for y, s in ROWS if y == 1]
    neg = [s for y, s in ROWS if y == 0]
    auc = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(E.roc_auc(df, "y", "s").first()["auc"] - auc) < 1e-12
    # average precision, step rule over distinct thresholds
    ap, prev_r = 0.0, 0.0
    for t in sorted({s for _, s in ROWS}, reverse=True):
        tp = sum(1 for y, s in ROWS if s >= t and y == 1)
        fp = sum(1 for y, s in ROWS if s >= t and y == 0)
        r = tp / len(pos)
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert abs(E.average_precision(df, "y", "s").first()["average_precision"] - ap) < 1e-12
    curve = E.roc_curve(df, "y", "s").orderBy("threshold").collect()
    assert curve[0].tpr == 1.0 and curve[0].fpr == 1.0


def test_classification_metrics(spark):
    df = spark.createDataFrame([(y, int(s >= 0.5), s) for y, s in ROWS], "y int, p int, s double")
    m = E.classification_metrics(df, "y", "p", "s").first()
    assert (m.tp, m.fp, m.tn, m.fn) == (3, 1, 3, 1)
    assert abs(m.precision - 0.75) < 1e-12 and abs(m.recall - 0.75) < 1e-12
    ll = -np.mean([y * math.log(s) + (1 - y) * math.log(1 - s) for y, s in ROWS])
    assert abs(m.log_loss - ll) < 1e-12
    rep = {r.cls: r for r in E.classification_report(df, "y", "p").collect()}
    assert rep[1].support == 4 and abs(rep[0].recall - 0.75) < 1e-12


def test_threshold_sweep_best(spark):
    df = spark.createDataFrame(ROWS, "y int, s double")
    out = E.threshold_sweep(df, "y", "s").collect()
    assert len(out) == 17
    best = [r for r in out if r.is_best]
    assert best and all(b.f1 == max(r.f1 for r in out if r.f1 is not None) for b in best)


def test_regression_metrics(spark):
    y = np.array([3.0, -0.5, 2.0, 7.0])
    p = np.array([2.5, 0.0, 2.0, 8.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    m = E.regression_metrics(df, "y", "p").first()
    assert abs(m.mae - 0.5) < 1e-12 and abs(m.mse - 0.375) < 1e-12
    assert abs(m.r2 - (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-12
    assert abs(m.median_ae - 0.5) < 1e-12
    assert m.rmsle is not None
