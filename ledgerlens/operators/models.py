"""Model fitting, tuning and scoring on Spark ML.

Estimators are distributed Spark ML estimators; candidate fits run side by
side, on hash folds or, for classifiers, on stratified ones.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import reduce
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_table
from .features import encoder_stages, fold_column, standardise, stratified_folds
from .ordering import running_totals
from .windows import percent_below


# ----------------------------------------------------------------------------- M10–M12
def linear_regressor(kind: str = "linear", alpha: float = 1.0, label_sd: float | None = None,
                     n: int | None = None, label: str = "label", features: str = "features"):
    """Plain, ridge or lasso regression with the analysed library's penalty scale.

    Ridge: Spark scales the L2 term by the label deviation, so
    ``regParam = alpha · sd_pop(label) / n``; lasso: ``regParam = alpha``.
    """
    if kind == "linear":
        return LinearRegression(labelCol=label, featuresCol=features, solver="normal", regParam=0.0)
    if kind == "ridge":
        if label_sd is None or n is None:
            raise ValueError("ridge needs label_sd and n")
        return LinearRegression(labelCol=label, featuresCol=features, solver="normal", elasticNetParam=0.0,
                                regParam=alpha * label_sd / n, standardization=False)
    if kind == "lasso":
        return LinearRegression(labelCol=label, featuresCol=features, elasticNetParam=1.0, regParam=alpha,
                                standardization=False, maxIter=200)
    raise ValueError(kind)


def tree_regressor(kind: str = "forest", label: str = "label", features: str = "features", seed: int = 42, **kw):
    """Decision tree, random forest or gradient-boosted trees.

    A forest keeps every row's node per tree between its passes in place of
    walking each tree from its root again (``cacheNodeIds``; the same forest).
    """
    kw = {"cacheNodeIds": True} | kw if kind == "forest" else kw
    cls = {"tree": DecisionTreeRegressor, "forest": RandomForestRegressor, "gbt": GBTRegressor}[kind]
    return cls(labelCol=label, featuresCol=features, seed=seed, **kw)


# ----------------------------------------------------------------------------- M13–M15
def weighted_classifier(kind: str = "logistic", label: str = "label", features: str = "features",
                        weight: str = "weight", seed: int = 42, **kw):
    """Class-balanced logistic regression, random forest, boosted trees."""
    if kind == "logistic":
        return LogisticRegression(labelCol=label, featuresCol=features, weightCol=weight, maxIter=100, **kw)
    if kind == "forest":
        return RandomForestClassifier(labelCol=label, featuresCol=features, weightCol=weight, seed=seed,
                                      **{"cacheNodeIds": True} | kw)  # see tree_regressor
    if kind == "gbt":
        return GBTClassifier(labelCol=label, featuresCol=features, weightCol=weight, seed=seed, **kw)
    raise ValueError(kind)


def positive_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """``scale_pos_weight`` = negatives / positives as a weight column."""
    c = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("q")).first()
    ratio = (c["q"] / c["p"]) if c["p"] else 1.0
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(ratio)).otherwise(F.lit(1.0)))


def pipeline(categorical: Sequence[str], numeric: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[*encoder_stages(categorical, numeric), estimator])


# ----------------------------------------------------------------------------- M16–M18
def cross_validate(pipe: Pipeline, df: DataFrame, key: str, evaluator, k: int = 5, grid=None,
                   parallelism: int = 4, seed: int = 42, stratify: str | None = None):
    """K-fold CV; returns (fitted CV model, mean metrics, sd metrics).

    ``stratify`` names a classifier's label: every fold then holds each class
    in the same proportion (``stratified_folds``); without it folds go by hash.
    """
    folded = stratified_folds(df, stratify, key, k, seed) if stratify else fold_column(df, key, k, seed)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid or [{}], evaluator=evaluator,
                        numFolds=k, foldCol="fold", parallelism=parallelism, collectSubModels=False)
    m = cv.fit(folded)
    return m, list(m.avgMetrics), list(m.stdMetrics)


def out_of_fold(models: Mapping[str, Pipeline], df: DataFrame, key: str, label: str = "label", fold: str = "fold",
                classifier: bool = False, parallelism: int = 4, prepare: Pipeline | None = None) -> DataFrame:
    """``key, model, fold, label, prediction`` — what each model says about
    every row when fitted to the other folds; classifiers add ``score``, the
    probability of class 1.

    ``fold`` holds whole numbers from 0.  Fits run ``parallelism`` at a time
    and their predictions are written side by side, so metrics of any number
    of models and folds are one aggregate over one table.

    ``prepare`` are stages that all models share.  They are fitted once per
    fold, to the rows the models are fitted to, and what they make of the rows
    is kept until the fold's last model is done, so a fit reads finished vectors.
    """
    from multiprocessing.pool import ThreadPool
    from threading import Lock

    rows, kept, lock = df.persist(), {}, Lock()
    try:
        folds = [r[0] for r in rows.select(fold).distinct().orderBy(fold).collect()]
        left = dict.fromkeys(folds, len(models))

        def prepared(f):
            if prepare is None:
                return rows
            with lock:
                if f not in kept:
                    kept[f] = prepare.fit(rows.where(F.col(fold) != f)).transform(rows).persist()
                return kept[f]

        def predict(task):
            f, name = task
            ready = prepared(f)
            model = models[name].fit(ready.where(F.col(fold) != f))
            out = model.transform(ready.where(F.col(fold) == f))
            score = [vector_to_array("probability")[1].alias("score")] if classifier else []
            out = scratch_table(out.select(key, F.lit(name).alias("model"), F.lit(f).cast("int").alias("fold"),
                                           F.col(label).cast("double").alias("label"), "prediction", *score), "out-of-fold")
            with lock:
                left[f] -= 1
                if not left[f] and f in kept:
                    kept[f].unpersist()
            return out

        with ThreadPool(parallelism) as pool:
            parts = pool.map(predict, [(f, name) for f in folds for name in models], chunksize=1)
    finally:
        for ready in kept.values():
            ready.unpersist()
        rows.unpersist()
    return reduce(DataFrame.unionByName, parts)


def cv_regression_metrics(predictions: DataFrame) -> DataFrame:
    """Per model MAE, RMSE and R² over all out-of-fold predictions, and mean and
    population sd over the folds of each fold's R².

    One aggregate by (model, fold) of sums; the rest is arithmetic on one row
    per model and fold.  A fold whose labels are all equal has no R².
    """
    error = F.col("label") - F.col("prediction")
    per = predictions.groupBy("model", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(error)).alias("abs"), F.sum(error * error).alias("sq"),
        F.var_pop("label").alias("var"), F.avg("label").alias("mean"))
    r2 = 1 - F.try_divide(F.col("sq"), F.col("n") * F.col("var"))
    w = Window.partitionBy("model")  # one row per fold
    centre = F.sum(F.col("mean") * F.col("n")).over(w) / F.sum("n").over(w)
    per = per.withColumns({"r2": r2, "ss": F.col("n") * (F.col("var") + (F.col("mean") - centre) * (F.col("mean") - centre))})
    return per.groupBy("model").agg(
        (F.sum("abs") / F.sum("n")).alias("mae"), F.sqrt(F.sum("sq") / F.sum("n")).alias("rmse"),
        (1 - F.try_divide(F.sum("sq"), F.sum("ss"))).alias("r2"),
        F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_sd"), F.count("r2").alias("folds"))


def cv_auc(predictions: DataFrame) -> DataFrame:
    """Per model mean and population sd over the folds of the area under the ROC curve.

    Ranks come from one running count over (model, fold, score) counts, so a
    score that many rows share is one row; equal scores count half.
    """
    counts = predictions.groupBy("model", "fold", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    run = running_totals(counts, ["model", "fold", "score"], ["neg"], prefix="to_")
    first = run.groupBy("model", "fold").agg(F.min(F.col("to_neg") - F.col("neg")).alias("from_neg"))  # one row per fit
    below = F.col("to_neg") - F.col("from_neg") - F.col("neg") / 2
    per = run.join(F.broadcast(first), ["model", "fold"]).groupBy("model", "fold").agg(
        F.try_divide(F.sum(F.col("pos") * below), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))
    return per.groupBy("model").agg(F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_sd"),
                                    F.count("auc").alias("folds"))


def draw_candidates(grid: Mapping[str, Sequence], n: int = 10, seed: int = 42) -> list[dict]:
    """``n`` distinct combinations of a grid (all, if it has no more), the same for a seed.

    Combinations are drawn by number and a number is read as digits, one per
    parameter; the product itself is never built.
    """
    total = prod(len(values) for values in grid.values())
    rnd, numbers = random.Random(seed), {}
    if total <= 2 * n:
        numbers = dict.fromkeys(rnd.sample(range(total), min(n, total)))
    while len(numbers) < min(n, total):
        numbers[rnd.randrange(total)] = None
    out = []
    for number in numbers:
        chosen = {}
        for name, values in grid.items():
            number, digit = divmod(number, len(values))
            chosen[name] = values[digit]
        out.append(chosen)
    return out


def random_search(build, grid: Mapping[str, Sequence], train: DataFrame, key: str, n: int = 10, k: int = 5,
                  label: str = "label", seed: int = 42, parallelism: int = 4,
                  prepare: Pipeline | None = None) -> tuple[DataFrame, PipelineModel]:
    """Random search over ``grid`` for a regression; returns (candidates with their CV R², fitted best).

    ``build(**parameters)`` gives the pipeline of a combination.  Candidates
    are compared by cross-validation within ``train`` alone; the best (of
    equals the first drawn) is fitted to all of it, so rows kept apart judge
    it afterwards.  ``prepare``: the stages before it that no parameter
    changes, fitted once per fold (``out_of_fold``).
    """
    drawn = draw_candidates(grid, n, seed)
    folded = fold_column(train, key, k, seed)
    found = cv_regression_metrics(out_of_fold({str(i): build(**c) for i, c in enumerate(drawn)}, folded, key, label,
                                              parallelism=parallelism, prepare=prepare)).collect()
    score = {int(r["model"]): r for r in found}
    best = max(range(len(drawn)), key=lambda i: (score[i]["cv_r2_mean"], -i))
    rows = [(i, str(c), score[i]["cv_r2_mean"], score[i]["cv_r2_sd"], score[i]["folds"], i == best) for i, c in enumerate(drawn)]
    table = train.sparkSession.createDataFrame(
        rows, "candidate int, parameters string, cv_r2_mean double, cv_r2_sd double, folds long, is_best boolean")
    model = build(**drawn[best])
    if prepare is None:
        return table, model.fit(train)
    first = prepare.fit(train)
    ready = first.transform(train).persist()
    try:
        return table, PipelineModel([first, model.fit(ready)])
    finally:
        ready.unpersist()


def compare_models(spark, results: dict[str, dict], metric: str, higher_is_better: bool = True) -> DataFrame:
    """One row per model with its metrics and a best flag."""
    names = sorted({k for r in results.values() for k in r})
    rows = [(m, *[float(r.get(k)) if r.get(k) is not None else None for k in names]) for m, r in results.items()]
    df = spark.createDataFrame(rows, ["model", *names])
    best = (max if higher_is_better else min)(results, key=lambda m: results[m][metric])
    return df.withColumn("is_best", F.col("model") == F.lit(best))


def feature_importance(model: PipelineModel, df: DataFrame, features: str = "features") -> list[tuple[str, float]]:
    """Named feature importances (tree models) or absolute coefficients, sorted."""
    out = model.transform(df.limit(1))
    attrs = out.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray()
    else:
        vals = abs(last.coefficients.toArray())
    return sorted(((names.get(i, f"f{i}"), float(v)) for i, v in enumerate(vals)), key=lambda t: -t[1])


# ----------------------------------------------------------------------------- M20–M22
def cluster_features(df: DataFrame, cols: Sequence[str], log_cols: Sequence[str] = ()) -> DataFrame:
    """log1p of skewed columns, population standardisation (M7), assembled vector."""
    src = df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in log_cols})
    src = standardise(src, cols)
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip").transform(src)


#: Rows of a block, rows of a block met at a time, and bytes of blocks that a task holds to meet them.
_BLOCK, _STRIP, _HELD = 5000, 8, 64 << 20


def silhouette(df: DataFrame, cluster: str = "prediction", features: str = "features", rows: int | None = None,
               seed: int = 42) -> DataFrame:
    """Euclidean silhouette of all rows with a cluster, one row: ``rows, silhouette``.

    A point alone in its cluster counts 0, and fewer than two clusters give
    null, as in the usual definition.  With ``rows`` it is that of as many
    rows, those of smallest hash of their features.
    """
    points = df.select(F.col(cluster).cast("int").alias("c"), vector_to_array(features).alias("x")).where("c IS NOT NULL")
    if rows is not None:
        points = points.orderBy(F.xxhash64("x", F.lit(seed)), "x", "c").limit(rows)
    found = _silhouettes(points.select(F.array("c").alias("c"), "x"), 1)
    return df.sparkSession.createDataFrame(found, "rows long, silhouette double")


def _silhouettes(points: DataFrame, n: int) -> list[tuple[int, float | None]]:
    """Rows and Euclidean silhouette of ``n`` clusterings of the same points: ``c``, a point's cluster in each, and ``x``.

    Every point meets every other, and one distance serves all clusterings.
    Points are packed into blocks, sorted by their clusters; each block meets
    all blocks, and per point and cluster a sum of distances is kept, never a
    pair.  A task holds a bounded share of the blocks and nothing of the
    points is gathered; the driver sees one row per cluster.
    """
    points = scratch_table(points, "silhouette-points")
    counts = points.select(F.posexplode("c").alias("q", "c")).groupBy("q", "c").count().orderBy("q", "c").collect()
    names = [np.array([r["c"] for r in counts if r["q"] == q]) for q in range(n)]
    first = np.cumsum([0, *map(len, names)])  # clusters of all clusterings are numbered in one row
    sizes = np.array([r["count"] for r in counts])
    total = sum(r["count"] for r in counts if r["q"] == 0)
    if all(len(c) < 2 for c in names):
        return [(total, None)] * n

    def pack(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(i, _BLOCK)
                c = part.column(0).flatten().to_numpy().reshape(part.num_rows, n)
                c = np.stack([first[q] + np.searchsorted(names[q], c[:, q]) for q in range(n)], axis=1).astype("<i8")
                runs, code, length = np.unique(c, axis=0, return_inverse=True, return_counts=True)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)[np.argsort(code.ravel(), kind="stable")]
                yield pa.RecordBatch.from_pydict({"x": [x.T.astype("<f8").tobytes()], "runs": [runs.tobytes()],
                                                  "length": [length.astype("<i8").tobytes()]})

    def unpack(x, runs, length):
        length = np.frombuffer(length, "<i8")
        return np.frombuffer(x, "<f8").reshape(-1, length.sum()), np.frombuffer(runs, "<i8").reshape(-1, n), length

    def distances(x, y, starts):
        """Run by column of ``x``: the sum of its distances to the columns of ``y`` in that run; runs begin at ``starts``."""
        sums = np.empty((x.shape[1], len(starts)))
        whole = np.empty((2, _STRIP, y.shape[1]))
        for i in range(0, x.shape[1], _STRIP):
            strip = x[:, i:i + _STRIP, None]
            total, square = whole[:, :strip.shape[1]]
            for d in range(len(x)):
                out = square if d else total
                np.subtract(strip[d], y[d], out=out)
                np.multiply(out, out, out=out)
                if d:
                    np.add(total, square, out=total)
            np.sqrt(total, out=total)
            np.add.reduceat(total, starts, axis=1, out=sums[i:i + _STRIP])
        return np.ascontiguousarray(sums.T)

    def meet(batches):
        def met():
            return pa.RecordBatch.from_pydict({"block": [block], "runs": [own[1]], "length": [own[2]], "sums": [sums.tobytes()]})

        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = [column[i].as_py() for column in batch.columns]
                if row[0] != block:
                    if block is not None:
                        yield met()
                    block, own = row[0], row[1:4]
                    x = unpack(*own)[0]
                    sums = np.zeros((len(sizes), x.shape[1]))
                y, runs, length = unpack(*row[4:])
                for clusters, far in zip(runs, distances(x, y, np.cumsum(length) - length)):
                    sums[clusters] += far
        if block is not None:
            yield met()

    def widths(table):
        runs, length = (np.frombuffer(table.column(name)[0].as_py(), "<i8") for name in ("runs", "length"))
        owns = np.repeat(runs.reshape(-1, n), length, axis=0)
        sums = sum(np.frombuffer(s.as_py(), float).reshape(len(sizes), len(owns)) for s in table.column("sums"))
        row, out = np.arange(len(owns)), []
        for q in range(n):
            mine, clusters = owns[:, q], slice(first[q], first[q + 1])
            inside = sums[mine, row] / np.maximum(1, sizes[mine] - 1)
            means = sums[clusters] / sizes[clusters, None]
            means[mine - first[q], row] = np.inf
            other = means.min(axis=0) if len(means) > 1 else inside
            out.append(np.where(sizes[mine] > 1, (other - inside) / np.maximum(np.maximum(inside, other), 1e-300), 0.0).sum())
        return pa.table({"q": pa.array(range(n), pa.int32()), "width": out})

    parts = max(1, total // (16 * _BLOCK))
    blocks = points.coalesce(parts).mapInArrow(pack, "x binary, runs binary, length binary").select(
        F.monotonically_increasing_id().alias("block"), "*")
    blocks = scratch_table(blocks, "silhouette-blocks")
    held = 1 + blocks.agg(F.sum(F.length("x") + F.length("runs"))).first()[0] // _HELD
    own = blocks.repartitionByRange(blocks.count(), "block")  # a block is a task
    other = blocks.coalesce(held).toDF("with", "y", "y_runs", "y_length").drop("with").hint("shuffle_replicate_nl")
    sums = own.crossJoin(other).mapInArrow(meet, "block long, runs binary, length binary, sums binary")
    found = sums.groupBy("block").applyInArrow(widths, "q int, width double").groupBy("q").agg(F.sum("width").alias("w")).collect()
    width = {r["q"]: r["w"] for r in found}
    return [(total, width[q] / total if len(names[q]) > 1 else None) for q in range(n)]


def choose_k(df: DataFrame, ks: Sequence[int] = range(2, 9), starts: int = 10, seed: int = 42,
             parallelism: int = 4) -> list[dict]:
    """Per k the best of ``starts`` seeded K-means fits (lowest cost), its
    Euclidean silhouette and Spark's squared-Euclidean silhouette, both over
    all rows.  The fits read one written column of features, ``parallelism``
    at a time; each holds its vectors in memory, which Spark leaves out for a
    cached table (it would decode that table again in every iteration).  The
    distance of two rows is taken once for all k."""
    from multiprocessing.pool import ThreadPool

    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    vectors = scratch_table(df.select("features"), "vectors")

    def fit(task):
        k, s = task
        m = KMeans(k=k, seed=seed + s, featuresCol="features", maxIter=50).fit(vectors)
        return k, m.summary.trainingCost, s, m

    with ThreadPool(parallelism) as pool:
        fits = pool.map(fit, [(k, s) for k in ks for s in range(starts)], chunksize=1)
    best = [min((f for f in fits if f[0] == k), key=lambda f: f[1:3]) for k in ks]
    placed = vectors
    for i, (_, _, _, m) in enumerate(best):
        placed = m.transform(placed, {m.predictionCol: f"c{i}"})
    placed = placed.select(F.array(*[f"c{i}" for i in range(len(best))]).alias("c"), vector_to_array("features").alias("x"))
    return [{"k": k, "inertia": cost, "model": m, "squared_silhouette": ev.evaluate(m.transform(vectors)), "silhouette": found[1]}
            for (k, cost, _, m), found in zip(best, _silhouettes(placed, len(best)))]


def assign_clusters(model, df: DataFrame, name: str = "cluster") -> DataFrame:
    """M21."""
    return model.transform(df).withColumnRenamed("prediction", name)


def cluster_profile(df: DataFrame, cluster: str, value: str, means: Sequence[str], rates: Sequence[str],
                    mode_col: str | None = None) -> DataFrame:
    """Count, % of rows, median of ``value``, means, rates and mode per cluster."""
    from .aggregate import mode_by
    from .ordering import attach_row, with_quantiles
    agg = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                  *[F.avg(F.col(m).cast("double")).alias(f"mean_{m}") for m in means],
                                  *[F.avg(F.col(r).cast("double")).alias(f"rate_{r}") for r in rates])
    agg = attach_row(agg, agg.agg(F.sum("n").alias("__all"))).withColumn(
        "pct_of_rows", F.col("n").cast("double") * 100 / F.col("__all")).drop("__all")
    agg = with_quantiles(agg, df, [cluster], value, {"median": 0.5})
    if mode_col:
        agg = agg.join(mode_by(df, cluster, mode_col, "mode"), cluster, "left")
    return agg


# ----------------------------------------------------------------------------- M23, M24
# Cut-offs and labels of the exit probability.
TIERS = ((0.5, "High likelihood"), (0.25, "Moderate likelihood"))
LOWEST_TIER = "Lower likelihood"


def score(reg_model: PipelineModel, clf_model: PipelineModel, df: DataFrame,
          tiers=TIERS, default_tier: str = LOWEST_TIER, known: DataFrame | None = None,
          amount: str | None = None) -> DataFrame:
    """Batch scoring — predicted amount (expm1 of the log prediction),
    exit probability, tier, and with ``known`` the percentage of its non-null
    ``amount`` values below the prediction."""
    from ..functions.columns import tier
    r = reg_model.transform(df).withColumn("predicted_amount", F.expm1("prediction")).drop(
        "prediction", "features", *[c for c in reg_model.transform(df.limit(0)).columns if c.endswith(("__idx", "__ohe"))])
    keep = [c for c in r.columns if not c.endswith(("__idx", "__ohe"))]
    c = clf_model.transform(r.select(*keep))
    c = c.withColumn("exit_probability", vector_to_array("probability")[1])
    c = c.withColumn("tier", tier("exit_probability", [t for t, _ in tiers], [n for _, n in tiers],
                                  default=default_tier))
    return c if known is None else percent_below(c, "predicted_amount", known, amount, "percentile")


def learning_curve(pipe: Pipeline, df: DataFrame, key: str, evaluator, sizes: Sequence[float],
                   k: int = 3, seed: int = 42) -> list[dict]:
    """CV metric on nested hash samples of growing size, and the metric
    on the sample itself of a model fitted to all of it."""
    from .features import hash_unit
    out = []
    for frac in sizes:
        sub = df.where(hash_unit(key, seed + 101) < frac).persist()
        _, mean, sd = cross_validate(pipe, sub, key, evaluator, k=k, seed=seed)
        own = evaluator.evaluate(pipe.fit(sub).transform(sub))
        sub.unpersist()
        out.append({"fraction": frac, "metric_mean": mean[0], "metric_sd": sd[0], "training_metric": own})
    return out


def regression_evaluator(label: str = "label", metric: str = "r2"):
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def auc_evaluator(label: str = "label"):
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
