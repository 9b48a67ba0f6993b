"""Registered queries: features and models (M) and explanations (X).

Model fits are not SQL-expressible; those queries are rows-only.  Feature
preparation steps that are plain aggregations carry DuckDB oracles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import explain as X
from ..operators import features as M
from ..operators import models as ML
from ..operators import evaluate as E
from ..operators.evaluate import roc_auc
from ..operators.ordering import attach_row
from ..session import read_tables, scratch_table
from .catalog import query
from .catalog_more import wide
from .star import startup_entities
from .oracle_ctes import with_star

NUMERIC = ["funding_rounds", "years_since_founded", "num_round_types_used", "category_count"]
FLAGS = ["is_multi_round", "has_debt_financing"]
CATEG = ["industry_grouped", "country_grouped"]
LABEL_REG = "log_funding_total_usd"
LABEL_CLF = "is_exited"


def modeling(spark, sf):
    """M1 + M2: the modelling table, complete cases only."""
    w = wide(spark, sf)
    t = M.modeling_table(w, NUMERIC, FLAGS,
                         {"industry_grouped": ("primary_category", 5), "country_grouped": ("country_name", 5)},
                         [LABEL_REG, LABEL_CLF], "startup_id")
    return t.withColumn(LABEL_CLF, F.col(LABEL_CLF).cast("int"))


_COMPLETE_SQL = """funding_rounds IS NOT NULL AND years_since_founded IS NOT NULL AND num_round_types_used IS NOT NULL
  AND category_count IS NOT NULL AND log_funding_total_usd IS NOT NULL"""


@query("m1_modeling_table", with_star("""
WITH ti AS (SELECT primary_category FROM feat WHERE primary_category IS NOT NULL GROUP BY primary_category
            ORDER BY COUNT(*) DESC, primary_category LIMIT 5),
tc AS (SELECT country_name FROM feat WHERE country_name IS NOT NULL GROUP BY country_name
       ORDER BY COUNT(*) DESC, country_name LIMIT 5)
SELECT startup_id, CAST(funding_rounds AS DOUBLE) AS funding_rounds, CAST(years_since_founded AS DOUBLE) AS years_since_founded,
  CAST(num_round_types_used AS DOUBLE) AS num_round_types_used, CAST(category_count AS DOUBLE) AS category_count,
  CAST(is_multi_round AS INTEGER) AS is_multi_round, CAST(has_debt_financing AS INTEGER) AS has_debt_financing,
  COALESCE(ti.primary_category, 'Other') AS industry_grouped, COALESCE(tc.country_name, 'Other') AS country_grouped,
  log_funding_total_usd, CAST(is_exited AS INTEGER) AS is_exited
FROM feat f LEFT JOIN ti ON f.primary_category = ti.primary_category LEFT JOIN tc ON f.country_name = tc.country_name"""))
def m1_modeling_table(spark, sf):
    return modeling(spark, sf)


_ALL = NUMERIC + FLAGS + CATEG + [LABEL_REG]


@query("m2_complete_cases", with_star("""
SELECT COUNT(*) AS n FROM feat WHERE funding_rounds IS NOT NULL AND years_since_founded IS NOT NULL
  AND num_round_types_used IS NOT NULL AND category_count IS NOT NULL AND log_funding_total_usd IS NOT NULL"""))
def m2_complete_cases(spark, sf):
    return M.complete_cases(modeling(spark, sf), _ALL).agg(F.count(F.lit(1)).alias("n"))


def _data(spark, sf):
    return M.complete_cases(modeling(spark, sf), _ALL)


# The hash has no SQL form; that the parts are both there, overlap nowhere and make up all rows has one.
@query("m3_hash_split", with_star(f"SELECT COUNT(*) AS rows, 0 AS in_both, true AS both_parts FROM feat WHERE {_COMPLETE_SQL}"))
def m3_hash_split(spark, sf):
    train, test = M.split(_data(spark, sf), "startup_id", 0.2)
    parts = train.select("startup_id", F.lit(1).alias("train"), F.lit(0).alias("test")).unionByName(
        test.select("startup_id", F.lit(0).alias("train"), F.lit(1).alias("test")))
    per = parts.groupBy("startup_id").agg(F.max("train").alias("train"), F.max("test").alias("test"))
    return per.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("train") * F.col("test")).cast("int").alias("in_both"),
                   ((F.max("train") == 1) & (F.max("test") == 1)).alias("both_parts"))


# Sizes are exact and hash-independent: round(0.2 · n_class) rows of each class go to test.
@query("m4_stratified_split", with_star("""
WITH d AS (SELECT CAST(is_exited AS INTEGER) AS is_exited FROM feat WHERE funding_rounds IS NOT NULL
  AND years_since_founded IS NOT NULL AND num_round_types_used IS NOT NULL AND category_count IS NOT NULL
  AND log_funding_total_usd IS NOT NULL),
c AS (SELECT is_exited, COUNT(*) AS n, CAST(round(COUNT(*) * 0.2) AS BIGINT) AS t FROM d GROUP BY is_exited)
SELECT is_exited, true AS is_test, t AS n FROM c WHERE t > 0
UNION ALL SELECT is_exited, false AS is_test, n - t AS n FROM c WHERE n - t > 0"""))
def m4_stratified_split(spark, sf):
    s = M.stratified_split(_data(spark, sf), LABEL_CLF, "startup_id", 0.2)
    return M.split_sizes(s, "is_test", LABEL_CLF)


# Two splits that SQL can name: the first fifth of each class by key, and every fifth key.
_DRIFT_COLS = ["funding_rounds", "years_since_founded"]


@query("m4_split_drift", with_star(f"""
WITH d AS (SELECT startup_id, CAST(is_exited AS INTEGER) AS is_exited, CAST(funding_rounds AS DOUBLE) AS funding_rounds,
  CAST(years_since_founded AS DOUBLE) AS years_since_founded FROM feat WHERE {_COMPLETE_SQL}),
parts AS (
  SELECT 'stratified' AS split, *, ROW_NUMBER() OVER (PARTITION BY is_exited ORDER BY startup_id)
    <= CAST(round(COUNT(*) OVER (PARTITION BY is_exited) * 0.2) AS BIGINT) AS is_test FROM d
  UNION ALL SELECT 'unstratified', *, startup_id % 5 = 0 FROM d),
classes AS (SELECT split, 'class' AS kind, CAST(is_exited AS VARCHAR) AS name,
    abs(COUNT(*) FILTER (WHERE NOT is_test) / SUM(COUNT(*) FILTER (WHERE NOT is_test)) OVER (PARTITION BY split)
      - COUNT(*) FILTER (WHERE is_test) / SUM(COUNT(*) FILTER (WHERE is_test)) OVER (PARTITION BY split)) AS drift
  FROM parts GROUP BY split, is_exited),
long AS (SELECT split, is_test, 'funding_rounds' AS name, funding_rounds AS v FROM parts
  UNION ALL SELECT split, is_test, 'years_since_founded', years_since_founded FROM parts),
per AS (SELECT split, name, v, COUNT(*) FILTER (WHERE is_test) AS a, COUNT(*) FILTER (WHERE NOT is_test) AS b
  FROM long GROUP BY split, name, v),
run AS (SELECT split, name, abs(SUM(a) OVER w / SUM(a) OVER t - SUM(b) OVER w / SUM(b) OVER t) AS gap
  FROM per WINDOW w AS (PARTITION BY split, name ORDER BY v), t AS (PARTITION BY split, name))
SELECT split, kind, name, CAST(drift AS DOUBLE) AS drift FROM classes
UNION ALL SELECT split, 'numeric', name, CAST(MAX(gap) AS DOUBLE) FROM run GROUP BY split, name"""))
def m4_split_drift(spark, sf):
    d = _data(spark, sf)
    splits = {"stratified": M.stratified_split(d, LABEL_CLF, "startup_id", 0.2, shuffle=False),
              "unstratified": d.withColumn("is_test", F.col("startup_id") % 5 == 0)}
    out = []
    for name, parts in splits.items():
        out.append(M.class_drift(parts, LABEL_CLF).select(
            F.lit(name).alias("split"), F.lit("class").alias("kind"), F.col(LABEL_CLF).cast("string").alias("name"), "drift"))
        out.append(M.numeric_drift(parts, _DRIFT_COLS).select(
            F.lit(name).alias("split"), F.lit("numeric").alias("kind"), F.col("feature").alias("name"),
            F.col("distance").alias("drift")))
    return reduce(lambda a, b: a.unionByName(b), out)


# Hash splits have no SQL form; that stratifying leaves the classes no further apart has one.
@query("m4_stratified_against_unstratified", "SELECT true AS not_worse, true AS within_a_row")
def m4_stratified_against_unstratified(spark, sf):
    d = _data(spark, sf)
    by_class = M.class_drift(M.stratified_split(d, LABEL_CLF, "startup_id", 0.2), LABEL_CLF)
    plain = M.class_drift(d.withColumn("is_test", M.hash_unit("startup_id", 7) < 0.2), LABEL_CLF)
    n = d.agg(F.count(F.lit(1)).alias("n"))
    worst = attach_row(attach_row(by_class.agg(F.max("drift").alias("own")), plain.agg(F.max("drift").alias("other"))), n)
    # rounding each class to whole rows moves a share by a row of the test part at most
    return worst.select((F.col("own") <= F.col("other")).alias("not_worse"),
                        (F.col("own") <= 1 / (0.2 * F.col("n") - 1)).alias("within_a_row"))


@query("m5_encode")
def m5_encode(spark, sf):
    from pyspark.ml import Pipeline
    train, test = M.split(_data(spark, sf), "startup_id", 0.2)
    model = Pipeline(stages=M.encoder_stages(CATEG, NUMERIC + FLAGS)).fit(train)
    out = model.transform(test)
    return out.select("startup_id", "features")


@query("m5_encoded_levels", with_star(f"""
WITH ti AS (SELECT primary_category FROM feat WHERE primary_category IS NOT NULL GROUP BY primary_category
            ORDER BY COUNT(*) DESC, primary_category LIMIT 5)
SELECT COALESCE(ti.primary_category, 'Other') AS level, CAST(COUNT(*) AS DOUBLE) AS total
FROM feat f LEFT JOIN ti ON f.primary_category = ti.primary_category WHERE {_COMPLETE_SQL.replace(" AND category_count", " AND f.category_count")}
GROUP BY 1"""))
def m5_encoded_levels(spark, sf):
    """Every level has a column of its own, and the column's sum is the level's number of rows."""
    from pyspark.ml import Pipeline
    d = _data(spark, sf)
    out = Pipeline(stages=M.encoder_stages(["industry_grouped"], [])).fit(d).transform(d)
    levels = [a["name"] for a in out.schema["industry_grouped__ohe"].metadata["ml_attr"]["attrs"]["binary"]]
    sums = out.select(vector_to_array("industry_grouped__ohe").alias("v")).agg(
        F.array(*[F.sum(F.col("v")[i]) for i in range(len(levels))]).alias("sums"))
    pairs = F.arrays_zip(F.array(*map(F.lit, levels)).alias("level"), F.col("sums"))
    return sums.select(F.explode(pairs).alias("p")).select(F.col("p")["level"].alias("level"), F.col("p")["sums"].alias("total"))


@query("m6_impute", with_star("""
SELECT startup_id, COALESCE(CAST(years_since_founded AS DOUBLE),
    (SELECT quantile_cont(CAST(years_since_founded AS DOUBLE), 0.5) FROM feat)) AS years_since_founded,
  COALESCE(country_name, 'Unknown') AS country_name FROM feat"""))
def m6_impute(spark, sf):
    w = wide(spark, sf).select("startup_id", "years_since_founded", "country_name")
    return M.impute_constant(M.impute_median(w, ["years_since_founded"]), ["country_name"])


@query("m7_standardise", with_star("""
SELECT startup_id, (CAST(funding_rounds AS DOUBLE) - AVG(CAST(funding_rounds AS DOUBLE)) OVER ())
  / STDDEV_POP(CAST(funding_rounds AS DOUBLE)) OVER () AS funding_rounds FROM feat"""))
def m7_standardise(spark, sf):
    return M.standardise(wide(spark, sf).select("startup_id", "funding_rounds"), ["funding_rounds"])


@query("m8_variance_filter", with_star("""
SELECT 'funding_rounds' AS feature, VAR_POP(CAST(funding_rounds AS DOUBLE)) AS variance,
  VAR_POP(CAST(funding_rounds AS DOUBLE)) > 0.5 AS keep FROM feat
UNION ALL SELECT 'category_count', VAR_POP(CAST(category_count AS DOUBLE)), VAR_POP(CAST(category_count AS DOUBLE)) > 0.5
FROM feat"""))
def m8_variance_filter(spark, sf):
    return M.variance_filter(wide(spark, sf), ["funding_rounds", "category_count"], 0.5)


def _mi_sql():
    cc = ("funding_rounds IS NOT NULL AND years_since_founded IS NOT NULL AND num_round_types_used IS NOT NULL "
          "AND category_count IS NOT NULL AND log_funding_total_usd IS NOT NULL")
    part = """
  SELECT '{f}' AS feature, SUM(nxy / n * LN(nxy * n / (nx * ny))) AS mi FROM (
    SELECT b, y, CAST(COUNT(*) AS DOUBLE) AS nxy,
      CAST(SUM(COUNT(*)) OVER (PARTITION BY b) AS DOUBLE) AS nx,
      CAST(SUM(COUNT(*)) OVER (PARTITION BY y) AS DOUBLE) AS ny,
      CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS n
    FROM (SELECT 1 + (SELECT COUNT(*) FROM edges_{f} ed WHERE CAST(base.{f} AS DOUBLE) > ed.e) AS b, y
          FROM base) t
    GROUP BY b, y) j"""
    feats = NUMERIC
    edges = "".join(f""",
all_{f} AS (SELECT DISTINCT unnest(quantile_cont(CAST({f} AS DOUBLE), [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])) AS e FROM base),
edges_{f} AS (SELECT e FROM all_{f} WHERE e > (SELECT MIN(e) FROM all_{f}) AND e < (SELECT MAX(e) FROM all_{f}))"""
                    for f in feats)
    body = " UNION ALL ".join(part.format(f=f) for f in feats)
    return with_star(f"""WITH base AS (SELECT {", ".join(NUMERIC)}, CAST(is_exited AS INTEGER) AS y
  FROM feat WHERE {cc}){edges} {body}""")


@query("m9_mutual_information", _mi_sql())
def m9_mutual_information(spark, sf):
    return M.mutual_information(_data(spark, sf), NUMERIC, LABEL_CLF)


#: Trees and depth of the analysed application's forest; its 150 boosting rounds are 20 here, each being several Spark jobs.
FOREST, ROUNDS = {"numTrees": 100, "maxDepth": 12}, 20


def _regressor(kind, sd=None, n=None):
    if kind in ("linear", "ridge", "lasso"):
        return ML.linear_regressor(kind, 1.0 if kind == "ridge" else 0.01, sd, n)
    return ML.tree_regressor(kind, **(FOREST if kind == "forest" else {"maxIter": ROUNDS, "maxDepth": 5} if kind == "gbt"
                                      else {"maxDepth": 5}))


def _reg_parts(spark, sf):
    train, test = M.split(_data(spark, sf).withColumn("label", F.col(LABEL_REG)), "startup_id", 0.2)
    return scratch_table(train, "train"), scratch_table(test, "test")


def _reg_pipe(kind, train):
    st = train.agg(F.stddev_pop("label").alias("sd"), F.count(F.lit(1)).alias("n")).first()
    return ML.pipeline(CATEG, NUMERIC + FLAGS, _regressor(kind, st["sd"], st["n"]))


def _reg_fit(spark, sf, kind="linear"):
    train, test = _reg_parts(spark, sf)
    return _reg_pipe(kind, train).fit(train), test


@query("m10_m12_m18_regression_models")
def m10_m12_m18_regression_models(spark, sf):
    """Every regression model: metrics on held-out rows, and R² over five folds of the training rows."""
    train, test = _reg_parts(spark, sf)
    pipes = {kind: _reg_pipe(kind, train) for kind in ["linear", "ridge", "lasso", "tree", "forest", "gbt"]}
    folds = ML.cv_regression_metrics(ML.out_of_fold(pipes, M.fold_column(train, "startup_id", 5), "startup_id"))
    cv = {r["model"]: {"cv_r2_mean": r["cv_r2_mean"], "cv_r2_sd": r["cv_r2_sd"]} for r in folds.collect()}
    res = {}
    for kind, pipe in pipes.items():
        own = E.regression_metrics(pipe.fit(train).transform(test), "label", "prediction", len(NUMERIC + FLAGS)).first()
        res[kind] = {k: own[k] for k in ("mae", "rmse", "r2", "adj_r2")} | cv[kind]
    return ML.compare_models(spark, res, "r2")


# Straight lines on folds that SQL can name, so that predictions and metrics have a twin.
_LINES = ["funding_rounds", "num_round_types_used"]


def _oof_sql():
    part = """
  SELECT '{c}' AS model, d.f AS fold, d.y, l.a + l.b * d.{c} AS p FROM d JOIN (
    SELECT k.f, regr_intercept(d.y, d.{c}) AS a, regr_slope(d.y, d.{c}) AS b FROM range(5) k(f) JOIN d ON d.f <> k.f GROUP BY k.f) l
  ON l.f = d.f"""
    body = " UNION ALL ".join(part.format(c=c) for c in _LINES)
    return with_star(f"""WITH d AS (SELECT startup_id % 5 AS f, log_funding_total_usd AS y, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _LINES)}
  FROM feat WHERE {_COMPLETE_SQL}), o AS ({body}),
folds AS (SELECT model, fold, 1 - SUM((y - p) * (y - p)) / (COUNT(*) * VAR_POP(y)) AS r2 FROM o GROUP BY model, fold)
SELECT model, AVG(abs(y - p)) AS mae, sqrt(AVG((y - p) * (y - p))) AS rmse, 1 - SUM((y - p) * (y - p)) / (COUNT(*) * VAR_POP(y)) AS r2,
  MIN(c.m) AS cv_r2_mean, MIN(c.s) AS cv_r2_sd, MIN(c.n) AS folds
FROM o JOIN (SELECT model, AVG(r2) AS m, STDDEV_POP(r2) AS s, COUNT(*) AS n FROM folds GROUP BY model) c USING (model) GROUP BY model""")


@query("m18_out_of_fold_metrics", _oof_sql())
def m18_out_of_fold_metrics(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG)).withColumn("fold", F.col("startup_id") % 5)
    pipes = {c: ML.pipeline([], [c], ML.linear_regressor("linear")) for c in _LINES}
    return ML.cv_regression_metrics(ML.out_of_fold(pipes, d, "startup_id"))


# With one feature the penalised lines have a closed form (penalty 1 on the square, 0.01 on the size of the slope).
@query("m10_one_feature_lines", with_star(f"""
WITH s AS (SELECT COUNT(*) AS n, COVAR_POP(log_funding_total_usd, CAST(funding_rounds AS DOUBLE)) AS xy,
    VAR_POP(CAST(funding_rounds AS DOUBLE)) AS xx FROM feat WHERE {_COMPLETE_SQL})
SELECT 'linear' AS model, round(xy / xx, 4) AS slope FROM s
UNION ALL SELECT 'ridge', round(n * xy / (n * xx + 1), 4) FROM s
UNION ALL SELECT 'lasso', round(sign(xy) * greatest(abs(xy) - 0.01, 0) / xx, 4) FROM s"""))
def m10_one_feature_lines(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG))
    st = d.agg(F.stddev_pop("label").alias("sd"), F.count(F.lit(1)).alias("n")).first()
    fits = [(kind, ML.pipeline([], ["funding_rounds"], _regressor(kind, st["sd"], st["n"])).fit(d)) for kind in ("linear", "ridge", "lasso")]
    return spark.createDataFrame([(kind, round(float(m.stages[-1].coefficients[0]), 4)) for kind, m in fits], "model string, slope double")


# One cut of one feature: the tree that lowers the squared error most, and the first round of boosting is that tree.
@query("m11_m12_stump", with_star(f"""
WITH v AS (SELECT CAST(funding_rounds AS DOUBLE) AS x, COUNT(*) AS n, SUM(log_funding_total_usd) AS s FROM feat WHERE {_COMPLETE_SQL}
  GROUP BY funding_rounds),
c AS (SELECT x, SUM(n) OVER o AS n1, SUM(s) OVER o AS s1, SUM(n) OVER () AS n, SUM(s) OVER () AS s, COUNT(*) OVER o AS i, COUNT(*) OVER () AS k
  FROM v WINDOW o AS (ORDER BY x)),
best AS (SELECT * FROM c WHERE i < k ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC LIMIT 1)
SELECT model, round(CASE WHEN v.x <= b.x THEN b.s1 / b.n1 ELSE (b.s - b.s1) / (b.n - b.n1) END, 6) AS prediction,
  MIN(v.x) AS lowest, MAX(v.x) AS highest, CAST(SUM(v.n) AS BIGINT) AS n
FROM v, best b, (SELECT unnest(['tree', 'gbt']) AS model) m GROUP BY 1, 2"""))
def m11_m12_stump(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG))
    out = []
    for kind, kw in (("tree", {}), ("gbt", {"maxIter": 1})):
        m = ML.pipeline([], ["funding_rounds"], ML.tree_regressor(kind, maxDepth=1, maxBins=256, **kw)).fit(d)
        out.append(m.transform(d).groupBy(F.lit(kind).alias("model"), F.round("prediction", 6).alias("prediction")).agg(
            F.min("funding_rounds").alias("lowest"), F.max("funding_rounds").alias("highest"), F.count(F.lit(1)).alias("n")))
    return out[0].unionByName(out[1])


# With one yes-or-no feature a weighted logistic fit gives the weighted share of each answer.
@query("m13_one_flag", with_star(f"""
WITH d AS (SELECT CAST(has_debt_financing AS INTEGER) AS x, CAST(is_exited AS INTEGER) AS y FROM feat WHERE {_COMPLETE_SQL}),
cw AS (SELECT y, (SELECT COUNT(*) FROM d) / (2.0 * COUNT(*)) AS w FROM d GROUP BY y)
SELECT x AS has_debt_financing, COUNT(*) AS n, round(CAST(SUM(CASE WHEN d.y = 1 THEN w ELSE 0 END) / SUM(w) AS DOUBLE), 3) AS p
FROM d JOIN cw ON d.y = cw.y GROUP BY x"""))
def m13_one_flag(spark, sf):
    d = M.class_weights(_data(spark, sf).withColumn("label", F.col(LABEL_CLF).cast("double")), "label")
    m = ML.pipeline([], ["has_debt_financing"], ML.weighted_classifier("logistic")).fit(d)
    return m.transform(d).groupBy("has_debt_financing").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(vector_to_array("probability")[1]), 3).alias("p"))


@query("m15_positive_weight", with_star(f"""
SELECT CAST(is_exited AS INTEGER) AS is_exited, COUNT(*) AS n,
  CASE WHEN is_exited THEN CAST((SELECT COUNT(*) FILTER (WHERE NOT is_exited) / COUNT(*) FILTER (WHERE is_exited) FROM feat
    WHERE {_COMPLETE_SQL}) AS DOUBLE) ELSE 1.0 END AS weight
FROM feat WHERE {_COMPLETE_SQL} GROUP BY is_exited"""))
def m15_positive_weight(spark, sf):
    return ML.positive_weight(_data(spark, sf), LABEL_CLF).groupBy(LABEL_CLF, "weight").agg(F.count(F.lit(1)).alias("n"))


def _clf_data(spark, sf):
    d = M.stratified_split(_data(spark, sf).withColumn("label", F.col(LABEL_CLF).cast("double")), "label", "startup_id", 0.2)
    d = scratch_table(d, "classes")
    train, test = (d.where(F.col("is_test") == part).drop("is_test") for part in (False, True))
    return M.class_weights(train, "label"), test  # weights from the training rows alone


def _classifiers():
    return {"logistic": {}, "forest": FOREST, "gbt": {"maxIter": 20}}


def _clf_pipe(kind, **kw):
    return ML.pipeline(CATEG, NUMERIC + FLAGS, ML.weighted_classifier(kind, **kw))


@query("m13_m15_classifiers")
def m13_m15_classifiers(spark, sf):
    """Every classifier: metrics on held-out rows, and the area under the ROC curve over five stratified folds."""
    train, test = _clf_data(spark, sf)
    train = scratch_table(train, "weighted")
    pipes = {kind: _clf_pipe(kind, **kw) for kind, kw in _classifiers().items()}
    folded = M.stratified_folds(train, "label", "startup_id", 5)
    cv = {r["model"]: r for r in ML.cv_auc(ML.out_of_fold(pipes, folded, "startup_id", classifier=True)).collect()}
    res = {}
    for kind, pipe in [*pipes.items(), ("gbt_positive_weight", pipes["gbt"])]:
        rows = ML.positive_weight(train, "label") if kind.endswith("positive_weight") else train
        out = pipe.fit(rows).transform(test).select(
            "label", "prediction", vector_to_array("probability")[1].alias("__p")).persist()
        own = E.classification_metrics(out, "label", "prediction").first()
        res[kind] = {"auc": roc_auc(out, "label", "__p").first()["auc"],
                     **{k: own[k] for k in ("accuracy", "precision", "recall", "f1")},
                     **({k: cv[kind][k] for k in ("cv_auc_mean", "cv_auc_sd")} if kind in cv else {})}
        out.unpersist()
    return ML.compare_models(spark, res, "auc")


@query("m16_stratified_folds", with_star(f"""
SELECT is_exited, CAST((rn - 1) % 5 AS INTEGER) AS fold, COUNT(*) AS n FROM (
  SELECT CAST(is_exited AS INTEGER) AS is_exited, ROW_NUMBER() OVER (ORDER BY CAST(is_exited AS INTEGER) NULLS FIRST) AS rn
  FROM feat WHERE {_COMPLETE_SQL}) GROUP BY is_exited, (rn - 1) % 5"""))
def m16_stratified_folds(spark, sf):
    return M.stratified_folds(_data(spark, sf), LABEL_CLF, "startup_id", 5).groupBy(LABEL_CLF, "fold").agg(
        F.count(F.lit(1)).alias("n"))


# The analysed application's search space; its boosting rounds (100, 200, 300) are 4, 8 and 12 here.
SEARCH_SPACE = {"rounds": [4, 8, 12], "depth": [3, 4, 5, 6], "rate": [0.03, 0.05, 0.1], "rows": [0.8, 0.9, 1.0],
                "columns": [0.8, 0.9, 1.0]}


def boosted(rounds, depth, rate, rows, columns):
    return ML.tree_regressor("gbt", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
                             featureSubsetStrategy=str(columns))


@query("m16_m17_cross_validation_search")
def m16_m17_cross_validation_search(spark, sf):
    """Ten of 324 combinations by five folds of the training rows; the best one's R² on held-out rows."""
    train, test = _reg_parts(spark, sf)
    encoders = Pipeline(stages=M.encoder_stages(CATEG, NUMERIC + FLAGS))  # no parameter changes them
    table, best = ML.random_search(boosted, SEARCH_SPACE, train, "startup_id", n=10, k=5, prepare=encoders)
    held_out = E.regression_metrics(best.transform(test), "label", "prediction", len(NUMERIC + FLAGS)).select(
        F.col("r2").alias("held_out_r2"))
    return attach_row(table, held_out).withColumn("held_out_r2", F.when(F.col("is_best"), F.col("held_out_r2")))


@query("m19_feature_importance")
def m19_feature_importance(spark, sf):
    m, test = _reg_fit(spark, sf, "forest")
    return spark.createDataFrame(ML.feature_importance(m, test), "feature string, importance double")


@query("m19_importance_shares", "SELECT 1.0::DOUBLE AS total, true AS in_order, true AS each_at_most_one")
def m19_importance_shares(spark, sf):
    """Importances of a forest are shares of one, largest first."""
    m, test = _reg_fit(spark, sf, "forest")
    values = [v for _, v in ML.feature_importance(m, test)]
    return spark.createDataFrame([(round(sum(values), 9), values == sorted(values, reverse=True), all(0 <= v <= 1 for v in values))],
                                 "total double, in_order boolean, each_at_most_one boolean")


@query("m20_m21_choose_k")
def m20_m21_choose_k(spark, sf):
    df = ML.cluster_features(_data(spark, sf), ["funding_rounds", "num_round_types_used", LABEL_REG])
    res = ML.choose_k(df)  # k from 2 to 8, ten starts each
    return spark.createDataFrame([(r["k"], float(r["inertia"]), r["silhouette"], float(r["squared_silhouette"])) for r in res],
                                 "k int, inertia double, silhouette double, squared_silhouette double")


# Every row meets every other.
@query("m20_silhouette", with_star(f"""
WITH pts AS (SELECT startup_id AS i, CAST(is_exited AS INTEGER) AS c, CAST(funding_rounds AS DOUBLE) AS x,
  CAST(years_since_founded AS DOUBLE) AS y FROM feat WHERE {_COMPLETE_SQL}),
far AS (SELECT a.i, a.c, b.c AS other, SUM(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS s, COUNT(*) AS n
  FROM pts a JOIN pts b ON true GROUP BY a.i, a.c, b.c),
widths AS (SELECT i, MIN(n) FILTER (WHERE c = other) AS own, MIN(s) FILTER (WHERE c = other) AS inside,
  MIN(s / n) FILTER (WHERE c <> other) AS outside FROM far GROUP BY i)
SELECT COUNT(*) AS rows, AVG(CASE WHEN own > 1 THEN (outside - inside / (own - 1)) / greatest(outside, inside / (own - 1)) ELSE 0 END) AS silhouette
FROM widths"""))
def m20_silhouette(spark, sf):
    d = VectorAssembler(inputCols=["funding_rounds", "years_since_founded"], outputCol="features").transform(_data(spark, sf))
    return ML.silhouette(d, LABEL_CLF)


@query("m21_assigned_rows", with_star(f"SELECT COUNT(*) AS rows, 3 AS clusters FROM feat WHERE {_COMPLETE_SQL}"))
def m21_assigned_rows(spark, sf):
    """Every complete row is assigned to one of the clusters (which one has no SQL form)."""
    df = ML.cluster_features(_data(spark, sf), ["funding_rounds", "num_round_types_used", LABEL_REG])
    out = ML.assign_clusters(ML.choose_k(df, [3], starts=2)[0]["model"], df)
    return out.where(F.col("cluster").isNotNull()).agg(F.count(F.lit(1)).alias("rows"),
                                                       F.count_distinct("cluster").cast("int").alias("clusters"))


@query("m22_cluster_profile", with_star("""
WITH m AS (SELECT market, status, ROW_NUMBER() OVER (PARTITION BY market ORDER BY COUNT(*) DESC, status) AS rn
           FROM feat WHERE status IS NOT NULL GROUP BY market, status)
SELECT f.market, COUNT(*) AS n, AVG(CAST(funding_rounds AS DOUBLE)) AS mean_funding_rounds,
  AVG(CAST(is_exited AS DOUBLE)) AS rate_is_exited,
  CAST(COUNT(*) AS DOUBLE) * 100 / SUM(COUNT(*)) OVER () AS pct_of_rows,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS median, MIN(m.status) AS mode
FROM feat f LEFT JOIN m ON f.market = m.market AND m.rn = 1 GROUP BY f.market"""))
def m22_cluster_profile(spark, sf):
    return ML.cluster_profile(wide(spark, sf), "market", "funding", ["funding_rounds"], ["is_exited"], "status")


@query("m23_score")
def m23_score(spark, sf):
    reg, test = _reg_fit(spark, sf, "linear")
    train, _ = _clf_data(spark, sf)
    clf = ML.pipeline(CATEG, NUMERIC + FLAGS, ML.weighted_classifier("logistic")).fit(train)
    out = ML.score(reg, clf, test.drop("label"), known=startup_entities(read_tables(spark, sf)), amount="funding_total_usd")
    return out.select("startup_id", "predicted_amount", "exit_probability", "tier", "percentile")


# The probabilities have no SQL form; what the score columns say of each other has one.
@query("m23_score_columns", with_star(f"""
SELECT COUNT(*) AS rows, COUNT(*) AS in_bounds, COUNT(*) AS tier_agrees, COUNT(*) AS percentile_in_bounds FROM feat WHERE {_COMPLETE_SQL}"""))
def m23_score_columns(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG))
    reg = ML.pipeline(CATEG, NUMERIC + FLAGS, ML.linear_regressor("linear")).fit(d)
    clf = _clf_pipe("logistic").fit(M.class_weights(d.withColumn("label", F.col(LABEL_CLF).cast("double")), "label"))
    out = ML.score(reg, clf, d.drop("label"), known=startup_entities(read_tables(spark, sf)), amount="funding_total_usd")
    p = F.col("exit_probability")
    tier = F.when(p >= 0.5, "High likelihood").when(p >= 0.25, "Moderate likelihood").otherwise("Lower likelihood")
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count_if(p.between(0, 1)).alias("in_bounds"),
                   F.count_if(F.col("tier") == tier).alias("tier_agrees"),
                   F.count_if(F.col("percentile").between(0, 100)).alias("percentile_in_bounds"))


@query("m24_learning_curve")
def m24_learning_curve(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG))
    est = ML.linear_regressor("linear")
    res = ML.learning_curve(ML.pipeline(CATEG, NUMERIC + FLAGS, est), d, "startup_id",
                            ML.regression_evaluator("label"), [0.1, 0.28, 0.46, 0.64, 0.82, 1.0], k=3)
    return spark.createDataFrame([(float(r["fraction"]), float(r["metric_mean"]), float(r["metric_sd"]),
                                   float(r["training_metric"])) for r in res],
                                 "fraction double, r2_mean double, r2_sd double, training_r2 double")


@query("x1_permutation_importance")
def x1_permutation_importance(spark, sf):
    m, test = _reg_fit(spark, sf, "forest")
    return X.permutation_importance(m, test, NUMERIC + FLAGS + CATEG, "startup_id")  # every feature, ten repeats


# For a straight line the mean output at a grid value is the line itself.
@query("x2_partial_dependence", with_star(f"""
SELECT CAST(g AS DOUBLE) AS grid_value, a + b * g AS average_output FROM range(1, 7) r(g), (
  SELECT regr_intercept(log_funding_total_usd, CAST(funding_rounds AS DOUBLE)) AS a,
    regr_slope(log_funding_total_usd, CAST(funding_rounds AS DOUBLE)) AS b FROM feat WHERE {_COMPLETE_SQL}) s"""))
def x2_partial_dependence(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG))
    m = ML.pipeline([], ["funding_rounds"], ML.linear_regressor("linear")).fit(d)
    return X.partial_dependence(m, d, "funding_rounds", [1, 2, 3, 4, 5, 6])


def _line(spark, sf):
    d = _data(spark, sf).withColumn("label", F.col(LABEL_REG))
    return ML.pipeline([], ["funding_rounds"], ML.linear_regressor("linear")).fit(d), d


# Moving a feature that the line does not use changes nothing; moving its own costs something.
@query("x1_unused_feature", "SELECT 'funding_rounds' AS feature, true AS costs UNION ALL SELECT 'years_since_founded', false")
def x1_unused_feature(spark, sf):
    m, d = _line(spark, sf)
    found = X.permutation_importance(m, d, ["funding_rounds", "years_since_founded"], "startup_id")
    return found.select("feature", (F.col("importance_mean") > 1e-9).alias("costs"))


# Every row's curve of a straight line is the line.
@query("x3_ice_line", with_star(f"""
SELECT CAST(g AS DOUBLE) AS grid_value, LEAST(300, n) AS curves, round(a + b * g, 6) AS lowest, round(a + b * g, 6) AS highest FROM range(1, 5) r(g), (
  SELECT COUNT(*) AS n, regr_intercept(log_funding_total_usd, CAST(funding_rounds AS DOUBLE)) AS a,
    regr_slope(log_funding_total_usd, CAST(funding_rounds AS DOUBLE)) AS b FROM feat WHERE {_COMPLETE_SQL}) s"""))
def x3_ice_line(spark, sf):
    m, d = _line(spark, sf)
    return X.ice(m, d, "funding_rounds", [1, 2, 3, 4], "startup_id", rows=300).groupBy(
        F.col("grid_value").cast("double").alias("grid_value")).agg(
        F.count(F.lit(1)).alias("curves"), F.round(F.min("output"), 6).alias("lowest"), F.round(F.max("output"), 6).alias("highest"))


# Contributions and base add up to the prediction, within the sampling error of the backgrounds drawn.
@query("x4_additivity", "SELECT true AS adds_up, true AS base_is_mean")
def x4_additivity(spark, sf):
    m, test = _reg_fit(spark, sf, "linear")
    phi = X.sampled_shapley(m, test, test, NUMERIC + FLAGS, "startup_id", samples=64)
    out = m.transform(test)
    base = X.expected_output(m, test)
    both = phi.groupBy("startup_id").agg(F.sum("phi").alias("s")).join(out.select("startup_id", "prediction"), "startup_id")
    spread = out.agg(F.stddev_pop("prediction").alias("sd"), F.avg("prediction").alias("mean"))
    gap = F.col("prediction") - F.col("s") - base
    return attach_row(both.agg(F.max(F.abs(gap)).alias("worst"), F.avg(gap).alias("bias")), spread).select(
        (F.col("worst") < 6 * F.col("sd") / 8).alias("adds_up"), (F.abs(F.col("mean") - base) < 1e-9).alias("base_is_mean"))


@query("x2_partial_dependence_forest")
def x2_partial_dependence_forest(spark, sf):
    m, test = _reg_fit(spark, sf, "forest")
    return X.partial_dependence(m, test, "funding_rounds", [1, 2, 3, 4, 5, 6])


@query("x3_ice")
def x3_ice(spark, sf):
    m, test = _reg_fit(spark, sf, "forest")
    return X.ice(m, test, "funding_rounds", [1, 2, 3, 4], "startup_id", rows=300)


def _shapley(spark, sf):
    m, test = _reg_fit(spark, sf, "forest")
    feats = NUMERIC + FLAGS
    others = test.drop(*feats)
    phi = X.sampled_shapley(m, test, test, feats, "startup_id", samples=16)  # the whole test set
    return phi, others


@query("x4_sampled_shapley")
def x4_sampled_shapley(spark, sf):
    phi, _ = _shapley(spark, sf)
    return phi


@query("x5_global_attribution")
def x5_global_attribution(spark, sf):
    phi, _ = _shapley(spark, sf)
    return X.global_attribution(phi, top_n=5)
