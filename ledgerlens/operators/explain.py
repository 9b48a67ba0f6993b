"""Batch model explanation.

All explanations are Spark jobs: the model is applied with ``transform`` to
DataFrames that Spark derives (permuted columns, grid copies, Shapley
coalitions); nothing is collected row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import attach_row, global_row_number


def _prediction(out: str) -> Callable[[DataFrame], Column]:
    if out == "probability":
        from pyspark.ml.functions import vector_to_array
        return lambda df: vector_to_array(F.col("probability"))[1]
    return lambda df: F.col(out)


# ----------------------------------------------------------------------------- X1
def r2_column(label: Column, pred: Column) -> Column:
    """R² as an aggregate expression."""
    return 1 - F.sum((label - pred) * (label - pred)) / (F.var_pop(label) * F.count(label))


def permutation_importance(model, df: DataFrame, features: Sequence[str], key: str, label: str = "label",
                           metric: Callable[[Column, Column], Column] = r2_column, repeats: int = 10, seed: int = 42,
                           output: str = "prediction") -> DataFrame:
    """Drop in ``metric`` when one feature's values are moved to other rows.

    Rows are numbered once, in a seeded hash order; repeat ``r`` gives each
    row the values that stand a seeded number of places further on (an
    equi-join on the position, so no skew).  All features and repeats are
    scored by one ``transform`` and measured by one aggregate.
    """
    feats = list(features)
    numbered = global_row_number(df, [F.xxhash64(F.col(key), F.lit(seed)), key], "__pos")
    n = df.count()
    pred = _prediction(output)
    if n < 2:
        raise ValueError("at least two rows are needed to move values between")
    shifts = [1 + (seed * 7919 + 104_729 * (r + 1)) % (n - 1) for r in range(repeats)]
    moved = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(s).alias("by")) for r, s in enumerate(shifts)])
    rows = numbered.withColumn("__m", F.explode(moved)).withColumn(
        "__from", F.pmod(F.col("__pos") - 1 + F.col("__m.by"), F.lit(n)) + 1)
    other = numbered.select(F.col("__pos").alias("__from"), *[F.col(f).alias("__v_" + f) for f in feats])
    rows = rows.join(other, "__from").withColumn("__f", F.explode(F.array(*[F.lit(f) for f in feats])))
    for f in feats:
        rows = rows.withColumn(f, F.when(F.col("__f") == f, F.col("__v_" + f)).otherwise(F.col(f)))
    rows = rows.withColumn("__r", F.col("__m.r")).drop("__m", "__from", "__pos", *["__v_" + f for f in feats])
    shuffled, plain = model.transform(rows), model.transform(df)
    base = plain.agg(metric(F.col(label).cast("double"), pred(plain)).alias("__base"))
    per = shuffled.groupBy(F.col("__f").alias("feature"), "__r").agg(
        metric(F.col(label).cast("double"), pred(shuffled)).alias("__metric"))
    drop = attach_row(per, base).withColumn("__drop", F.col("__base") - F.col("__metric"))
    return drop.groupBy("feature").agg(F.avg("__drop").alias("importance_mean"),
                                       F.stddev_samp("__drop").alias("importance_sd"))


# ----------------------------------------------------------------------------- X2, X3
def _grid_copies(df: DataFrame, feature: str, grid: Sequence[float]) -> DataFrame:
    return df.withColumn(feature, F.explode(F.array(*[F.lit(float(g)) for g in grid])))


def partial_dependence(model, df: DataFrame, feature: str, grid: Sequence[float],
                       output: str = "prediction") -> DataFrame:
    """Mean model output with ``feature`` set to each grid value for every row."""
    pred = _prediction(output)
    out = model.transform(_grid_copies(df, feature, grid))
    return out.groupBy(F.col(feature).alias("grid_value")).agg(F.avg(pred(out)).alias("average_output"))


def ice(model, df: DataFrame, feature: str, grid: Sequence[float], key: str, rows: int = 300,
        seed: int = 42, output: str = "prediction") -> DataFrame:
    """Per-row curves for a seeded hash sample of ``rows`` rows."""
    pred = _prediction(output)
    sample = df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(rows)
    out = model.transform(_grid_copies(sample, feature, grid))
    return out.select(key, F.col(feature).alias("grid_value"), pred(out).alias("output"))


# ----------------------------------------------------------------------------- X4, X5
def sampled_shapley(model, explain: DataFrame, background: DataFrame, features: Sequence[str], key: str,
                    samples: int = 32, seed: int = 42, output: str = "prediction",
                    background_rows: int | None = None) -> DataFrame:
    """Sampled Shapley values (Štrumbelj & Kononenko, 2014).

    For every explained row and sample m: draw a background row b and a
    feature order π (both from seeded hashes); build the coalition instances
    that take the first 0, 1, … features of π from the row and the rest from
    b; φ_j is the mean output difference between the instance that ends with j
    and the one before it.  The background is all of ``background``, or its
    ``background_rows`` rows of smallest hash; rows meet their background by
    an equi-join on a unique position.  The work is rows × samples ×
    (features + 1) model evaluations in one ``transform``.  Returns
    ``(key, feature, phi)``.
    """
    pred = _prediction(output)
    feats = list(features)
    order = [F.xxhash64(*[F.col(f) for f in feats])] + feats
    bg = background.select(*feats)
    if background_rows is not None:
        bg = bg.orderBy(*order).limit(background_rows)
    bgn = global_row_number(bg, order, "__bidx") \
        .select((F.col("__bidx") - 1).alias("__bidx"), *[F.col(f).alias("__b_" + f) for f in feats])
    nb = bgn.count()
    if not nb:
        raise ValueError("the background has no rows")
    passthrough = [c for c in explain.columns if c not in feats and c != key]
    rows = explain.select(key, *feats, *passthrough).withColumn("__m", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    rows = rows.withColumn("__bidx", F.pmod(F.xxhash64(F.col(key), F.col("__m"), F.lit(seed)), F.lit(nb)))
    # Spark takes the exploded rows for as small as the table they come from and would broadcast them
    rows = rows.join(bgn.hint("shuffle_hash"), "__bidx")
    # place of every feature in this sample's random order
    rows = rows.withColumns({"__p_" + f: F.xxhash64(F.col(key), F.col("__m"), F.lit(f), F.lit(seed + 1)) for f in feats})
    rows = rows.withColumns({"__at_" + f: reduce(add, [(F.col("__p_" + g) < F.col("__p_" + f)).cast("int") for g in feats])
                             for f in feats})
    rows = rows.withColumn("__taken", F.explode(F.sequence(F.lit(0), F.lit(len(feats)))))
    mixed = [F.when(F.col("__at_" + f) < F.col("__taken"), F.col(f)).otherwise(F.col("__b_" + f)).alias(f) for f in feats]
    scored = model.transform(rows.select(key, "__taken", *["__at_" + f for f in feats], *mixed, *passthrough))
    y = pred(scored)
    per = scored.groupBy(key).agg(*[(F.sum(F.when(F.col("__at_" + f) == F.col("__taken") - 1, y)
                                           .when(F.col("__at_" + f) == F.col("__taken"), -y)) / F.lit(samples)).alias(f"__phi{i}")
                                    for i, f in enumerate(feats)])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"__phi{i}").alias("phi")) for i, f in enumerate(feats)])
    return per.select(key, F.explode(pairs).alias("__pair")).select(key, "__pair.feature", "__pair.phi")


def expected_output(model, background: DataFrame, output: str = "prediction") -> float:
    """Base value of the attributions: mean model output over the background."""
    out = model.transform(background)
    return float(out.agg(F.avg(_prediction(output)(out))).first()[0])


def global_attribution(phi: DataFrame, top_n: int | None = None) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    out = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    if top_n:
        out = out.orderBy(F.col("mean_abs_phi").desc(), "feature").limit(top_n)
    return out
