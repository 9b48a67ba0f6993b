"""Feature preparation.

Splits are hash-based (``xxhash64`` of the key and a seed): stable under
repartitioning and re-execution, unlike ``randomSplit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.cleaning import group_top_n
from ..session import scratch_table
from .ordering import attach_row, global_row_number, group_quantiles, running_totals

_BUCKETS = 1_000_000


def modeling_table(wide: DataFrame, numeric: Sequence[str], flags: Sequence[str],
                   grouped: dict[str, tuple[str, int]], label_cols: Sequence[str], key: str) -> DataFrame:
    """M1: denormalised table + grouped categoricals (C34) + flags as 0/1."""
    out = wide
    for new, (col, n) in grouped.items():
        out = group_top_n(out, col, n, "Other", out=new)
    return out.select(key, *[F.col(c).cast("double").alias(c) for c in numeric],
                      *[F.col(f).cast("int").alias(f) for f in flags], *grouped.keys(), *label_cols)


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M2: rows with every listed column present."""
    return df.na.drop(subset=list(cols))


def hash_unit(key: str | Sequence[str], seed: int):
    keys = [key] if isinstance(key, str) else list(key)
    return (F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(_BUCKETS)) / _BUCKETS)


def split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M3: deterministic train/test split by key hash."""
    u = hash_unit(key, seed)
    return df.where(u >= test_fraction), df.where(u < test_fraction)


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                     seed: int = 42, shuffle: bool = True) -> DataFrame:
    """M4: exact per-class split — within each class, rows in hash order
    (``shuffle=False``: in key order); the first ``round(fraction·n_class)``
    go to test.  Uses the distributed row number (a dominant class is spread
    over many partitions).  Adds a boolean ``is_test`` column."""
    h = df.withColumn("__h", hash_unit(key, seed) if shuffle else F.lit(0.0))
    numbered = global_row_number(h, [F.col(label).asc_nulls_first(), "__h", key], "__rn")
    per = numbered.groupBy(label).agg(F.min("__rn").alias("__s"), F.count(F.lit(1)).alias("__n"))
    j = numbered.join(per, numbered[label].eqNullSafe(per[label]), "inner").drop(per[label])
    cut = F.round(F.col("__n") * F.lit(test_fraction))
    return j.withColumn("is_test", (F.col("__rn") - F.col("__s")) < cut).drop("__h", "__rn", "__s", "__n")


def split_sizes(df: DataFrame, flag: str = "is_test", by: str | None = None) -> DataFrame:
    g = df.groupBy(*([by] if by else []), flag)
    return g.agg(F.count(F.lit(1)).alias("n"))


def class_drift(parts: DataFrame, label: str, flag: str = "is_test") -> DataFrame:
    """M4: per class its share of the training rows and of the test rows, and how far they lie apart.

    A class missing from one part has the share 0 there; one aggregate by
    class, then its total.
    """
    per = parts.groupBy(label).agg(F.count_if(~F.col(flag)).alias("__train"), F.count_if(F.col(flag)).alias("__test"))
    both = attach_row(per, per.agg(F.sum("__train").alias("__all_train"), F.sum("__test").alias("__all_test")))
    shares = both.select(label, *[F.try_divide(F.col(f"__{p}"), F.col(f"__all_{p}")).alias(f"{p}_share") for p in ("train", "test")])
    return shares.withColumn("drift", F.abs(F.col("train_share") - F.col("test_share")))


def numeric_drift(parts: DataFrame, cols: Sequence[str], flag: str = "is_test") -> DataFrame:
    """M4: per column the largest gap between the distribution functions of
    the two parts (two-sample Kolmogorov distance), nulls ignored.

    Values are counted per (column, value) first; one running count over all
    columns together gives both functions at every value.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = parts.selectExpr(f"`{flag}` AS __test", f"stack({len(cols)}, {pairs}) AS (feature, value)").where("value IS NOT NULL")
    counts = long.groupBy("feature", "value").agg(F.count_if("__test").alias("a"), F.count_if(~F.col("__test")).alias("b"))
    run = running_totals(counts, ["feature", "value"], ["a", "b"], prefix="to_")
    per = run.groupBy("feature").agg(*[x for c in "ab" for x in (
        F.min(F.col(f"to_{c}") - F.col(c)).alias(f"from_{c}"), F.sum(c).alias(f"all_{c}"))])  # one row per column
    at = [F.try_divide(F.col(f"to_{c}") - F.col(f"from_{c}"), F.col(f"all_{c}")) for c in "ab"]
    return run.join(F.broadcast(per), "feature").groupBy("feature").agg(F.max(F.abs(at[0] - at[1])).alias("distance"))


def encoder_stages(categorical: Sequence[str], numeric: Sequence[str], out: str = "features"):
    """M5: ``StringIndexer(keep)`` + ``OneHotEncoder(dropLast)`` + assembler.
    Fitted on training data only; an unseen category maps to all zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    stages, cols = [], list(numeric)
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        # the indexer's extra "unseen" bucket is the last category, and dropLast
        # removes exactly that bucket: every seen level keeps a column, unseen → zeros
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True))
        cols.append(f"{c}__ohe")
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep"))
    return stages


def impute_constant(df: DataFrame, cols: Sequence[str], value: str = "Unknown") -> DataFrame:
    """M6: categorical gaps as a constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M6: numeric gaps as the column's exact median: one distributed quantile
    over (column, value) pairs for all columns."""
    pairs = ", ".join(f"'{i}', CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (col, value)")
    found = group_quantiles(long, ["col"], "value", {"m": 0.5})
    wide = found.agg(*[F.max(F.when(F.col("col") == str(i), F.col("m"))).alias(f"__med{i}") for i in range(len(cols))])
    out = attach_row(df, wide)
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"__med{i}")) for i, c in enumerate(cols)}) \
              .drop(*[f"__med{i}" for i in range(len(cols))])


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M7: ``(x - mean) / population sd`` (one aggregation for all columns)."""
    s = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)])
    j = attach_row(df, s)
    return j.withColumns({c: (F.col(c).cast("double") - F.col(f"m_{i}")) / F.col(f"s_{i}")
                          for i, c in enumerate(cols)}).select(*df.columns)


def variance_filter(df: DataFrame, cols: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """M8: population variance per column and whether it passes ``> threshold``."""
    wide = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', v{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) as (feature, variance)")
    return long.withColumn("keep", F.col("variance") > F.lit(threshold))


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """M9: binned mutual information (nats) of each feature with a discrete
    target; features binned by their distinct ``i/bins`` quantile edges.

    All features at once: one long table of (feature, value, class) counts,
    one ordering over it for every feature's edges (one short list per
    feature, broadcast), one aggregate by (feature, bin, class).
    """
    pairs = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    long = df.where(F.col(target).isNotNull()).selectExpr(f"`{target}` AS y", f"stack({len(features)}, {pairs}) AS (feature, value)")
    counts = scratch_table(long.where("value IS NOT NULL").groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("n")), "counts")
    found = group_quantiles(counts, ["feature"], "value", {f"e{i}": i / bins for i in range(bins + 1)}, weight="n")
    edges = F.array_sort(F.array_distinct(F.array(*[f"e{i}" for i in range(bins + 1)])))
    inner = F.when(F.size(edges) > 2, F.slice(edges, 2, F.size(edges) - 2)).otherwise(F.array().cast("array<double>"))
    binned = counts.join(F.broadcast(found.select("feature", inner.alias("edges"))), "feature")
    bin_ = F.size(F.filter("edges", lambda e: F.col("value") > e))
    joint = binned.groupBy("feature", bin_.alias("b"), "y").agg(F.sum("n").cast("double").alias("nxy"))
    per = Window.partitionBy("feature")  # at most bins × classes rows each
    nx, ny, n = F.sum("nxy").over(per.partitionBy("feature", "b")), F.sum("nxy").over(per.partitionBy("feature", "y")), F.sum("nxy").over(per)
    terms = joint.select("feature", (F.col("nxy") / n * F.log(F.col("nxy") * n / (nx * ny))).alias("term"))
    return terms.groupBy("feature").agg(F.sum("term").alias("mi"))


def fold_column(df: DataFrame, key: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Hash folds for cross-validation (stable, no shuffle)."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.col(key), F.lit(seed + 7)), F.lit(k)).cast("int"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Folds 0 to ``k - 1`` in which every class has the same number of rows, give or take one.

    Rows are numbered in the order of (class, hash of the key): a class is a
    run of consecutive numbers, so their remainders by ``k`` spread it evenly,
    and the folds' sizes differ by one at most.  Null labels are a class of
    their own; repeated rows are rows of their own.
    """
    hashed = df.withColumn("__h", hash_unit(key, seed))
    numbered = global_row_number(hashed, [F.col(label).asc_nulls_first(), "__h", key], "__rn")
    return numbered.withColumn(name, F.pmod(F.col("__rn") - 1, F.lit(k)).cast("int")).drop("__h", "__rn")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced class weights ``n / (classes · n_class)`` (classes from one small aggregate)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = attach_row(counts, tot) \
              .select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(name))
    return df.join(w, label, "left")  # small for few classes: Spark broadcasts it then
