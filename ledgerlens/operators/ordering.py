"""Global order without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task.  That is fine after aggregating to a bounded number of groups (years,
countries) but not over entity- or row-grain data.  The helpers here give
the same answers by one path at every size:

1. range-partition on the order key; row numbers need no more than a sort in
   each partition, sums and ranks a window per partition (so types and nulls
   behave as in SQL);
2. write the result once, with the number of its partition, to a scratch
   table in the shared folder;
3. one row of totals per partition, whose running sum gives the offsets: the
   row count is the partition count, whatever the data;
4. a broadcast join of those offsets finishes the global value.

Spark seeds the range-boundary sample with the RDD id, so two plans over the
same ``repartitionByRange`` may cut partitions differently; writing the rows
after the cut fixes it for every reader and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..session import scratch_table

_PID = "__pid"
_LOCAL = "__local"
_AT = "__at"
#: ``monotonically_increasing_id`` holds the partition above these bits and the row in it below.
_ROW_BITS = 33


def _order_exprs(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _ranged(df: DataFrame, order: Sequence, num_partitions: int | None) -> DataFrame:
    return df.repartitionByRange(*([num_partitions] if num_partitions else []), *_order_exprs(order))


@cache
def _labels(spark: SparkSession, n: int, tasks: int) -> tuple[int, ...]:
    """``n`` distinct numbers that Spark's hash deals to ``tasks`` tasks in turn, so
    that no two of the first ``tasks`` meet in one."""
    rounds = -(-n // tasks)
    tries = spark.range(tasks * (rounds + 3) * 12).select(
        F.col("id").cast("int").alias("x"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(tasks)).alias("task"))
    per = tries.groupBy("task").agg(F.slice(F.array_sort(F.collect_list("x")), 1, rounds).alias("xs"))
    found = {r["task"]: r["xs"] for r in per.collect()}
    spare = iter(range(tasks * (rounds + 3) * 12, tasks * (rounds + 3) * 12 + n))  # unlikely: a task without enough tries
    return tuple(found[i % tasks][i // tasks] if len(found.get(i % tasks, ())) > i // tasks else next(spare) for i in range(n))


def _windowed(df: DataFrame, order: Sequence, columns, num_partitions: int | None) -> DataFrame:
    """``df`` in range partitions of ``order`` with ``columns(window)`` computed per partition, and
    the partition in ``__pid``, as a scratch table.

    The window's shuffle is by a label of the partition, one partition per task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = _labels(df.sparkSession, max(tasks, num_partitions or 0), tasks)
    ranged = _ranged(df, order, num_partitions).withColumn(_PID, F.spark_partition_id())
    ranged = ranged.withColumn("__label", F.element_at(F.array(*map(F.lit, labels)), F.col(_PID) + 1))
    return scratch_table(ranged.withColumns(columns(Window.partitionBy("__label"))).drop("__label"), "ordered")


def _before(totals: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sums of ``cols`` over all earlier partitions; ``totals`` has one row per partition."""
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_PID, *[F.sum(c).over(w).alias("__off_" + c) for c in cols])


def global_row_number(df: DataFrame, order: Sequence, name: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number in ``order`` (which must be a total order to be deterministic).

    One shuffle: rows are sorted within their range partitions, and a row's
    place there is part of its monotonically increasing id.
    """
    placed = scratch_table(_ranged(df, order, num_partitions).sortWithinPartitions(*_order_exprs(order))
                           .withColumn(_AT, F.monotonically_increasing_id()), "ordered")
    pid = F.call_function("shiftright", F.col(_AT), F.lit(_ROW_BITS)).alias(_PID)
    offs = _before(placed.groupBy(pid).agg(F.count(F.lit(1)).alias("n")), ["n"])
    place = F.col(_AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (placed.withColumn(_PID, pid).join(F.broadcast(offs), _PID, "left")
                  .withColumn(name, F.coalesce(F.col("__off_n"), F.lit(0)) + place)
                  .drop(_PID, _AT, "__off_n"))


def running_totals(df: DataFrame, order: Sequence, sum_cols: Sequence[str],
                   prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in global ``order``.

    Rows with equal order keys are accumulated one by one, so pass a
    total order (e.g. distinct values after a ``groupBy``).  Types are those
    of SQL ``SUM`` (decimals stay decimals); nulls add nothing, and a sum is
    null until the first value.
    """
    def sums(w: WindowSpec) -> dict[str, Column]:
        w = w.orderBy(*_order_exprs(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {prefix + c: F.sum(c).over(w) for c in sum_cols}

    local = _windowed(df, order, sums, num_partitions)
    types = {c: local.schema[prefix + c].dataType for c in sum_cols}
    totals = local.groupBy(_PID).agg(*[F.sum(c).alias(c) for c in sum_cols])
    out = local.join(F.broadcast(_before(totals, sum_cols)), _PID, "left")
    for c in sum_cols:
        here, off = F.col(prefix + c), F.col("__off_" + c)
        out = out.withColumn(prefix + c, F.coalesce((off + here).cast(types[c]), here, off.cast(types[c])))
    return out.drop(_PID, *["__off_" + c for c in sum_cols])


def global_lag(df: DataFrame, order: Sequence, value: str, name: str, num_partitions: int | None = None) -> DataFrame:
    """``value`` of the row before in ``order`` (a total order); null in the first row."""
    def lag(w: WindowSpec) -> dict[str, Column]:
        w = w.orderBy(*_order_exprs(order))
        return {_LOCAL: F.row_number().over(w), name: F.lag(value).over(w)}

    local = _windowed(df, order, lag, num_partitions)
    last = local.groupBy(_PID).agg(F.max_by(F.struct(F.col(value).alias("v")), _LOCAL).alias("__last"))
    earlier = last.select(_PID, F.lag("__last").over(Window.orderBy(_PID))["v"].alias("__earlier"))
    return (local.join(F.broadcast(earlier), _PID, "left")
                 .withColumn(name, F.when(F.col(_LOCAL) == 1, F.col("__earlier")).otherwise(F.col(name)))
                 .drop(_PID, _LOCAL, "__earlier"))


def global_rank(df: DataFrame, value: str, name: str, dense: bool = False, cumulative: str | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """``RANK`` (or ``DENSE_RANK``) by ``value``, descending, nulls last, over all rows.

    ``cumulative`` names a further column: the sum of ``value`` down to the
    row, equal values sharing it (SQL's default ``RANGE`` frame).

    Rows of one value are spread over partitions like all others.  Within a
    partition the local rank plus an offset is right except for its first
    and last run of equal values, which may go on in its neighbours: those
    runs, two per partition, take rank and sum from the partitions where
    their value begins and ends.
    """
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name != value and f.dataType.typeName() not in ("map", "variant")]
    spread = F.xxhash64(*rest) if rest else F.lit(0)

    def columns(w: WindowSpec) -> dict[str, Column]:
        w = w.orderBy(F.col(value).desc_nulls_last())
        out = {_LOCAL: (F.dense_rank() if dense else F.rank()).over(w).cast("long")}
        return out | ({cumulative: F.sum(value).over(w)} if cumulative else {})

    local = _windowed(df.withColumn("__spread", spread), [F.col(value).desc_nulls_last(), "__spread"], columns,
                      num_partitions).drop("__spread")
    v = F.col(value)

    def plus(a: Column, b: Column) -> Column:  # as in SQL, a sum is null until the first value
        return F.coalesce(a + b, a, b)

    ends = local.groupBy(_PID).agg(
        F.count(F.lit(1)).alias("n"), F.max(_LOCAL).alias("top"), F.max(v).alias("first_v"),
        F.when(F.count(v) == F.count(F.lit(1)), F.min(v)).alias("last_v"),
        *([F.sum(v).alias("s"), F.min(F.when(F.col(_LOCAL) == 1, F.col(cumulative))).alias("first_s")] if cumulative else []))
    by_pid = Window.orderBy(_PID)
    past = by_pid.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.lag(F.struct("last_v")).over(by_pid)["last_v"].eqNullSafe(F.col("first_v")), F.lit(False)) & (
        F.row_number().over(by_pid) > 1)
    ends = ends.withColumn("on", F.when(goes_on, 1).otherwise(0))
    if dense:  # a value that goes on is counted once
        before = F.coalesce(F.sum(F.col("top") - F.col("on")).over(past), F.lit(0)) - F.col("on")
    else:
        before = F.coalesce(F.sum("n").over(past), F.lit(0))
    ends = ends.withColumn("before", before)
    if cumulative:
        ends = ends.withColumn("past_s", F.sum("s").over(past))
    else:
        ends = ends.withColumns(dict.fromkeys(("past_s", "s", "first_s"), F.lit(0)))
    run = [F.struct(F.col(f"{e}_v").alias("v"), (F.col("before") + r).alias("r"),
                    plus(F.col("past_s"), F.col(t)).alias("c"))
           for e, r, t in (("first", F.lit(1), "first_s"), ("last", F.col("top"), "s"))]
    runs = ends.select(_PID, F.explode(F.array(*run)).alias("run")).groupBy(F.col("run.v").alias("v")).agg(
        F.min("run.r").alias("r"), F.max_by("run.c", F.struct(F.col(_PID), F.col("run.r"))).alias("c"))
    for e in ("first", "last"):
        named = runs.select(F.col("v").alias(f"{e}_w"), F.col("r").alias(f"{e}_r"), F.col("c").alias(f"{e}_c"))
        ends = ends.join(F.broadcast(named), F.col(f"{e}_v").eqNullSafe(F.col(f"{e}_w")), "left")
    per = ends.select(_PID, F.struct("top", "before", "past_s", "first_r", "last_r", "first_c", "last_c").alias("__ends"))
    e = F.col("__ends")
    first, last = F.col(_LOCAL) == 1, F.col(_LOCAL) == e["top"]
    out = local.join(F.broadcast(per), _PID, "left").withColumn(
        name, F.when(first, e["first_r"]).when(last, e["last_r"]).otherwise(e["before"] + F.col(_LOCAL)))
    if cumulative:
        kind = local.schema[cumulative].dataType
        out = out.withColumn(cumulative, F.when(first, e["first_c"]).when(last, e["last_c"])
                             .otherwise(plus(e["past_s"], F.col(cumulative))).cast(kind))
    return out.select(*df.columns, name, *([cumulative] if cumulative else []))


def attach_row(df: DataFrame, row_df: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (an ungrouped aggregate: exactly
    one row by construction) to every row, as a scalar subquery: no action
    while the query is built, and no constant-key join, which Catalyst would
    plan as a nested loop."""
    row = row_df.select(F.struct(*[F.col(c) for c in row_df.columns]).alias("row")).scalar()
    return df.select("*", *[row.getField(c).alias(c) for c in row_df.columns])


def small_window(order: Sequence | None = None) -> Window:
    """A global window — only for inputs already aggregated to a bounded size."""
    w = Window.partitionBy()
    return w.orderBy(*_order_exprs(order)) if order else w


def ntile_of_position(pos: Column, n_rows: Column, buckets: int) -> Column:
    """SQL ``NTILE(buckets)`` bucket of a 1-based position among ``n_rows`` rows.

    The first ``n_rows % buckets`` buckets hold one extra row.
    """
    b = F.lit(buckets)
    q = F.floor(n_rows / b)
    r = n_rows - q * b
    big = r * (q + 1)
    return F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((pos - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("long")


def group_quantiles(df: DataFrame, by: Sequence[str], value, probs: dict[str, float],
                    num_partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group of ``by``.

    Same definition as SQL ``percentile``/``median`` (position ``p*(n-1)``).
    Rows are first counted per (group, value) with map-side combine, so a hot
    group and a hot value both shrink before anything is shuffled; the counts
    are accumulated in global order, and each group keeps the values whose
    span of positions holds the wanted ones.  Null values are ignored; groups
    with no value are absent (without ``by`` the one row is null).
    ``weight``: a column that says how many rows a row stands for.
    """
    by = list(by)
    v = F.col(value) if isinstance(value, str) else value
    base = df.select(*by, v.cast("double").alias("__v"), (F.col(weight) if weight else F.lit(1)).alias("__w")).where(
        F.col("__v").isNotNull())
    counts = base.groupBy(*by, "__v").agg((F.sum("__w") if weight else F.count("__w")).cast("long").alias("__n"))
    order = [F.col(b).asc_nulls_first() for b in by] + [F.col("__v").asc()]
    spans = running_totals(counts, order, ["__n"], "__to", num_partitions).withColumnRenamed("__to__n", "__to")
    stats = spans.groupBy(*by).agg(F.min(F.col("__to") - F.col("__n")).alias("__first"), F.sum("__n").alias("__total"))
    if by:
        keyed = stats.select(*[F.col(b).alias("__k_" + b) for b in by], "__first", "__total")
        cond = None
        for b in by:
            c = F.col(b).eqNullSafe(F.col("__k_" + b))
            cond = c if cond is None else cond & c
        spans = spans.join(keyed, cond)
    else:
        spans = attach_row(spans, stats)
    to = F.col("__to") - F.col("__first")

    def at(position: Column) -> Column:
        return F.max(F.when((position >= to - F.col("__n")) & (position < to), F.col("__v")))

    parts, out = [], []
    for i, (name, p) in enumerate(probs.items()):
        position = F.lit(float(p)) * (F.col("__total") - 1)
        parts += [at(F.floor(position)).alias(f"__lo{i}"), at(F.ceil(position)).alias(f"__hi{i}"),
                  F.max(position - F.floor(position)).alias(f"__f{i}")]
        lo, hi, f = (F.col(f"__{x}{i}") for x in ("lo", "hi", "f"))
        out.append((lo + f * (hi - lo)).alias(name))
    return spans.groupBy(*by).agg(*parts).select(*by, *out)


def with_quantiles(agg: DataFrame, df: DataFrame, by: Sequence[str], value,
                   probs: dict[str, float]) -> DataFrame:
    """Attach :func:`group_quantiles` columns to an aggregate keyed by ``by`` (null-safe)."""
    q = group_quantiles(df, by, value, probs)
    if not by:
        return attach_row(agg, q)
    qr = q.select(*[F.col(b).alias("__k_" + b) for b in by], *probs.keys())
    cond = None
    for b in by:
        c = agg[b].eqNullSafe(qr["__k_" + b])
        cond = c if cond is None else cond & c
    return agg.join(qr, cond, "left").drop(*["__k_" + b for b in by])


__all__ = ["global_row_number", "running_totals", "global_lag", "global_rank", "small_window", "ntile_of_position",
           "group_quantiles", "with_quantiles", "attach_row"]
