"""Data-quality checks and reports.

Each check is one aggregation (or a handful) over the whole table; results
are small long-form DataFrames ``(check, column, value)`` that union into a
single report (D17).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_item, normalise_key
from .ordering import attach_row


def _all_null(cols: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols], F.lit(True))


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


# ----------------------------------------------------------------------------- D1
def row_reconciliation(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame]) -> DataFrame:
    """Per source: raw rows, fully blank raw rows, rows kept after cleaning."""
    parts = []
    for name, r in raw.items():
        a = r.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(_all_null(r.columns)).alias("blank_rows"))
        k = clean[name].agg(F.count(F.lit(1)).alias("kept_rows"))
        parts.append(attach_row(a, k)
                      .select(F.lit(name).alias("source"), "raw_rows", "blank_rows", "kept_rows"))
    return _union(parts)


# ----------------------------------------------------------------------------- D2
def null_profile(df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Percent of nulls per column (one pass), highest first."""
    cols = df.columns
    wide = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100).alias(f"c{i}")
                    for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column, null_pct)")
    if top_n is not None:
        long = long.orderBy(F.col("null_pct").desc(), "column").limit(top_n)
    return long


# ----------------------------------------------------------------------------- D3
def validity(df: DataFrame, column: str) -> DataFrame:
    """D3: non-null count, min, max and count of values ≤ 0."""
    x = F.col(column).cast("double")
    return df.agg(F.lit(column).alias("column"), F.count(x).alias("non_null"), F.min(x).alias("min"),
                  F.max(x).alias("max"), F.count_if(x <= 0).alias("non_positive"))


# ----------------------------------------------------------------------------- D4
def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows beyond the first per non-null key: ``count(*) - count(distinct key)``."""
    keys = [key] if isinstance(key, str) else list(key)
    nn = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return nn.agg((F.count(F.lit(1)) - F.count_distinct(*keys)).alias("duplicate_rows"))


def duplicate_key_count(df: DataFrame, key: str | Sequence[str]) -> int:
    return int(duplicate_keys(df, key).first()["duplicate_rows"] or 0)


# ----------------------------------------------------------------------------- D5
def source_overview(df: DataFrame, name: str = "source") -> DataFrame:
    """Rows, columns, fully blank rows and exact duplicate rows."""
    base = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(_all_null(df.columns)).alias("blank_rows"))
    distinct_rows = df.distinct().agg(F.count(F.lit(1)).alias("__d"))
    j = attach_row(base, distinct_rows)
    return j.select(F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"),
                    "blank_rows", (F.col("rows") - F.col("__d")).alias("duplicate_rows"))


# ----------------------------------------------------------------------------- D7
def cardinality(df: DataFrame, cols: Sequence[str] | None = None, top_n: int | None = None,
                approx: bool = False) -> DataFrame:
    """Distinct non-null values per column and as % of rows."""
    cols = list(cols or df.columns)
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[fn(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("__n", f"stack({len(cols)}, {pairs}) as (column, distinct_count)")
    long = long.select("column", F.col("distinct_count").cast("long").alias("distinct_count"),
                       (F.col("distinct_count").cast("double") / F.col("__n").cast("double") * 100)
                       .alias("distinct_pct"))
    if top_n is not None:
        long = long.orderBy(F.col("distinct_count").desc(), "column").limit(top_n)
    return long


# ----------------------------------------------------------------------------- D9
def key_overlap(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """Shared distinct keys before and after normalising (lower + trim)."""
    b_key = b_key or key

    def shared(fa, fb):
        ka = a.select(fa.alias("k")).where(F.col("k").isNotNull()).distinct()
        kb = b.select(fb.alias("k")).where(F.col("k").isNotNull()).distinct()
        return ka.join(kb, "k", "inner").agg(F.count(F.lit(1)).alias("n"))

    raw = shared(F.col(key), F.col(b_key)).select(F.lit("raw").alias("stage"), F.col("n").alias("shared_keys"))
    nrm = shared(normalise_key(key), normalise_key(b_key)).select(F.lit("normalised").alias("stage"),
                                                                    F.col("n").alias("shared_keys"))
    return raw.unionByName(nrm)


# ----------------------------------------------------------------------------- D10
def delimiter_audit(df: DataFrame, column: str, delimiter: str = "|") -> DataFrame:
    """Share of non-null values starting / ending with the delimiter;
    empty-first-item rate of a naive split vs missing rate after the fix."""
    x = F.col(column)
    nn = F.count(x).cast("double")
    naive_first = F.split(x, "\\" + delimiter).getItem(0)
    return df.agg(
        (F.count_if(x.startswith(delimiter)).cast("double") / nn * 100).alias("leading_pct"),
        (F.count_if(x.endswith(delimiter)).cast("double") / nn * 100).alias("trailing_pct"),
        (F.count_if(naive_first == "").cast("double") / nn * 100).alias("naive_empty_pct"),
        (F.count_if(x.isNotNull() & first_item(x, delimiter).isNull()).cast("double") / nn * 100)
        .alias("fixed_missing_pct"))


# ----------------------------------------------------------------------------- D11
def before_after(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Rows, nulls and distinct values of a column before and after a step."""
    def m(df, stage):
        return df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col(column).isNull()).alias("nulls"),
                      F.count_distinct(column).alias("distinct_values"))
    return m(before, "before").unionByName(m(after, "after"))


# ----------------------------------------------------------------------------- D12
def name_collision_audit(df: DataFrame, name: str, group: str) -> DataFrame:
    """Names found in more than one group, with the group count."""
    return (df.where(F.col(name).isNotNull()).groupBy(name)
              .agg(F.count_distinct(group).alias("groups"))
              .where(F.col("groups") > 1))


# ----------------------------------------------------------------------------- D13
def match_rate(df: DataFrame, flag: str, reference: DataFrame) -> DataFrame:
    """Rows of ``df`` that matched, rows of the reference list, and the
    matched rows as a percentage of that list."""
    matched = df.agg(F.count_if(F.col(flag)).alias("matched"))
    both = attach_row(matched, reference.agg(F.count(F.lit(1)).alias("reference_rows")))
    return both.select("matched", "reference_rows",
                       F.try_divide(F.col("matched").cast("double") * 100, F.col("reference_rows").cast("double"))
                       .alias("match_pct"))


def unmapped_values(df: DataFrame, source: str, mapped: str) -> DataFrame:
    """Distinct source values whose mapping is null."""
    return df.where(F.col(source).isNotNull() & F.col(mapped).isNull()).select(source).distinct()


# ----------------------------------------------------------------------------- D14
class RowCountChanged(AssertionError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """A left join onto ``df`` cannot fan out, since no key (nulls included) occurs twice."""
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise RowCountChanged(f"repeated keys on {list(keys)}")


def assert_same_rows(before: DataFrame, after: DataFrame) -> int:
    """Fan-out guard — the join must not change the row count."""
    b, a = before.count(), after.count()
    if a != b:
        raise RowCountChanged(f"row count changed from {b} to {a}")
    return a


# ----------------------------------------------------------------------------- D15
def check_constraints(tables: Mapping[str, DataFrame], spec: Mapping[str, Mapping]) -> DataFrame:
    """Primary key / unique / not null / foreign key / max length checks.

    ``spec[table]`` may hold ``primary_key``: cols, ``unique``: [cols...],
    ``not_null``: cols, ``foreign_keys``: [(cols, ref_table, ref_cols)],
    ``max_length``: {col: n}.  Returns ``(table, check, columns, violations)``.
    """
    rows = []
    for t, s in spec.items():
        df = tables[t]
        simple = []  # null and length checks: one scan for all of a table
        keys = []
        if s.get("primary_key"):
            pk = s["primary_key"]
            keys.append(("primary_key_duplicates", pk, duplicate_keys(df, pk)))
            simple.append(("primary_key_nulls", pk, reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])))
        keys += [("unique_duplicates", u, duplicate_keys(df, u)) for u in s.get("unique", [])]
        simple += [("not_null", [c], F.col(c).isNull()) for c in s.get("not_null", [])]
        simple += [(f"max_length:{n}", [c], F.length(c) > n) for c, n in s.get("max_length", {}).items()]
        for cols, ref, rcols in s.get("foreign_keys", []):
            r = tables[ref].select(*[F.col(rc).alias(c) for c, rc in zip(cols, rcols)]).distinct()
            child = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])).select(*cols)
            orphans = child.join(r, list(cols), "left_anti").agg(F.count(F.lit(1)).alias("duplicate_rows"))
            keys.append((f"foreign_key_orphans:{ref}", cols, orphans))
        if simple:
            wide = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(simple)])
            long = ", ".join(f"'{name}', '{','.join(cols)}', c{i}" for i, (name, cols, _) in enumerate(simple))
            rows.append(wide.selectExpr(f"stack({len(simple)}, {long}) AS (`check`, columns, violations)")
                            .select(F.lit(t).alias("table"), "check", "columns", F.col("violations").cast("long")))
        for name, cols, r in keys:
            rows.append(r.select(F.lit(t).alias("table"), F.lit(name).alias("check"),
                                 F.lit(",".join(cols)).alias("columns"),
                                 F.col("duplicate_rows").cast("long").alias("violations")))
    return _union(rows)


class ConstraintViolated(ValueError):
    pass


def require_constraints(tables: Mapping[str, DataFrame], spec: Mapping[str, Mapping]) -> None:
    """D15 as a gate: raise if any check of ``spec`` finds violations."""
    bad = check_constraints(tables, spec).where("violations > 0").collect()
    if bad:
        raise ConstraintViolated("; ".join(f"{r['table']}.{r['columns']}: {r['check']} {r['violations']}" for r in bad))


# ----------------------------------------------------------------------------- D16
def warehouse_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    return _union([df.agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows"),
                          F.lit(len(df.columns)).cast("long").alias("columns"))
                   for n, df in tables.items()])


# ----------------------------------------------------------------------------- D17
def quality_report(sections: Mapping[str, DataFrame]) -> DataFrame:
    """One long table ``(section, check, value)`` from wide check results:
    every non-key column of each section becomes a ``check`` row."""
    parts = []
    for sec, df in sections.items():
        num = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("long", "integer", "double", "float", "decimal", "short")]
        label = [f.name for f in df.schema.fields if f.name not in num]
        lab = F.concat_ws("/", *[F.col(c).cast("string") for c in label]) if label else F.lit("")
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in num)
        parts.append(df.select(lab.alias("__lab"), *num)
                       .selectExpr("__lab", f"stack({len(num)}, {pairs}) as (metric, value)")
                       .select(F.lit(sec).alias("section"),
                               F.when(F.col("__lab") == "", F.col("metric"))
                                .otherwise(F.concat_ws(":", "__lab", "metric")).alias("check"),
                               "value"))
    return _union(parts)
