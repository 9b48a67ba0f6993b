"""Site-relative line removal.

For every host, the share of its pages that hold a line is the number of those
pages divided by the number of the host's pages; lines above a ratio are
boilerplate of that host and are dropped from its pages.  A line that is
common elsewhere but rare on a host stays there.

Only DataFrame functions.  Lines are counted by (host, digest) with map-side
sums, so a host with a third of all pages is spread over all tasks.  What is
joined back to the pages is one short list per host: with pages of L distinct
lines on average, at most L / ratio digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, materialise

#: Site templates put a line on a fixed kind of page: navigation on all, a footer or a notice on about one in ten.
#: Text of one's own hardly ever stands on one page in twenty, so half the rate of the rarest template is the limit.
RATIO = 0.05
#: On fewer pages a share says little: one chance repeat more would move it by a tenth or more.
MIN_PAGES = 10


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL; null where there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, lines)``: digests of the lines on more than ``ratio`` of a host's pages, and on ``min_pages`` at least."""
    rows = pages.select(host.alias("host"), text.alias("text"))
    totals = materialise(rows.groupBy("host").agg(F.count("*").alias("pages")), "host-pages")
    lines = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), lambda l: F.trim(l)), lambda l: l != ""))
    held = rows.select("host", F.explode(lines).alias("line")).groupBy("host", _digest(F.col("line")).alias("line"))
    common = held.agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    common = common.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host_col: str | Column = "source", text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, counts: tuple[str, str] = ("_n_lines", "_n_dropped")) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text_col``, and the columns ``counts`` (lines, lines
    removed) at the end.

    ``host_col`` names the host, or is an expression such as ``host_of(url)``.
    Lines are compared without spaces at their ends; a page counts once for a
    line however often it holds it; blank lines are never boilerplate and
    stay.  Every row is a page, repeated rows included.  Null hosts are one
    host; null text stays null with 0 lines; a page may end up empty.  An
    empty table stays empty.  Other columns pass unchanged, whatever their
    names; one named as in ``counts`` is an error.  The list of lines is
    written first, so Spark broadcasts it only if its files are small, and
    else splits a hot host.
    """
    if taken := {c.lower() for c in counts} & {c.lower() for c in pages.columns}:
        raise ValueError(f"the table has {sorted(taken)}; choose other names for the counts")
    site, gone, left = fresh_names([*pages.columns, *counts], "host", "gone", "left")
    given = F.col(host_col) if isinstance(host_col, str) else host_col
    host = F.concat(F.when(given.isNull(), "-").otherwise("+"), F.coalesce(given.cast("string"), F.lit("")))
    text = F.col(text_col).cast("string")
    found = materialise(boilerplate(pages, host, text, ratio, min_pages), "boilerplate").select(
        F.col("host").alias(site), F.col("lines").alias(gone))
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda l: ~F.array_contains(F.col(gone), _digest(F.trim(l))))
    joined = pages.withColumn(site, host).join(found, site, "left")
    joined = joined.withColumn(left, F.when(F.col(gone).isNull(), lines).otherwise(kept))
    n = F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines))
    dropped = F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(left))
    counted = joined.withColumns({counts[0]: n.cast("long"), counts[1]: dropped.cast("long")})
    cut = counted.withColumn(text_col, F.when(F.col(gone).isNull(), text).otherwise(F.array_join(left, "\n")))
    return cut.drop(site, gone, left)
