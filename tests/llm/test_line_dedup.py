from collections import Counter

import pytest
from fixtures import edge_docs, empty_docs, rows_of, with_clashes
from pyspark.sql import functions as F

from ledgerlens.llm import line_dedup


def slow(rows, ratio, least):
    pages = Counter(s for _, s, _ in rows)
    held = Counter((s, l) for _, s, t in rows for l in {x.strip(" ") for x in (t or "").split("\n")} - {""} if t is not None)
    drop = {k for k, n in held.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for i, s, t in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if (s, x.strip(" ")) not in drop]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    rows = [(i, f"h{i % 3}" if i % 7 else None, "\n".join(
        [" menu "] * (i % 2) + [f"line {i}", "", f"shared {i % 4}", "menu"] + ["menu"] * (i % 5 == 0))) for i in range(60)]
    rows += [(60, "h0", None), (61, "h0", ""), (62, "h9", "menu"), (3, "h0", rows[3][2]), (None, "h1", "menu\n")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, lines string")
    for ratio, least in ((0.1, 5), (0.5, 2), (0.3, 3)):
        found = line_dedup.drop_boilerplate(pages, ratio=ratio, min_pages=least)
        assert rows_of(found, "doc_id", "text", "_n_lines", "_n_dropped") == slow(rows, ratio, least)


def test_shuffled_join_gives_the_same(spark):
    rows = [(i, "hot" if i % 3 else f"h{i}", f"menu\nline {i}") for i in range(90)]
    pages = spark.createDataFrame(rows, "doc_id long, source string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = line_dedup.drop_boilerplate(pages)
        assert rows_of(found, "doc_id", "text", "_n_lines", "_n_dropped") == slow(rows, line_dedup.RATIO, line_dedup.MIN_PAGES)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_edges(spark):
    docs = with_clashes(edge_docs(spark))
    found = line_dedup.drop_boilerplate(docs)
    assert found.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    assert rows_of(found, *docs.columns) == rows_of(docs)
    assert line_dedup.drop_boilerplate(empty_docs(spark)).count() == 0
    named = docs.withColumn("_n_lines", F.lit("theirs"))
    with pytest.raises(ValueError, match="_n_lines"):
        line_dedup.drop_boilerplate(named)
    other = line_dedup.drop_boilerplate(named, counts=("a", "b"))
    assert other.columns == [*named.columns, "a", "b"] and rows_of(other, *named.columns) == rows_of(named)


def test_host_of(spark):
    urls = spark.createDataFrame([("https://Blog.A.com/x?y",), ("no url",), (None,)], "u string")
    assert [r[0] for r in urls.select(line_dedup.host_of(F.col("u"))).collect()] == ["blog.a.com", None, None]


def test_pages_by_the_host_of_their_url(spark):
    rows = [(i, f"https://www.{'Shop' if i % 3 else 'news'}.org/p/{i}", f"<nav>\nbody {i}\nshop footer" if i % 3 else f"<nav>\nitem {i}")
            for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = line_dedup.drop_boilerplate(pages, line_dedup.host_of(F.col("url")), "html")
    assert rows_of(found, "page_id", "html") == sorted(((i, f"body {i}" if i % 3 else f"item {i}") for i in range(60)), key=repr)


def test_native(spark):
    plan = line_dedup.drop_boilerplate(edge_docs(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))
