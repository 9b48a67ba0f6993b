"""S-series: dirty CSV reads, export, warehouse publish/read, model IO."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning as CL
from ledgerlens.sources import files as S
from ledgerlens.sources import warehouse as WH


def test_latin1_csv_with_padded_headers(spark, tmp_path):
    p = tmp_path / "raw_a.csv"
    text = (" permalink , name , funding_total_usd \n"
            '/A, Café ," 1,750,000 "\n'
            "/b,Bob, - \n"
            ",,\n,,\n,,\n")
    p.write_bytes(text.encode("latin-1"))
    df = S.read_csv(spark, str(p), encoding="ISO-8859-1")
    assert df.columns == ["permalink", "name", "funding_total_usd"]
    assert all(f.dataType.typeName() == "string" for f in df.schema.fields)
    clean = CL.drop_all_null_rows(df)
    assert clean.count() == 2
    rows = {r.permalink: r for r in clean.collect()}
    assert rows["/A"].name == " Café "
    from ledgerlens.functions.columns import parse_currency
    money = {r.permalink: r.m for r in clean.select("permalink", parse_currency("funding_total_usd").alias("m")).collect()}
    assert money == {"/A": 1750000.0, "/b": None}


def test_bom_utf8(spark, tmp_path):
    p = tmp_path / "raw_c.csv"
    p.write_bytes("﻿company,country\nX,US\n".encode("utf-8"))
    df = S.read_csv(spark, str(p))
    assert df.columns == ["company", "country"]
    assert df.count() == 1


def test_write_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    out = str(tmp_path / "out")
    S.write_csv(df, out, single_file=True)
    back = S.read_csv(spark, out)
    assert sorted((r.id, r.v) for r in back.collect()) == [("1", "a"), ("2", None)]


def test_warehouse_publish_and_failed_load_keeps_old(spark, tmp_path):
    root = str(tmp_path / "wh")
    t1 = {"dim": spark.createDataFrame([(1, "a"), (2, "")], "id int, v string"),
          "fact": spark.createDataFrame([(1, 10.0)], "id int, x double")}
    v1 = WH.load_warehouse(t1, root, order=["dim", "fact"])
    got = WH.read_warehouse(spark, root)
    assert set(got) == {"dim", "fact"}
    assert got["dim"].where(F.col("v").isNull()).count() == 1  # empty string → null

    def failing(staged):
        raise ValueError("constraint violated")

    with pytest.raises(ValueError):
        WH.load_warehouse({"dim": t1["dim"], "fact": t1["fact"]}, root, checks=failing)
    assert WH.current_version(spark, root)[0] == v1


def test_query_registry(spark):
    spark.createDataFrame([(1,), (2,)], "x int").createOrReplaceTempView("qr_t")
    reg = WH.QueryRegistry({"s": "SELECT SUM(x) AS s FROM qr_t WHERE x >= :lo"})
    assert reg.run(spark, "s", lo=2).first()["s"] == 2


def test_text_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb"), (2, "c")], "k int, text string")
    out = S.text_lines(df, "k").orderBy("k", "line_no").collect()
    assert [(r.k, r.line_no, r.line) for r in out] == [(1, 1, "a"), (1, 2, ""), (1, 3, "b"), (2, 1, "c")]


def test_read_text_lines_counts_per_file_over_splits(spark, tmp_path):
    texts = {"a.txt": [f"line {i}" for i in range(3000)], "b.txt": ["x", "", "y"]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = S.read_text_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, lines in texts.items():
        got = sorted((r.line_no, r.line) for r in rows if r.path.endswith(name))
        assert got == [(i + 1, x) for i, x in enumerate(lines)]


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('k,v\n1,"two\nlines"\n2,one\n')
    assert sorted(map(tuple, S.read_csv(spark, str(p), multi_line=True).collect())) == [("1", "two\nlines"), ("2", "one")]


def test_save_and_load_model(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    m = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                         LinearRegression(labelCol="y")]).fit(df)
    path = str(tmp_path / "model")
    S.save_model(m, path)
    back = S.load_model(path)
    assert abs(back.stages[-1].coefficients[0] - 2.0) < 1e-6
    assert os.path.isdir(path)


def test_registry_binds_its_tables(spark, tmp_path):
    """Two warehouses with the same table names are open at once; each run reads the one it is given."""
    reg = WH.QueryRegistry({"total": "SELECT SUM(x) AS s FROM {fact}"})
    opened = []
    for i, n in enumerate((3, 5)):
        root = str(tmp_path / f"wh{i}")
        WH.load_warehouse({"fact": spark.range(n).selectExpr("id AS x")}, root)
        opened.append(WH.read_warehouse(spark, root))
    assert [reg.run(spark, "total", t).first()["s"] for t in opened] == [3, 10]
    assert reg.run(spark, "total", opened[0]).first()["s"] == 3


def test_readers_always_find_a_version_while_others_publish(spark, tmp_path):
    import threading
    root = str(tmp_path / "wh")
    WH.load_warehouse({"t": spark.range(1)}, root)
    stop, faults = threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                WH.current_version(spark, root)
            except Exception as e:  # noqa: BLE001
                faults.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    versions = [WH.load_warehouse({"t": spark.range(i)}, root, keep_hours=0) for i in range(2, 7)]
    stop.set()
    reader.join()
    assert not faults
    assert versions == sorted(set(versions)) and WH.current_version(spark, root)[0] == versions[-1]
    assert WH.read_warehouse(spark, root)["t"].count() == 6
    kept = [p.name for p in (tmp_path / "wh").iterdir() if p.name.startswith("v")]
    assert sorted(kept) == versions[-2:]  # older versions are gone
    last = [WH.load_warehouse({"t": spark.range(i)}, root) for i in range(3)]
    kept = [n for n in os.listdir(root) if n.startswith("v")]
    assert sorted(kept) == versions[-2:] + last  # replaced a moment ago: a reader may still be at them


def test_star_follows_its_sources(spark, tmp_path):
    from ledgerlens.plans.star import SOURCES, warehouse
    src = "/root/testdata/sf0.001"
    for t in SOURCES:
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    first = warehouse(spark, str(tmp_path))["fact_startup_funding"].count()
    spark.read.parquet(f"{src}/customer.parquet").where("c_custkey % 2 = 0").write.mode("overwrite").parquet(
        str(tmp_path / "customer.parquet"))
    again = warehouse(spark, str(tmp_path))["fact_startup_funding"].count()
    assert 0 < again < first


def test_star_with_broken_constraints_is_not_published(spark):
    from ledgerlens.operators.quality import ConstraintViolated, require_constraints
    tables = {"dim": spark.createDataFrame([(1,), (1,)], "k int"), "fact": spark.createDataFrame([(2,)], "k int")}
    with pytest.raises(ConstraintViolated, match="primary_key_duplicates"):
        require_constraints(tables, {"dim": {"primary_key": ["k"]}})
    with pytest.raises(ConstraintViolated, match="foreign_key_orphans:dim"):
        require_constraints(tables, {"fact": {"foreign_keys": [(["k"], "dim", ["k"])]}})
