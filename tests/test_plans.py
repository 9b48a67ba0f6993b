"""Plan regression: registered queries keep their physical plans free of
cartesian / nested-loop joins."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(spark, monkeypatch):
    """Of the final plan of every query, and of every table it writes on the way."""
    from pyspark.sql.readwriter import DataFrameWriter

    q, o = E.queries(), E.oracle_sql()
    written, write = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        written.append(_plan(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    bad, behind = [], 0
    for name in sorted(o):
        written.clear()
        plans = [_plan(q[name](spark, SF)), *written]
        behind += len(written)
        if any("CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan for plan in plans):
            bad.append(name)
    assert bad == [] and behind > 50


def test_filters_and_pruning_reach_the_scan(spark):
    plan = _plan(E.queries()["w1_top_n_per_group"](spark, SF))
    assert "PushedFilters: [IsNotNull(funding_total_usd)" in plan or "isnotnull(funding_total_usd" in plan
    from ledgerlens.plans.star import startup_entities
    from ledgerlens.session import read_tables
    p = _plan(startup_entities(read_tables(spark, SF)))
    assert "LessThan(o_orderdate" in p
    assert "c_address" not in p
