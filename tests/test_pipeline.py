"""End-to-end cleaning flow on the three dirty extracts (FIXTURES §4):
read → clean → merge → dedupe → match → bridge, with the quality checks."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import cleaning as CL
from ledgerlens.operators import joins as J
from ledgerlens.operators import quality as D
from ledgerlens.operators import reshape as U
from ledgerlens.sources.files import read_csv

RAW_A = (" permalink , name , category_list , funding_total_usd , status , country_code , founded_at \n"
         "/Org/Alpha ,Café Alpha,|Ent|Pol|,\" 1,750,000 \",operating,USA,2010-01-01\n"
         "/org/beta,Beta,Ent,\" - \",,GBR,2914-01-01\n"
         "/org/gamma,Gamma,|,500000,closed,USA,1636-09-08\n"
         "/org/delta,Delta,,nan,acquired,,junk\n"
         ",,,,,,\n,,,,,,\n,,,,,,\n")
RAW_B = ("permalink,status,founded_at\n"
         "/org/alpha,ipo,2010-01-01\n"
         "/ORG/BETA ,closed,2011-05-05\n"
         ",operating,2001-01-01\n"
         ",closed,2002-02-02\n"
         "/org/epsilon,operating,2012-12-12\n"
         "/org/epsilon,closed,2013-01-01\n")
RAW_C = ("company,country,industry,select_investors\n"
         "Café Alpha,USA,Fintech,\"Sequoia, Accel ,Sequoia\"\n"
         "Café Alpha,USA,Fintech,\"Tiger\"\n"
         "Beta,GBR,Vultr,Accel\n"
         "Beta,FRA,Retail,\n"
         "Gamma,,Retail,Index\n")


@pytest.fixture()
def extracts(spark, tmp_path):
    a, b, c = tmp_path / "raw_a.csv", tmp_path / "raw_b.csv", tmp_path / "raw_c.csv"
    a.write_bytes(RAW_A.encode("latin-1"))
    b.write_bytes(RAW_B.encode("utf-8"))
    c.write_bytes(("﻿" + RAW_C).encode("utf-8"))
    return (read_csv(spark, str(a), encoding="ISO-8859-1"), read_csv(spark, str(b)), read_csv(spark, str(c)))


def test_clean_merge_match_bridge(spark, extracts):
    raw_a, raw_b, raw_c = extracts
    assert raw_c.columns[0] == "company"                               # S2: BOM stripped
    a = CL.drop_all_null_rows(raw_a)                                     # C2
    assert D.row_reconciliation({"a": raw_a}, {"a": a}).first().blank_rows == 3   # D1
    a = a.withColumn("permalink", C.normalise_key("permalink"))          # C3
    a = CL.parse_currency_columns(a, ["funding_total_usd"])              # C4
    a = CL.null_future_dates(a, ["founded_at"], 2025)                    # C5
    got = {r.permalink: (r.funding_total_usd, r.founded_at) for r in a.collect()}
    assert got["/org/alpha"][0] == 1750000.0 and got["/org/beta"] == (None, None)
    assert got["/org/delta"] == (None, None) and got["/org/gamma"][1].year == 1636

    b = raw_b.withColumn("permalink", C.normalise_key("permalink"))
    b = CL.flag_before_year(b, "founded_at", 1900, "is_pre_1900")        # C6
    assert D.duplicate_key_count(b, "permalink") == 1                    # D4 (null keys ignored)
    ov = D.key_overlap(raw_a, raw_b, "permalink")                        # D9
    assert {r.stage: r.shared_keys for r in ov.collect()} == {"raw": 0, "normalised": 2}
    b1 = U.dedupe_keep_first(b.withColumn("o", F.monotonically_increasing_id()), ["permalink"], ["o"])
    merged = J.enrich_left(a, b1.select("permalink", "status"), "permalink", overwrite=["status"])  # J1
    merged = J.append_missing(merged, b1.select("permalink", "status"), "permalink")               # J2, U1
    status = {r.permalink: r.status for r in merged.collect()}
    assert status["/org/alpha"] == "ipo" and status["/org/beta"] == "closed"
    assert status["/org/epsilon"] == "operating" and status["/org/gamma"] == "closed"
    assert merged.where(F.col("permalink").isNull()).count() == 1        # null key kept once (deduped)

    merged = merged.withColumn("primary_category", C.first_item("category_list")) \
                   .withColumn("category_count", C.item_count("category_list"))                 # C10, C11
    cats = {r.permalink: (r.primary_category, r.category_count) for r in merged.collect()}
    assert cats["/org/alpha"] == ("Ent", 2) and cats["/org/gamma"] == (None, 0)

    c = CL.fix_values(raw_c, "industry", "industry", {"Vultr": "Enterprise Tech"})                # C8
    c = c.withColumn("company_key", C.normalise_key("company")).withColumn("o", F.monotonically_increasing_id())
    assert D.name_collision_audit(c, "company_key", "country").count() == 1                       # D12
    fact = merged.withColumn("company_key", C.normalise_key("name"))
    ref = c.select("company_key", F.col("country").alias("country_code"), "o", "industry", "select_investors")
    matched = J.match_entities(fact, ref, ["company_key", "country_code"], ["o"],
                               ["industry", "select_investors"], flag="is_unicorn")                # J4, D14
    assert matched.count() == fact.count()
    rate = D.match_rate(matched, "is_unicorn", ref).first()              # D13
    assert rate.matched == 2 and rate.reference_rows == ref.count()
    dim, bridge = J.build_bridge(matched.where("is_unicorn"), "permalink", "select_investors")   # J9
    assert sorted(r.member for r in dim.collect()) == ["Accel", "Sequoia"]
    assert bridge.count() == 3
