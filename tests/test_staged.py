"""Joins in buckets: wide rows that meet a large lookup are written as columns instead of shuffled."""

import glob

import pytest

from wrenchlake import schemas
from wrenchlake.operators import ingest, skew
from wrenchlake.plans import catalog
from wrenchlake.sources import feeds

FACTS = [(i, f"P{i % 7}" if i % 5 else None, "T1" if i % 2 else "T2") for i in range(200)] + [(1000 + i, "HOT", "T1") for i in range(300)] * 2
LOOKUP = [(f"P{i}", "T1", f"group {i}") for i in range(5)] + [("HOT", "T1", None), (None, "T1", "none"), ("P6", "T2", "group 6")]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sides(spark):
    facts = spark.createDataFrame(FACTS, "n int, part string, type string")
    lookup, large = skew.bounded_or_dealt(spark.createDataFrame(LOOKUP, "part string, type string, found string"), 0)
    assert large
    return facts, lookup


@pytest.mark.parametrize("hot_rows", [1_000_000, 100, 10])
def test_join_in_buckets_is_a_left_join(spark, rows, hot_rows):
    facts, lookup = _sides(spark)
    joined, _ = skew.join_in_buckets(facts, lookup, ["part", "type"], 1, hot_rows)
    plain = facts.join(lookup.drop("_dealt"), ["part", "type"], "left")
    assert sorted(joined.columns) == sorted(plain.columns)
    assert rows(joined, "n", "part", "type", "found") == rows(plain, "n", "part", "type", "found")


def test_the_facts_are_neither_shuffled_nor_sorted(spark):
    facts, lookup = _sides(spark)
    joined, _ = skew.join_in_buckets(facts, lookup, ["part", "type"], 1)
    plan = _plan(joined)
    assert plan.count("Exchange") == 1 and "ShuffledHashJoin" in plan and "Sort" not in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]


def test_nothing_to_join(spark, rows):
    facts, lookup = _sides(spark)
    assert rows(skew.join_in_buckets(facts.limit(0), lookup, ["part", "type"], 1)[0]) == []
    assert rows(skew.join_in_buckets(facts, lookup.limit(0), ["part", "type"], 1)[0], "n", "found") == rows(facts.selectExpr("n", "null"))


def test_a_hot_key_is_met_file_by_file(spark):
    facts, lookup = _sides(spark)
    joined, _ = skew.join_in_buckets(facts, lookup, ["part", "type"], 1, 100)
    assert "Union" in _plan(joined) and "BroadcastHashJoin" in _plan(joined)


def _cards(spark):
    raw = spark.createDataFrame([], schemas.JOB_CARDS.ddl)
    first = dict.fromkeys(raw.columns) | {
        "JobCard": "JC1", "PartNumber": "P1", "PrimaryPartNumber": "P1", "VehicleChassisNumber": "me3j3000aaa000001", "Product": "Classic 350", "DealerCode": "D1",
    }
    cards = [first, first, first | {"JobCard": "JC2", "DealerCode": "D2", "PartNumber": None}, first | {"JobCard": None, "VehicleChassisNumber": None}]
    parts = [("P1", "NEW CLASSIC", "BRAKES", "V", "C"), ("P1", "METEOR", "ENGINE", "V", "C"), (None, "NA", "NONE", "V", "C")]
    parts = spark.createDataFrame(parts, "PartNumber string, ModelType string, PartGroup string, PartVariant string, PartCategory string")
    dealers = spark.createDataFrame([("D1", "here"), (None, "nowhere")], "Code string, CityCode string")
    return spark.createDataFrame([tuple(c[n] for n in raw.columns) for c in cards], raw.schema), parts, dealers


def test_staged_ingestion_gives_the_same_table(spark, rows, monkeypatch):
    raw, parts, dealers = _cards(spark)
    plain = ingest.ingest_job_cards(raw, parts, dealers, "2021-08-01")
    monkeypatch.setattr(ingest, "bounded_or_dealt", lambda df: skew.bounded_or_dealt(df, 0))
    staged = ingest.ingest_job_cards(raw, parts, dealers, "2021-08-01", staged=raw.count())
    assert staged.columns == plain.columns and [f.dataType for f in staged.schema] == [f.dataType for f in plain.schema]
    assert rows(staged) == rows(plain)
    assert "Bucketed: true" in _plan(staged)


@pytest.mark.parametrize("part", ["l_partkey", "p_type"])
def test_the_whole_job_card_table_moves_no_line_to_a_large_part_master(spark, rows, monkeypatch, part):
    sf = "/root/testdata/sf0.001"
    plain = catalog._ingested(spark, sf, part)
    monkeypatch.setattr(ingest, "bounded_or_dealt", lambda df: skew.bounded_or_dealt(df, 0))
    whole = catalog._ingested(spark, sf, part, whole=True)
    assert "l_orderkey" not in "".join(line for line in _plan(whole).splitlines() if "Exchange" in line)
    assert "Scan parquet" in _plan(whole) and "lineitem" not in _plan(whole)
    assert rows(whole) == rows(plain)


def test_feed_files_are_compressed(spark, monkeypatch, tmp_path):
    """The stand-in feed is the largest thing on the disk when it is written as plain text."""
    monkeypatch.setattr(catalog, "_scratch", lambda _: str(tmp_path))
    assert catalog.feed_job_cards(spark, "/root/testdata/sf0.001").count() == feeds.read_feed(spark, f"{tmp_path}/cards", "job_cards").count() > 0
    assert glob.glob(f"{tmp_path}/cards/*.csv.gz") and not glob.glob(f"{tmp_path}/cards/*.csv")
