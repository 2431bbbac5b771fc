"""Use cases that read job cards straight from ingestion."""

import re

import pytest

from wrenchlake import schemas
from wrenchlake.operators import ingest
from wrenchlake.plans import catalog

SF = "/root/testdata/sf0.001"
PARTS = [("P1", "NEW CLASSIC", "BRAKES", "V", "C"), ("P1", "METEOR", "ENGINE", "V", "C")]


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def enriched(spark):
    parts = spark.createDataFrame(PARTS, "PartNumber string, ModelType string, PartGroup string, PartVariant string, PartCategory string")
    dealers = spark.createDataFrame([("D1", "here"), ("D1", "there"), (None, "nowhere")], "Code string, CityCode string")
    raw = spark.createDataFrame([], schemas.JOB_CARDS.ddl)
    first = dict.fromkeys(raw.columns) | {
        "JobCard": "JC1", "PartNumber": "P1", "PrimaryPartNumber": "P1", "VehicleChassisNumber": "me3j3000aaa000001", "Product": "Classic 350", "DealerCode": "D1",
    }
    rows = [first, first | {"JobCard": "JC2", "DealerCode": "D2", "PartNumber": None}, first | {"JobCard": "JC3", "VehicleChassisNumber": None}]
    raw = spark.createDataFrame([tuple(r[c] for c in raw.columns) for r in rows], raw.schema)
    return ingest.ingest_job_cards(raw, parts, dealers, "2021-08-01")


def test_lookups_that_nobody_asks_for_are_not_joined(enriched):
    assert _optimized(enriched.select("JobCard", "Plant", "MfgDate")).count("Join") == 0
    assert _optimized(enriched.select("JobCard", "PartGroup")).count("Join") == 1


def test_lookups_by_raw_columns(enriched, rows):
    found = rows(enriched, "JobCard", "ModelType", "PartGroup", "PrimaryPartGroup", "City")
    assert found == [("JC1", "NEW CLASSIC", "BRAKES", "BRAKES", "HERE"), ("JC2", "NEW CLASSIC", None, "BRAKES", None), ("JC3", "NA", None, None, "HERE")]


def test_a_use_case_writes_no_job_card_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "scratch_root", lambda _: str(tmp_path))
    straight = catalog.label_quality(spark, SF).collect()
    assert not (tmp_path / next(iter([p.name for p in tmp_path.iterdir()]), "none") / "job_cards_l_partkey").exists()
    catalog.prepare(spark, SF)
    assert sorted(map(repr, catalog.label_quality(spark, SF).collect())) == sorted(map(repr, straight)) != []


def test_lookups_shuffle_the_lines_and_not_their_texts(spark, monkeypatch):
    """With a part master too large to broadcast, the rows that meet it carry none of the feed's derived texts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(ingest, "bounded", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog._ingested(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = plan[plan.index("Join LeftOuter") :]
    below = below[below.index("\n") :]
    assert "ModelType" in below and not re.search(r"AS (JobCard|State|DealerName|VehicleChassisNumber|PrimaryPart|Product)#", below)
