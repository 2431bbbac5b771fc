"""Golden frames for part changes."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.operators import trigger
from wrenchlake.session import materialise

D = dt.date.fromisoformat
CARD_DDL = ", ".join(
    f"{c} {'date' if c in ('CreatedOn', 'MfgDate') else 'bigint' if c in ('Kilometers', 'MfgMonth', 'MfgYear') else 'string'}"
    for c in schemas.CHANGE_FACT_COLUMNS
)


def cards(spark, items):
    """items: (job card, part, model, build date[, plant])."""
    data = []
    for jc, part, model, built, *plant in items:
        row = dict.fromkeys(schemas.CHANGE_FACT_COLUMNS)
        row.update(JobCard=jc, PartNumber=part, ModelID=model, MfgDate=D(built), CreatedOn=D("2022-01-01"), Plant=plant[0] if plant else "TVT")
        data.append(tuple(row[c] for c in schemas.CHANGE_FACT_COLUMNS))
    return spark.createDataFrame(data, CARD_DDL)


def change(parts, effective, mfg, reason, models="['M1', 'M2']", plant="TVT"):
    listed = "[" + ", ".join(f"{{'Part No': '{p}', 'Part Description': 'text {p}'}}" for p in parts) + "]"
    return (listed, "DC", models, D(mfg), plant, "mod", D(effective), reason)


def changes(spark, *items):
    return trigger.parse_engineering_changes(spark.createDataFrame(list(items), schemas.ENGINEERING_CHANGES.ddl))


def run(spark, facts, listed, **kw):
    return trigger.trigger_cutoff(facts, listed, trigger.ENGINEERING, "2022-02-01", **kw)


FACTS = [
    ("J1", "A", "M1", "2020-01-01"), ("J2", "A", "M1", "2020-06-01"), ("J3", "A", "M1", "2021-06-01"),
    ("J4", "A", "M9", "2020-06-01"), ("J5", "B", "M2", "2020-06-01"), ("J6", "C", "M1", "1900-01-01"),
    ("J7", "A", "M1", "2099-01-01"), ("J2", "A", "M1", "2020-06-01"),
]


def listing(spark):
    return changes(
        spark,
        change(["A", "B"], "2020-03-01", "2020-02-01", "first"),
        change(["A"], "2021-03-01", "2021-02-01", "second"),
        change(["A"], "2021-03-01", "2021-04-01", "second twin"),
        change(["C"], "2019-01-01", "1899-01-01", "old"),
    )


EXPECTED = sorted([
    ("J2", "A", "first"), ("J3", "A", "second"), ("J3", "A", "second twin"), ("J5", "B", "first"), ("J6", "C", "old"),
    ("J7", "A", "second"), ("J7", "A", "second twin"),
], key=repr)


def test_windows_end_at_the_next_change_of_the_same_part(spark, rows):
    got = run(spark, cards(spark, FACTS), listing(spark))
    assert rows(got, "JobCard", "PartNumber", "ReasonForChange") == EXPECTED
    row = got.filter("JobCard = 'J5'").first()
    assert (row.PartDescription, row.PartDefect, row.ApplicableModels) == ("text B", "DC", "M1,M2")
    assert (row.EffectiveDate, row.EffectiveYear, row.EffectiveMonth, row.EffectiveMonthName) == (D("2020-03-01"), "2020", "03", "Mar")
    assert row.MfgDate == D("2020-06-01") and row.RunDate == D("2022-02-01")


def test_builds_far_from_the_list_find_their_window(spark, rows):
    listed = changes(spark, change(["A"], "1800-01-01", "1800-01-01", "old"), change(["A"], "2020-01-01", "2020-01-01", "new"))
    facts = cards(spark, [("J1", "A", "M1", "1799-12-31"), ("J2", "A", "M1", "1801-05-05"), ("J3", "A", "M1", "2019-12-31"), ("J4", "A", "M1", "2199-01-01")])
    assert rows(run(spark, facts, listed), "JobCard", "ReasonForChange") == [("J2", "old"), ("J3", "old"), ("J4", "new")]
    assert run(spark, facts, listed.limit(0)).count() == 0


def test_duplicates_go_before_the_stamps_come(spark):
    """Rows are ranked by the job card's columns and a short change id; no text of the change is shuffled with them."""
    plan = run(spark, cards(spark, FACTS), listing(spark))._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("Window [row_number()"):].split("\n")[0]
    assert "_stamp_" not in ranked and "Models" not in ranked
    below = plan[plan.index("Window [row_number()"):]
    below = below[: below.index("Relation", 0)] if "Relation" in below else below
    assert "ModificationDetail" not in below.split("Join")[0]


def test_a_kind_of_its_own_behaves_like_the_known_one(spark, rows):
    own = trigger.ChangeKind(**{f: getattr(trigger.ENGINEERING, f) for f in trigger.ENGINEERING.__dataclass_fields__})
    got = trigger.trigger_cutoff(cards(spark, FACTS), listing(spark), own, "2022-02-01")
    assert got.columns == run(spark, cards(spark, FACTS), listing(spark)).columns
    assert rows(got, "JobCard", "PartNumber", "ReasonForChange") == EXPECTED
    assert got.filter("JobCard = 'J5'").first().PartDescription == "text B"


def test_unread_changes_are_reported(spark):
    raw = spark.createDataFrame([change(["A"], "2020-01-01", "2020-01-01", "x"), ("[broken", "DC", "[]", None, "TVT", "m", None, "y")], schemas.ENGINEERING_CHANGES.ddl)
    assert [r.ReasonForChange for r in trigger.unread_changes(raw).collect()] == ["y"]
    assert trigger.parse_engineering_changes(raw, strict=False).filter("Parts IS NULL").count() == 1


def test_plant_match_is_an_option(spark, rows):
    facts = cards(spark, [("J1", "A", "M1", "2020-06-01", "TVT"), ("J2", "A", "M1", "2020-06-01", "ORG")])
    listed = changes(spark, change(["A"], "2020-01-01", "2020-01-01", "x", plant="ORG"))
    assert rows(run(spark, facts, listed), "JobCard") == [("J1",), ("J2",)]
    assert rows(run(spark, facts, listed, match_plant=True), "JobCard") == [("J2",)]


def test_empty_window_when_the_next_change_builds_earlier(spark, rows):
    listed = changes(
        spark, change(["A"], "2020-01-01", "2021-01-01", "late"), change(["A"], "2020-02-01", "2020-06-01", "early")
    )
    assert rows(run(spark, cards(spark, FACTS), listed), "JobCard", "ReasonForChange") == [
        ("J2", "early"), ("J3", "early"), ("J7", "early")
    ]


def test_approvals_order_by_build_date(spark, rows):
    data = [("['A']", "['M1']", D("2020-01-01"), "N1", *["t"] * 6), ("['A', 'Z']", "['M1']", D("2021-01-01"), "N2", *["t"] * 6)]
    listed = trigger.parse_part_approvals(spark.createDataFrame(data, schemas.PART_APPROVALS.ddl))
    got = trigger.trigger_cutoff(cards(spark, FACTS), listed, trigger.APPROVAL, "2022-02-01")
    assert rows(got, "JobCard", "PPAPNumber", "MfgDate") == [
        ("J1", "N1", D("2020-01-01")), ("J2", "N1", D("2020-01-01")), ("J3", "N2", D("2021-01-01")), ("J7", "N2", D("2021-01-01"))
    ]


def test_summary_keeps_the_latest_change(spark, rows):
    got = trigger.trigger_cutoff_summary(run(spark, cards(spark, FACTS), listing(spark)))
    assert rows(got, "PartNumber", "EffectiveDate", "ReportedIssues") == [
        ("A", D("2021-03-01"), 2), ("B", D("2020-03-01"), 1), ("C", D("2019-01-01"), 1)
    ]


def test_windows_of_one_part_do_not_overlap_when_dates_rise(spark):
    listed = changes(spark, *[change(["A", "B"], f"20{y}-01-01", f"20{y}-01-01", str(y)) for y in range(10, 22)])
    windows = trigger.change_windows(listed, "EffectiveDate").select("_part_no", "_from", "_to")
    a, b = windows.alias("a"), windows.alias("b")
    clash = a.join(b, "_part_no").filter("a._from < b._from AND (a._to IS NULL OR a._to > b._from)")
    assert clash.count() == 0


def test_sweep_equals_the_plain_interval_join(spark, rows):
    """Windows that overlap, touch, are empty, open or without a date, and days on every bound."""
    rng = random.Random(3)

    def day():
        return None if rng.random() < 0.1 else D("2020-01-01") + dt.timedelta(days=rng.randrange(40))

    listed = [(rng.choice("AB"), d, day(), k) for k in range(60) if (d := day())]
    days = sorted({(part, D("2019-12-25") + dt.timedelta(days=k)) for part in "ABC" for k in range(60) if rng.random() < 0.8})
    windows = spark.createDataFrame(listed, "_part_no string, _from date, _to date, _change int")
    got = rows(trigger.open_windows(spark.createDataFrame(days, "_part_no string, _day date"), windows), "_part_no", "_day", "_change")
    assert got == sorted(((p, d, c) for p, d in days for part, start, end, c in listed if p == part and start <= d and (end is None or d < end)), key=repr)


def test_a_hot_part_is_spread_over_its_build_dates(spark):
    """A million cards of one part, a thousand windows: the join deals them by part and date."""
    n = 1_000_000
    filled = {c: F.lit("x") for c in schemas.CHANGE_FACT_COLUMNS} | {
        "JobCard": F.col("id").cast("string"), "PartNumber": F.lit("A"), "ModelID": F.lit("M1"), "CreatedOn": F.lit("2022-01-01").cast("date"),
        "MfgDate": F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 2500).cast("int")), "Kilometers": F.lit(1).cast("bigint"),
    }
    hot = spark.range(n).select(*[filled[c].alias(c) for c in schemas.CHANGE_FACT_COLUMNS])
    at = [(D("2015-01-01") + dt.timedelta(days=2 * k)).isoformat() for k in range(1000)]
    listed = changes(spark, *[change(["A"], day, day, f"c{k}") for k, day in enumerate(at)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = run(spark, hot, listed)
        assert found.count() == n
        tasks = found.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < n
    last = found.groupBy("ReasonForChange").count()
    assert {r["count"] for r in last.filter("ReasonForChange != 'c999'").collect()} == {800}


def test_each_list_is_parsed_once(spark):
    raw = spark.createDataFrame([change(["A"], "2020-01-01", "2020-01-01", "x")], schemas.ENGINEERING_CHANGES.ddl)
    parts = trigger.text.parse_literal(F.col("PartDetails"), trigger.text.PART_LIST)
    plan = raw.select(parts.alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 or plan.count("jsontostructs") == 1
    found = run(spark, cards(spark, FACTS), trigger.parse_engineering_changes(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in found and "from_json" not in found and "jsontostructs" not in found


def test_folded_days_equal_one_summary(spark, rows):
    found = run(spark, cards(spark, [(f"J{k % 9}", "A" if k % 4 else "B", "M1", f"2020-{k % 12 + 1:02d}-01") for k in range(60)]), listing(spark))
    whole = materialise(found.withColumn("JobCard", F.when(F.col("JobCard") != "J3", F.col("JobCard"))))
    parts = [whole.filter(F.pmod(F.hash(*whole.columns), F.lit(3)) == k) for k in range(3)]
    totals = trigger.folded_summary(whole.limit(0).withColumn("ReportedIssues", F.lit(0).cast("bigint")), whole.limit(0), trigger.new_issues(whole.limit(0), whole.limit(0)))
    known = whole.select("PartNumber", "EffectiveDate", "JobCard").limit(0)
    for part in parts:
        fresh = materialise(trigger.new_issues(part, known))
        totals, known = materialise(trigger.folded_summary(totals, part, fresh)), known.unionByName(fresh)
    assert rows(trigger.latest_changes(totals)) == rows(trigger.trigger_cutoff_summary(whole).select(*totals.columns))


@pytest.fixture
def shuffled(spark, monkeypatch):
    """Nothing is broadcast, as on large tables."""
    monkeypatch.setattr(trigger, "bounded", lambda df: materialise(df, "large"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _exchanges(df) -> int:
    return len(re.findall(r"(?m)^[ :+*()\d-]*Exchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_large_tables_meet_in_one_shuffle_each(spark, rows, shuffled):
    """The wide rows of job cards are shuffled once: to the windows of their part."""
    facts = materialise(cards(spark, FACTS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    found = run(spark, facts, listing(spark))
    assert _exchanges(found) == 2
    assert rows(found, "JobCard", "PartNumber", "ReasonForChange") == EXPECTED


def test_cards_that_no_change_can_take_are_left_out_before_the_shuffle(spark, shuffled):
    facts = materialise(cards(spark, FACTS))
    plan = run(spark, facts, listing(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "ModelID" in plan and re.search(r"ModelID#\d+L? IN \(M[12],M[12]\)", plan) and ">= 1899-01-01" in plan


@pytest.mark.parametrize("most", [0, 2, 100])
def test_crowded_parts_are_swept_with_the_same_result(spark, rows, most):
    rng = random.Random(most)
    dates = [(D("2020-01-01") + dt.timedelta(days=rng.randrange(60))).isoformat() for _ in range(200)]
    listed = [change(["A"] if k % 4 else ["A", "B"], dates[k], dates[k + 50], f"c{k}", plant="ORG" if k % 3 else "TVT") for k in range(20)]
    facts = [(f"J{k % 70}", "ABC"[k % 3], f"M{k % 4}", dates[k], "ORG" if k % 2 else "TVT") for k in range(200)]
    plain = {(c[7], p, f[0]) for f in facts for c in listed for p in "AB" if p == f[1] and f"'Part No': '{p}'" in c[0]
             and f[2] in ("M1", "M2") and f[4] == c[4] and c[3] <= D(f[3]) and (D(f[3]) < _until(listed, p, c))}
    found = run(spark, cards(spark, facts), changes(spark, *listed), match_plant=True, most_windows=most)
    assert rows(found, "ReasonForChange", "PartNumber", "JobCard") == sorted(plain) != []


def _until(listed, part, own):
    """Build date of the next change of the part, by the next later effective date."""
    later = [(c[6], c[3]) for c in listed if f"'Part No': '{part}'" in c[0] and c[6] > own[6]]
    return min(later)[1] if later else D("9999-01-01")


def test_a_hot_part_is_split_though_no_shuffle_follows(spark, shuffled):
    n, limits = 200_000, {"skewedPartitionThresholdInBytes": "64KB", "skewedPartitionFactor": "1.5"}
    filled = {c: F.lit("x") for c in schemas.CHANGE_FACT_COLUMNS} | {
        "JobCard": F.sha2(F.col("id").cast("string"), 256), "PartNumber": F.when(F.col("id") % 10 > 0, "A").otherwise(F.concat(F.lit("P"), "id")),
        "ModelID": F.lit("M1"), "CreatedOn": F.lit("2022-01-01").cast("date"), "MfgDate": F.lit("2021-01-01").cast("date"), "Kilometers": F.lit(1).cast("bigint"),
    }
    hot = spark.range(0, n, 1, 16).select(*[filled[c].alias(c) for c in schemas.CHANGE_FACT_COLUMNS])
    for key, value in limits.items():
        spark.conf.set(f"spark.sql.adaptive.skewJoin.{key}", value)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        found = run(spark, hot, changes(spark, change(["A"], "2020-01-01", "2020-01-01", "x")))
        assert found.count() == n * 9 // 10
        whole = run(spark, hot, changes(spark, change(["A"], "2020-01-01", "2020-01-01", "x")))
        whole.collect()
        assert "skew=true" in whole._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in limits:
            spark.conf.unset(f"spark.sql.adaptive.skewJoin.{key}")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
