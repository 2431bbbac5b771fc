"""Golden frames for visits, maturity, cost and the data checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.operators import cost, maturity, quality, visits

D = dt.date.fromisoformat
TYPES = {"CreatedOn": "date", "MfgDate": "date", "DateofSale": "date", "Kilometers": "bigint", "MfgMonth": "bigint", "MfgYear": "bigint",
         "LineAmount": "double", "CreatedOnYear": "bigint", "CreatedOnMonth": "bigint"}
DDL = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in schemas.JOB_CARD_TABLE)
GOOD = {
    "JobCard": "JC00000000000001", "VehicleChassisNumber": "ME3U30000KA000001", "ModelType": "UCE", "Model": "CLASSIC",
    "Plant": "TVT", "Country": "Domestic", "PartNumber": "A1", "PartDescription": "filter", "MfgYear": 2019, "MfgMonth": 3,
    "MfgDate": D("2019-03-01"), "ItemType": "Part", "PrimaryConsequential": "Primary", "PrimaryPart": "pump", "JobSubType": "REPAIR",
    "JobCardStatus": "Closed", "CreatedOn": D("2020-01-01"), "Kilometers": 1000, "BillType": "WARRANTY", "City": "pune",
    "LineAmount": 1.0,
}


def cards(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}.get(n) for n in schemas.JOB_CARD_TABLE) for c in changes], DDL)


def number(i):
    return f"JC{i:014d}"


COMMON_BAD = [
    {"VehicleChassisNumber": "ME3U30000KA00000"}, {"VehicleChassisNumber": None}, {"JobCard": "JC1"}, {"ModelType": "NA"},
    {"Model": ""}, {"Model": "ROYAL"}, {"Model": None}, {"Plant": "NA"}, {"Country": "International"}, {"PartAction": "x"},
]


@pytest.mark.parametrize(
    "profile, good, bad",
    [
        ("relationship", {"PrimaryConsequential": "x Consequential", "ItemType": "Spare Part"}, [{"PrimaryPart": None}, {"PartNumber": None}, {"MfgYear": 1900}, {"PrimaryConsequential": "Primary"}, {"ItemType": "part"}]),
        ("unplanned", {}, [{"PartDescription": None}, {"MfgYear": 1900}, {"PrimaryConsequential": None}]),
        ("repeat", {}, [{"JobSubType": "PDI"}, {"JobSubType": None}, {"JobCardStatus": "Canceled"}, {"JobCardStatus": None}, {"ItemType": "Spare Part"}]),
        ("warranty", {}, [{"BillType": "PAID"}, {"MfgDate": D("2019-01-01")}, {"CreatedOn": D("2022-03-02")}]),
    ],
)
def test_quality_filter(spark, profile, good, bad):
    keep = quality.quality_filter(profile)
    assert cards(spark, good).filter(keep).count() == 1
    assert cards(spark, *[{**good, **b} for b in [*COMMON_BAD, *bad]]).filter(keep).count() == 0


def test_unknown_profile():
    with pytest.raises(ValueError):
        quality.quality_filter("none")


def test_repeat_issues_bounds_ties_and_exclude_list(spark, rows):
    def visit(i, day, km, part="A1"):
        return {"JobCard": number(i), "CreatedOn": D(day), "Kilometers": km, "PartNumber": part}

    facts = cards(
        spark,
        visit(1, "2020-01-01", 1000), visit(1, "2020-01-05", 1100),  # one job card and part counts once
        visit(2, "2020-04-01", 4000),  # 91 days, 3000 km
        visit(3, "2020-07-02", 4001),  # 92 days
        visit(4, "2020-07-03", 7002),  # 3001 km
        visit(5, "2020-07-03", 7002),  # same day and reading: ordered by job card
        visit(6, "2020-07-04", 6000),  # reading went back
        visit(7, "2020-01-02", 1001, "X9"), visit(8, "2020-01-03", 1002, "X9"),
    )
    exclude = spark.createDataFrame([("X9",), (None,)], "PartNo string")
    for hot_rows in (1000, 2):
        got = visits.repeat_issues(facts, exclude, "2021-01-01", hot_rows=hot_rows)
        assert rows(got, "JobCard", "PreviousJC", "RepeatedDaysDifference", "RepeatedKilometersDifference") == [
            (number(2), number(1), 91, 3000), (number(5), number(4), 0, 0)
        ]
    assert got.columns[-5:] == ["JCMonthNameYear", "JCMonthYear", "RunDate", "MfgMonthYear", "MfgMonthNameYear"]
    again = got.unionByName(got)
    assert rows(visits.repeat_vehicle_count(again), "RepeatCount") == [(4,)]


def test_latest_repeat(spark, rows):
    def visit(i, car, day, km):
        return {"JobCard": number(i), "VehicleChassisNumber": car, "CreatedOn": day and D(day), "Kilometers": km}

    facts = cards(
        spark,
        visit(1, "a", "2020-01-01", 10), visit(2, "a", "2020-02-01", 20), visit(3, "a", "2020-03-01", 5),  # back in km: passes
        visit(4, "b", "2020-01-01", 10),  # single
        visit(5, "c", "2020-01-01", 10), visit(6, "c", "2020-01-01", 20),  # both on the latest date
        visit(7, "d", "2020-01-01", 10), visit(8, "d", "2020-04-01", 20),  # 91 days
        visit(9, "e", None, 10), visit(10, "e", "2020-04-01", 20),
        visit(11, "f", "2020-01-01", None), visit(12, "f", "2020-01-02", 20),
    )
    assert rows(visits.latest_repeat(facts), "JobCard", "prev_job_card", "Days_Diff", "Km_Diff", "row_num") == [
        (number(3), number(2), 29, -15, 3), (number(6), number(5), 0, 10, 2)
    ]


def test_latest_repeat_needs_a_vehicle_and_a_part(spark):
    def visit(i, day, **keys):
        return {"JobCard": number(i), "CreatedOn": D(day), "Kilometers": i, **keys}

    facts = cards(
        spark,
        visit(1, "2020-01-01", VehicleChassisNumber=None), visit(2, "2020-01-02", VehicleChassisNumber=None),
        visit(3, "2020-01-01", VehicleChassisNumber="a", PartNumber=None), visit(4, "2020-01-02", VehicleChassisNumber="a", PartNumber=None),
    )
    assert visits.latest_repeat(facts).count() == 0


def test_relationship_tree(spark, rows):
    facts = cards(
        spark,
        {"PrimaryConsequential": "Consequential", "PrimaryPartNumber": "X9"},
        {"PrimaryConsequential": "Consequential", "PartNumber": "X9", "JobCard": number(2)},
        {"PrimaryConsequential": "Consequential", "JobCard": number(3)},
    )
    exclude = spark.createDataFrame([("X9",), ("X9",), (None,)], "PartNo string")
    assert rows(visits.relationship_tree(facts, exclude, "2021-01-01"), "JobCard") == [(number(1),), (number(3),)]
    assert rows(visits.relationship_tree(facts, exclude, "2021-01-01", exclude_primary=True), "JobCard") == [(number(3),)]


def production(spark, built, sold):
    ddl = "MfgDate date, ModelGroup string, VehicleChassisNumber string, VehicleAge bigint"
    return spark.createDataFrame(built, ddl), spark.createDataFrame(sold, ddl)


def test_maturity_markers(spark):
    month, other = D("2019-02-03"), D("2020-05-01")
    built = [(month, "UCE", f"c{i}", None) for i in range(20)] + [(other, "UCE", "x", None), (month, "NA", "n", None), (D("2018-12-31"), "UCE", "o", None)]
    sold = [(month, "UCE", f"c{i}", 40 if i else 400) for i in range(19)] + [(D("2021-01-01"), "UCE", "s", 10)]
    made, gone = production(spark, built, sold)
    got = {r.MfgMonthYear: r for r in maturity.maturity_markers(made, gone, "2021-06-30", eo_horizons={"EOFirstYear": 365}).collect()}
    assert set(got) == {"2019-02", "2020-05"}
    mature, empty = got["2019-02"], got["2020-05"]
    assert (mature.PCount, mature.SCount, mature.FF1Count, mature.FF12Count) == (20, 19, 19, 1)
    assert (mature.FF1Maturity, mature.FF3Maturity, mature.EOFirstYearMaturity, mature.FF1) == ("Matured", "NotMatured", "NotMatured", "(1) FF1")
    assert (empty.PCount, empty.SCount, empty.FF1Count, empty.FF1Maturity, empty.FF1) == (1, None, None, "NotMatured", None)


def test_duplicate_sales_count_once_only_on_request(spark):
    month = D("2019-02-03")
    made, gone = production(spark, [(month, "UCE", "a", None)], [(month, "UCE", "a", 40), (month, "UCE", "a", 10), (month, "UCE", "a", 50)])
    assert maturity.maturity_markers(made, gone, "2021-06-30").first().FF1Count == 2
    assert maturity.maturity_markers(made, gone, "2021-06-30", dedupe_sales=True).first().FF1Count == 1


def test_sales_maturity(spark):
    def months(counts):
        return spark.createDataFrame([(2020, m) for m, n in counts.items() for _ in range(n)], "Year int, Month int")

    got = maturity.sales_maturity(months({1: 10, 2: 10, 3: 10, 4: 1}), months({1: 9, 2: 10, 3: 8, 5: 1}))
    assert {r.Month: (r.SalesPercentage, r.M_NM) for r in got.collect()} == {
        1: (90.0, None), 2: (100.0, "Matured"), 3: (80.0, "Not Matured"), 4: (None, None), 5: (None, None)
    }


def test_refresh_and_changed_flags(spark, rows):
    flags = {"FF1Maturity": "FF1Maturity"}
    markers = spark.createDataFrame([("2020-01", "UCE", "Matured"), ("2020-02", "UCE", "NotMatured"), ("2020-03", "UCE", None)], "MfgMonthYear string, ModelGroup string, FF1Maturity string")
    facts = spark.createDataFrame(
        [("a", "2020-01", "UCE", "NotMatured"), ("b", "2020-02", "UCE", "Matured"), ("c", "2020-01", "TWINS", "Matured"), ("d", "2020-01", "UCE", None)],
        "id string, MfgMonthYear string, ModelType string, FF1Maturity string",
    )
    assert rows(maturity.refresh_maturity(facts, markers, flags), "id", "FF1Maturity") == [("a", "Matured"), ("b", "NotMatured"), ("c", "Matured"), ("d", "Matured")]
    assert rows(maturity.refresh_maturity(facts, markers, flags, only_promote=True), "id", "FF1Maturity") == [("a", "Matured"), ("b", "Matured"), ("c", "Matured"), ("d", None)]
    old = markers.withColumn("FF1Maturity", F.lit("NotMatured"))
    assert rows(maturity.changed_flags(old, markers), "MfgMonthYear", "FF1Maturity") == [("2020-01", "Matured"), ("2020-03", None)]


def test_warranty_cost(spark):
    markers = spark.createDataFrame([("2019-03", "UCE", "Matured", "NotMatured", "NotMatured")], "MfgMonthYear string, ModelGroup string, EOFirstYearMaturity string, EOSecondYearMaturity string, EOThirdYearMaturity string")
    facts = cards(spark, {}, {"JobCard": number(2), "CreatedOn": D("2021-03-01")}, {"JobCard": number(3), "ModelType": "TWINS"})
    got = {r.JobCard: r for r in cost.warranty_cost(facts, markers, "2022-01-01").collect()}
    first, second, third = (got[number(i)] for i in (1, 2, 3))
    assert (first.FirstYearBucket, first.SecondYearBucket, first.ThirdYearBucket) == ("first_year", "second_year", "third_year")
    assert (second.FirstYearBucket, second.SecondYearBucket, second.ThirdYearBucket) == ("NA", "second_year", "third_year")
    assert (first.FirstYearMaturity, third.FirstYearMaturity, first.City, first.MfgMonthNameYear) == ("Matured", None, "PUNE", "Mar-2019")


def test_part_failure_rate(spark):
    data = [("Jan-2020", "2020-01", "ff data", "j1", "a"), ("Jan-2020", "2020-01", "ff data", None, "a"), ("Jan-2020", "2020-01", "dms sales data", None, "a"),
            ("Jan-2020", "2020-01", "dms sales data", None, "a"), ("Feb-2020", "2020-02", "ff data", "j2", "b")]
    facts = spark.createDataFrame(data, "MfgMonthNameYear string, MfgMonthYear string, DMart string, JobCard string, VehicleChassisNumber string")
    got = {r.MfgMonthYear: (r.Numerator, r.Denominator, r.part_failure) for r in cost.part_failure_rate(facts).collect()}
    assert got == {"2020-01": (1, 2, 50.0), "2020-02": (1, 1, 100.0)}


def test_label_quality_and_rule_counts(spark, rows):
    facts = cards(
        spark, {"PrimaryConsequential": "Consequential"},
        {"PrimaryConsequential": "Consequential", "JobCard": "x", "ModelType": "NA", "PartNumber": None},
        {"PrimaryConsequential": "Consequential", "VehicleChassisNumber": None},
    )
    rules = quality.relationship_rules()
    labelled = quality.label_quality(quality.relationship_scope(facts), rules)
    assert rows(labelled, "comments", "data_quality") == [
        ("ModelType is Null,JobCard length not 16,PartNumber is Null", "bad data"), (None, "good data"), (None, "good data")
    ]
    counts = {r.Rule: r.Records for r in quality.rule_counts(facts, rules).collect()}
    assert counts == {"ModelType is Null": 1, "Plant is Null": 0, "PrimaryPart is Null": 0, "JobCard length not 16": 1,
                      "VehicleChassisNumber length not 17": 0, "PartNumber is Null": 1, "PartDescription is Null": 0}


def test_duplicates(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    assert rows(quality.duplicate_keys(df, ["k"])) == [("a", 2), (None, 2)]
    extra = quality.duplicate_rows(df, ["k"])
    assert rows(extra) == [("a", 2), (None, 1)]
    assert extra.count() + df.select("k").distinct().count() == df.count()
    assert quality.is_unique(df, "k").first() == (5, 2, 2, False)
    assert rows(quality.row_multiplicity(df)) == [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)]
    assert (None, 1, 2) in rows(quality.row_multiplicity(df, keep_nulls=True))


def test_missing_parts(spark, rows):
    parts = spark.createDataFrame([("A1", "UCE")], "PartNumber string, ModelType string")
    facts = cards(spark, {}, {"PartNumber": "B2"}, {"PartNumber": "B2"}, {"PartNumber": None}, {"ModelType": "TWINS"})
    assert rows(quality.missing_parts(facts, parts)) == [("A1", "TWINS"), ("B2", "UCE")]
    grouped = facts.withColumn("PartGroup", F.when(F.col("ModelType") == "UCE", "g"))
    assert rows(quality.parts_without_group(grouped)) == [("A1", "TWINS")]


def test_delta_counts_and_completeness(spark, rows):
    days = spark.createDataFrame([(D("2022-01-01"),), (D("2022-01-03"),), (D("2022-01-03"),)], "RunDate date")
    counts = quality.delta_counts({"a": (days, "RunDate"), "b": (days.limit(0), "RunDate")}, "2022-01-03")
    assert rows(counts) == [("a", 2), ("b", 0)]
    assert rows(quality.feed_completeness(days, "2022-01-01", "2022-01-04")) == [(D("2022-01-02"),), (D("2022-01-04"),)]


def test_roadside_labels(spark, rows):
    df = spark.createDataFrame([("engine stuck", "Flat-bed Tow"), ("tyre", None)], "TypeofIncident string, ServiceProvided string")
    assert rows(cost.roadside_labels(df)) == [("ENGINE RELATED", "TOWING"), ("TYRE", None)]


def test_feed_completeness_reads_the_days_of_the_period_only(spark, tmp_path):
    days = spark.createDataFrame([(D("2020-01-01"),), (D("2020-01-03"),), (D("2021-01-01"),)], "RunDate date").withColumn("x", F.lit(1))
    days.write.partitionBy("RunDate").parquet(str(tmp_path / "t"))
    missing = quality.feed_completeness(spark.read.parquet(str(tmp_path / "t")), "2020-01-01", "2020-01-03")
    assert [r.RunDate for r in missing.collect()] == [D("2020-01-02")]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(RunDate" in plan and "(RunDate" in plan.split("PartitionFilters:")[1].split("]")[0].replace("isnotnull(RunDate", "")
