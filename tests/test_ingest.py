"""Feeds from files to tables."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.operators import ingest, skew, visits
from wrenchlake.operators.repeat_days import StaleDayError
from wrenchlake.plans import daily
from wrenchlake.sources import counts, feeds, tables
from wrenchlake.streaming.landing import BATCH, ChangedFileError, load_new_files

D = dt.date.fromisoformat
NAMES = [c.split()[0] for c in schemas.JOB_CARDS.ddl.replace("\n", " ").split(",")]


def card_line(**values):
    return ",".join(values.get(n, "") for n in NAMES)


def write_cards(path, *lines, encoding="utf-8"):
    path.write_text("\n".join([",".join(f"raw {i}" for i in range(len(NAMES))), *lines]) + "\n", encoding=encoding)
    return str(path)


CARD = {
    "JobCard": "JC00000000000001", "PartNumber": "A1", "LineAmount": "12.5", "PartDescription": "\"filter, ölig\"",
    "ItemType": "Spare Part", "PrimaryConsequential": "Primary", "PrimaryPart": "pump RJC 9", "PrimaryPartNumber": "B2",
    "CreatedOnDateTime": "2022-06-10 12:33:00", "VehicleChassisNumber": "me3u30000ka000001", "JobSubType": "REPAIR",
    "Kilometers": "900", "City": "ignored", "DateofSale": "2022-01-01 00:00:00", "Product": "Classic 350",
    "DealerCode": "D1", "ModelID": "M", "CustomerComplaint": "\"two\nlines\"",
}


def masters(spark):
    sheet = spark.createDataFrame(
        [("A1", "filter", "oil", "v", "c"), ("A1", "another", "air", "v", "c"), ("B2", "pump", "fuel", "v", "c"), (None, "x", "x", "x", "x")],
        schemas.PART_SHEET.ddl,
    )
    twins = spark.createDataFrame([("A1", "twin filter", "twin", "v", "c")], schemas.PART_SHEET.ddl)
    parts = ingest.build_part_master([sheet, sheet.limit(0), twins])
    dealers = spark.createDataFrame([("D1", "pune"), ("D1", "delhi"), (None, "x")], schemas.DEALERS.ddl)
    return parts, dealers


def test_part_master(spark, rows):
    parts, _ = masters(spark)
    assert rows(parts, "PartNumber", "PartName", "PartGroup", "ModelType") == [
        ("A1", "ANOTHER", "AIR", "HIMALAYAN"), ("A1", "ANOTHER", "AIR", "UCE"), ("A1", "TWIN FILTER", "TWIN", "TWINS"),
        ("B2", "PUMP", "FUEL", "HIMALAYAN"), ("B2", "PUMP", "FUEL", "UCE"),
    ]


def test_job_cards_from_file_to_table(spark, tmp_path):
    parts, dealers = masters(spark)
    files = write_cards(tmp_path / "cards.csv", card_line(**CARD), card_line(**{**CARD, "JobCard": "JC00000000000002", "Kilometers": "", "PrimaryPart": ""}))
    table = str(tmp_path / "cards")
    for _ in range(2):  # The second run of the day must not double its rows.
        daily.load_job_cards(spark, files, parts, dealers, table, "2022-06-11")
    daily.load_job_cards(spark, files, parts, dealers, table, "2022-06-12")
    cards = tables.read_table(spark, table)
    assert cards.count() == 4
    assert set(cards.columns) == {*schemas.JOB_CARD_TABLE, "RunDate"}
    first, second = tables.latest_delta(cards, "2022-06-11").orderBy("JobCard").collect()
    assert (first.Model, first.ModelType, first.ModelName, first.Plant) == ("CLASSIC", "UCE", "CLASSIC 350", "TVT")
    assert (first.PartGroup, first.PrimaryPartGroup, first.City) == ("AIR", "FUEL", "DELHI")
    assert (first.CreatedOn, first.CreatedOnYear, first.CreatedOnMonth) == (D("2022-06-10"), 2022, 6)
    assert (first.Kilometers, first.KmsGroup) == (900, "(B) 500 - 3000")
    assert (first.PartFilter, first.PrimaryPartNew, first.PrimaryPartFilter) == ("filter, lig", "pump ", "pump ")
    assert first.CustomerComplaint == "two\nlines"
    assert (second.Kilometers, second.KmsGroup, second.PrimaryPart, second.PrimaryPartNew) == (-1, "NA", None, None)
    assert tables.as_of(cards, "2022-06-11").count() == 2


def test_legacy_dedupe_matches_one_model_type_only(spark):
    parts, _ = masters(spark)
    facts = spark.createDataFrame([("UCE", "A1", None), ("TWINS", "A1", None)], "ModelType string, PartNumber string, PrimaryPartNumber string")
    both = ingest.add_part_groups(facts, parts)
    legacy = ingest.add_part_groups(facts, parts, legacy_dedupe=True)
    assert {r.ModelType: r.PartGroup for r in both.collect()} == {"UCE": "AIR", "TWINS": "TWIN"}
    assert {r.ModelType: r.PartGroup for r in legacy.collect()} == {"UCE": None, "TWINS": "TWIN"}


def test_feed_options(spark, tmp_path):
    path = tmp_path / "ignore.csv"
    path.write_text("a,b,c\nP1,caf\xe9,Yes\nP2,tea,No\n", encoding="ISO-8859-1")
    read = feeds.read_feed(spark, str(path), "ignore_list", encoding=feeds.FALLBACK_ENCODING)
    assert read.first()["Part Description"] == "café"
    assert ingest.ignore_list(read).collect()[0].PartNo == "P1"
    pruned = feeds.read_feed(spark, str(path), "ignore_list", columns=["Part No", "Repeat/Repair Service"])
    assert pruned.columns == ["Part No", "Repeat/Repair Service"]
    sales = tmp_path / "sales.csv"
    sales.write_text("h\n,,,10/06/2022 12:05,,,,,,,,,\n")
    dated = feeds.read_feed(spark, str(sales), "sales", date_format="dd/MM/yyyy HH:mm")
    assert dated.first().SalesOrderDate == dt.datetime(2022, 6, 10, 12, 5)
    own = schemas.Feed("name string, value string")
    plain = tmp_path / "plain.csv"
    plain.write_text("x,1\n,2\n")
    assert [tuple(r) for r in feeds.read_feed(spark, str(plain), own, header=False).collect()] == [("x", "1"), (None, "2")]


def test_date_format(spark, tmp_path):
    path = tmp_path / "days.csv"
    path.write_text("d\n10/06/2022\n")
    read = feeds.read_feed(spark, str(path), schemas.Feed("d date"), date_format="dd/MM/yyyy")
    assert read.first().d == D("2022-06-10")


def test_cities(spark, tmp_path):
    path = tmp_path / "cities.txt"
    path.write_text("Pune,\n Delhi , \nPune,\nAgra\n")
    assert sorted(r.City for r in feeds.read_cities(spark, str(path)).collect()) == ["Agra", "Delhi", "Pune"]


def test_landing_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    line = ",,dealer,2022-06-10 00:00:00,D1,M,F,Classic 350,ME3U30000KA000001,Z,R,S,C\n"
    (landing / "a.csv").write_text("h\n" + line)
    args = str(landing), "sales"
    for day, expected in (("2022-06-11", 1), ("2022-06-12", 1), ("2022-06-13", 3)):
        if day == "2022-06-13":
            (landing / "b.csv").write_text("h\n" + line + line)
        load_new_files(spark, *args, lambda raw, d=day: ingest.ingest_sales(raw, d), str(tmp_path / "t"), str(tmp_path / "cp"))
        assert tables.read_table(spark, str(tmp_path / "t")).count() == expected


def test_daily_flows(spark, tmp_path, rows):
    parts, dealers = masters(spark)
    card = {**CARD, "PrimaryConsequential": "Primary & Consequential"}
    service = {**card, "JobCard": "JC00000000000003", "PartNumber": "S1"}
    files = write_cards(
        tmp_path / "cards.csv", card_line(**card), card_line(**service), card_line(**{**service, "PartNumber": "A1"}),
        card_line(**{**card, "JobCard": "JC00000000000004", "PartNumber": "X9"}),
    )
    cards, out = str(tmp_path / "cards"), str(tmp_path / "out")
    daily.load_job_cards(spark, files, parts, dealers, cards, "2022-06-11")
    exclude = spark.createDataFrame([("X9",), (None,)], "PartNo string")
    codes = ingest.labour_codes(spark.createDataFrame([("S1", "service"), (None, "x")], schemas.LABOUR_CODES.ddl))
    later = write_cards(tmp_path / "later.csv", card_line(**{**card, "JobCard": "JC00000000000005"}))
    daily.load_job_cards(spark, later, parts, dealers, cards, "2022-06-12")
    first, second = "2022-06-11", "2022-06-12"
    for day in (first, second, second):
        daily.append_relationship(spark, cards, exclude, f"{out}/relationship", day)
    assert rows(tables.read_table(spark, f"{out}/relationship"), "JobCard", "PartNumber", "RunDate") == [
        ("JC00000000000001", "A1", D(first)), ("JC00000000000003", "A1", D(first)), ("JC00000000000003", "S1", D(first)),
        ("JC00000000000005", "A1", D(second)),
    ]
    for _ in range(2):
        daily.append_unplanned(spark, cards, exclude, codes, f"{out}/unplanned", f"{out}/share", first)
    unplanned = tables.read_table(spark, f"{out}/unplanned")
    assert rows(unplanned, "JobCard", "ServiceSchedule", "VehicleAge", "DaysDifference") == [
        ("JC00000000000001", "Between Service-1 & Service-2", "(B) 3 - 12 Months", 160)
    ]
    share = tables.read_table(spark, f"{out}/share").groupBy("DMart").count()
    assert rows(share) == [("dms raw table", 4), ("unplanned table", 1)]
    quoted = "\"[{'Part No': 'A1', 'Part Description': 'filter'}]\""
    (tmp_path / "changes.csv").write_text(f"h\n{quoted},DC,\"['M']\",2018-01-01,TVT,mod,2018-01-01,why\n")
    daily.load_changes(spark, str(tmp_path / "changes.csv"), f"{out}/changes")
    for day, of_the_day, in_all in ((first, 2, 2), (second, 1, 3), (second, 1, 3)):
        daily.append_trigger_cutoff(spark, cards, f"{out}/changes", f"{out}/trigger", f"{out}/report", day)
        assert spark.read.option("header", True).csv(f"{out}/report/details").count() == of_the_day
        assert spark.read.option("header", True).csv(f"{out}/report/summary").first().ReportedIssues == str(in_all)
    assert tables.read_table(spark, f"{out}/trigger").count() == 3
    with pytest.raises(StaleDayError):
        daily.append_trigger_cutoff(spark, cards, f"{out}/changes", f"{out}/trigger", f"{out}/report", first)
    (tmp_path / "approvals.csv").write_text("h\n\"['A1']\",\"['M']\",2018-01-01,N1,t,t,t,TVT,p,q\n")
    daily.load_approvals(spark, str(tmp_path / "approvals.csv"), f"{out}/parsed")
    for day in (first, second):
        daily.append_approvals(spark, cards, f"{out}/parsed", f"{out}/approvals", day)
    assert rows(tables.read_table(spark, f"{out}/approvals").groupBy("RunDate").count()) == [(D(first), 2), (D(second), 1)]
    for day in (first, second):
        daily.append_repeats(spark, cards, exclude, f"{out}/repeats", day)
    assert "PreviousJC" in tables.read_table(spark, f"{out}/repeats/repeats").columns
    with pytest.raises(StaleDayError):
        daily.append_repeats(spark, cards, exclude, f"{out}/repeats", first)
    daily.report_deltas(spark, {"cards": cards}, f"{out}/deltas", second)
    assert spark.read.option("header", True).csv(f"{out}/deltas/delta").first().DeltaRecords == "1"


def test_write_day_replaces_exactly_one_day(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = spark.createDataFrame([(1, D("2022-01-01")), (2, D("2022-01-02"))], "x int, RunDate date")
    tables.write_append(whole, path)
    tables.write_day(whole.filter("x < 0"), path, "2022-01-01")
    assert [r.x for r in tables.read_table(spark, path).collect()] == [2]
    with pytest.raises(Exception, match="another run day"):
        tables.write_day(whole, path, "2022-01-01")
    assert tables.as_of(tables.read_table(spark, path), "2022-01-01").count() == 0


def test_as_of_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_append(spark.createDataFrame([(1, D("2022-01-01")), (2, D("2022-01-02"))], "x int, RunDate date"), path)
    plan = tables.as_of(tables.read_table(spark, path), "2022-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(RunDate" in plan and "<= 2022-01-01" in plan


def test_values_that_cannot_be_read(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('h,h,h\n"1,234.5",900,2022-06-10 12:00:00\n2.5,900 km,2022-06-10 12:00:00\n3.5,7,10-06-2022 12:00\n4.5,8,2022-06-11 12:00:00\n')
    feed = schemas.Feed("amount double, kms bigint, at timestamp_ntz")
    with pytest.raises(Exception):
        feeds.read_feed(spark, str(path), feed).collect()
    kept = feeds.read_feed(spark, str(path), feed, keep_unreadable=True)
    assert [r[feeds.UNREADABLE] is not None for r in kept.collect()] == [True, True, True, False]
    assert tuple(feeds.unreadable_lines(kept).first()) == (4, 3)
    assert feeds.read_feed(spark, str(path), feed, columns=["kms"], keep_unreadable=True).columns == ["kms", feeds.UNREADABLE]


def test_landing_and_batch_share_a_table(spark, tmp_path):
    landing, table, checkpoint = tmp_path / "landing", str(tmp_path / "t"), str(tmp_path / "cp")
    landing.mkdir()
    line = ",,dealer,2022-06-10 00:00:00,D1,M,F,Classic 350,ME3U30000KA000001,Z,R,S,C\n"

    def load(day):
        load_new_files(spark, str(landing), "sales", lambda raw: ingest.ingest_sales(raw, day), table, checkpoint)

    def daily_load(day):
        batch = ingest.ingest_sales(feeds.read_feed(spark, str(landing / "a 1.csv"), "sales"), day).withColumn(BATCH, F.lit("daily"))
        tables.write_day(batch, table, day, within=(BATCH,))

    (landing / "a 1.csv").write_text("h\n" + line)
    load("2022-06-11")
    daily_load("2022-06-12")
    (landing / "b.csv").write_text("h\n" + line + line)
    load("2022-06-13")
    assert sorted(r.RunDate.day for r in tables.read_table(spark, table).collect()) == [11, 12, 13, 13]
    (landing / "a 1.csv").write_text("h\n" + line * 5)
    with pytest.raises(ChangedFileError, match="a%201.csv"):
        load("2022-06-14")
    daily_load("2022-06-11")
    assert tables.latest_delta(tables.read_table(spark, table), "2022-06-11").count() == 5


def test_a_landed_batch_that_fails_runs_again_as_a_whole(spark, tmp_path):
    """The first attempt writes its rows and dies before the batch counts as done; the second replaces them."""
    landing, table, checkpoint = tmp_path / "landing", str(tmp_path / "t"), str(tmp_path / "cp")
    landing.mkdir()
    line = ",,dealer,2022-06-10 00:00:00,D1,M,F,Classic 350,ME3U30000KA000001,Z,R,S,C\n"
    (landing / "a.csv").write_text("h\n" + line * 3)

    def load():
        load_new_files(spark, str(landing), "sales", lambda raw: ingest.ingest_sales(raw, "2022-06-11"), table, checkpoint)

    load()
    shutil.rmtree(tmp_path / "cp" / "commits")  # as if the run had been killed after the write
    load()
    assert tables.read_table(spark, table).count() == 3


def orders(spark, *days):
    return spark.createDataFrame([(k, D(day)) for k, day in enumerate(days)], "x int, RunDate date")


def test_a_failed_day_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_append(orders(spark, "2022-01-01", "2022-01-02"), path)
    with pytest.raises(Exception, match="another run day"):
        tables.write_day(orders(spark, "2022-01-01", "2022-01-02", "2022-01-01"), path, "2022-01-01")
    with pytest.raises(Exception, match="another run day: none"):
        tables.write_day(orders(spark, "2022-01-01").withColumn("RunDate", F.lit(None).cast("date")), path, "2022-01-01")
    assert sorted(r.x for r in tables.read_table(spark, path).collect()) == [0, 1]
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == ["RunDate=2022-01-01", "RunDate=2022-01-02", "_SUCCESS"]
    # A day may be made from itself.
    own = tables.latest_delta(tables.read_table(spark, path), "2022-01-02")
    tables.write_day(own.withColumn("x", F.col("x") + 10), path, "2022-01-02")
    assert sorted(r.x for r in tables.read_table(spark, path).collect()) == [0, 11]


@pytest.mark.parametrize("old_is_gone", [False, True])
def test_a_swap_that_was_cut_short_is_finished(spark, tmp_path, monkeypatch, old_is_gone):
    path = str(tmp_path / "t")
    tables.write_append(orders(spark, "2022-01-01", "2022-01-02"), path)
    finish = tables.finish_swaps
    monkeypatch.setattr(tables, "finish_swaps", lambda *_: None)  # the run dies when the new day is complete
    tables.write_day(orders(spark, "2022-01-01", "2022-01-01"), path, "2022-01-01")
    monkeypatch.setattr(tables, "finish_swaps", finish)
    assert tables.read_table(spark, path).count() == 2
    if old_is_gone:
        shutil.rmtree(tmp_path / "t" / "RunDate=2022-01-01")
    tables.write_day(orders(spark, "2022-01-03"), path, "2022-01-03")
    assert sorted(r.RunDate.day for r in tables.read_table(spark, path).collect()) == [1, 1, 2, 3]
    assert tables.run_days(spark, path) == ["2022-01-01", "2022-01-02", "2022-01-03"]


def test_partitions_are_replaced_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "2020-01"), (2, "a b:c"), (3, None), (4, "2020-02")], "x int, month string")
    rows.write.partitionBy("month").parquet(path)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "month=2020-02").iterdir()}
    now = tables.read_partitioned(spark, path, "month")
    tables.replace_partitions(now.filter("x in (2, 3)").withColumn("x", F.col("x") * 10), path, "month", ["2020-01", "a b:c", None])
    got = sorted((r.x, r.month) for r in tables.read_partitioned(spark, path, "month").collect())
    assert got == [(4, "2020-02"), (20, "a b:c"), (30, None)]
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "month=2020-02").iterdir()}
    with pytest.raises(Exception, match="another partition"):
        tables.replace_partitions(rows, path, "month", ["2020-01"])


def test_ordered_report(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = spark.range(5000).select((F.col("id") % 7 == 0).alias("hot"), (F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("t"))
    rows = rows.withColumn("key", F.when(F.col("hot"), 0).otherwise(F.col("n"))).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_ordered(rows, path, [F.col("key").desc()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "report").glob("part-*"))) > 1
    got = [(r.key, r.hot, r.n) for r in tables.read_ordered(spark, path).orderBy("place").collect()]
    assert got == sorted(((r.key, r.hot, r.n) for r in rows.collect()), key=lambda r: (-r[0], r[1], r[2]))
    assert sorted(r.place for r in tables.read_ordered(spark, path).collect()) == list(range(1, 5001))


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_append(orders(spark, "2022-01-01", "2022-01-02", "2022-01-02", "2022-01-05"), path)
    tables.write_day(orders(spark, "2022-01-05").filter("x < 0"), path, "2022-01-05")
    with counts.footer_counts(spark):
        plan = counts.counted_by(spark, path, "RunDate")._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [RunDate]" in plan
    found = {r.RunDate.day: r.Records for r in counts.rows_by_partition(spark, path).collect()}
    assert {day: n for day, n in found.items() if n} == {1: 1, 2: 2}
    assert sorted(r.RunDate.day for r in counts.missing_days(spark, path, "2022-01-01", "2022-01-05").collect()) == [3, 4, 5]
    assert [tuple(r) for r in counts.delta_counts_of(spark, {"t": path, "u": path}, "2022-01-02").collect()] == [("t", 2), ("u", 2)]
    assert counts.delta_counts_of(spark, {"t": path}, "2023-01-02").first().DeltaRecords == 0
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_rewrite_and_catalog_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_append(spark.range(10).withColumn("RunDate", F.lit("2022-01-01").cast("date")), path)
    promoted = tables.read_table(spark, path).withColumn("id", F.col("id") * 2)
    tables.rewrite(promoted, path, str(tmp_path / "staging"), "RunDate")
    assert tables.read_table(spark, path).agg(F.sum("id")).first()[0] == 90
    for rows in (5, 7):
        tables.create_table(spark.range(rows), "made_here", str(tmp_path / "made"))
    assert spark.table("made_here").count() == 7
    spark.sql("DROP TABLE made_here")


def test_unplanned_reads_one_partition(spark, tmp_path):
    parts, dealers = masters(spark)
    files = write_cards(tmp_path / "cards.csv", card_line(**CARD))
    table = str(tmp_path / "cards")
    for day in ("2022-06-11", "2022-06-12"):
        daily.load_job_cards(spark, files, parts, dealers, table, day)
    listed = spark.createDataFrame([("X",)], "PartNo string")
    codes = spark.createDataFrame([("Y",)], "LaborCode string")
    visited = visits.unplanned_visits(tables.read_table(spark, table), listed, codes, "2022-06-12")
    plan = visited._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(RunDate" in plan
    assert visited.count() == 1


def test_windows_of_a_change_list_are_worked_out_once(spark, tmp_path, monkeypatch, rows):
    quoted = "\"[{'Part No': 'A1', 'Part Description': 'one'}, {'Part No': 'A1', 'Part Description': 'two'}]\""
    (tmp_path / "changes.csv").write_text(f"h\n{quoted},DC,\"['M']\",2018-01-01,TVT,mod,2018-01-01,why\n")
    daily.load_changes(spark, str(tmp_path / "changes.csv"), f"{tmp_path}/changes")
    windows = tables.read_table(spark, f"{tmp_path}/changes-windows")
    assert rows(windows, "_part_no", "_from", "_to", "_part_text", "_stamp_Plant") == [("A1", D("2018-01-01"), None, "one", "TVT")]
    facts = {c: "x" for c in schemas.CHANGE_FACT_COLUMNS} | {
        "PartNumber": "A1", "ModelID": "M", "CreatedOn": D("2022-06-11"), "MfgDate": D("2020-01-01"), "RunDate": D("2022-06-11"),
    }
    ddl = ", ".join(f"{c} {'date' if c in ('CreatedOn', 'MfgDate', 'RunDate') else 'string'}" for c in facts)
    spark.createDataFrame([tuple(facts.values())], ddl).write.partitionBy("RunDate").parquet(f"{tmp_path}/cards")

    def again(*_):
        raise AssertionError("windows worked out on a run day")

    monkeypatch.setattr(daily.trigger, "change_windows", again)
    daily.append_trigger_cutoff(spark, f"{tmp_path}/cards", f"{tmp_path}/changes", f"{tmp_path}/out", f"{tmp_path}/report", "2022-06-11")
    assert rows(tables.read_table(spark, f"{tmp_path}/out"), "JobCard", "PartDescription") == [("x", "one")]


def test_a_large_part_master_is_hashed_and_the_cards_are_not_sorted(spark, monkeypatch, rows):
    """With a part master too large to broadcast, no job card is sorted for it, and the rows are those of the broadcast."""
    parts = [("A1", "UCE", "g1", "v1", "c1"), ("A1", "UCE", "g0", "v2", "c2"), ("B2", "UCE", "g2", None, "c3"), ("A1", "TWINS", None, "v4", "c4"), (None, "UCE", "g5", "v5", "c5")]
    master = spark.createDataFrame(parts, "PartNumber string, ModelType string, PartGroup string, PartVariant string, PartCategory string")
    cards = [(n, m, p, q) for n in (1, 1, 2) for m in ("UCE", "TWINS", "NA", None) for p in ("A1", "B2", "X", None) for q in ("B2", "A1", None)]
    facts = spark.createDataFrame(cards, "JobCard int, ModelType string, PartNumber string, PrimaryPartNumber string")
    small = rows(ingest.add_part_groups(facts, master))
    monkeypatch.setattr(ingest, "bounded_or_hashed", lambda df: skew.bounded_or_hashed(df, 0), raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = ingest.add_part_groups(facts, master)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
        assert rows(met) == small and len(small) == len(cards)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
