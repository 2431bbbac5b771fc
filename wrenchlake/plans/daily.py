"""The daily and monthly flows: feed files to tables, and tables to use-case tables.

Each flow reads tables by path, runs one operator on the rows of its run day
(or on the whole history where the operator needs it) and writes one table, so
the use cases never re-run the ingestion and a flow that runs again replaces
what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.functions import dates
from wrenchlake.operators import cost, ingest, maturity, quality, trigger, visits
from wrenchlake.operators.repeat_days import StaleDayError, update_repeats
from wrenchlake.schemas import RUN_DATE
from wrenchlake.sources import counts, feeds, tables


def _cards_of(spark: SparkSession, job_cards: str, asof, run_date: str) -> DataFrame:
    return tables.latest_delta(tables.read_table(spark, job_cards), asof, run_date)


def load_job_cards(
    spark: SparkSession, files: str | list[str], parts: DataFrame, dealers: DataFrame, table: str, asof,
    run_date: str = RUN_DATE, date_format: str | None = None,
) -> None:
    """One day's job-card files into the job-card table; running it again replaces the day."""
    raw = feeds.read_feed(spark, files, "job_cards", date_format=date_format)
    tables.write_day(ingest.ingest_job_cards(raw, parts, dealers, asof, run_date), table, asof, run_date)


def load_sales(spark: SparkSession, files: str | list[str], table: str, asof, run_date: str = RUN_DATE) -> None:
    """One day's sales files into the sales table."""
    raw = feeds.read_feed(spark, files, "sales")
    tables.write_day(ingest.ingest_sales(raw, asof, run_date), table, asof, run_date)


def append_relationship(
    spark: SparkSession, job_cards: str, exclude: DataFrame, table: str, asof, run_date: str = RUN_DATE
) -> None:
    """The run day's consequential-part rows into the relationship table."""
    cards = _cards_of(spark, job_cards, asof, run_date)
    tables.write_day(visits.relationship_tree(cards, exclude, asof, run_date=run_date), table, asof, run_date)


def append_unplanned(
    spark: SparkSession, job_cards: str, ignored: DataFrame, service_codes: DataFrame, table: str, share_table: str, asof,
    run_date: str = RUN_DATE,
) -> None:
    """The run day's unplanned visits, and the same rows with their denominator."""
    cards = tables.read_table(spark, job_cards)
    visited = visits.unplanned_visits(cards, ignored, service_codes, asof, run_date)
    tables.write_day(visited, table, asof, run_date)
    unplanned = tables.latest_delta(tables.read_table(spark, table, schema=visited.schema), asof, run_date)
    tables.write_day(visits.unplanned_share(unplanned, cards, asof, run_date), share_table, asof, run_date)


def load_changes(spark: SparkSession, files: str | list[str], table: str, strict: bool = True) -> None:
    """The engineering changes of the files into a table, their lists parsed, and their windows into ``<table>-windows``."""
    parsed = trigger.parse_engineering_changes(feeds.read_feed(spark, files, "engineering_changes"), strict)
    _write_changes(parsed, trigger.ENGINEERING, table)


def load_approvals(spark: SparkSession, files: str | list[str], table: str, strict: bool = True) -> None:
    """The part approvals of the files into a table, their lists parsed, and their windows into ``<table>-windows``."""
    parsed = trigger.parse_part_approvals(feeds.read_feed(spark, files, "part_approvals"), strict)
    _write_changes(parsed, trigger.APPROVAL, table)


def _write_changes(parsed: DataFrame, kind: trigger.ChangeKind, table: str) -> None:
    # Windows depend on the list alone, so they are worked out once and not on every run day.
    tables.write_replace(trigger.stamped_windows(parsed, kind), f"{table}-windows")
    tables.write_replace(parsed, table)


def _failures_of(
    spark: SparkSession, job_cards: str, changes: str, kind: trigger.ChangeKind, asof, run_date: str
) -> DataFrame:
    """The run day's failures after the changes, whose windows were written when the list was loaded."""
    windows = tables.read_table(spark, f"{changes}-windows")
    return trigger.trigger_cutoff(_cards_of(spark, job_cards, asof, run_date), None, kind, asof, run_date=run_date, windows=windows)


def append_trigger_cutoff(
    spark: SparkSession, job_cards: str, changes: str, table: str, report: str, asof: str, run_date: str = RUN_DATE
) -> None:
    """The run day's failures after part changes; the report has them in detail and sums up all days.

    ``changes`` is the table of ``load_changes``, beside which its windows lie. The sums are kept beside the
    table: ``<table>-totals`` per part and date, and the job cards that count in
    them in ``<table>-issues``. A run adds its own day to the totals of the day
    before. A day that later ones rest on is refused.
    """
    totals, issues = f"{table}-totals", f"{table}-issues"
    done = tables.run_days(spark, totals, run_date)
    if any(d > asof for d in done):
        raise StaleDayError(f"{asof} lies before {max(done)}, which rests on it")
    before = [d for d in done if d < asof]
    rows = _failures_of(spark, job_cards, changes, trigger.ENGINEERING, asof, run_date)
    tables.write_day(rows, table, asof, run_date)
    details = tables.latest_delta(tables.read_table(spark, table, schema=rows.schema), asof, run_date)
    keys = details.select("PartNumber", "EffectiveDate", "JobCard")
    known = tables.read_table(spark, issues, schema=keys.withColumn(run_date, dates.day(asof)).schema) if before else keys.withColumn(run_date, dates.day(asof))
    fresh = trigger.new_issues(keys, known.filter(F.col(run_date) < dates.day(asof)))
    tables.write_day(fresh.withColumn(run_date, dates.day(asof)), issues, asof, run_date)
    added = tables.latest_delta(tables.read_table(spark, issues), asof, run_date)
    none = trigger.folded_summary(details.limit(0).withColumn("ReportedIssues", F.lit(0).cast("bigint")), details.limit(0), added.limit(0))
    so_far = tables.latest_delta(tables.read_table(spark, totals), before[-1], run_date) if before else none
    summed = trigger.folded_summary(so_far, details, added).withColumn(run_date, dates.day(asof))
    tables.write_day(summed, totals, asof, run_date)
    if before:
        tables.drop_days(spark, totals, before[-1], run_date)
    current = tables.latest_delta(tables.read_table(spark, totals), asof, run_date).drop(run_date)
    tables.write_report({"summary": trigger.latest_changes(current), "details": details}, report)


def append_approvals(
    spark: SparkSession, job_cards: str, approvals: str, table: str, asof, run_date: str = RUN_DATE
) -> None:
    """The run day's failures after approved part changes; ``approvals`` is the table of ``load_approvals``."""
    rows = _failures_of(spark, job_cards, approvals, trigger.APPROVAL, asof, run_date)
    tables.write_day(rows, table, asof, run_date)


def append_repeats(
    spark: SparkSession, job_cards: str, exclude: DataFrame, folder: str, asof: str, since: str | None = None, run_date: str = RUN_DATE
) -> None:
    """The run day's job cards into the repeat-issue tables; ``since`` takes in all days from that one on."""
    cards = tables.read_table(spark, job_cards)
    first = asof if since is None else since
    update_repeats(spark, cards.filter(F.col(run_date).between(dates.day(first), dates.day(asof))), exclude, folder, asof, run_date)


def rebuild_markers(spark: SparkSession, production: str, sales: str, table: str, asof, **options) -> None:
    """The month's maturity markers from the production and sales tables."""
    made, sold = tables.read_table(spark, production), tables.read_table(spark, sales)
    tables.write_replace(maturity.maturity_markers(made, sold, asof, **options), table)


def refresh_flags(
    spark: SparkSession, facts: str, markers: str, staging: str, flags: dict[str, str] | None = None, only_promote: bool = False
) -> None:
    """The month's markers onto the flags of a use-case table, in place."""
    marked = maturity.refresh_maturity(tables.read_table(spark, facts), tables.read_table(spark, markers), flags, only_promote)
    tables.rewrite(marked, facts, staging)


def refresh_flag_partitions(
    spark: SparkSession, facts: str, markers: str, flags: dict[str, str] | None = None, only_promote: bool = False
) -> list[str | None]:
    """The same for a table partitioned by build month: only the months with a changed flag are written anew.

    Returns these months. Their number is at most that of the table's folders.
    """
    rows, marks = tables.read_partitioned(spark, facts, "MfgMonthYear"), tables.read_table(spark, markers)
    stale = sorted((r[0] for r in maturity.stale_months(rows, marks, flags, only_promote).collect()), key=lambda m: m or "")
    if stale:
        own = F.coalesce(F.col("MfgMonthYear").isin([m for m in stale if m is not None]), F.lit(None in stale))
        tables.replace_partitions(maturity.refresh_maturity(rows.filter(own), marks, flags, only_promote), facts, "MfgMonthYear", stale)
    return stale


def rebuild_warranty_cost(
    spark: SparkSession, job_cards: str, markers: str, table: str, asof, mfg_after="2019-01-01", run_date: str = RUN_DATE
) -> None:
    """The warranty-cost table with the engine-opening markers."""
    cards = tables.read_table(spark, job_cards)
    tables.write_replace(cost.warranty_cost(cards, tables.read_table(spark, markers), asof, mfg_after, run_date=run_date), table)


def report_deltas(spark: SparkSession, paths: dict[str, str], report: str, asof, run_date: str = RUN_DATE) -> None:
    """Rows each table received on the run day, as a report; counted from file footers."""
    tables.write_report({"delta": counts.delta_counts_of(spark, paths, asof, run_date)}, report)


def report_missing_parts(spark: SparkSession, job_cards: str, parts: DataFrame, report: str) -> None:
    """The month's parts that the master lacks, in order of part and model type, with their place."""
    found = quality.missing_parts(tables.read_table(spark, job_cards, ["PartNumber", "ModelType"]), parts)
    tables.write_ordered(found, report, [F.col("PartNumber"), F.col("ModelType")])


def report_duplicate_chassis(spark: SparkSession, sales: str, report: str) -> None:
    """The month's chassis numbers that were sold more than once, the most frequent first."""
    found = quality.duplicate_keys(tables.read_table(spark, sales, ["VehicleChassisNumber"]), ["VehicleChassisNumber"])
    tables.write_ordered(found, report, [F.col("Count").desc(), F.col("VehicleChassisNumber")])
