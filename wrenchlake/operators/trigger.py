"""Failures seen after a part change took effect."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.functions import dates, text
from wrenchlake.operators.skew import bounded, keep_first
from wrenchlake.session import materialise, split_hot_joins

# A part with more windows than this is swept by date instead of meeting all of them.
MOST_WINDOWS = 100
# Most model names that job cards are filtered by before they meet the changes.
MOST_MODELS = 1_000


@dataclass(frozen=True)
class ChangeKind:
    """How a change list is ordered and what of it is stamped on the failures."""

    order_col: str
    stamps: dict[str, str]
    plant_col: str = "Plant"
    # Whether the part description of the change replaces the one on the job card.
    describes_parts: bool = False
    # Name of the date whose year, month and month name are added as <prefix>Year, <prefix>Month, <prefix>MonthName.
    dated_by: str | None = None


ENGINEERING = ChangeKind(
    order_col="EffectiveDate",
    stamps={
        "PartDefectCode": "PartDefect",
        "ApplicableModels": "ApplicableModels",
        "Plant": "Plant",
        "ReasonForChange": "ReasonForChange",
        "ModificationDetail": "ModificationDetail",
        "EffectiveDate": "EffectiveDate",
    },
    describes_parts=True,
    dated_by="EffectiveDate",
)

APPROVAL = ChangeKind(
    order_col="MfgDate",
    stamps={
        "PPAPNumber": "PPAPNumber",
        "PPAPTitle": "PPAPTitle",
        "PPAPType": "PPAPType",
        "PPAPStatus": "PPAPStatus",
        "PPAPPlant": "PPAPPlant",
        "ProcessArea": "ProcessArea",
        "Purpose": "Purpose",
        "MfgDate": "MfgDate",
    },
    plant_col="PPAPPlant",
)


def _parsed(raw: DataFrame, lists: dict[str, Column]) -> DataFrame:
    """``raw`` with its text lists parsed once each, as a written table.

    A change list is a small file, or a few, often one task to read; its rows
    are spread over the cores before the parse.
    """
    spread = raw.repartition(max(raw.sparkSession.sparkContext.defaultParallelism, 1))
    return materialise(spread.withColumns(lists), "parsed_changes")


def parse_engineering_changes(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Change list with text lists turned into arrays: Parts (number, description) and Models.

    A text that is no list fails the query; ``strict=False`` leaves its array
    NULL (see ``unread_changes``). The list is parsed here, into a table.
    """
    lists = _parsed(
        raw,
        {
            "_parts": text.parse_literal(F.col("PartDetails"), text.PART_LIST, strict),
            "Models": text.parse_literal(F.col("ApplicableModels"), text.TEXT_LIST, strict),
        },
    )
    return lists.withColumns(
        {
            "Parts": F.transform(
                "_parts",
                lambda p: F.struct(p["Part No"].alias("PartNumber"), p["Part Description"].alias("PartDescription")),
            ),
            "PartDetails": text.joined_field(F.col("_parts"), "Part No"),
            "ApplicableModels": F.array_join("Models", ","),
        }
    ).drop("_parts")


def unread_changes(raw: DataFrame, column: str = "PartDetails", ddl: str = text.PART_LIST) -> DataFrame:
    """Rows of a raw list whose ``column`` holds text that is no list."""
    unread = text.parse_literal(F.col(column), ddl, strict=False).isNull() & (F.trim(text.one_line(F.col(column))) != "")
    return raw.filter(unread)


def parse_part_approvals(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Approval list with text lists turned into arrays; approvals carry no part description."""
    lists = _parsed(
        raw,
        {
            "_parts": text.parse_literal(F.col("PartDetailsNew"), text.TEXT_LIST, strict),
            "Models": text.parse_literal(F.col("ModelDetails"), text.TEXT_LIST, strict),
        },
    )
    described = F.transform("_parts", lambda p: F.struct(p.alias("PartNumber"), F.lit(None).cast("string").alias("PartDescription")))
    return lists.withColumn("Parts", described).drop("_parts")


def change_windows(changes: DataFrame, order_col: str) -> DataFrame:
    """One row per change and part with the build-date window [_from, _to) it is responsible for.

    The window ends at the build date of the next change of the part, that is
    the one with the next later ``order_col``; of several on that date the
    earliest build date counts. The last change stays open (``_to`` NULL).
    """
    items = changes.select("*", F.posexplode("Parts").alias("_place", "_part")).select(
        "*", F.col("_part.PartNumber").alias("_part_no"), F.col("_part.PartDescription").alias("_part_text")
    )
    # One row per part and date, so the window below never sees the raw list.
    steps = items.groupBy(F.col("_part_no").alias("_step_part"), F.col(order_col).alias("_step")).agg(
        F.min("MfgDate").alias("_starts")
    )
    following = F.lead("_starts").over(Window.partitionBy("_step_part").orderBy("_step"))
    steps = steps.withColumn("_to", following).drop("_starts")
    on = (F.col("_part_no") == F.col("_step_part")) & (F.col(order_col) == F.col("_step"))
    # A change without a date has no successor and stays open.
    return items.withColumn("_from", F.col("MfgDate")).join(steps, on, "left").drop("_part", "_step_part", "_step")


def open_windows(days: DataFrame, windows: DataFrame) -> DataFrame:
    """_part_no, _day, _change for every window of the part that is open on the day.

    ``days`` holds distinct (_part_no, _day), ``windows`` [_from, _to) per
    _change and _part_no. The starts and ends of a part's windows cut time into
    steps, counted in order. Sweeping a part's days and steps by date gives the
    step each day lies in; a window spans a run of steps, so day and window meet
    by (part, step). No pair of a day and a window that is closed then is made.
    """
    marks = windows.select("_part_no", F.explode(F.array("_from", "_to")).alias("_at")).filter(F.col("_at").isNotNull()).distinct()
    count = F.row_number().over(Window.partitionBy("_part_no").orderBy("_at"))
    steps = materialise(marks.withColumn("_step", count), "steps")

    stream = steps.select("_part_no", F.col("_at").alias("_day"), "_step").unionByName(days.withColumn("_step", F.lit(None).cast("int")))
    # A step begins before the days of its own date.
    in_order = Window.partitionBy("_part_no").orderBy("_day", F.col("_step").asc_nulls_last())
    swept = stream.select("_part_no", "_day", F.col("_step").isNull().alias("_asked"), F.last("_step", ignorenulls=True).over(in_order).alias("_step"))
    placed = swept.filter(F.col("_asked") & F.col("_step").isNotNull()).drop("_asked")

    first = steps.select("_part_no", F.col("_at").alias("_from"), F.col("_step").alias("_opens"))
    last = steps.select("_part_no", F.col("_at").alias("_to"), F.col("_step").alias("_closes"))
    ends = steps.groupBy("_part_no").agg((F.max("_step") + 1).alias("_end"))
    spans = windows.join(first, ["_part_no", "_from"]).join(last, ["_part_no", "_to"], "left").join(ends, "_part_no")
    until = F.coalesce("_closes", "_end") - 1
    spans = spans.filter(until >= F.col("_opens")).select("_part_no", "_change", F.explode(F.sequence("_opens", until)).alias("_step"))
    return placed.join(spans, ["_part_no", "_step"]).select("_part_no", "_day", "_change")


def stamped_windows(changes: DataFrame, kind: ChangeKind) -> DataFrame:
    """The windows of a parsed list, one row per change and part, with all that ``trigger_cutoff`` takes from a change.

    A change that lists a part twice says about it what stands first.
    """
    needed = dict.fromkeys([*kind.stamps, kind.plant_col, kind.order_col, "MfgDate", "Models", "Parts"])
    listed = changes.withColumn("_change", _change_id(changes)).select("_change", *needed)
    opened = change_windows(listed, kind.order_col).filter(F.col("_from").isNotNull())
    # The date is part of the key since the rows lie by part and date after the join with the next change.
    once = keep_first(opened, ["_part_no", kind.order_col, "_change"], [F.col("_place")])
    stamps = [F.col(source).alias(f"_stamp_{target}") for source, target in kind.stamps.items()]
    return once.select("_part_no", "_from", "_to", "_change", "Models", F.col(kind.plant_col).alias("_plant"), "_part_text", *stamps)


def _may_match(facts: DataFrame, windows: DataFrame) -> DataFrame:
    """``facts`` without rows that no window can take: built before the first or after the last one, or of a model that no change names."""
    first, last, still_open = windows.agg(
        F.min("_from").cast("string"), F.max("_to").cast("string"), F.max(F.col("_to").isNull())
    ).first()
    if first is None:
        return facts.filter(F.lit(False))
    kept = facts.filter(F.col("MfgDate") >= F.lit(first).cast("date"))
    if not still_open:
        kept = kept.filter(F.col("MfgDate") < F.lit(last).cast("date"))
    models = windows.select(F.explode("Models").alias("_model")).dropna().distinct().limit(MOST_MODELS + 1).collect()
    # A longer list of models is left to the join.
    return kept.filter(F.col("ModelID").isin([m[0] for m in models])) if len(models) <= MOST_MODELS else kept


def _meet(facts: DataFrame, windows: DataFrame, match_plant: bool, most_windows: int) -> DataFrame:
    """Every job card with every window of its part that is open on its build date, names its model and, if asked for, its plant."""
    terms = F.array_contains("Models", F.col("ModelID"))
    if match_plant:
        terms = terms & (F.col("Plant") == F.col("_plant"))
    day, part = F.col("MfgDate"), F.col("PartNumber") == F.col("_part_no")
    is_open = (day >= F.col("_from")) & (F.col("_to").isNull() | (day < F.col("_to")))
    counts = windows.groupBy("_part_no").agg(F.count(F.lit(1)).alias("_n"))
    crowded = bounded(counts.filter(F.col("_n") > most_windows).select("_part_no"))
    columns = ["_change", *facts.columns, *[c for c in windows.columns if c.startswith(("_stamp_", "_part_text"))]]
    if crowded.isEmpty():
        return facts.join(windows, part & is_open & terms).select(*columns)
    few, many = (windows.join(crowded, "_part_no", how) for how in ("left_anti", "left_semi"))
    theirs = facts.join(crowded, F.col("PartNumber") == F.col("_part_no"), "left_semi")
    days = theirs.select(F.col("PartNumber").alias("_part_no"), F.col("MfgDate").alias("_day")).distinct()
    open_then = open_windows(days, many.select("_part_no", "_from", "_to", "_change"))
    on_day = part & (day == F.col("_day")) & terms
    swept = theirs.join(open_then.join(many, ["_part_no", "_change"]), on_day)
    return facts.join(few, part & is_open & terms).select(*columns).unionByName(swept.select(*columns))


def trigger_cutoff(
    jobcards: DataFrame,
    changes: DataFrame | None,
    kind: ChangeKind,
    asof,
    match_plant: bool = False,
    run_date: str = schemas.RUN_DATE,
    windows: DataFrame | None = None,
    most_windows: int = MOST_WINDOWS,
) -> DataFrame:
    """Job cards of a changed part on vehicles built inside the change's window.

    ``changes`` is a parsed list (see ``parse_engineering_changes``); where its
    ``stamped_windows`` are a table already, ``windows`` is that table. A job
    card counts once per change and part. A change listed twice in the same
    words counts as one.

    Job cards and windows, which carry what a change stamps on a failure, meet
    by part in one shuffle, and duplicates are dropped where the rows then lie.
    A part with very many failures is split by adaptive execution (see
    ``split_hot_joins``). For parts of more than ``most_windows`` windows the
    build dates, each once, are swept against the windows (``open_windows``),
    and a job card meets exactly those open on its date, by (part, date).
    """
    split_hot_joins(jobcards.sparkSession)
    if windows is None:
        windows = bounded(stamped_windows(changes, kind))
    facts = jobcards.select(*schemas.CHANGE_FACT_COLUMNS).filter(F.col("PartNumber").isNotNull() & F.col("MfgDate").isNotNull())
    matched = _meet(_may_match(facts, windows), windows, match_plant, most_windows)
    rest = [c for c in schemas.CHANGE_FACT_COLUMNS if c not in ("JobCard", "PartNumber", "CreatedOn")]
    once = keep_first(matched, ["_change", "PartNumber", "JobCard"], [F.col(c) for c in ("CreatedOn", *rest)])
    result = once.withColumns({target: F.col(f"_stamp_{target}") for target in kind.stamps.values()})
    result = result.withColumn(run_date, dates.day(asof))
    if kind.describes_parts:
        result = result.withColumn("PartDescription", F.col("_part_text"))
    if kind.dated_by:
        stamp, prefix = F.col(kind.dated_by), kind.dated_by.removesuffix("Date")
        result = result.withColumns(
            {
                f"{prefix}Year": F.date_format(stamp, "yyyy"),
                f"{prefix}Month": F.date_format(stamp, "MM"),
                f"{prefix}MonthName": F.date_format(stamp, "MMM"),
            }
        )
    return result.drop(*[c for c in result.columns if c.startswith("_")])


def _change_id(changes: DataFrame) -> Column:
    """Short identity of a change, taken from its content so that a re-run of a lost task gives the same one."""
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(*[F.col(c) for c in changes.columns])), 256), 1, 24))


_SUMMED_TEXTS = ["PartDescription", "PartDefect", "ReasonForChange", "ModificationDetail"]


def trigger_cutoff_summary(rows: DataFrame) -> DataFrame:
    """Reported issues of the latest change of each part."""
    per_change = rows.groupBy("PartNumber", "EffectiveDate").agg(
        *[F.max(c).alias(c) for c in _SUMMED_TEXTS], F.count_distinct("JobCard").alias("ReportedIssues")
    )
    return latest_changes(per_change)


def latest_changes(per_change: DataFrame) -> DataFrame:
    """The latest change of each part, from one row per part and date."""
    return keep_first(per_change, ["PartNumber"], [F.col("EffectiveDate").desc()])


def new_issues(rows: DataFrame, known: DataFrame) -> DataFrame:
    """PartNumber, EffectiveDate, JobCard that ``rows`` report and ``known`` does not hold, each once."""
    keys = ["PartNumber", "EffectiveDate", "JobCard"]
    reported = rows.select(*keys).filter(F.col("JobCard").isNotNull()).distinct()
    old = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = [F.col("JobCard") == F.col("_JobCard")] + [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys[:2]]
    return reported.join(old, on, "left_anti")


def folded_summary(totals: DataFrame, rows: DataFrame, issues: DataFrame) -> DataFrame:
    """Totals per part and date with one more run day: its ``rows``, and the ``issues`` that were not reported before.

    ``totals`` is what this function returned for the day before, or a frame of
    its columns without rows; the sums of all days equal one sum over all rows.
    """
    keys = ["PartNumber", "EffectiveDate"]
    no_text = [F.lit(None).cast("string").alias(c) for c in _SUMMED_TEXTS]
    texts = rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in _SUMMED_TEXTS]).withColumn("ReportedIssues", F.lit(0).cast("bigint"))
    counts = issues.groupBy(*keys).agg(F.count(F.lit(1)).alias("ReportedIssues")).select(*keys, *no_text, "ReportedIssues")
    together = totals.select(*keys, *_SUMMED_TEXTS, "ReportedIssues").unionByName(texts).unionByName(counts)
    return together.groupBy(*keys).agg(*[F.max(c).alias(c) for c in _SUMMED_TEXTS], F.sum("ReportedIssues").alias("ReportedIssues"))
