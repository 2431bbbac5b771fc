"""Row filters, rule labels, duplicate checks and load counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.functions import dates
from wrenchlake.functions import fixed_values as fixed
from wrenchlake.operators.repeated import LEAST_ROWS, may_repeat
from wrenchlake.operators.skew import HOT_ROWS, all_but_first


def _common() -> Column:
    return (
        (F.length("VehicleChassisNumber") == fixed.CHASSIS_LENGTH)
        & (F.length("JobCard") == fixed.JOB_CARD_LENGTH)
        & (F.col("ModelType") != fixed.UNKNOWN)
        & ~F.col("Model").isin(fixed.REJECTED_MODELS)
        & (F.col("Plant") != fixed.UNKNOWN)
        & (F.col("Country") == "Domestic")
        & F.col("PartAction").isNull()
    )


def _named_part() -> Column:
    return (
        F.col("PartNumber").isNotNull()
        & F.col("PartDescription").isNotNull()
        & (F.col("MfgYear") != fixed.UNKNOWN_YEAR)
    )


def repair_visit() -> Column:
    """Visits that are neither accident nor pre-delivery work; unknown types do not pass."""
    return ~F.col("JobSubType").isin(fixed.NON_REPAIR_VISITS)


def quality_filter(profile: str, mfg_after="2019-01-01", date_col: str = "CreatedOn") -> Column:
    """Row predicate of a use case: relationship, unplanned, repeat or warranty.

    A comparison with NULL does not pass, as in the SQL the rules come from.
    """
    if profile == "relationship":
        return (
            _common()
            & _named_part()
            & F.col("ItemType").contains("Part")
            & F.col("PrimaryConsequential").contains("Consequential")
            & F.col("PrimaryPart").isNotNull()
        )
    if profile == "unplanned":
        return (
            _common()
            & _named_part()
            & F.col("ItemType").contains("Part")
            & F.col("PrimaryConsequential").contains("Primary")
        )
    if profile == "repeat":
        return (
            _common()
            & _named_part()
            & (F.col("ItemType") == "Part")
            & repair_visit()
            & (F.col("JobCardStatus") != "Canceled")
        )
    if profile == "warranty":
        return (
            _common()
            & (F.col("BillType") == "WARRANTY")
            & (F.col("MfgDate") > dates.day(mfg_after))
            & dates.within_years(F.col(date_col), F.col("MfgDate"), 3)
        )
    raise ValueError(f"unknown profile: {profile}")


def without_parts(df: DataFrame, excluded: DataFrame, key: str = "PartNumber", listed: str = "PartNo") -> DataFrame:
    """Rows whose part is not on the list; a NULL on the list has no effect."""
    listing = excluded.select(F.col(listed).alias(key)).dropna()
    return df.join(listing, key, "left_anti")


def missing_parts(jobcards: DataFrame, parts: DataFrame) -> DataFrame:
    """Distinct (PartNumber, ModelType) of the job cards that the part master lacks.

    The facts shrink to their distinct pairs first, combined map-side, so only
    those meet the master.
    """
    wanted = jobcards.dropna(subset=["PartNumber"]).select("PartNumber", "ModelType").distinct()
    return wanted.join(parts.select("PartNumber", "ModelType"), ["PartNumber", "ModelType"], "left_anti")


def parts_without_group(jobcards: DataFrame) -> DataFrame:
    """The same check on enriched job cards: distinct pairs whose part group stayed empty."""
    empty = F.col("PartNumber").isNotNull() & F.col("PartGroup").isNull()
    return jobcards.filter(empty).select("PartNumber", "ModelType").distinct()


def duplicate_keys(df: DataFrame, keys: list[str], least_rows: int = LEAST_ROWS) -> DataFrame:
    """Keys that occur more than once, with their row count; only rows whose key may repeat are shuffled."""
    found = may_repeat(df.select(*keys), keys, least_rows)
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("Count")).filter("Count > 1")


def duplicate_rows(
    df: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    hot_rows: int = HOT_ROWS,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Every row of a key but its first; ``order`` defaults to the other columns."""
    df = may_repeat(df, keys, least_rows)
    by = order or [F.col(c) for c in df.columns if c not in keys] or [F.col(k) for k in keys]
    return all_but_first(df, keys, by, hot_rows)


def is_unique(df: DataFrame, key: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row: rows, distinct non-null keys, null keys, and whether all rows have a key of their own.

    The distinct keys are all non-null ones less the extra rows of repeated
    keys, so only rows whose key may repeat are shuffled.
    """
    counts = df.agg(F.count(F.lit(1)).alias("Records"), F.count_if(F.col(key).isNull()).alias("NullKeys"))
    repeated = duplicate_keys(df.select(key).dropna(), [key], least_rows)
    parts = counts.unionByName(repeated.agg(F.sum(F.col("Count") - 1).alias("extra")), allowMissingColumns=True)
    whole = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts.columns])
    distinct = F.col("Records") - F.col("NullKeys") - F.col("extra")
    return whole.select(
        "Records", distinct.alias("DistinctKeys"), "NullKeys", (F.col("Records") == distinct).alias("IsUnique")
    )


def row_multiplicity(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Whole rows with their number of copies; rows holding a NULL are left out unless asked for."""
    rows = df if keep_nulls else df.dropna()
    return rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("records"))


def delta_counts(tables: dict[str, tuple[DataFrame, str]], day) -> DataFrame:
    """Rows loaded on ``day`` per table; ``tables`` maps a name to (frame, run-day column).

    A table without rows on the day keeps its line, with a count of 0.
    """
    counts = [
        df.filter(F.col(column) == dates.day(day))
        .agg(F.count(F.lit(1)).alias("DeltaRecords"))
        .select(F.lit(name).alias("TableName"), "DeltaRecords")
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def relationship_rules() -> dict[str, Column]:
    """Data-quality rules of the relationship use case: comment to the condition that earns it."""
    return {
        "ModelType is Null": F.col("ModelType") == fixed.UNKNOWN,
        "Plant is Null": F.col("Plant") == fixed.UNKNOWN,
        "PrimaryPart is Null": F.col("PrimaryPart").isNull(),
        "JobCard length not 16": F.length("JobCard") != fixed.JOB_CARD_LENGTH,
        "VehicleChassisNumber length not 17": F.length("VehicleChassisNumber") != fixed.CHASSIS_LENGTH,
        "PartNumber is Null": F.col("PartNumber").isNull(),
        "PartDescription is Null": F.col("PartDescription").isNull(),
    }


def relationship_scope(jobcards: DataFrame) -> DataFrame:
    """Rows the business rule of the relationship use case selects, before any quality rule."""
    return jobcards.filter(
        F.col("ItemType").contains("Part")
        & F.col("PrimaryConsequential").contains("Consequential")
        & F.col("PartAction").isNull()
    )


def label_quality(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``comments`` (the failed rules, comma-joined, or NULL) and ``data_quality``."""
    failed = F.concat_ws(",", *[F.when(test, F.lit(comment)) for comment, test in rules.items()])
    return df.withColumn("comments", F.nullif(failed, F.lit(""))).withColumn(
        "data_quality", F.when(F.col("comments").isNull(), F.lit("good data")).otherwise(F.lit("bad data"))
    )


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows failing each rule, counted in one pass."""
    totals = df.agg(*[F.count_if(test).alias(f"_{i}") for i, test in enumerate(rules.values())])
    lines = F.array(
        *[F.struct(F.lit(comment).alias("Rule"), F.col(f"_{i}").alias("Records")) for i, comment in enumerate(rules)]
    )
    return totals.select(F.inline(lines))


def feed_completeness(table: DataFrame, first_day, last_day, run_date: str = schemas.RUN_DATE) -> DataFrame:
    """Days of the period on which the table received no rows."""
    spark = table.sparkSession
    expected = spark.range(1).select(
        F.explode(F.sequence(dates.day(first_day), dates.day(last_day))).alias(run_date)
    )
    day = F.col(run_date).cast("date")
    loaded = table.filter(day.between(dates.day(first_day), dates.day(last_day))).select(day.alias(run_date)).distinct()
    return expected.join(loaded, run_date, "left_anti")
