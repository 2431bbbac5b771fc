"""Warranty cost, part failure rate, roadside labels and group comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.functions import bands, dates, text
from wrenchlake.operators.maturity import attach_maturity
from wrenchlake.operators.quality import quality_filter
from wrenchlake.operators.skew import bounded

EO_FLAGS = {
    "FirstYearMaturity": "EOFirstYearMaturity",
    "SecondYearMaturity": "EOSecondYearMaturity",
    "ThirdYearMaturity": "EOThirdYearMaturity",
}


def warranty_cost(
    jobcards: DataFrame,
    markers: DataFrame,
    asof,
    mfg_after="2019-01-01",
    date_col: str = "CreatedOn",
    run_date: str = schemas.RUN_DATE,
) -> DataFrame:
    """Warranty-billed domestic rows of the first three years, in cumulative year buckets, with maturity."""
    event, built = F.col(date_col), F.col("MfgDate")
    month = dates.first_of_month(F.col("MfgYear"), F.col("MfgMonth"))
    rows = jobcards.filter(quality_filter("warranty", mfg_after, date_col)).select(
        *[F.upper("City").alias("City") if c == "City" else F.col(c) for c in schemas.COST_COLUMNS],
        bands.year_bucket(event, built, 1, "first_year").alias("FirstYearBucket"),
        bands.year_bucket(event, built, 2, "second_year").alias("SecondYearBucket"),
        bands.year_bucket(event, built, 3, "third_year").alias("ThirdYearBucket"),
        dates.month_label(month).alias("MfgMonthNameYear"),
        dates.month_key(month).alias("MfgMonthYear"),
        F.lit("wc data").alias("DMart"),
        dates.day(asof).alias(run_date),
    )
    return attach_maturity(rows, markers, EO_FLAGS)


def part_failure_rate(facts: DataFrame) -> DataFrame:
    """Failures per hundred sold vehicles by build month; one is added to the population."""
    failures = F.count(F.when(F.col("DMart") == "ff data", F.col("JobCard")))
    population = F.count_distinct(F.when(F.col("DMart") == "dms sales data", F.col("VehicleChassisNumber"))) + 1
    return (
        facts.groupBy("MfgMonthNameYear", "MfgMonthYear")
        .agg(failures.alias("Numerator"), population.alias("Denominator"))
        .withColumn("part_failure", F.col("Numerator") / F.col("Denominator") * 100)
    )


def roadside_labels(cases: DataFrame) -> DataFrame:
    """Roadside cases with incident and service texts upper-cased and grouped."""
    return cases.withColumns(
        {
            "TypeofIncident": text.relabel_if_contains(F.col("TypeofIncident"), "ENGINE", "ENGINE RELATED"),
            "ServiceProvided": text.relabel_if_contains(F.col("ServiceProvided"), "TOW", "TOWING"),
        }
    )


def above_group_average(df: DataFrame, group: str, value: str, average: str = "GroupAverage") -> DataFrame:
    """Rows above the mean of their own group, with the mean rounded to a whole number.

    The mean is an aggregate joined back, not a window, so a group holding much
    of the data is never gathered in one task.
    """
    means = bounded(df.groupBy(F.col(group).alias("_group")).agg(F.avg(value).alias("_mean")))
    return (
        df.join(means, F.col(group) == F.col("_group"))
        .filter(F.col(value) > F.col("_mean"))
        .withColumn(average, F.round("_mean"))
        .drop("_group", "_mean")
    )
