"""Maturity of build months: has enough of what was built been sold and been on the road long enough."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchlake.functions import dates
from wrenchlake.functions import fixed_values as fixed
from wrenchlake.operators.skew import bounded

MARKER_KEYS = ["MfgMonthYear", "ModelGroup"]


def _maturity(enough_sold: Column, aged: str) -> Column:
    mature = enough_sold & (F.col(aged) >= F.lit(fixed.MATURE_SHARE) * F.col("SCount"))
    return F.when(mature, F.lit(fixed.MATURED)).otherwise(F.lit(fixed.NOT_MATURED))


def maturity_markers(
    production: DataFrame,
    sales: DataFrame,
    asof,
    first_month: str = "2019-01",
    horizons: dict[str, int] | None = None,
    eo_horizons: dict[str, int] | None = None,
    dedupe_sales: bool = False,
) -> DataFrame:
    """Production, sales and aged-sales counts per build month and model group, with maturity flags.

    Production needs MfgDate, ModelGroup and VehicleChassisNumber; sales also
    VehicleAge in days. Aged sales count rows, unless ``dedupe_sales`` counts
    every chassis once. ``eo_horizons`` adds the engine-opening flags.
    """
    horizons = fixed.FF_HORIZONS if horizons is None else horizons
    eo_horizons = eo_horizons or {}
    # The month bound is on the build date, so it reaches both scans.
    start = F.lit(f"{first_month}-01").cast("date")
    in_period = (F.col("MfgDate") >= start) & (F.col("MfgDate") <= F.last_day(dates.day(asof)))
    known = in_period & (F.col("ModelGroup") != fixed.UNKNOWN)
    month = dates.month_key(F.col("MfgDate")).alias("MfgMonthYear")

    built = (
        production.filter(known)
        .groupBy(month, "ModelGroup")
        .agg(F.count_distinct("VehicleChassisNumber").alias("PCount"))
    )
    ages = {f"{name}Count": days for name, days in {**horizons, **eo_horizons}.items()}
    sold_rows = sales.filter(known).select(month, "ModelGroup", "VehicleChassisNumber", "VehicleAge")
    if dedupe_sales:
        sold_rows = sold_rows.groupBy(*MARKER_KEYS, "VehicleChassisNumber").agg(F.max("VehicleAge").alias("VehicleAge"))
        sold_count = F.count("VehicleChassisNumber")
    else:
        sold_count = F.count_distinct("VehicleChassisNumber")
    sold = sold_rows.groupBy(*MARKER_KEYS).agg(
        sold_count.alias("SCount"),
        *[F.count_if(F.col("VehicleAge") >= days).alias(name) for name, days in ages.items()],
    )
    both = built.join(sold.withColumn("_sold", F.lit(True)), MARKER_KEYS, "left")
    enough_sold = F.col("SCount") >= F.lit(fixed.MATURE_SHARE) * F.col("PCount")
    return both.select(
        *MARKER_KEYS,
        "PCount",
        "SCount",
        *[f"{name}Count" for name in horizons],
        *[_maturity(enough_sold, f"{name}Count").alias(f"{name}Maturity") for name in {**horizons, **eo_horizons}],
        *[F.when(F.col("_sold"), F.lit(f"({i}) {name}")).alias(name) for i, name in enumerate(horizons, start=1)],
    )


def sales_maturity(production: DataFrame, sales: DataFrame) -> DataFrame:
    """Share of a month's production that was sold; production and sales carry Year and Month."""
    built = production.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("ProdCount"))
    sold = sales.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("SalesCount"))
    share = F.col("SalesCount") / F.col("ProdCount") * 100
    return (
        built.join(sold, ["Year", "Month"], "full")
        .withColumn("SalesPercentage", share)
        .withColumn(
            "M_NM",
            F.when(F.col("SalesPercentage") > 90, F.lit("Matured")).when(
                F.col("SalesPercentage") < 90, F.lit("Not Matured")
            ),
        )
    )


def _with_markers(facts: DataFrame, markers: DataFrame, flags: dict[str, str], prefix: str) -> DataFrame:
    # One row per build month and model group: a few hundred in practice, and
    # checked. Without the broadcast all facts would shuffle onto these few keys.
    small = bounded(
        markers.select(
            F.col("MfgMonthYear").alias("_month"),
            F.col("ModelGroup").alias("_group"),
            *[F.col(source).alias(f"{prefix}{target}") for target, source in flags.items()],
            F.lit(True).alias("_marked"),
        )
    )
    on = (F.col("MfgMonthYear") == F.col("_month")) & (F.col("ModelType") == F.col("_group"))
    return facts.join(small, on, "left").drop("_month", "_group")


def attach_maturity(facts: DataFrame, markers: DataFrame, flags: dict[str, str] | None = None) -> DataFrame:
    """Add maturity flags to facts by build month and model type.

    ``flags`` maps the new column to the marker column; all failure-frequency
    flags by default.
    """
    flags = flags or {f"{name}Maturity": f"{name}Maturity" for name in fixed.FF_HORIZONS}
    return _with_markers(facts, markers, flags, "").drop("_marked")


def _refreshed(flags: dict[str, str], only_promote: bool) -> dict[str, Column]:
    """The value of each flag after a refresh, over facts joined with markers."""

    def value(target: str) -> Column:
        old, new = F.col(target), F.col(f"_new_{target}")
        if only_promote:
            rises = (old == fixed.NOT_MATURED) & (new == fixed.MATURED)
            return F.when(rises, new).otherwise(old)
        return F.when(F.col("_marked"), new).otherwise(old)

    return {target: value(target) for target in flags}


def _all_flags(flags: dict[str, str] | None) -> dict[str, str]:
    return flags or {f"{name}Maturity": f"{name}Maturity" for name in fixed.FF_HORIZONS}


def refresh_maturity(
    facts: DataFrame, markers: DataFrame, flags: dict[str, str] | None = None, only_promote: bool = False
) -> DataFrame:
    """Facts with their flags replaced by the current markers.

    Rows without a marker keep their flags. With ``only_promote`` a flag changes
    from NotMatured to Matured and in no other way.
    """
    flags = _all_flags(flags)
    joined = _with_markers(facts, markers, flags, "_new_")
    return joined.withColumns(_refreshed(flags, only_promote)).select(*facts.columns)


def stale_months(
    facts: DataFrame, markers: DataFrame, flags: dict[str, str] | None = None, only_promote: bool = False
) -> DataFrame:
    """Build months (MfgMonthYear) in which ``refresh_maturity`` would change a flag; reads keys and flags only."""
    flags = _all_flags(flags)
    joined = _with_markers(facts.select("MfgMonthYear", "ModelType", *flags), markers, flags, "_new_")
    differs = [~F.col(target).eqNullSafe(value) for target, value in _refreshed(flags, only_promote).items()]
    return joined.filter(reduce(Column.__or__, differs)).select("MfgMonthYear").distinct()


def changed_flags(old: DataFrame, new: DataFrame, flag: str = "FF1Maturity") -> DataFrame:
    """Build months and groups whose flag differs between two marker tables, with the new flag."""
    before = old.select(*MARKER_KEYS, F.col(flag).alias("_before"))
    after = new.select(*MARKER_KEYS, flag)
    differs = ~F.col("_before").eqNullSafe(F.col(flag))
    return before.join(after, MARKER_KEYS).filter(differs).drop("_before")
