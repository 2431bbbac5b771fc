"""Daily feeds to enriched tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchlake import schemas
from wrenchlake.functions import bands, dates, text, vehicle
from wrenchlake.functions import fixed_values as fixed
from wrenchlake.operators.decode import decode_vehicle
from wrenchlake.operators.skew import bounded, bounded_or_dealt, bounded_or_hashed, join_in_buckets, keep_first, one_per_key
from wrenchlake.session import clear_scratch, split_rule_chains

# Rows that a task takes in a staged ingestion: of the feed's columns, and of the whole table when it is written by day.
FEED_ROWS, TABLE_ROWS = 1_500_000, 500_000


def build_part_master(sheets: list[DataFrame], order: list[Column] | None = None) -> DataFrame:
    """Part master from the three sheets, one row per part and model type.

    Each sheet is cleaned, deduplicated on the part number and repeated for the
    model types it stands for. The row kept per part is the first in ``order``
    (name, group, variant, category unless given).
    """
    masters = []
    for sheet, model_types in zip(sheets, fixed.SHEET_MODEL_TYPES):
        cleaned = sheet.select(
            F.col("Part No").alias("PartNumber"),
            F.upper("Part Name").alias("PartName"),
            F.upper("Part Group").alias("PartGroup"),
            F.upper("Part category").alias("PartVariant"),
            F.upper("Category").alias("PartCategory"),
        ).dropna(subset=["PartNumber"])
        by = order or [F.col(c) for c in ("PartName", "PartGroup", "PartVariant", "PartCategory")]
        first = keep_first(cleaned, ["PartNumber"], by)
        masters.append(first.withColumn("ModelType", F.explode(F.array(*[F.lit(m) for m in model_types]))))
    result = masters[0]
    for master in masters[1:]:
        result = result.unionByName(master)
    return result


def _master_lookup(parts: DataFrame, legacy_dedupe: bool) -> DataFrame:
    """One row per lookup key of the part master.

    ``legacy_dedupe`` keeps one row per part number only, so a part shared by
    several model types matches just one of them; the model type that sorts
    first in the master's own sequence wins.
    """
    rows = parts.dropna(subset=["PartNumber"])
    rest = [F.col(c) for c in ("PartGroup", "PartVariant", "PartCategory")]
    if not legacy_dedupe:
        return keep_first(rows, ["PartNumber", "ModelType"], rest)
    sequence = F.array_position(
        F.array(*[F.lit(m) for m in ("NEW CLASSIC", "TWINS", "METEOR", "UCE", "HIMALAYAN")]), F.col("ModelType")
    )
    return keep_first(rows, ["PartNumber"], [sequence, *rest])


def add_part_groups(df: DataFrame, parts: DataFrame, legacy_dedupe: bool = False, staged: int = 0) -> DataFrame:
    """Part columns for the part and the group of the primary part, by model type.

    Rows that meet a part master too large to broadcast are shuffled for each of
    the two lookups or, with ``staged`` (about how many rows there are), written
    in buckets instead (``join_in_buckets``).
    """
    lookup = _master_lookup(parts, legacy_dedupe)
    by_part, by_primary = ["ModelType", "PartNumber"], ["ModelType", "PrimaryPartNumber"]
    master, large = bounded_or_dealt(lookup) if staged else (bounded_or_hashed(lookup), False)
    cell = ["_dealt"] if large else []
    as_part = master.select("ModelType", "PartNumber", "PartGroup", "PartVariant", "PartCategory", *cell)
    as_primary = master.select(
        "ModelType", F.col("PartNumber").alias("PrimaryPartNumber"), F.col("PartGroup").alias("PrimaryPartGroup"), *cell
    )
    if large:
        with_primary, written = join_in_buckets(df, as_primary, by_primary, -(-staged // FEED_ROWS))
        grouped, _ = join_in_buckets(with_primary, as_part, by_part, -(-staged // TABLE_ROWS))
        clear_scratch(df.sparkSession, written)
        return grouped
    return df.join(one_per_key(as_part, by_part), by_part, "left").join(one_per_key(as_primary, by_primary), by_primary, "left")


def add_city(df: DataFrame, dealers: DataFrame) -> DataFrame:
    """Upper-cased city of the dealer."""
    known = keep_first(dealers.dropna(subset=["Code"]), ["Code"], [F.col("CityCode")])
    cities = bounded(known.select(F.col("Code").alias("DealerCode"), F.upper("CityCode").alias("City")))
    return df.drop("City").join(one_per_key(cities, ["DealerCode"]), "DealerCode", "left")


def ingest_job_cards(
    raw: DataFrame,
    parts: DataFrame,
    dealers: DataFrame,
    asof,
    run_date: str = schemas.RUN_DATE,
    legacy_dedupe: bool = False,
    late: dict[str, Column] | None = None,
    staged: int = 0,
) -> DataFrame:
    """Raw job cards to the enriched job-card table.

    The fact side is only projected and joined to the masters. Each master is
    deduplicated once, counted, and broadcast if it is small enough; a larger
    one meets the facts in a shuffle, where a part master is hashed and the
    facts are not sorted. So the joins come first, on the raw
    columns, and what is derived from these comes after and is never shuffled.

    ``late`` names feed columns that are expressions over other columns of
    ``raw``: they are worked out after the joins as well, so that a shuffle
    carries the narrow columns they come from. PartNumber and PrimaryPartNumber,
    which the joins with the part master need, are columns of ``raw``.

    ``staged``, about the number of rows, is for callers that take the whole
    table: where the part master is too large to broadcast, the rows are written
    for each lookup at once, as compressed columns, instead of shuffled when the
    result is asked for.
    """
    split_rule_chains(raw.sparkSession)
    late = late or {}
    chassis, product = (F.upper(late.get(c, F.col(c))) for c in ("VehicleChassisNumber", "Product"))
    platform = vehicle.chassis_slices(chassis)["platform"]
    keyed = raw.withColumn("ModelType", vehicle.model_type(platform, product, vehicle.is_decodable(chassis, product)))
    grouped = add_part_groups(keyed, parts, legacy_dedupe, staged)
    if "DealerCode" in late:
        grouped = grouped.withColumn("DealerCode", late["DealerCode"])
    # The city is the dealer's, whatever the feed says.
    joined = add_city(grouped, dealers).withColumns({name: value for name, value in late.items() if name not in ("City", "DealerCode")})
    dated = joined.withColumns(
        {
            "CreatedOn": F.to_date("CreatedOnDateTime"),
            "CreatedOnYear": dates.year_of(F.col("CreatedOnDateTime")),
            "CreatedOnMonth": dates.month_of(F.col("CreatedOnDateTime")),
            run_date: dates.day(asof),
            "Kilometers": bands.known_kilometers(F.col("Kilometers")),
            "PrimaryPartNew": text.before_marker(F.col("PrimaryPart"), "RJC"),
            "PartFilter": text.ascii_only(F.col("PartDescription")),
        }
    )
    derived = decode_vehicle(dated).withColumns(
        {
            "KmsGroup": bands.kms_group(F.col("Kilometers")),
            "PrimaryPartFilter": text.ascii_only(F.col("PrimaryPartNew")),
        }
    )
    return derived.select(*schemas.JOB_CARD_TABLE, run_date)


def ingest_sales(raw: DataFrame, asof, run_date: str = schemas.RUN_DATE) -> DataFrame:
    """Raw vehicle sales to the sales table."""
    ordered = F.col("SalesOrderDate")
    dated = raw.withColumns(
        {
            "SalesOrderDateYear": dates.year_of(ordered),
            "SalesOrderDateMonth": dates.month_of(ordered),
            "SalesOrderDateMonthName": F.date_format(ordered, "MMMM"),
            "SalesOrderDate": F.to_date(ordered),
            run_date: dates.day(asof),
        }
    )
    return decode_vehicle(dated)


def ignore_list(df: DataFrame) -> DataFrame:
    """Parts marked as repeat or repair service work."""
    return df.filter(F.col("Repeat/Repair Service") == "Yes").select(F.col("Part No").alias("PartNo"))


def labour_codes(df: DataFrame) -> DataFrame:
    """Scheduled-service labour codes under their table names."""
    return df.select(F.col("Labor code").alias("LaborCode"), F.col("Labor description").alias("LaborDescription"))
