"""Domain tables derived from the driver's star-schema tables.

Every expression below is plain SQL that Spark and DuckDB read alike, so the
oracle starts from the very same input. Dates move on by 20 years, which puts
visits next to the build years a chassis code can express.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.session import split_rule_chains

# Synthetic 17-character chassis of a customer key, with some missing, short and lower-case ones.
CHASSIS = """CASE WHEN {k} % 211 = 3 THEN NULL
  WHEN {k} % 101 = 7 THEN substr({full}, 1, 16)
  WHEN {k} % 53 = 5 THEN lower({full})
  ELSE {full} END"""
FULL_CHASSIS = """('ME3' || substr('UDPJX', CAST({k} % 5 + 1 AS INT), 1) || substr('345678', CAST({k} % 6 + 1 AS INT), 1) || '000'
  || substr('012ABCGKLNZ', CAST({k} % 11 + 1 AS INT), 1) || substr('ABCDHJKLMNOIZ', CAST({k} % 13 + 1 AS INT), 1)
  || substr('0BK2N1Z', CAST({k} % 7 + 1 AS INT), 1) || lpad(CAST({k} AS STRING), 6, '0'))"""

PRODUCT = """CASE CAST({k} % 9 AS INT) WHEN 0 THEN 'Classic 350 Chrome' WHEN 1 THEN 'Continental-GT 650' WHEN 2 THEN ' himalayan,BS6 411'
  WHEN 3 THEN 'CL 500' WHEN 4 THEN 'Signals 350' WHEN 5 THEN 'Interceptor650 Orange' WHEN 6 THEN 'Meteor 350, classic trim'
  WHEN 7 THEN 'MACHISMO 500' ELSE NULL END"""


def chassis_sql(key: str) -> str:
    return CHASSIS.format(k=key, full=FULL_CHASSIS.format(k=key))


def product_sql(key: str) -> str:
    return PRODUCT.format(k=key)


def raw_job_cards_sql(part: str = "l_partkey") -> dict[str, str]:
    """Raw job-card columns over lineitem, orders and part; ``part`` picks what stands in as the part number."""
    by_key = part == "l_partkey"
    number = "'P' || CAST(l_partkey AS STRING)" if by_key else f"CAST({part} AS STRING)"
    # Coarse part numbers come with fewer vehicles, so that repeats happen at all.
    vehicle = "o_custkey" if by_key else "CAST(floor(o_custkey / 4) AS BIGINT)"
    shipped = "(l_shipdate + INTERVAL 20 YEAR)"
    text = {name: "CAST(NULL AS STRING)" for name in (
        "Observation", "IsRepeated", "PartDefectID", "StatusReason", "CustomerVoice", "RegistrationNumber", "JobType",
        "FinalCustomer", "RepairCategory", "PartBatchCode", "FieldObservationReport", "TechnicalObservation",
        "ComplaintObservedByDealer", "CorrectiveActiontaken",
    )}
    return {
        "JobCard": "CASE WHEN l_orderkey % 97 = 1 THEN 'JC' || CAST(l_orderkey AS STRING) "
        "ELSE 'JC' || lpad(CAST(l_orderkey AS STRING), 14, '0') END",
        "PartNumber": f"CASE WHEN l_linenumber = 6 AND l_orderkey % 5 = 0 THEN NULL ELSE {number} END",
        "LineAmount": "l_extendedprice",
        "PartDescription": "CASE WHEN l_partkey % 9 = 0 THEN p_name || ' café' WHEN l_partkey % 23 = 0 THEN NULL ELSE p_name END",
        "ItemType": "CASE WHEN l_linestatus = 'O' OR l_linenumber <= 2 THEN 'Part' WHEN l_linenumber <= 4 THEN 'Spare Part' ELSE 'Labour' END",
        "RequestedQuantity": "l_quantity",
        "IssuedQuantityNew": "l_quantity",
        "PartDefectCode": "'DC' || CAST(l_partkey % 40 AS STRING)",
        "PrimaryConsequential": "CASE l_returnflag WHEN 'A' THEN 'Primary' WHEN 'R' THEN 'Consequential' ELSE 'Primary Part' END",
        "PrimaryPart": "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 2 = 0 THEN p_name || ' RJC ' || p_brand ELSE p_name || 'ü' END",
        "PrimaryPartNumber": "'P' || CAST(l_suppkey AS STRING)",
        "PartAction": "CASE WHEN l_linenumber = 5 AND l_tax > 0.04 THEN 'Rejected' ELSE NULL END",
        "CreatedOnDateTime": shipped,
        "CustomerComplaint": "p_type",
        "CashierInvoicingDateTime": "(l_shipdate + INTERVAL 20 YEAR + INTERVAL 3 DAY)",
        "Region": "'REGION_' || CAST(o_custkey % 5 AS STRING)",
        "VehicleChassisNumber": chassis_sql(vehicle),
        "JobSubType": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'ACCIDENTAL' WHEN o_orderkey % 37 = 0 THEN 'PDI' "
        "WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'REPAIR' END",
        "Kilometers": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 700 END",
        "State": "'STATE_' || CAST(o_custkey % 25 AS STRING)",
        "Zone": "'ZONE_' || CAST(o_custkey % 4 AS STRING)",
        "City": "'unused'",
        "DealerName": "'Dealer ' || CAST(l_suppkey AS STRING)",
        "BillType": "CASE l_returnflag WHEN 'N' THEN 'WARRANTY' ELSE 'PAID' END",
        "DateofSale": "(o_orderdate + INTERVAL 20 YEAR)",
        "Product": product_sql(vehicle),
        "ModelID": "o_orderpriority",
        "DealerCode": "'D' || CAST(l_suppkey AS STRING)",
        "JobCardStatus": "CASE WHEN o_orderkey % 29 = 0 THEN 'Canceled' WHEN o_orderkey % 31 = 0 THEN NULL "
        "WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END",
        **text,
    }


# Extra stand-in columns next to the raw feed.
LOAD_DAY = "CAST(date_trunc('quarter', l_shipdate + INTERVAL 20 YEAR) AS DATE)"
ORDER_MONTH = "CAST(date_trunc('month', o_orderdate + INTERVAL 20 YEAR) AS DATE)"

PARTS = {
    # Every sheet lacks some parts and repeats others under another name, so that there are parts to be missed.
    "sheets": [
        {"filter": "p_partkey % 3 <> 1"},
        {"filter": "p_partkey % 2 = 0"},
        {"filter": "p_partkey % 5 < 3"},
    ],
    "columns": {
        "Part No": "CASE WHEN p_partkey % 50 = 49 THEN NULL ELSE 'P' || CAST(p_partkey - p_partkey % 7 AS STRING) END",
        "Part Name": "p_name",
        "Part Group": "p_brand",
        "Part category": "lower(p_type)",
        "Category": "'size ' || CAST(p_size AS STRING)",
    },
}

DEALERS = {
    "Code": "CASE WHEN s_suppkey % 20 = 19 THEN NULL ELSE 'D' || CAST(s_suppkey - s_suppkey % 2 AS STRING) END",
    "CityCode": "'city ' || CAST(s_nationkey AS STRING)",
}

SALES = {
    "FirstName": "'first'",
    "LastName": "'last'",
    "DealerName": "'Dealer ' || CAST(o_custkey % 90 AS STRING)",
    "SalesOrderDate": "(o_orderdate + INTERVAL 20 YEAR)",
    "DealerCode": "'D' || CAST(o_custkey % 90 AS STRING)",
    "ModelID": "o_orderpriority",
    "ModelFamily": "o_orderstatus",
    "Product": product_sql("o_custkey"),
    "VehicleChassisNumber": chassis_sql("o_custkey"),
    "Zone": "'ZONE_' || CAST(o_custkey % 4 AS STRING)",
    "Region": "'REGION_' || CAST(o_custkey % 5 AS STRING)",
    "State": "'STATE_' || CAST(o_custkey % 25 AS STRING)",
    "City": "'CITY_' || CAST(o_custkey % 60 AS STRING)",
}

# Three generations of changes per part; half of them name two parts. The lists are spelled in several ways: other
# quotes, None far from its neighbours, None inside a text, a comma before the bracket.
CHANGES = {
    "PartDetails": "'[{''Part No'': ''P' || CAST(p_partkey AS STRING) || ''', ''Part Description'': ' || "
    "CASE WHEN p_partkey % 3 = 0 THEN '\"' || p_name || ', None, x\"' ELSE '''' || p_name || '''' END || '}' || "
    "CASE WHEN p_partkey % 2 = 0 THEN ',\n {''Part No'': ''P' || CAST(p_partkey + 1 AS STRING) || ''', ''Part Description'':             None         }' "
    "ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN ' , ]' ELSE ']' END",
    "PartDefectCode": "'DC' || CAST(p_partkey % 40 AS STRING)",
    "ApplicableModels": "'[''1-URGENT'', ''2-HIGH'', ''3-MEDIUM'', ''4-NOT SPECIFIED'']'",
    "MfgDate": "CAST(DATE '2016-01-01' + CAST(p_partkey % 365 + 700 * gen - 30 AS INT) AS DATE)",
    "Plant": "CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN 'TVT' WHEN 1 THEN 'ORG' ELSE 'VLM' END",
    "ModificationDetail": "'generation ' || CAST(gen AS STRING) || ' of ' || p_brand",
    "EffectiveDate": "CAST(DATE '2016-01-01' + CAST(p_partkey % 365 + 700 * gen AS INT) AS DATE)",
    "ReasonForChange": "p_type",
}

APPROVALS = {
    "PartDetailsNew": "'[''P' || CAST(p_partkey AS STRING) || ''', ''P' || CAST(p_partkey + 3 AS STRING) || ''']'",
    "ModelDetails": "'[''2-HIGH'', ''5-LOW'']'",
    "MfgDate": "CAST(DATE '2016-01-01' + CAST(p_partkey % 365 + 500 * gen AS INT) AS DATE)",
    "PPAPNumber": "'N' || CAST(p_partkey AS STRING) || '-' || CAST(gen AS STRING)",
    "PPAPTitle": "p_name",
    "PPAPType": "p_type",
    "PPAPStatus": "'Approved'",
    "PPAPPlant": "CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN 'TVT' WHEN 1 THEN 'ORG' ELSE 'VLM' END",
    "ProcessArea": "p_brand",
    "Purpose": "CAST(p_size AS STRING)",
}

ROADSIDE = {
    "CaseNo": "event_id",
    "IncidentDate": "CAST(ts AS DATE)",
    "VehicleChassisNumber": chassis_sql("user_id"),
    "Kilometers": "CAST(round(value * 100) AS BIGINT)",
    "TypeofIncident": "CASE WHEN event_type = 'error' THEN 'Engine ' || event_type WHEN event_id % 50 = 0 THEN NULL ELSE event_type END",
    "ServiceProvided": "CASE WHEN event_type = 'click' THEN 'two-way tow' WHEN event_type = 'view' THEN 'On spot' ELSE event_type END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def sql_list(columns: dict[str, str]) -> str:
    """The same projection as text for the oracle."""
    return ",\n  ".join(f'{sql} AS "{name}"' for name, sql in columns.items())


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)


def raw_job_cards(spark: SparkSession, sf_dir: str, part: str = "l_partkey", extra: dict[str, str] | None = None) -> DataFrame:
    split_rule_chains(spark)
    return project(_lines(spark, sf_dir), {**raw_job_cards_sql(part), **(extra or {})})


# Columns of the lines that no job card is made of.
UNUSED = ("l_discount", "o_totalprice", "p_partkey", "p_size", "p_retailprice")
# What the part lookups of ingestion join on.
LOOKUP_COLUMNS = ("PartNumber", "PrimaryPartNumber")


def job_card_lines(spark: SparkSession, sf_dir: str, part: str = "l_partkey") -> tuple[DataFrame, dict[str, Column]]:
    """The same job cards as their lines with the lookup columns, and the other feed columns as expressions over them."""
    columns = raw_job_cards_sql(part)
    lines = _lines(spark, sf_dir).drop(*UNUSED).withColumns({c: F.expr(columns[c]) for c in LOOKUP_COLUMNS})
    return lines, {name: F.expr(sql) for name, sql in columns.items() if name not in LOOKUP_COLUMNS}


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "orders"), SALES)


def part_sheets(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    parts = table(spark, sf_dir, "part")
    return [project(parts.filter(sheet["filter"]), PARTS["columns"]) for sheet in PARTS["sheets"]]


def dealers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "supplier"), DEALERS)


def _generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumn("gen", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))


def engineering_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_generations(spark, sf_dir), CHANGES)


def part_approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_generations(spark, sf_dir), APPROVALS)


def roadside_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), ROADSIDE)


def excluded_parts(spark: SparkSession, sf_dir: str, part: str = "l_partkey") -> DataFrame:
    """Exclude list; it holds a NULL to show that one does no harm."""
    rows = table(spark, sf_dir, "part")
    number = "'P' || CAST(p_partkey AS STRING)" if part == "l_partkey" else part
    wanted = "p_size <= 5 AND p_partkey % 10 < 9" if part == "l_partkey" else "p_size <= 5 AND p_type = 'SMALL'"
    return rows.select(F.expr(f"CASE WHEN {wanted} THEN {number} ELSE NULL END").alias("PartNo")).distinct()


# Labour codes: every part has one; the ones of scheduled services are also part numbers.
LABOUR = {
    "Labor code": "CASE WHEN p_size = 50 THEN 'P' ELSE 'L' END || CAST(p_partkey AS STRING)",
    "Labor description": "p_name",
}

# Visits by vehicle and brand; some lack the vehicle, some the part.
HISTORY = {
    "VehicleChassisNumber": "CASE WHEN o_custkey % 17 = 3 THEN NULL ELSE o_custkey END",
    "PartNumber": "CASE WHEN l_linenumber = 6 THEN NULL ELSE p_brand END",
    "JobCard": "l_orderkey",
    "CreatedOn": "CAST(l_shipdate AS DATE)",
    "Kilometers": "CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity * 700 AS BIGINT) END",
}


def labour_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "part"), LABOUR)


def visit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_lines(spark, sf_dir), HISTORY)
