"""Declared feeds: column names, types and reading rules. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

# Day a batch was loaded; tables are partitioned by it. Operators take its name
# as an argument, so tables that stamp the day under another name work as well.
RUN_DATE = "RunDate"


@dataclass(frozen=True)
class Feed:
    """One delimited feed: DDL in file order and the options it needs."""

    ddl: str
    multi_line: bool = False
    options: dict = field(default_factory=dict)


JOB_CARDS = Feed(
    """JobCard string, PartNumber string, LineAmount double, PartDescription string, ItemType string,
    Observation string, RequestedQuantity double, IssuedQuantityNew double, IsRepeated string,
    PartDefectID string, PartDefectCode string, PrimaryConsequential string, PrimaryPart string,
    PrimaryPartNumber string, PartAction string, StatusReason string, CreatedOnDateTime timestamp_ntz,
    CustomerComplaint string, CustomerVoice string, CashierInvoicingDateTime timestamp_ntz, Region string,
    RegistrationNumber string, VehicleChassisNumber string, JobType string, JobSubType string,
    Kilometers double, State string, Zone string, City string, DealerName string, FinalCustomer string,
    BillType string, DateofSale timestamp_ntz, Product string, RepairCategory string, PartBatchCode string,
    ModelID string, DealerCode string, FieldObservationReport string, TechnicalObservation string,
    ComplaintObservedByDealer string, CorrectiveActiontaken string, JobCardStatus string""",
    multi_line=True,
)

SALES = Feed(
    """FirstName string, LastName string, DealerName string, SalesOrderDate timestamp_ntz, DealerCode string,
    ModelID string, ModelFamily string, Product string, VehicleChassisNumber string, Zone string,
    Region string, State string, City string"""
)

PART_SHEET = Feed("`Part No` string, `Part Name` string, `Part Group` string, `Part category` string, Category string")

PART_MASTER = Feed(
    "PartNumber string, PartName string, PartGroup string, PartVariant string, PartCategory string, ModelType string"
)

DEALERS = Feed("Code string, CityCode string")

IGNORE_LIST = Feed("`Part No` string, `Part Description` string, `Repeat/Repair Service` string")

LABOUR_CODES = Feed("`Labor code` string, `Labor description` string")

EXCLUDE_LIST = Feed("PartNumber string, PartDescription string")

ENGINEERING_CHANGES = Feed(
    """PartDetails string, PartDefectCode string, ApplicableModels string, MfgDate date, Plant string,
    ModificationDetail string, EffectiveDate date, ReasonForChange string""",
    multi_line=True,
)

PART_APPROVALS = Feed(
    """PartDetailsNew string, ModelDetails string, MfgDate date, PPAPNumber string, PPAPTitle string,
    PPAPType string, PPAPStatus string, PPAPPlant string, ProcessArea string, Purpose string""",
    multi_line=True,
)

FEEDS = {
    "job_cards": JOB_CARDS,
    "sales": SALES,
    "part_sheet": PART_SHEET,
    "part_master": PART_MASTER,
    "dealers": DEALERS,
    "ignore_list": IGNORE_LIST,
    "labour_codes": LABOUR_CODES,
    "exclude_list": EXCLUDE_LIST,
    "engineering_changes": ENGINEERING_CHANGES,
    "part_approvals": PART_APPROVALS,
}


def names(feed: str) -> list[str]:
    """Column names of a feed in file order."""
    return [column.split()[0] for column in FEEDS[feed].ddl.replace("\n", " ").split(",")]


# Job-card table after ingestion, in table order (the run day comes on top).
JOB_CARD_TABLE = [
    "JobCard", "PartNumber", "LineAmount", "PartDescription", "ItemType", "Observation", "RequestedQuantity",
    "IssuedQuantityNew", "IsRepeated", "PartDefectID", "PartDefectCode", "PrimaryConsequential", "PrimaryPart",
    "PrimaryPartNumber", "PartAction", "StatusReason", "CreatedOnDateTime", "CustomerComplaint", "CustomerVoice",
    "CashierInvoicingDateTime", "Region", "RegistrationNumber", "VehicleChassisNumber", "JobType", "JobSubType",
    "Kilometers", "State", "Zone", "DealerName", "FinalCustomer", "BillType", "DateofSale", "Product",
    "RepairCategory", "PartBatchCode", "ModelID", "DealerCode", "FieldObservationReport", "TechnicalObservation",
    "ComplaintObservedByDealer", "CorrectiveActiontaken", "JobCardStatus", "CreatedOn", "CreatedOnYear",
    "CreatedOnMonth", "Model", "ModelType", "ModelName", "Plant", "MfgMonth", "MfgYear", "MfgDate", "Country",
    "KmsGroup", "PartGroup", "PartVariant", "PartCategory", "PrimaryPartNew", "PrimaryPartFilter", "PartFilter",
    "PrimaryPartGroup", "City",
]

# Columns the use-case tables keep from a job card.
RELATIONSHIP_COLUMNS = [
    "VehicleChassisNumber", "JobCard", "CreatedOn", "PartNumber", "PartDescription", "JobSubType", "BillType",
    "PrimaryPartNumber", "PartGroup", "PrimaryPartNew", "PrimaryPartGroup", "Zone", "Region", "State", "DealerCode",
    "DealerName", "City", "ModelType", "Model", "Kilometers", "KmsGroup", "Plant", "MfgMonth", "MfgYear",
    "CreatedOnYear", "CreatedOnMonth",
]

VISIT_COLUMNS = [
    "VehicleChassisNumber", "JobCard", "PartNumber", "PartDescription", "ItemType", "PartAction", "PartGroup",
    "PartVariant", "PartCategory", "PartDefectCode", "JobSubType", "BillType", "CustomerComplaint", "Zone", "Region",
    "State", "DealerCode", "DealerName", "City", "Kilometers", "KmsGroup", "CreatedOn", "Model", "ModelType",
    "ModelName", "DateofSale", "Plant", "MfgMonth", "MfgYear", "CreatedOnYear", "CreatedOnMonth",
]

REPEAT_COLUMNS = [
    "VehicleChassisNumber", "CreatedOn", "JobCard", "PartNumber", "PartDescription", "ItemType", "PartAction",
    "PartGroup", "PartVariant", "PartCategory", "PartDefectCode", "JobSubType", "JobCardStatus", "BillType",
    "IssuedQuantityNew", "CustomerComplaint", "Zone", "Region", "State", "DealerCode", "DealerName", "City",
    "Kilometers", "KmsGroup", "Model", "ModelType", "Plant", "MfgMonth", "MfgYear", "CreatedOnYear", "CreatedOnMonth",
]

CHANGE_FACT_COLUMNS = [
    "VehicleChassisNumber", "JobCard", "Zone", "Region", "State", "DealerName", "DealerCode", "City", "CreatedOn",
    "PartNumber", "PartDescription", "PartGroup", "PartDefectCode", "BillType", "ModelID", "ModelType", "Kilometers",
    "KmsGroup", "MfgMonth", "MfgYear", "MfgDate", "Plant",
]

COST_COLUMNS = [
    "VehicleChassisNumber", "JobCard", "PartNumber", "ItemType", "PrimaryConsequential", "PartDescription",
    "PartGroup", "PartCategory", "PartVariant", "Zone", "Region", "State", "DealerName", "DealerCode", "City",
    "Model", "ModelType", "Plant", "MfgMonth", "MfgYear", "LineAmount",
]
# What the filter of the warranty use case reads besides.
COST_FILTER_COLUMNS = ["Country", "PartAction", "BillType", "MfgDate", "CreatedOn"]
