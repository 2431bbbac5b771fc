"""Fixed values of the domain: code letters, labels, bands and word lists."""

# Platform letter, 4th character of the chassis code.
MODEL_TYPES = {"U": "UCE", "D": "HIMALAYAN", "P": "TWINS"}

# Displacement digit, 5th character of the chassis code.
DISPLACEMENTS = {"3": "350", "4": "410", "5": "500", "6": "535", "7": "650"}

# Plant digit.
PLANTS = {"0": "TVT", "1": "ORG", "2": "VLM"}

# Month letter.
MFG_MONTHS = {
    "A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6,
    "G": 7, "H": 8, "K": 9, "L": 10, "M": 11, "N": 12,
}

# Year letter.
MFG_YEARS = {
    "A": 2010, "B": 2011, "C": 2012, "D": 2013, "E": 2014, "F": 2015, "G": 2016,
    "H": 2017, "J": 2018, "K": 2019, "L": 2020, "M": 2021, "N": 2022, "O": 2023,
}
UNKNOWN_MONTH = 1
UNKNOWN_YEAR = 1900
UNKNOWN = "NA"
CHASSIS_LENGTH = 17
JOB_CARD_LENGTH = 16

# Odometer bands: (upper bound in km, label); the first band starts at 0.
KMS_BANDS = [
    (500, "(A) 0 - 500"),
    (3000, "(B) 500 - 3000"),
    (5000, "(C) 3000 - 5000"),
    (10000, "(D) 5000 - 10000"),
    (15000, "(E) 10000 - 15000"),
    (20000, "(F) 15000 - 20000"),
    (25000, "(G) 20000 - 25000"),
    (30000, "(H) 25000 - 30000"),
]
KMS_ABOVE = "(I) 30000 & Above"

# Service schedule: (label, upper km, upper days); the last label is open-ended.
SERVICE_LABELS = [
    "Before Service-1",
    "Between Service-1 & Service-2",
    "Between Service-2 & Service-3",
    "Between Service-3 & Service-4",
    "After Service-4",
]
SERVICE_650 = {"models": ["INTERCEPTOR 650", "CONTINENTAL 650"], "kms": [800, 10500, 20600, 30700], "days": [75, 405, 780, 1145]}
SERVICE_OTHER = {"kms": [800, 5500, 10600, 15700], "days": [75, 220, 410, 590]}

# Age of the vehicle at the visit: (upper bound in days, label); first band starts at 0.
AGE_BANDS = [
    (90, "(A) 0 - 3 Months"),
    (365, "(B) 3 - 12 Months"),
    (730, "(C) 12 - 24 Months"),
    (1095, "(D) 24 - 36 Months"),
]
AGE_ABOVE = "(E) 36 Months & Above"

# Model tokens that never enter an analysis.
REJECTED_MODELS = ["U", "NA", "MACHISMO", "", "TAURUS", "ROYAL", "DSW"]

# Visits that are not repairs.
NON_REPAIR_VISITS = ["ACCIDENTAL", "PDI"]

# Model types a part-master sheet applies to, by sheet position.
SHEET_MODEL_TYPES = [["UCE", "HIMALAYAN"], ["METEOR", "NEW CLASSIC"], ["TWINS"]]

# Failure-frequency and engine-opening horizons in days since sale.
FF_HORIZONS = {"FF1": 30, "FF3": 90, "FF6": 180, "FF12": 360, "FF18": 540, "FF24": 720, "FF30": 900, "FF36": 1080}
EO_HORIZONS = {"EOFirstYear": 365, "EOSecondYear": 730, "EOThirdYear": 1095}
MATURE_SHARE = 0.95
MATURED = "Matured"
NOT_MATURED = "NotMatured"
