"""Parameters of the two domains: tax-return quality and grant-application rules.

Everything that changes the result of a query lives here as plain data, so a
caller can override it per run (``dataclasses.replace``) instead of editing code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — these must stay equal to the behaviour being reproduced
# (validation patterns, bounds, weights, thresholds, keyword lists, postal
# districts, placeholder strings, rule catalogue).  Listed in natural order.
# ---------------------------------------------------------------------------

NRIC_PATTERN = r"^[STFG]\d{7}[A-Z]$"
POSTAL_PATTERN = r"^\d{6}$"
POSTAL_MIN = 10000
POSTAL_MAX = 829999
TAX_TOLERANCE = 0.1
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DMY_DATE_PATTERN = r"^\d{1,2}/\d{1,2}/\d{4}$"

SCORE_WEIGHTS = {
    "nric": 0.25,
    "postal_code": 0.15,
    "filing_date": 0.20,
    "tax_calculation": 0.15,
    "cpf": 0.10,
    "completeness": 0.15,
}
ACCEPT_THRESHOLD = 0.8
QUARANTINE_THRESHOLD = 0.6

# The 18 input columns of a tax-return file, with their types, in file order.
TAX_COLUMNS = [
    ("taxpayer_id", "string"),
    ("nric", "string"),
    ("full_name", "string"),
    ("filing_status", "string"),
    ("assessment_year", "int"),
    ("filing_date", "string"),
    ("annual_income_sgd", "double"),
    ("chargeable_income_sgd", "double"),
    ("tax_payable_sgd", "double"),
    ("tax_paid_sgd", "double"),
    ("total_reliefs_sgd", "double"),
    ("number_of_dependents", "int"),
    ("occupation", "string"),
    ("residential_status", "string"),
    ("postal_code", "string"),
    ("housing_type", "string"),
    ("cpf_contributions_sgd", "double"),
    ("foreign_income_sgd", "double"),
]

# Occupation category -> keywords, first matching category wins (order matters).
OCCUPATION_CATEGORIES = [
    ("Engineering", ["Engineer", "Developer", "Software", "Network", "Systems", "DevOps",
                     "Cybersecurity", "Ux Designer", "Ui Designer", "Technical Lead",
                     "Technical Architect"]),
    ("Management", ["Manager", "Director", "Senior", "VP", "Managing"]),
    ("Healthcare", ["Doctor", "Nurse", "Medical"]),
    ("Finance", ["Accountant", "Finance", "Investment", "Banker"]),
    ("Sales", ["Sales", "Marketing"]),
    ("Operations", ["Operations", "Support", "Administrative", "Customer Service"]),
    ("Consulting", ["Consultant", "Analyst", "Business Analyst", "Data Analyst"]),
    ("Legal", ["Legal", "Counsel"]),
    ("Education", ["Teacher", "Education"]),
    ("Research", ["Research", "Scientist"]),
]
OTHER_CATEGORY = "Other"

# Postal districts: (district, area, two-digit postal prefixes, region).
POSTAL_DISTRICTS = [
    (1, "Raffles Place, Marina, Cecil, People’s Park", ["01", "02", "03", "04", "05", "06"], "Central"),
    (2, "Anson, Tanjong Pagar", ["07", "08"], "Central"),
    (3, "Queenstown, Tiong Bahru", ["14", "15", "16"], "Central"),
    (4, "Telok Blangah, Harbourfront", ["09", "10"], "Central"),
    (5, "Pasir Panjang, Hong Leong Garden, Clementi New Town", ["11", "12", "13"], "West"),
    (6, "High Street, Beach Road (part)", ["17"], "Central"),
    (7, "Middle Road, Golden Mile", ["18", "19"], "Central"),
    (8, "Little India", ["20", "21"], "Central"),
    (9, "Orchard, Cairnhill, River Valley", ["22", "23"], "Central"),
    (10, "Ardmore, Bukit Timah, Holland Road, Tanglin", ["24", "25", "26", "27"], "Central"),
    (11, "Watten Estate, Novena, Thomson", ["28", "29", "30"], "Central"),
    (12, "Balestier, Toa Payoh, Serangoon", ["31", "32", "33"], "Central"),
    (13, "Macpherson, Braddell", ["34", "35", "36", "37"], "Central"),
    (14, "Geylang, Eunos", ["38", "39", "40", "41"], "Central"),
    (15, "Katong, Joo Chiat, Amber Road", ["42", "43", "44", "45"], "East"),
    (16, "Bedok, Upper East Coast, Eastwood, Kew Drive", ["46", "47", "48"], "East"),
    (17, "Loyang, Changi", ["49", "50", "81"], "East"),
    (18, "Tampines, Pasir Ris", ["51", "52"], "East"),
    (19, "Serangoon Garden, Hougang, Sengkang, Punggol", ["53", "54", "55", "82"], "North-East"),
    (20, "Bishan, Ang Mo Kio", ["56", "57"], "North-East"),
    (21, "Upper Bukit Timah, Clementi Park, Ulu Pandan", ["58", "59"], "Central"),
    (22, "Jurong", ["60", "61", "62", "63", "64"], "West"),
    (23, "Hillview, Dairy Farm, Bukit Panjang, Choa Chu Kang", ["65", "66", "67", "68"], "West"),
    (24, "Lim Chu Kang, Tengah", ["69", "70", "71"], "North"),
    (25, "Krangi, Woodgrove, Woodlands", ["72", "73"], "North"),
    (26, "Upper Thomson, Springleaf", ["77", "78"], "Central"),
    (27, "Yishun, Sembawang", ["75", "76"], "North"),
    (28, "Seletar", ["79", "80"], "North-East"),
]

# Grant-application rules.
DQ_DIMENSIONS = ["Completeness", "Uniqueness", "Validity", "Conformity", "Consistency", "Timeliness"]
GRANT_STATUSES = ["Pending", "Approved", "Rejected"]
GRANT_SCHEMES = ["EDUCATION BURSARY", "HEALTHCARE SUBSIDY", "SKILLS UPGRADING GRANT"]
# Substrings that mark a placeholder value (rule V007, upper-cased contains).
PLACEHOLDER_SUBSTRINGS = ["NOT_A_DATE", "INVALID_DATE", "INVALID_NRIC", "NULL", "N/A", "NA"]
# Whole values that the flexible date parser treats as "no date".
DATE_PLACEHOLDERS = ["NOT_A_DATE", "INVALID_DATE", "NULL", "N/A", "NA"]
SLA_DAYS = 30
MAX_AGE_YEARS = 5
DATASET_NAME = "grant_applications"

# Rule catalogue: (rule_id, rule_name, dimension).  The {sla}/{years} fields are
# filled from the run parameters.
RULE_CATALOGUE = [
    ("C001", "application_id is not null/empty", "Completeness"),
    ("C002", "application_date is not null/empty", "Completeness"),
    ("C003", "application_status is not null/empty", "Completeness"),
    ("C004", "requested_amount is not null", "Completeness"),
    ("C005", "approved_amount is not null when Approved", "Completeness"),
    ("C006", "decision_date is not null when Approved/Rejected", "Completeness"),
    ("U001", "application_id is unique", "Uniqueness"),
    ("U002", "No exact duplicate rows", "Uniqueness"),
    ("V001", "citizen_nric matches NRIC format", "Validity"),
    ("V002", "household_income in valid range", "Validity"),
    ("V003", "requested_amount >= 0", "Validity"),
    ("V004", "approved_amount >= 0 when not null", "Validity"),
    ("V005", "household_size in valid range (1-20)", "Validity"),
    ("V006", "approved_amount only when Approved", "Validity"),
    ("V007", "No placeholder values", "Validity"),
    ("CF001", "decision_date follows YYYY-MM-DD format", "Conformity"),
    ("CF002", "application_date is ISO or canonicalizable", "Conformity"),
    ("CF003", "application_status matches canonical values", "Conformity"),
    ("CF004", "grant_scheme_name matches catalog", "Conformity"),
    ("CS001", "decision_date >= application_date", "Consistency"),
    ("CS002", "approved_amount <= requested_amount when Approved", "Consistency"),
    ("CS003", "decision_date NULL when Pending", "Consistency"),
    ("CS004", "decision_date NOT NULL when Approved/Rejected", "Consistency"),
    ("T001", "decision_lag <= {sla} days", "Timeliness"),
    ("T002", "application_date not > {years} years old", "Timeliness"),
]

# The 10 expected columns of a grant-application file (dates read as text).
GRANT_COLUMNS = [
    ("application_id", "string"),
    ("citizen_nric", "string"),
    ("grant_scheme_name", "string"),
    ("household_income", "double"),
    ("household_size", "int"),
    ("application_date", "string"),
    ("application_status", "string"),
    ("requested_amount", "double"),
    ("approved_amount", "double"),
    ("decision_date", "string"),
]

# ---------------------------------------------------------------------------
# Run parameters (overridable)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TaxParams:
    nric_pattern: str = NRIC_PATTERN
    nric_allow_empty: bool = False
    postal_pattern: str = POSTAL_PATTERN
    postal_min: int = POSTAL_MIN
    postal_max: int = POSTAL_MAX
    tax_tolerance: float = TAX_TOLERANCE
    cpf_non_resident_must_be_zero: bool = True
    iso_pattern: str = ISO_DATE_PATTERN
    dmy_pattern: str = DMY_DATE_PATTERN
    weights: dict = field(default_factory=lambda: dict(SCORE_WEIGHTS))
    accept_threshold: float = ACCEPT_THRESHOLD
    quarantine_threshold: float = QUARANTINE_THRESHOLD
    occupation_categories: tuple = tuple((c, tuple(k)) for c, k in OCCUPATION_CATEGORIES)
    # "return": one fact row per return (dimensions resolved on their full
    # natural key); "reference": resolve on the single documented key, which
    # fans out when that key is not unique in the dimension.
    fact_grain: str = "return"

    def __post_init__(self):
        total = sum(self.weights.values())
        if not 0 <= total <= 9.99:
            raise ValueError(f"score weights must sum to a value in [0, 9.99], got {total}")
        if self.fact_grain not in ("return", "reference"):
            raise ValueError("fact_grain must be 'return' or 'reference'")


@dataclass(frozen=True)
class DQParams:
    sla_days: int = SLA_DAYS
    max_age_years: int = MAX_AGE_YEARS
    dataset_name: str = DATASET_NAME
    dataset_version: str | None = None
    # Reference point for "age" rules; None = current time at run start.
    as_of: str | None = None
