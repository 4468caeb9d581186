"""Inline lookup tables (operator S3) and fixed vocabularies.

Every table here is a literal of known, small size, so joining it with
``F.broadcast`` is safe at any data scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the survey vendor's / dashboard's vocabulary
# for results to match; they are data, kept here in their natural order.
# ---------------------------------------------------------------------------

# Sentinel labels written into data columns by the roll-ups and fallbacks.
ALL_UNITS = "All Units"
ALL_SERVICE_LINES = "All Service Lines"
ALL_GROUPS = "All Groups"
NULL_UNIT = "Null Unit"
UNKNOWN = "Unknown"
OTHER = "Other"
NOT_SPECIFIED = "Not Specified"

# 0-10 rating answers banded into five response groups (highest first).
RATING_BANDS = [
    ("Very Good", ["10-Best possible", "10-Best hosp", "9"]),
    ("Good", ["7", "8"]),
    ("Average", ["5", "6"]),
    ("Poor", ["3", "4"]),
    ("Very Poor", ["0-Worst possible", "0-Worst hosp", "1", "2"]),
]

# 1-5 answers and their response-group labels.
FIVE_POINT_LABELS = [
    ("5", "Very Good"),
    ("4", "Good"),
    ("3", "Average"),
    ("2", "Poor"),
    ("1", "Very Poor"),
]

# Scales of the survey types: top answers, best answer, response groups, and
# whether answers outside the groups have none (closed) or stay as they are.
HOSPITAL_BANDS = [
    ("Very Good", ["10-Best possible", "9"]),
    ("Good", ["7", "8"]),
    ("Average", ["5", "6"]),
    ("Poor", ["3", "4"]),
    ("Very Poor", ["0-Worst possible", "1", "2"]),
]
PROVIDER_BANDS = [
    ("Very Good", ["10-Best provider", "9"]),
    ("Good", ["7", "8"]),
    ("Average", ["5", "6"]),
    ("Poor", ["3", "4"]),
    ("Very Poor", ["0-Worst provider", "1", "2"]),
]
SCALES = {
    "1-5": (["5"], "Very Good", None, False),
    "child 0-10": (["10-Best possible", "10-Best hosp", "9"], "10-Best possible", RATING_BANDS, True),
    "hospital 0-10": (["10-Best possible", "9"], "10-Best possible", HOSPITAL_BANDS, True),
    "provider 0-10": (["10-Best provider", "9"], "10-Best provider", PROVIDER_BANDS, True),
    "always": (["Always"], "Always", None, False),
    "yes": (["Yes"], "Yes", None, False),
    "yes definitely": (["Yes, definitely"], "Yes, definitely", None, False),
    "recommend": (["Definitely Yes"], "Definitely Yes", None, False),
    "agree": (["Strongly Agree"], "Strongly Agree", None, False),
    "none": ([], None, None, False),
}

# Domains left out of the monthly reports.
EXCLUDED_REPORT_DOMAINS = ["Meals", "Overall Assessment", "Pediatric ICU/CCU", "Personal Issues"]

# Goal-file domain name -> response domain name.
GOAL_DOMAIN_TRANSLATION = [
    ("Child Care in ER", "Child's Care in ER"),
    ("Child's care in ER", "Child's Care in ER"),
    ("Comm Child's Doctor", "Comm You Child's Doctor"),
    ("Comm Child's Med", "Communication Child's Med"),
    ("Comm Child's Nurse", "Comm You Child's Nurse"),
    ("Doctor Comm Child", "Doctors Communicate Child"),
    ("Doctors Comm Child", "Doctors Communicate Child"),
    ("Help Child Feel Comfortable", "Help Child Feel Comfortab"),
    ("Nurse Comm Child", "Nurses Communicate Child"),
    ("Nurses Comm Child", "Nurses Communicate Child"),
    ("Overall Rating", "Rate Hospital"),
    ("Prepare Child Leave Hospital", "Prepare Child Leave Hosp"),
    ("Prevent Mistakes RPT Conc", "Prevent Mistakes Rpt Conc"),
    ("Resp to Call Bell", "Response to Call Button"),
]

# Child-survey constants written onto every unit-extract row.
CHILD_SERVICE_LINE_ID = 11
CHILD_SERVICE_LINE = "Womens and Childrens"
CHILD_SUB_SERVICE_LINE = "Children"

# ---------------------------------------------------------------------------
# Test-data configuration (our fixtures, see FIXTURES.md). Question ids 1..7
# stand in for the vendor's ids.
# ---------------------------------------------------------------------------

AGE_QUESTION = 6
UNIT_QUESTION = 7

# question_id, varname, question_text, alias, domain, scale, top answers,
# top-box label, goal-domain override, order
QUESTION_RULES = [
    (1, "CH_1", "Nurses listened carefully", "Nurse listened", "Nurses Communicate Child",
     "1-5", ["5"], "Very Good", None, 1),
    (2, "CH_2", "Rate this hospital 0-10", "Rate hospital", "Global",
     "0-10", ["10-Best possible", "10-Best hosp", "9"], "10-Best possible", "Rate Hospital", 2),
    (3, "CH_3", "Room was quiet at night", "Quiet room", "Environment",
     "always", ["Always"], "Always", None, 3),
    (4, "CH_4", "Told what to do at home", "Home instructions", "Prepare Child Leave Hosp",
     "yes-definitely", ["Yes, definitely"], "Yes, definitely", None, 4),
    (5, "CH_5", "Would recommend the hospital", "Recommend", "Global",
     "recommend", ["Definitely Yes"], "Definitely Yes", "Recommend", 5),
    (6, "AGE", "Patient age", "Age", None, None, None, None, None, 6),
    (7, "UNIT", "Unit of stay", "Unit", None, None, None, None, None, 7),
]

# Survey types and the service whose answers they are.
CHILD, ADULT, CLINIC, CHILD_LINE = "child", "adult", "clinic", "child by line"
SERVICE_OF_TYPE = {CHILD: "PD", ADULT: "IN", CLINIC: "MD", CHILD_LINE: "PD"}

# survey type, question, scale, domain, goal-domain override
SURVEY_RULES = [
    (CHILD, 1, "1-5", "Nurses Communicate Child", None),
    (CHILD, 2, "child 0-10", "Global", "Rate Hospital"),
    (CHILD, 3, "always", "Environment", None),
    (CHILD, 4, "yes definitely", "Prepare Child Leave Hosp", None),
    (CHILD, 5, "recommend", "Global", "Recommend"),
    (CHILD, 6, "none", None, None),
    (CHILD, 7, "none", None, None),
    (ADULT, 1, "1-5", "Nurses Communicate Child", None),
    (ADULT, 2, "hospital 0-10", "Global", "Rate Hospital"),
    (ADULT, 3, "always", "Environment", "Quietness"),
    (ADULT, 4, "yes", "Prepare Child Leave Hosp", None),
    (ADULT, 5, "agree", "Global", "Recommend"),
    (ADULT, 6, "none", None, None),
    (ADULT, 7, "none", None, None),
    (CLINIC, 1, "1-5", "Nurses Communicate Child", None),
    (CLINIC, 2, "provider 0-10", "Overall Assessment", "Overall Doctor Rating 0-10"),
    (CLINIC, 3, "always", "Environment", None),
    (CLINIC, 4, "yes", "Prepare Child Leave Hosp", None),
    (CLINIC, 5, "yes definitely", "Overall Assessment", "Recommend Provider"),
    (CLINIC, 6, "none", None, None),
    # the inline domain table of the child surveys by line and by unit
    (CHILD_LINE, 1, "1-5", "Nurses Communicate Child", None),
    (CHILD_LINE, 2, "hospital 0-10", "Global Rating Item", None),
    (CHILD_LINE, 3, "always", "Hospital Environment", "Quietness"),
    (CHILD_LINE, 4, "yes definitely", "Prepare Child Leave Hosp", None),
    (CHILD_LINE, 5, "recommend", "Global Rating Item", None),
    (CHILD_LINE, 6, "none", None, None),
    (CHILD_LINE, 7, "none", None, None),
]

# Question dimension by service (varnames differ by the service's own survey).
SERVICE_QUESTIONS = [(q, service, varname) for service in ("PD", "IN", "MD")
                     for q, varname in ((1, "CH_1"), (2, "CH_2"), (3, "CH_3"), (4, "CH_4"), (5, "CH_5"), (6, "AGE"), (7, "UNIT"))]

RULES_SCHEMA = T.StructType([
    T.StructField("question_id", T.IntegerType(), False),
    T.StructField("varname", T.StringType(), False),
    T.StructField("question_text", T.StringType(), True),
    T.StructField("question_text_alias", T.StringType(), True),
    T.StructField("domain", T.StringType(), True),
    T.StructField("scale", T.StringType(), True),
    T.StructField("top_values", T.ArrayType(T.StringType()), True),
    T.StructField("top_label", T.StringType(), True),
    T.StructField("domain_override", T.StringType(), True),
    T.StructField("question_order", T.IntegerType(), True),
])

# Response department -> goal department, per fiscal year.
DEPARTMENT_TRANSLATION = [
    (1997, "10000005", "10000004"),
    (1997, "10000009", "10000008"),
    (1998, "10000013", "10000012"),
    (1999, "10000021", "10000020"),
]

# Survey unit label -> department id and service line (J4); U6 only via
# override, U7 unmapped.
UNIT_MAPPING = [
    ("U0", "10000003", "AFRICA"),
    ("U1", "10000010", "AMERICA"),
    ("U2", "10000021", "ASIA"),
    ("U3", "10000034", "EUROPE"),
    ("U4", "10000047", "MIDDLE EAST"),
    ("U5", "10000058", "AMERICA"),
]
# Unit labels whose department is fixed by hand, ahead of the mapping.
UNIT_OVERRIDES = [("U6", "10000066"), ("U1", "10000011")]
# Closed unit: its answers keep the encounter's department.
CLOSED_UNIT = "U5"
# Unit alias recode (closed/renamed units -> current label).
UNIT_ALIASES = [("U4", "U3"), ("U7", "U6")]

# department_id -> (group id, group name) (J14); all others -> 0 / Other.
DEPARTMENT_GROUPS = [
    ("10000001", 1, "Surgery"),
    ("10000002", 1, "Surgery"),
    ("10000005", 2, "Medicine"),
    ("10000008", 2, "Medicine"),
    ("10000012", 3, "Peds"),
    ("10000017", 3, "Peds"),
]


def lookup(spark: SparkSession, rows, schema) -> DataFrame:
    """S3: an inline VALUES table, marked for broadcast (its size is fixed)."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def rules(spark: SparkSession) -> DataFrame:
    return lookup(spark, QUESTION_RULES, RULES_SCHEMA)


def survey_rules(spark: SparkSession) -> DataFrame:
    """Scales and domains by (survey type, question), with texts of the question."""
    texts = {q[0]: q[2:4] for q in QUESTION_RULES}
    rows = []
    for survey_type, question, scale, domain, override in SURVEY_RULES:
        top, best, bands, closed = SCALES[scale]
        groups = {a: label for label, answers in bands for a in answers} if bands else dict(FIVE_POINT_LABELS)
        rows.append((survey_type, question, *texts[question], domain, override, top, best, groups, closed))
    return lookup(spark, rows, "survey_type string, question_id int, question_text string, question_text_alias string, domain string, "
                               "domain_override string, top_values array<string>, top_label string, groups map<string,string>, closed boolean")


def service_questions(spark: SparkSession) -> DataFrame:
    return lookup(spark, SERVICE_QUESTIONS, "question_id int, service_code string, varname string")


def domain_translation(spark: SparkSession) -> DataFrame:
    return lookup(spark, GOAL_DOMAIN_TRANSLATION, "goals_domain string, domain string")


def department_translation(spark: SparkSession) -> DataFrame:
    return lookup(spark, DEPARTMENT_TRANSLATION,
                  "goal_fiscal_yr int, response_department_id string, goal_department_id string")


def unit_mapping(spark: SparkSession) -> DataFrame:
    return lookup(spark, UNIT_MAPPING, "unit_name string, department_id string, service_line string")


def unit_overrides(spark: SparkSession) -> DataFrame:
    return lookup(spark, UNIT_OVERRIDES, "unit_name string, department_id string")


def unit_aliases(spark: SparkSession) -> DataFrame:
    return lookup(spark, UNIT_ALIASES, "unit_name string, current_unit string")


def department_groups(spark: SparkSession) -> DataFrame:
    return lookup(spark, DEPARTMENT_GROUPS, "department_id string, group_id int, group_name string")

# Goal-department overrides (R2): unit whose goals sit under another
# department key; surveys without a unit from one department.
GOAL_UNIT_KEYS = {"U2": 40}
GOAL_NO_UNIT_KEYS = {7: 8}
GOAL_UNIT_ALIASES = UNIT_ALIASES + [("U2", "U3")]


def goal_unit_aliases(spark: SparkSession) -> DataFrame:
    return lookup(spark, GOAL_UNIT_ALIASES, "unit_name string, current_unit string")

# Adult extract: unit reported under the child line whatever the mapping
# says (V19), display recode of one unit label, and the flagged sample.
ADULT_SPECIAL_UNIT = "U6"
NO_UNIT = "No Unit"
ALL_CLINICS = "All Clinics"
FLAT_GOAL, FLAT_GOAL_YEAR = "0.750", 2018
ADULT_DISPLAY_RECODE = ("U0", "U0-SSU")
FLAG_VARNAME = "CH_4"
FLAG_VALUE = "No"
