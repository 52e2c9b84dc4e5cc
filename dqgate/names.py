"""Fixed names shared by configuration files, results and reports."""

from __future__ import annotations

# Names of the configured checks.
ROW_COUNT = "RowCount"
SOURCE_DESTINATION = "SourceDestinationRowcountResult"
UNEXPECTED = "UnExpectedList"
UNIQUE = "UniqueCheck"
NULL = "NullCheck"
FOREIGN_KEY = "ForeignKeyCheck"
SLA = "SLACheck"
PRE_POST = "PrePostRowcountCheck"
KPI_RESULT = "KPIResultCheck"

# Stage names.
STAGE_BRONZE = "Bronze data check"
STAGE_SILVER = "Silver data check"
STAGE_GOLD = "Gold data check"
STAGE_SYNAPSE = "Synapse data check"
STAGE_PRE_POST = "Pre and post runs rowcount check"
STAGE_KPI = "KPI data check"

# Layers and location types.
BRONZE = "Bronze"
SILVER = "Silver"
GOLD = "Gold"
LOCATION_PATH = "ADLS"
LOCATION_CATALOG = "ADB_SQL"
LOCATION_WAREHOUSE = "Synapse"

# Accepted change between two results, in percent.
UPPER_LIMIT_PCT = 20
LOWER_LIMIT_PCT = 5

# Fixed value: days of audit history kept.
RETENTION_DAYS = 35

PASS = "Pass"
FAIL = "Fail"
ERROR = "Error"

# Check families: which rule set a configuration row belongs to.
FAMILY_ROW_COUNT = "row_count"
FAMILY_QUALITY = "data_quality"
FAMILY_PRE_POST = "pre_post"
FAMILY_KPI = "kpi"

# Result categories as they appear in summaries and reports.
CAT_ROW_COUNT = "Row Count"
CAT_SOURCE_DESTINATION = "Source Destination Row Count"
CAT_NULL = "Null Column Validation"
CAT_UNIQUE = "Duplicates Validation"
CAT_UNEXPECTED = "Unexpected list Validation"
CAT_FOREIGN_KEY = "Foreign Key Validation"
CAT_SLA = "SLA Check Validation"
CAT_PRE_POST = "Pre Post Runs"
CAT_KPI_PRE_POST = "Pre-Post Run"
CAT_KPI_SOURCE_DESTINATION = "Source Destination"
CAT_KPI_RESULT = "KPI"

CATEGORY_OF = {
    (FAMILY_ROW_COUNT, ROW_COUNT): CAT_ROW_COUNT,
    (FAMILY_ROW_COUNT, SOURCE_DESTINATION): CAT_SOURCE_DESTINATION,
    (FAMILY_QUALITY, NULL): CAT_NULL,
    (FAMILY_QUALITY, UNIQUE): CAT_UNIQUE,
    (FAMILY_QUALITY, UNEXPECTED): CAT_UNEXPECTED,
    (FAMILY_QUALITY, FOREIGN_KEY): CAT_FOREIGN_KEY,
    (FAMILY_QUALITY, SLA): CAT_SLA,
    (FAMILY_PRE_POST, PRE_POST): CAT_PRE_POST,
    (FAMILY_KPI, PRE_POST): CAT_KPI_PRE_POST,
    (FAMILY_KPI, SOURCE_DESTINATION): CAT_KPI_SOURCE_DESTINATION,
    (FAMILY_KPI, KPI_RESULT): CAT_KPI_RESULT,
}

# Aggregate names a configuration may use for a KPI on a path.
KPI_AGGREGATES = (
    "sum",
    "count",
    "avg",
    "min",
    "max",
    "stddev",
    "variance",
    "count_distinct",
    "approx_count_distinct",
)
