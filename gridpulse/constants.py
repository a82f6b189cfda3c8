"""Fixed values that must equal the source pipeline's for identical results.

Everything here is a plain value, kept together and in natural order, so the
operators can be read without hunting for magic numbers.
"""

# --- fixed values: outage sessionization and metrics -------------------------
GAP_MINUTES = 59                 # a gap strictly larger than this starts a new event
REPORT_HOURS = 0.25              # each report counts as a quarter hour for SAIDI
SMALL_THRESHOLD = 0.0001         # display "<0.0001" below this (after rounding)
SMALL_LABEL = "<0.0001"
ROUND_DIGITS = 4
COMPARE_TOLERANCE = 0.0001       # result comparison tolerance
FUZZY_MIN_SCORE = 85.0           # minimum score for a fuzzy county match

# --- fixed values: canonical column names ------------------------------------
COUNTY = "county"
AFFECTED = "per_outage_customers_affected"
SERVED = "customers_served"
TIMESTAMP = "timestamp"
PCT_OUT = "% out"
EMC = "emc"
REQUIRED_COLUMNS = ("county", "per_outage_customers_affected", "customers_served", "timestamp")
ALWAYS_ALLOWED = ("% out", "emc")
PROVIDER_COLUMN = "EMC"          # raw provider column, exact name
RAW_TIMESTAMP_COLUMN = "timestamp"  # raw timestamp column, exact name, case-sensitive

# --- fixed values: text that means "bad county" -------------------------------
BAD_COUNTY_VALUES = ("unknown", "Unknown", "UNKNOWN", "")

# --- fixed values: text read as missing (pandas CSV reader defaults) ----------
NULL_LITERALS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- fixed values: feed file naming -------------------------------------------
FEED_NAME_PATTERN = r"(?i)per[_]?count(y|ies)?"
FEED_SUFFIX_PATTERN = r"(?i)\.csv$"
MUNICIPAL_KEY = "muni"

# --- fixed values: retrieval settings (defaults, then per-state overrides) ----
SETTINGS_DEFAULTS = {
    "head_bytes": 500,
    "tail_bytes": 524288,
    "threshold_bytes": 2097152,
    "stale_threshold_days": 2,
    "use_optimization": True,
    "utilization_threshold_high": 0.8,
    "utilization_log_low": 0.3,
}
SETTINGS_STATE_OVERRIDES = {
    "al": {"tail_bytes": 300000},
    "fl": {"tail_bytes": 250000},
    "ga": {"tail_bytes": 200000},
    "il": {"tail_bytes": 100000},
    "la": {"tail_bytes": 250000},
    "ms": {"tail_bytes": 150000},
    "nc": {"tail_bytes": 25000},
    "sc": {"tail_bytes": 100000},
}

# --- fixed values: output layouts ---------------------------------------------
DASHBOARD_COLUMNS = ("County", "FIPS", "SAIDI", "LOWER_SAIFI", "SAIFI", "UPPER_SAIFI", "State", "Date")
HISTORY_COLUMNS = ("State", "County", "FIPS", "SAIDI", "SAIFI", "Date")
METRIC_COLUMNS = ("saidi", "lower_saifi", "middle_saifi", "upper_saifi")

# Grouping key of every per-county computation: one job may cover many
# states and days, and an outage crossing midnight is cut into two events.
KEY = ("state", "report_date", "county")
