"""Fixed values of the data contract.

Names, texts, thresholds and weights in this module are part of the results
(they appear in rows or decide scores), so they are stated once, in plain form.
"""

# --- fixed values: feeds ----------------------------------------------------
UNKNOWN_SOURCE = "Unknown"
FEED_FIELDS = {
    "Source A": {"record_id": "id", "name": "name", "email": "email",
                 "value": "amount", "created_at": "created"},
    "Source B": {"record_id": "customer_id", "name": "full_name", "email": "email_address",
                 "value": "value", "created_at": "timestamp"},
    "Source C": {"record_id": "userId", "name": "username", "email": "mail",
                 "value": "transaction_value", "created_at": "createdAt"},
}
SOURCE_LANES = ["Source A", "Source B", "Source C"]

# --- fixed values: validation texts, in rule order ---------------------------
MISSING_ID = "Missing record_id"
MISSING_NAME = "Missing name"
INVALID_EMAIL = "Invalid email"
NOT_NUMERIC = "Value must be numeric"
NEGATIVE_VALUE = "Value must not be negative"
INVALID_CREATED = "Invalid or missing created_at"

# --- fixed values: enumerations ----------------------------------------------
SOURCE_OUTCOMES = ["SUCCESS", "FAILED", "TIMEOUT"]
RUN_STATUSES = ["RUNNING", "COMPLETED", "PARTIAL", "FAILED"]
SOURCE_HEALTH = ["HEALTHY", "DEGRADED", "DOWN", "UNKNOWN"]
EVENT_TYPES = ["INGESTION_STARTED", "SOURCE_STARTED", "SOURCE_COMPLETED",
               "SOURCE_FAILED", "INGESTION_COMPLETED"]
ITEM_STATES = ["ACTIVE", "ACKNOWLEDGED", "RESOLVED"]
ANOMALY_SEVERITIES = ["LOW", "MEDIUM", "HIGH"]
ALERT_SEVERITIES = ["INFO", "LOW", "MEDIUM", "HIGH", "CRITICAL"]
LINEAGE_STAGES = ["SOURCE", "RAW_INGESTION", "VALIDATION", "NORMALIZATION",
                  "DEDUPLICATION", "STORAGE"]
LINEAGE_STATES = ["SUCCESS", "FAILED", "SKIPPED", "DUPLICATE"]

# --- fixed values: load policy -----------------------------------------------
LOAD_TIMEOUT_SECONDS = 5.0
LOAD_ATTEMPTS = 3
LOAD_RETRY_SECONDS = 0.5

# --- fixed values: quality ----------------------------------------------------
QUALITY_WEIGHTS = {"completeness": 0.25, "validity": 0.25, "consistency": 0.20,
                   "uniqueness": 0.15, "freshness": 0.15}
QUALITY_FIELDS = ["name", "email", "value", "created_at"]
QUALITY_SOURCE_FIELDS = ["name", "email", "value"]
FRESHNESS_DEFAULT = 95.0
FRESHNESS_UNREADABLE = 90.0
EMPTY_QUALITY_MESSAGE = "No records in repository yet"

# --- fixed values: anomalies --------------------------------------------------
ANOMALY_MIN_VALUES = 5
BOUND_SIGMAS = 2.5
HIGH_SIGMAS = 4.0
LOW_SIGMAS = 2.0
RUN_MIN_HISTORY = 3
RUN_SINGLE_STD = 100.0
RUN_ZERO_STD = 50.0
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.1
FOREST_SEED = 42
VALUE_REASON = ("Record value (%.2f) is significantly outside historical normal range "
                "[%.2f – %.2f]. Historical mean: %.2f, Std dev: %.2f.")
VALUE_RANGE = "%.1f – %.1f"
RUN_REASON = ("Ingestion run duration (%.1f ms) exceeded historical baseline "
              "[%.1f ms – %.1f ms].")
RUN_RANGE = "<%.1f ms"

# --- fixed values: health -----------------------------------------------------
HEALTH_WEIGHTS = {"availability": 0.30, "latency": 0.25, "validation": 0.25,
                  "reliability": 0.20}
HEALTH_LATENCY_RUNS = 10
HEALTH_VALIDATION_RUNS = 5
HEALTH_DEFAULT_MS = 500.0

# --- fixed values: alerts -----------------------------------------------------
ALERT_SOURCE_STATES = ["FAILED", "DEGRADED", "UNHEALTHY"]
ALERT_LATENCY_MS = 3000.0
ALERT_DUPLICATE_PERCENT = 15.0
ALERT_CLUSTER_MIN = 3
ALERT_CLUSTER_HIGH = 5
ORCHESTRATOR = "Pipeline Orchestrator"
DEDUPLICATOR = "Deduplicator"
ANOMALY_ENGINE = "ML Anomaly Engine"
ALERT_TEXTS = {
    "source": ("Source Degradation: %s",
               "Source %s is currently reporting %s status. Error: %s"),
    "latency": ("High Run Latency in Run #%d",
                "Ingestion run #%d took %.1fms, exceeding 3000ms threshold."),
    "duplicates": ("High Duplicate Rate (%.1f%%) in Run #%d",
                   "Detected %d duplicates out of %d records."),
    "failed": ("Failed Sources in Run #%d",
               "%d source(s) failed during concurrent ingestion run #%d."),
    "cluster": ("Multiple Active Anomalies (%d detected)",
                "%d active records/runs flagged as anomalies by IsolationForest."),
}

# --- fixed values: comparison, paging, feed -----------------------------------
COMPARE_LATEST_QUALITY = 95.0
COMPARE_PREVIOUS_QUALITY = 90.0
METRIC_NAMES = ["Records Processed", "Duplicates", "Validation Errors",
                "Latency (ms)", "Quality Score", "Anomalies"]
PAGE_SIZE = 20
RECENT_RUNS = 20
TREND_POINTS = 20
CHART_RUNS = 10
ACTIVITY_ITEMS = 12

# --- fixed values: lineage details --------------------------------------------
LINEAGE_RECEIVER = "IngestionOrchestrator"
LINEAGE_RULE_SET = "StandardSchemaValidator"
LINEAGE_SCHEMA = "CanonicalRecord"
LINEAGE_STORE = "Repository"
LINEAGE_NO_HASH = "sha256-computed"
