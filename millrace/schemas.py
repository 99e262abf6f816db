"""Table schemas, one StructType per entity."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_S, _D, _L, _I, _TS = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(),
                       T.TimestampType())
_TEXT_MAP = T.MapType(_S, _S)

# Feeds in text formats: values are text, the number grammar decides what they are.
RAW_A = _struct(("id", _S), ("name", _S), ("email", _S), ("amount", _S), ("created", _S))
RAW_B = _struct(("customer_id", _S), ("full_name", _S), ("email_address", _S),
                ("value", _S), ("timestamp", _S))
RAW_C = _struct(("userId", _S), ("username", _S), ("mail", _S),
                ("transaction_value", _S), ("createdAt", _S))
RAW = {"Source A": RAW_A, "Source B": RAW_B, "Source C": RAW_C}

# The reference point of a row inside its batch: feed rank, then arrival position.
CANONICAL = _struct(("record_id", _S, False), ("name", _S), ("email", _S), ("value", _D),
                    ("source", _S, False), ("created_at", _TS), ("ingested_at", _TS, False),
                    ("source_rank", _I), ("pos", _L))
RECORDS = _struct(("record_hash", _S, False), ("source", _S), ("source_record_id", _S),
                  ("name", _S), ("email", _S), ("value", _D), ("created_at", _TS),
                  ("ingested_at", _TS), ("run_id", _L))
REJECTS = _struct(("run_id", _L), ("source", _S), ("source_rank", _I), ("pos", _L),
                  ("record_id", _S), ("errors", T.ArrayType(_S)))
DUPLICATES = _struct(("run_id", _L), ("record_hash", _S), ("original_source", _S),
                     ("duplicate_source", _S), ("record_id", _S))

SOURCE_RESULT = _struct(("source", _S), ("status", _S), ("received", _L),
                        ("duration_ms", _D), ("error", _S), ("attempts", _I),
                        ("raw_path", _S))
RUNS = _struct(("run_id", _L), ("status", _S), ("total_received", _L), ("total_processed", _L),
               ("total_duplicates", _L), ("total_failed", _L), ("duration_ms", _D),
               ("started_at", _TS), ("completed_at", _TS),
               ("source_results", T.ArrayType(SOURCE_RESULT)),
               ("failed_sources", T.ArrayType(_S)), ("total_inserted", _L))
SOURCES = _struct(("source", _S), ("status", _S), ("last_success", _TS), ("last_failure", _TS),
                  ("records_received", _L), ("records_processed", _L), ("duplicates", _L),
                  ("error_message", _S), ("run_id", _L), ("updated_at", _TS))
QUALITY = _struct(("run_id", _L), ("overall_score", _D), ("completeness", _D), ("validity", _D),
                  ("consistency", _D), ("uniqueness", _D), ("freshness", _D),
                  ("quality_by_source", T.MapType(_S, _D)), ("details", _TEXT_MAP),
                  ("timestamp", _TS))
ANOMALIES = _struct(("id", _S), ("run_id", _L), ("record_id", _S), ("source", _S),
                    ("feature_name", _S), ("current_value", _D), ("expected_range", _S),
                    ("severity", _S), ("reason", _S), ("status", _S), ("timestamp", _TS))
ALERTS = _struct(("id", _S), ("severity", _S), ("title", _S), ("description", _S),
                 ("source", _S), ("status", _S), ("run_id", _L), ("record_id", _S),
                 ("timestamp", _TS))
ALERT_STATUS = _struct(("id", _S), ("status", _S), ("at", _TS))
HEALTH = _struct(("overall_score", _D), ("availability", _D), ("latency", _D),
                 ("validation", _D), ("reliability", _D), ("status", _S), ("updated_at", _TS),
                 ("run_id", _L))
LINEAGE = _struct(("record_id", _S), ("record_hash", _S), ("source", _S), ("run_id", _L),
                  ("stage_no", _I), ("stage", _S), ("status", _S), ("details", _TEXT_MAP),
                  ("timestamp", _TS))
_EVENT = (("event", _S), ("timestamp", _TS), ("source", _S), ("records", _L), ("duration_ms", _D),
          ("error", _S), ("status", _S))
EVENTS = _struct(("run_id", _L), ("attempt", _I), ("seq", _I), *_EVENT)
# One row, and so one file, per attempt at a run: all its events appear at once.
EVENT_LOG = _struct(("run_id", _L), ("attempt", _I), ("events", T.ArrayType(_struct(*_EVENT))))
RUN_STATE = _struct(("run_id", _L), ("attempt", _I), ("last_event", _S), ("last_at", _TS), ("finished", T.BooleanType()),
                    ("status", _S), ("sources_completed", _L), ("sources_failed", _L), ("records", _L),
                    ("silent", T.BooleanType()))

_WHOLE = T.DecimalType(38, 0)
BAND_SUMS = _struct(("band", _I), ("n", _L), ("total", _WHOLE), ("high", _WHOLE), ("mixed", _WHOLE), ("low", _WHOLE))
RUN_COUNTERS = _struct(("run_id", _L), ("source", _S), ("rows", _L), ("missing_name", _L),
                       ("missing_email", _L), ("missing_value", _L), ("missing_created_at", _L),
                       ("valid_rows", _L), ("consistent_rows", _L), ("newest_ingested_at", _TS),
                       ("unreadable_rows", _L), ("n", _L), ("moments", T.ArrayType(BAND_SUMS)))

FOREST_SAMPLES = _struct(("run_id", _L), ("u", _D), ("v", _D))
VALUE_COUNTS = _struct(("run_id", _L), ("low", _D), ("high", _D), ("rows", _L))
PAGE_COUNTS = _struct(("run_id", _L), ("source", _S), ("minute", _TS), ("digits", _S), ("rows", _L), ("low", _TS),
                      ("high", _TS))

TABLES = {
    "records": RECORDS, "rejects": REJECTS, "duplicates": DUPLICATES,
    "ingestion_runs": RUNS, "sources": SOURCES, "quality_metrics": QUALITY,
    "anomalies": ANOMALIES, "alerts": ALERTS, "alert_status": ALERT_STATUS,
    "pipeline_health": HEALTH, "data_lineage": LINEAGE, "event_log": EVENT_LOG,
    "run_counters": RUN_COUNTERS, "forest_samples": FOREST_SAMPLES, "value_counts": VALUE_COUNTS,
    "page_counts": PAGE_COUNTS,
}
