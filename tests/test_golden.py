"""The golden data set end to end, with exact numbers."""

import golden
import pytest
from pyspark.sql import functions as F

from millrace.operators.dedupe import (duplicate_pairs, duplicate_report, first_occurrences,
                                       with_fingerprint)
from millrace.operators.validate import rejected_records, valid_records
from millrace.plans.ingest import replay_run, run_ingestion, source_summary
from millrace.sinks.tables import Tables


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return Tables(spark, root, "golden", buckets=8).create()


@pytest.mark.parametrize("partitions", [1, 7])
def test_counts(spark, partitions):
    canonical = golden.canonical(spark, partitions)
    valid = with_fingerprint(valid_records(canonical))
    assert canonical.count() == 31
    assert valid.count() == 30
    kept = {r["source"]: r["count"] for r in first_occurrences(valid).groupBy("source").count().collect()}
    assert kept == {"Source A": 10, "Source B": 6, "Source C": 6}
    bad = rejected_records(canonical).collect()
    assert [(r["record_id"], r["errors"]) for r in bad] == [
        ("A-011", ["Invalid email", "Value must not be negative"])]
    pairs = {(r[0], r[1]): r[2] for r in duplicate_pairs(valid).collect()}
    assert pairs == {("Source A", "Source B"): 4, ("Source A", "Source C"): 2,
                     ("Source B", "Source C"): 2}
    report = {(r["original_source"], r["duplicate_source"], r["record_id"])
              for r in duplicate_report(valid).collect()}
    assert report == {("Source A", "Source B", i) for i in ("A-001", "A-002", "A-003", "A-004")
                      } | {("Source A", "Source C", i) for i in ("A-001", "A-005")
                           } | {("Source B", "Source C", i) for i in ("B-001", "B-002")}


def test_source_summary(spark):
    rows = {r["source"]: tuple(r)[1:] for r in source_summary(golden.canonical(spark, 5)).collect()}
    assert rows == {"Source A": (11, 1, 10, 10, 0), "Source B": (10, 0, 10, 6, 4),
                    "Source C": (10, 0, 10, 6, 4)}


def test_run_replay_and_reads(spark, lake):
    run = run_ingestion(spark, lake, golden.specs(spark), as_of="2026-09-23 00:00:00",
                        timeout=120.0).first()
    assert (run["run_id"], run["status"]) == (1, "COMPLETED")
    assert (run["total_received"], run["total_processed"], run["total_duplicates"],
            run["total_failed"], run["total_inserted"]) == (31, 22, 8, 0, 22)
    assert lake.records().count() == 22
    assert lake.read("rejects").count() == 1
    assert lake.read("duplicates").count() == 8
    status = {r["source"]: (r["status"], r["records_received"], r["records_processed"],
                            r["duplicates"]) for r in lake.sources().collect()}
    assert status == {"Source A": ("HEALTHY", 11, 10, 0), "Source B": ("HEALTHY", 10, 6, 4),
                      "Source C": ("HEALTHY", 10, 6, 4)}
    quality = lake.read("quality_metrics").first()
    assert [quality[c] for c in ("overall_score", "completeness", "validity", "consistency",
                                 "uniqueness", "freshness")] == [100.0] * 6
    events = [r["event"] for r in lake.read("events").orderBy("timestamp").collect()]
    assert events[0] == "INGESTION_STARTED" and events.count("SOURCE_COMPLETED") == 3
    assert lake.alerts().filter(F.col("title").startswith("High Duplicate Rate (25.8%)")
                                ).count() == 1

    again, message = replay_run(spark, lake, 1, as_of="2026-09-24 00:00:00")
    row = again.first()
    assert (row["run_id"], row["total_received"], row["total_processed"], row["total_inserted"]
            ) == (2, 31, 22, 0)
    assert lake.records().count() == 22
    assert message == "Run #1 replayed as new Run #2. Processed 22 unique records."
    one, message = replay_run(spark, lake, 1, "Source B")
    assert one.first()["total_received"] == 10
    assert message.endswith("Target source filter: Source B.")
    with pytest.raises(ValueError):
        replay_run(spark, lake, 99)
