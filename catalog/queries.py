"""Queries over the test tables, one or more for each operator."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import feeds as T
from millrace import contract as K, schemas
from millrace.functions.instants import iso_format, parse_instant, parse_iso
from millrace.functions.text import clean_email, clean_text, to_number
from millrace.operators import (alerts, anomaly, compare, dedupe, events, health, lineage,
                                normalize, quality, reads, runs, upsert, validate)
from millrace.plans.ingest import (health_or_compute, lineage_of, quality_or_compute, replay_run,
                                   run_forest, run_ingestion, source_summary, summarise_values)
from millrace.session import configure, shared_folder
from millrace.sinks.tables import Tables
from millrace.operators.counters import run_counters, value_stats_of
from millrace.operators.forest import Forest, fit_forest
from millrace.sources.feeds import SourceSpec, file_source, frame_source, payload_source
from millrace.sources.loader import load_sources, outcome_frame
from millrace.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), str(sf_dir).rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def written(frame: DataFrame, purpose: str, *by: str) -> DataFrame:
    """The frame in a folder that several readers share, so that it is computed once."""
    folder = f"{shared_folder(frame.sparkSession, purpose)}/rows"
    frame.write.partitionBy(*by).parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def iso(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: iso_format(c) for c in columns})


# -- sources, normalisation ----------------------------------------------------

CANON = ["record_id", "name", "email", "value", "source", "created_at", "pos"]


@query
def normalize_feed_a(spark, sf):
    """P2-P7, P6a"""
    return iso(T.feed(spark, sf, "Source A").select(*CANON), "created_at")


@query
def normalize_feed_b(spark, sf):
    """P2-P7, P6b"""
    return iso(T.feed(spark, sf, "Source B").select(*CANON), "created_at")


@query
def normalize_feed_c(spark, sf):
    """P2-P7, P6c"""
    return iso(T.feed(spark, sf, "Source C").select(*CANON), "created_at")


@query
def union_canonical(spark, sf):
    """S1"""
    return iso(T.canonical(spark, sf), "created_at", "ingested_at")


@query
def schema_detect(spark, sf):
    """P1"""
    return normalize.detect_schema(T.mixed_payloads(spark, sf)).select("rank", "pos", "source")


@query
def normalize_mixed(spark, sf):
    """P1, P6, P7 over JSON of all feeds"""
    rows = normalize.normalize_mixed(T.mixed_payloads(spark, sf), "rank", as_of=T.AS_OF)
    return iso(rows.select(*CANON, "source_rank"), "created_at")


@query
def unknown_schema(spark, sf):
    """P6d: rows of no known schema are kept and rejected visibly"""
    props = T.table(spark, sf, "events").select(F.col("props").alias("payload"),
                                                F.col("event_id").alias("pos"))
    rows = validate.with_errors(normalize.normalize_mixed(props, as_of=T.AS_OF))
    return rows.select("pos", "source", "record_id", F.array_join("errors", "; ").alias("errors"))


@query
def passthrough_mapping(spark, sf):
    """S6"""
    kind, key = F.col("event_type"), F.col("event_id")
    raw = T.table(spark, sf, "events").select(
        F.when(kind != "view", key).alias("id"),
        F.when(key % 2 == 1, F.concat(F.lit("R-"), key)).alias("record_id"),
        F.concat(F.lit("User "), "user_id").alias("name"), F.col("value"),
        F.when(kind != "click", kind).alias("source"), key.alias("pos"))
    return normalize.passthrough(raw, as_of=T.AS_OF).select("record_id", "name", "value",
                                                            "source", "pos")


@query
def text_cleaning(spark, sf):
    """P2, P3 over whole texts"""
    return T.table(spark, sf, "documents").select(
        "doc_id", F.length(clean_text("text")).cast("bigint").alias("n_clean"),
        F.sha2(clean_text("text"), 256).alias("clean_digest"),
        F.sha2(clean_email("text"), 256).alias("lower_digest"))


@query
def number_grammar(spark, sf):
    """P4"""
    q, k = F.col("l_quantity").cast("int"), F.col("l_orderkey") % 1000
    line = F.col("l_linenumber")
    text = (F.when(line == 1, F.concat(F.lit(" "), q, F.lit("\t")))
            .when(line == 2, F.concat(q, F.lit("_"), F.lpad(k.cast("string"), 3, "0")))
            .when(line == 3, F.concat(q, F.lit("."), k)).when(line == 4, F.concat(q, F.lit("e2")))
            .when(line == 5, F.concat(q, F.lit("d"))).when(line == 6, F.lit("n/a"))
            .otherwise(F.concat(F.lit("."), q)))
    return (T.table(spark, sf, "lineitem").select(line.alias("form"), to_number(text).alias("v"))
            .groupBy("form").agg(F.count(F.lit(1)).alias("texts"), F.count("v").alias("numbers"),
                                 F.round(F.sum("v"), 2).alias("total")))


@query
def instant_grammar(spark, sf):
    """P5"""
    at = T.instant("o_orderdate")
    form = F.col("o_orderkey") % 8
    text = (F.when(form == 0, F.date_format(at, "dd-MM-yyyy"))
            .when(form == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(form == 2, F.date_format(at, " yyyy-MM-dd HH:mm:ss"))
            .when(form == 3, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(form == 4, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .when(form == 5, F.date_format(at, "yyyyMMdd"))
            .when(form == 6, F.date_format(at, "d-M-yy")).otherwise("not-a-date"))
    return T.table(spark, sf, "orders").select(
        "o_orderkey", iso_format(parse_instant(text)).alias("instant"))


@query
def numbers_in_other_digits(spark, sf):
    """Digits of other scripts, also mixed with ASCII ones, and grouped"""
    q, k = F.col("l_quantity").cast("int").cast("string"), (F.col("l_orderkey") % 1000).cast("string")
    script = F.col("l_linenumber") % 4
    ascii_digits = "0123456789"
    arabic, wide, bold = ("".join(chr(z + d) for d in range(10)) for z in (0x660, 0xFF10, 0x1D7CE))
    text = (F.when(script == 0, F.concat(F.lit(" "), F.translate(q, ascii_digits, arabic)))
            .when(script == 1, F.concat(F.lit("-"), F.translate(q, ascii_digits, wide), F.lit("."), k))
            .when(script == 2, F.concat(F.translate(q, ascii_digits, bold), F.lit("_"),
                                        F.lpad(F.translate(k, ascii_digits, arabic), 3, chr(0x660))))
            .otherwise(F.concat(F.translate(q, ascii_digits, arabic), F.lit("x"))))
    return (T.table(spark, sf, "lineitem").select(script.alias("script"), to_number(text).alias("v"))
            .groupBy("script").agg(F.count(F.lit(1)).alias("texts"), F.count("v").alias("numbers"),
                                   F.round(F.sum("v"), 2).alias("total")))


@query
def week_dates_with_time(spark, sf):
    """P5: ISO week dates with a time behind them"""
    at, form = T.instant("o_orderdate"), F.col("o_orderkey") % 5
    year, week = F.extract(F.lit("YEAROFWEEK"), at).cast("string"), F.lpad(F.weekofyear(at).cast("string"), 2, "0")
    day = (F.weekday(at) + 1).cast("string")
    text = (F.when(form == 0, F.concat(year, F.lit("-W"), week, F.lit("-"), day, F.date_format(at, "'T'HH:mm:ss")))
            .when(form == 1, F.concat(year, F.lit("W"), week, day, F.date_format(at, "' 'HHmmss")))
            .when(form == 2, F.concat(year, F.lit("-W"), week, F.date_format(at, "'T'HH:mm'+02:00'")))
            .when(form == 3, F.concat(year, F.lit("-W54-"), day, F.date_format(at, "'T'HH:mm")))
            .otherwise(F.concat(year, F.lit("W"), week, F.date_format(at, "'T'HH'Z'"))))
    return T.table(spark, sf, "orders").select("o_orderkey", iso_format(parse_instant(text)).alias("instant"))


@query
def fingerprint(spark, sf):
    """P8"""
    return dedupe.with_fingerprint(T.canonical(spark, sf)).select("source", "pos", "record_hash")


@query
def record_documents(spark, sf):
    """Instants to text and back"""
    rows = T.records(spark, sf).withColumn("text", iso_format("created_at"))
    return rows.select("record_hash", "record_id", F.col("text").alias("created_at"),
                       (parse_iso("text") == F.col("created_at")).alias("same"))


# -- validation ----------------------------------------------------------------

@query
def validation_errors(spark, sf):
    """V1-V7"""
    return validate.with_errors(T.canonical(spark, sf)).select(
        "source", "pos", "record_id", F.array_join("errors", "; ").alias("errors"))


@query
def valid_records(spark, sf):
    """V8"""
    return validate.valid_records(T.canonical(spark, sf)).select("source", "pos", "record_id",
                                                                 "value")


@query
def rejected_records(spark, sf):
    """V8"""
    return validate.rejected_records(T.canonical(spark, sf)).select(
        "source", "pos", "record_id", F.array_join("errors", "; ").alias("errors"))


@query
def validation_counts(spark, sf):
    """V9"""
    return validate.validation_counts(T.canonical(spark, sf), ("source",))


@query
def reject_reasons(spark, sf):
    """V9"""
    return validate.reject_reasons(T.canonical(spark, sf), ("source",))


@query
def hash_guard(spark, sf):
    """V10"""
    rows = validate.require_hash(T.records(spark, sf))
    return rows.groupBy("source").agg(F.count("record_hash").alias("records"),
                                      F.min("record_hash").alias("lowest_hash"))


@query
def records_of_source(spark, sf):
    """V11"""
    return validate.records_of(T.records(spark, sf), "Source B").select("record_id", "email",
                                                                        "value")


# -- deduplication -------------------------------------------------------------

@query
def dedupe_first(spark, sf):
    """D1"""
    return T.records(spark, sf).select("record_hash", "source", "pos", "record_id", "value")


@query
def dedupe_by_id(spark, sf):
    """D4"""
    return dedupe.first_occurrences(T.valid(spark, sf), ("record_id",)).select(
        "record_id", "source", "pos")


@query
def duplicate_pairs(spark, sf):
    """D2, D3"""
    return dedupe.duplicate_pairs(T.valid(spark, sf))


@query
def duplicate_report(spark, sf):
    """D2"""
    return dedupe.duplicate_report(T.valid(spark, sf)).select(
        "record_hash", "original_source", "duplicate_source", "record_id", "pos")


@query
def duplicate_count(spark, sf):
    """D3"""
    return dedupe.duplicate_count(T.valid(spark, sf))


@query
def cross_run_new(spark, sf):
    """A first run loads feed A, a second one B and C"""
    stored = dedupe.first_occurrences(T.valid(spark, sf, ("Source A",)))
    return dedupe.new_records(T.valid(spark, sf, ("Source B", "Source C")), stored).select(
        "record_hash", "source", "pos")


@query
def source_counts(spark, sf):
    """What each source of a run received, lost and kept"""
    return source_summary(T.canonical(spark, sf))


# -- runs ----------------------------------------------------------------------

RUN = ["run_id", "status", "total_received", "total_processed", "total_duplicates",
       "total_failed"]


@query
def daily_runs(spark, sf):
    """A2 over one run per day"""
    return iso(T.runs(spark, sf), "started_at")


@query
def run_totals(spark, sf):
    """A1, A2"""
    rows = dedupe.with_fingerprint(validate.valid_records(T.feed_c_by_day(spark, sf)))
    kept = dedupe.first_occurrences(rows, ("run_id", "record_hash"))
    return runs.run_totals(T.outcomes(spark, sf), kept, rows).select(*RUN)


@query
def source_status_rows(spark, sf):
    """A3"""
    rows = T.table(spark, sf, "events").select(
        T.run_day("ts").alias("run_id"), F.col("event_type").alias("source"), "user_id",
        F.lit(1).alias("source_rank"), F.col("event_id").alias("pos"))
    kept = dedupe.first_occurrences(rows, ("run_id", "user_id"))
    at = F.lit(T.AS_OF).cast("timestamp")
    out = runs.source_status_rows(T.outcomes(spark, sf), kept, rows, at)
    return out.select("run_id", "source", "status", "records_received", "records_processed",
                      "duplicates", "error_message",
                      F.col("last_success").isNotNull().alias("succeeded"))


@query
def latest_run_upsert(spark, sf):
    """K3: half of the runs are written as RUNNING first, then all in their final form"""
    final = T.runs(spark, sf).select(*RUN, "completed_at")
    first = final.filter(F.col("run_id") <= 15).withColumns(
        {"status": F.lit("RUNNING"), "total_processed": F.lit(0).cast("bigint")})
    return upsert.upsert(first, final, ["run_id"], ["completed_at"]).select(*RUN)


@query
def source_status_upsert(spark, sf):
    """K4"""
    return iso(upsert.merge_source_status(T.source_log(spark, sf)), "last_success",
               "last_failure", "updated_at")


@query
def source_status_strict(spark, sf):
    """K4, replacing every column"""
    return iso(upsert.merge_source_status(T.source_log(spark, sf), strict=True), "last_success",
               "last_failure", "updated_at")


@query
def lifetime_stats(spark, sf):
    """A4, A5"""
    return iso(runs.lifetime_stats(T.runs(spark, sf)), "last_run_timestamp")


@query
def source_cards(spark, sf):
    """A8, R4"""
    return runs.source_cards(upsert.merge_source_status(T.source_log(spark, sf)))


@query
def status_fold(spark, sf):
    """Unknown health texts"""
    rows = T.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderstatus") == "F", "HEALTHY").when(F.col("o_orderstatus") == "O", "DOWN")
        .otherwise(F.col("o_orderstatus")).alias("status"))
    return runs.fold_status(rows).groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


@query
def failed_sources(spark, sf):
    """P12"""
    return runs.with_failed_sources(T.runs_with_results(spark, sf)).select(
        "run_id", F.array_join("failed_sources", ",").alias("failed_sources"))


@query
def run_documents(spark, sf):
    """An unfinished run has no start, end or duration yet"""
    part = T.runs(spark, sf)
    open_run = F.col("run_id") % 5 == 0
    rows = part.withColumns({c: F.when(~open_run, F.col(c))
                             for c in ("duration_ms", "started_at", "completed_at")})
    return runs.run_documents(rows).select("run_id", "duration_ms", "started_at",
                                           F.col("completed_at").isNull().alias("unfinished"))


# -- quality -------------------------------------------------------------------

@query
def quality_scores(spark, sf):
    """Q1-Q6, Q8"""
    return quality.quality_scores(dedupe.with_fingerprint(T.canonical(spark, sf)), T.AS_OF)


@query
def quality_by_source(spark, sf):
    """Q7"""
    return quality.quality_by_source(T.canonical(spark, sf))


@query
def quality_snapshot(spark, sf):
    """Q1-Q9 of the stored records, as the table of snapshots holds it"""
    row = quality.quality_snapshot(T.records(spark, sf), 1, T.AS_OF)
    return row.select(
        "run_id", "overall_score", *K.QUALITY_WEIGHTS,
        F.col("quality_by_source")["Source A"].alias("source_a"),
        F.col("quality_by_source")["Source B"].alias("source_b"),
        F.col("details")["total_records_evaluated"].cast("bigint").alias("rows"),
        F.col("details")["valid_records_count"].cast("bigint").alias("valid_rows"))


@query
def quality_newest_rows(spark, sf):
    """Q10: scores over the newest 1000 stored records"""
    return quality.quality_scores(T.records(spark, sf), T.AS_OF, limit=1000)


@query
def quality_by_run(spark, sf):
    """Q1-Q6 per run, K5"""
    return T.quality_snapshots(spark, sf).drop("timestamp")


# -- anomalies -----------------------------------------------------------------

ANOMALY = ["run_id", "record_id", "source", "feature_name", "current_value", "expected_range",
           "severity", "reason", "status"]


def _values(spark, sf):
    return validate.valid_records(T.feed_c_by_day(spark, sf))


@query
def value_bounds(spark, sf):
    """M1-M3"""
    stats = anomaly.value_stats(_values(spark, sf))
    return stats.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "low", "high")])


@query
def zscores(spark, sf):
    """M4"""
    rows = _values(spark, sf)
    return anomaly.score_values(rows, anomaly.value_stats(rows)).select(
        "pos", F.round("z", 4).alias("z"))


@query
def zscore_anomalies(spark, sf):
    """M1-M4, M7-M9 without the forest"""
    return anomaly.value_anomalies(_values(spark, sf), as_of=T.AS_OF).select(*ANOMALY)


@query
def latest_run_values(spark, sf):
    """The last run scanned against all earlier ones"""
    rows = _values(spark, sf)
    last = rows.agg(F.max("run_id")).scalar()
    return anomaly.value_anomalies(rows.filter(F.col("run_id") == last),
                                   rows.filter(F.col("run_id") < last),
                                   as_of=T.AS_OF).select(*ANOMALY)


@query
def forest_anomalies(spark, sf):
    """M5-M9 with the isolation forest"""
    return anomaly.detect_value_anomalies(_values(spark, sf), keys=("source_rank", "pos"),
                                          as_of=T.AS_OF).select(*ANOMALY)


@query
def forest_step(spark, sf):
    """M6: which rows a forest with known steps calls anomalous"""
    known = Forest(np.array([100.0, 1000.0, 20000.0]), np.array([0.7, 0.5, 0.4, 0.65]), 0.6)
    return (_values(spark, sf).filter(F.col("value").isNotNull())
            .groupBy(known.flags("value").alias("anomalous")).agg(F.count(F.lit(1)).alias("rows")))


@query
def forest_invariants(spark, sf):
    """M5, M6, M9: all values train the forest, what it flags stays within its share, and
    every value far from the mean is reported whatever the forest says"""
    rows = _values(spark, sf).filter(F.col("value").isNotNull())
    forest = fit_forest(rows, ("source_rank", "pos"))
    found = anomaly.value_anomalies(rows, as_of=T.AS_OF, forest=forest)
    far = anomaly.score_values(rows, anomaly.value_stats(rows)).filter(F.col("z") > K.BOUND_SIGMAS)
    missed = far.join(found.select(F.col("current_value").alias("value")).distinct(), "value", "left_anti")
    n = F.count(F.lit(1))
    return rows.agg(n.alias("training_rows"),
                    (F.count_if(forest.flags("value")) <= F.ceil(n * K.FOREST_CONTAMINATION))
                    .alias("within_share"),
                    (missed.agg(n).scalar() == 0).alias("far_values_found"))


@query
def run_duration_anomalies(spark, sf):
    """M11 for every run"""
    return anomaly.run_anomalies(T.spiky_runs(spark, sf), latest_only=False,
                                 as_of=T.AS_OF).select(*ANOMALY)


@query
def latest_run_anomaly(spark, sf):
    """M11 for the latest run"""
    return anomaly.run_anomalies(T.spiky_runs(spark, sf), as_of=T.AS_OF).select(*ANOMALY)


def _anomalies(spark, sf):
    """Stored anomalies: those of values, at the end of their run's day, and of runs."""
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(T.DAY_ONE).cast("timestamp"))
                             + F.col("run_id") * 86400)
    rows = validate.valid_records(T.feed_c_by_day(spark, sf)).withColumn(
        "record_hash", F.col("pos").cast("string"))
    found = anomaly.value_anomalies(rows).unionByName(
        anomaly.run_anomalies(T.spiky_runs(spark, sf), latest_only=False))
    return found.withColumn("timestamp", at).withColumn(
        "status", F.when(F.col("run_id") % 3 == 0, "RESOLVED").otherwise("ACTIVE"))


@query
def anomaly_identity(spark, sf):
    """A rescan of the same rows inserts nothing"""
    found = _anomalies(spark, sf)
    early = found.filter(F.col("run_id") <= 15)
    return upsert.insert_absent(found, early).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("inserted"))


@query
def anomaly_summary(spark, sf):
    """A6, A6b"""
    return runs.anomaly_summary(_anomalies(spark, sf))


@query
def anomaly_summary_filtered(spark, sf):
    """A6 over a filtered list"""
    return runs.anomaly_summary(validate.items_where(_anomalies(spark, sf), severity="HIGH",
                                                     source="Source C"))


@query
def anomalies_by_severity(spark, sf):
    """R8, V11"""
    rows = reads.anomalies_list(_anomalies(spark, sf), severity="HIGH")
    return iso(rows.select("run_id", "record_id", "source", "current_value", "timestamp"),
               "timestamp")


@query
def anomaly_by_id(spark, sf):
    """Looked up by the id of the newest run anomaly"""
    found = _anomalies(spark, sf)
    wanted = found.filter(F.col("feature_name") == "duration_ms").agg(
        F.max_by("id", "run_id")).scalar()
    return reads.by_id(found, wanted).select(*ANOMALY)


# -- health and alerts ---------------------------------------------------------

@query
def health_score(spark, sf):
    """H1-H6"""
    row = health.pipeline_health(T.runs(spark, sf),
                                 upsert.merge_source_status(T.source_log(spark, sf)),
                                 anomaly.run_anomalies(T.spiky_runs(spark, sf), latest_only=False),
                                 T.AS_OF)
    return row.drop("updated_at")


@query
def health_without_sources(spark, sf):
    """H1 when no source is known, H2 with long runs"""
    log = T.source_log(spark, sf)
    slow = T.runs(spark, sf).withColumn("duration_ms", F.col("duration_ms") * 3)
    none = log.filter(F.col("status") == "NO SUCH STATUS")
    return health.pipeline_health(slow, none, none, T.AS_OF).drop("updated_at")


@query
def health_without_runs(spark, sf):
    """H7"""
    rows = T.runs(spark, sf).filter(F.col("status") == "NO SUCH STATUS")
    log = T.source_log(spark, sf)
    return health.pipeline_health(rows, upsert.merge_source_status(log), rows,
                                  T.AS_OF).drop("updated_at")


@query
def latest_health(spark, sf):
    """The newest of the snapshots after the first half and after all runs"""
    rows = T.runs(spark, sf)
    log = T.source_log(spark, sf)
    none = rows.filter(F.col("status") == "NO SUCH STATUS")
    half = F.col("run_id") <= 15
    snaps = health.pipeline_health(rows.filter(half), upsert.merge_source_status(log.filter(half)),
                                   none, "2024-01-16 00:00:00").unionByName(
        health.pipeline_health(rows, upsert.merge_source_status(log), none, T.AS_OF))
    return iso(reads.latest_snapshot(snaps, "updated_at"), "updated_at")


ALERT = ["severity", "title", "description", "source", "status", "run_id"]


@query
def alerts_all_runs(spark, sf):
    """L1-L7 for every run, every source status ever logged"""
    slow = T.runs(spark, sf).withColumn("duration_ms", F.col("duration_ms") * 2)
    return alerts.scan_alerts(T.source_log(spark, sf), slow, _anomalies(spark, sf),
                              latest_only=False, as_of=T.AS_OF).select(*ALERT)


def _latest_alerts(spark, sf):
    return alerts.scan_alerts(upsert.merge_source_status(T.source_log(spark, sf)),
                              T.spiky_runs(spark, sf), _anomalies(spark, sf), as_of=T.AS_OF)


@query
def alerts_latest(spark, sf):
    """L1-L7 as after a run"""
    return _latest_alerts(spark, sf).select(*ALERT)


def _alerts(spark, sf):
    """Stored alerts of every run, at the end of their run's day."""
    slow = T.runs(spark, sf).withColumn("duration_ms", F.col("duration_ms") * 2)
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(T.DAY_ONE).cast("timestamp"))
                             + F.col("run_id") * 86400)
    return alerts.run_alerts(slow, latest_only=False).withColumn("timestamp", at)


@query
def alerts_insert(spark, sf):
    """K9: a rescan of all runs adds only what the first half did not raise"""
    found = _alerts(spark, sf)
    return upsert.insert_absent(found, found.filter(F.col("run_id") <= 15)).select(*ALERT)


def _alerts_now(spark, sf):
    found = _alerts(spark, sf)
    at = F.col("timestamp")
    log = found.filter(F.col("run_id") % 2 == 0).select(
        "id", F.lit("ACKNOWLEDGED").alias("status"), at.alias("at")).unionByName(
        found.filter(F.col("run_id") % 4 == 0).select(
            "id", F.lit("RESOLVED").alias("status"),
            F.timestamp_micros(F.unix_micros(at) + 1).alias("at")))
    return upsert.apply_status(found, log)


@query
def alert_status(spark, sf):
    """Latest logged state of each alert"""
    return _alerts_now(spark, sf).select(*ALERT)


@query
def active_alerts(spark, sf):
    """A7"""
    return runs.active_count(_alerts_now(spark, sf))


@query
def alerts_by_status(spark, sf):
    """R10, R15, V11"""
    rows = reads.alerts_list(_alerts_now(spark, sf), "ACKNOWLEDGED")
    return iso(rows.select("run_id", "title", "timestamp"), "timestamp")


@query
def alerts_any_status(spark, sf):
    """ALL is no filter"""
    return reads.alerts_list(_alerts_now(spark, sf), "ALL").groupBy("status").agg(
        F.count(F.lit(1)).alias("alerts"))


@query
def alert_by_id(spark, sf):
    """Looked up by the id of the newest failed-sources alert"""
    found = _alerts_now(spark, sf)
    wanted = found.filter(F.col("title").startswith("Failed Sources")).agg(
        F.max_by("id", "run_id")).scalar()
    return reads.by_id(found, wanted).select(*ALERT)


# -- reads ---------------------------------------------------------------------

PAGE = ["record_hash", "record_id", "source", "ingested_at"]


@query
def records_page(spark, sf):
    """R1"""
    return iso(reads.records_page(T.records(spark, sf), 3, 20).select(*PAGE), "ingested_at")


@query
def records_page_of_source(spark, sf):
    """R1, V11"""
    return iso(reads.records_page(T.records(spark, sf), 2, 15, "Source C").select(*PAGE),
               "ingested_at")


@query
def records_page_by_key(spark, sf):
    """R1 for deep pages: page 4 from the last row of page 3"""
    rows = T.records(spark, sf)
    last = reads.records_page(rows, 60, 1).select(*reads.NEWEST).first()
    return iso(reads.records_after(rows, last, 20).select(*PAGE), "ingested_at")


@query
def records_page_deep(spark, sf):
    """A deep page by fence posts that two parts of the records have left"""
    rows = written(T.records(spark, sf).select(*PAGE, "pos"), "deep")
    counts = written(reads.page_counts(rows.filter("pos % 2 = 0"), 5).unionByName(
        reads.page_counts(rows.filter("pos % 2 = 1"), 5)), "deep-counts")
    return iso(reads.records_page_at(rows, counts, 53, 25).select(*PAGE), "ingested_at")


@query
def page_numbers(spark, sf):
    """R1, R13"""
    return reads.page_numbers(reads.records_total(T.records(spark, sf)), 2, 200)


@query
def recent_runs(spark, sf):
    """R2"""
    return reads.recent_runs(T.runs(spark, sf)).select(*RUN)


@query
def run_by_id(spark, sf):
    """R3"""
    return reads.by_id(T.runs(spark, sf), 12, "run_id").select(*RUN)


@query
def latest_quality(spark, sf):
    """R5"""
    return iso(reads.latest_snapshot(T.quality_snapshots(spark, sf)), "timestamp")


@query
def quality_trend(spark, sf):
    """Snapshots of every third run have no run id"""
    snaps = T.quality_snapshots(spark, sf).withColumn(
        "run_id", F.when(F.col("run_id") % 3 != 0, F.col("run_id")))
    return iso(reads.quality_trend(snaps, 20), "timestamp")


@query
def duration_series(spark, sf):
    """R12"""
    return reads.duration_series(T.runs(spark, sf))


@query
def source_lanes(spark, sf):
    """One lane for each source name the tables know, and the fixed three"""
    sources = upsert.merge_source_status(T.source_log(spark, sf))
    lanes = reads.default_lanes(sources).unionByName(
        T.table(spark, sf, "events").select(F.col("event_type").alias("name")).distinct())
    return reads.source_lanes(lanes, sources)


# -- lineage, comparison, replay, events -----------------------------------------

def _details(c: str = "details"):
    pairs = F.array_sort(F.map_entries(c))
    return F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])),
                        "; ")


@query
def lineage_steps(spark, sf):
    """G1, K7"""
    steps = lineage.lineage_steps(T.records(spark, sf)).withColumn("details", _details())
    return iso(steps.drop("run_id"), "timestamp")


@query
def lineage_nested(spark, sf):
    """G2"""
    rows = lineage.nest_lineage(lineage.lineage_steps(T.records(spark, sf)))
    return iso(rows.select("record_id", "record_hash", "source", "received_at", "final_status",
                           F.array_join(F.transform("steps", lambda s: s["stage"]), ">")
                           .alias("stages")), "received_at")


@query
def lineage_summary(spark, sf):
    """G2 without the step list, over the lineage of every valid row"""
    rows = T.valid(spark, sf)
    return iso(lineage.lineage_summary(lineage.lineage_steps(rows)).drop("run_id", "source"),
               "received_at")


@query
def lineage_fallback(spark, sf):
    """Lineage of feed A is stored, the rest is rebuilt"""
    rows = T.records(spark, sf)
    stored = lineage.lineage_steps(rows.filter(F.col("source") == "Source A"))
    every, rebuilt = lineage.lineage_with_fallback(stored, rows)
    return every.groupBy("source", "stage").agg(F.count(F.lit(1)).alias("steps")).unionByName(
        rebuilt.groupBy("source", F.lit("rebuilt").alias("stage"))
        .agg(F.count(F.lit(1)).alias("steps")))


@query
def run_lineage(spark, sf):
    """G4"""
    rows = dedupe.with_fingerprint(T.canonical(spark, sf))
    kept = dedupe.first_occurrences(validate.valid_records(rows))
    return lineage.run_lineage(rows, kept).groupBy("source", "stage_no", "stage", "status").agg(
        F.count(F.lit(1)).alias("steps"))


def _measured(spark, sf):
    counts = anomaly.run_anomalies(T.spiky_runs(spark, sf), latest_only=False)
    return compare.measured_runs(T.spiky_runs(spark, sf), T.quality_snapshots(spark, sf), counts)


@query
def run_deltas(spark, sf):
    """Every run against the one before"""
    return compare.compare_all(_measured(spark, sf))


@query
def compare_latest(spark, sf):
    """The latest two runs"""
    return compare.compare_runs(_measured(spark, sf))


@query
def compare_two(spark, sf):
    """Two given runs"""
    return compare.compare_runs(_measured(spark, sf), 20, 7)


@query
def replay_candidates(spark, sf):
    """X2"""
    return compare.replay_candidates(T.runs(spark, sf)).select("run_id", "status")


@query
def replay_source(spark, sf):
    """One source of a stored run again, from its raw rows"""
    tables = _new_tables(spark, "replay")
    run_ingestion(spark, tables, [frame_source("Source A", 1, T.raw_a(spark, sf), "pos"),
                                  frame_source("Source B", 2, T.raw_b(spark, sf), "pos"),
                                  frame_source("Source C", 3, T.raw_c(spark, sf), "pos")],
                  as_of=T.AS_OF, forest=False)
    again, _ = replay_run(spark, tables, 1, "Source B", as_of=T.AS_OF, forest=False)
    return again.select(F.col("total_processed").alias("processed"),
                        F.col("total_inserted").alias("inserted"))


EVENT = ["event", "run_id", "timestamp", "source", "records", "duration_ms", "error", "status"]


@query
def lifecycle_events(spark, sf):
    """E1"""
    return iso(events.lifecycle_events(T.runs_with_results(spark, sf)).select(*EVENT),
               "timestamp")


@query
def event_messages(spark, sf):
    """P14"""
    rows = events.describe_events(events.lifecycle_events(T.runs_with_results(spark, sf)))
    return rows.select("run_id", "event", "source", "message", "tone")


@query
def event_json(spark, sf):
    """JSON without null fields, read back"""
    rows = events.event_json(events.lifecycle_events(T.runs_with_results(spark, sf)))
    return rows.select("run_id", "event", "source",
                       F.size(F.json_object_keys("message")).cast("bigint").alias("fields"),
                       F.get_json_object("message", "$.event").alias("event_text"))


@query
def activity_feed(spark, sf):
    """R16"""
    rows = events.lifecycle_events(T.runs_with_results(spark, sf))
    return iso(events.activity_feed(rows).select("run_id", "message", "tone", "timestamp"),
               "timestamp")


@query
def run_state(spark, sf):
    """E2"""
    return iso(events.run_state(events.lifecycle_events(T.runs_with_results(spark, sf))),
               "last_at")


@query
def source_state(spark, sf):
    """E2"""
    return iso(events.source_state(events.lifecycle_events(T.runs_with_results(spark, sf))),
               "last_at")


# -- whole runs ----------------------------------------------------------------

@query
def ingest_run(spark, sf):
    """S1-S7, K1-K9, E1, Q-L: a complete run from three sources into tables"""
    root = shared_folder(spark, "run")
    tables = Tables(spark, root, "millrace_" + root.rsplit("-", 1)[1].lower()).create()
    specs = [frame_source("Source A", 1, T.raw_a(spark, sf), "pos"),
             frame_source("Source B", 2, T.raw_b(spark, sf), "pos"),
             frame_source("Source C", 3, T.raw_c(spark, sf), "pos")]
    run = run_ingestion(spark, tables, specs, as_of=T.AS_OF, forest=False)
    stored = tables.read("records").agg(F.count(F.lit(1))).scalar()
    rejected = tables.read("rejects").agg(F.count(F.lit(1))).scalar()
    twice = tables.read("duplicates").agg(F.count(F.lit(1))).scalar()
    return run.select(*RUN, "total_inserted", stored.alias("stored"),
                      rejected.alias("rejects"), twice.alias("duplicates"))


def _new_tables(spark, purpose: str) -> Tables:
    root = shared_folder(spark, purpose)
    return Tables(spark, root, "millrace_" + root.rsplit("-", 1)[1].lower()).create()


@query
def ingest_files(spark, sf):
    """Feeds read from CSV and JSON files of unequal size, numbers partly
    sent as text, one feed with payloads of mixed schema; each source's status"""
    tables = _new_tables(spark, "files")
    a, b, c = (f"{tables.root}/in/{n}" for n in "abc")
    T.raw_a(spark, sf).drop("pos").repartition(3, "id").write.csv(a, header=True)
    rows = T.raw_b(spark, sf)
    names = [n for n in rows.columns if n != "pos"]
    text = rows.withColumn("value", F.col("value").cast("string"))
    for part, frame in (("even", rows.filter("pos % 2 = 0")), ("odd", text.filter("pos % 2 = 1"))):
        frame.select(names).write.json(f"{b}/{part}")
    T.raw_c(spark, sf).drop("pos").write.json(c)
    run_ingestion(spark, tables, [
        file_source("Source A", 1, a, "csv", options={
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}),
        file_source("Source B", 2, [f"{b}/even", f"{b}/odd"], "json"),
        payload_source("Feed M", 3, c)], as_of=T.AS_OF, forest=False)
    return tables.sources().select("source", "records_received", "records_processed", "duplicates")


@query
def ingest_repeat(spark, sf):
    """The same run twice under one run id changes nothing"""
    tables = _new_tables(spark, "repeat")
    specs = [frame_source("Source A", 1, T.raw_a(spark, sf), "pos"),
             frame_source("Source B", 2, T.raw_b(spark, sf), "pos"),
             frame_source("Source C", 3, T.raw_c(spark, sf), "pos")]
    for _ in range(2):
        run = run_ingestion(spark, tables, specs, run_id=1, as_of=T.AS_OF, forest=False)
    counts = [rows.agg(F.count(F.lit(1))).scalar().alias(n) for rows, n in (
        (tables.read("records"), "stored"), (tables.read("rejects"), "rejects"), (tables.read("duplicates"), "duplicates"),
        (tables.read("quality_metrics"), "quality_rows"), (tables.read("pipeline_health"), "health_rows"),
        (tables.sources(), "source_rows"), (tables.runs(), "run_rows"), (tables.read("events"), "event_rows"))]
    return run.select(*RUN, "total_inserted", *counts)


class _Flaky:
    """A source that fails a number of times before it answers, or takes too long."""

    def __init__(self, frame: DataFrame, failures: int = 0, seconds: float = 0.0):
        self.frame, self.failures, self.seconds = frame, failures, seconds

    def __call__(self, spark) -> DataFrame:
        if self.failures > 0:
            self.failures -= 1
            raise OSError("not ready")
        time.sleep(self.seconds)
        return self.frame


@query
def ingest_retry(spark, sf):
    """One source fails twice, one always, one never answers in time"""
    tables = _new_tables(spark, "retry")
    frames = [T.raw_a(spark, sf), T.raw_b(spark, sf), T.raw_c(spark, sf)]
    reads = [_Flaky(frames[0], failures=2), _Flaky(frames[1], failures=99),
             _Flaky(frames[2], seconds=60.0)]
    names = ["Source A", "Source B", "Source C"]
    specs = [SourceSpec(n, k + 1, r, "pos") for k, (n, r) in enumerate(zip(names, reads))]
    outcomes = load_sources(spark, specs[:2], 1, tables.raw_root, attempts=3, retry_seconds=0.1)
    outcomes += load_sources(spark, specs[2:], 1, tables.raw_root, timeout=2.0, attempts=2,
                             retry_seconds=0.1)
    return outcome_frame(spark, outcomes, 1).select("source", "status", "received", "attempts")


@query
def lineage_stored(spark, sf):
    """Lineage is rebuilt and stored by the first read, and only read by the second"""
    tables = _new_tables(spark, "lineage")
    run_ingestion(spark, tables, [frame_source("Source A", 1, T.raw_a(spark, sf), "pos")],
                  as_of=T.AS_OF, forest=False)
    first = lineage_of(tables).count()
    stored = tables.read("data_lineage").count()
    again = lineage_of(tables).count()
    after = tables.read("data_lineage").agg(F.count(F.lit(1)).alias("steps"))
    return after.select("steps", F.lit(stored).alias("stored_by_first"),
                        F.lit(first).alias("first_read"), F.lit(again).alias("second_read"))


@query
def quality_of_nothing(spark, sf):
    """Q9: scores of an empty selection"""
    none = dedupe.with_fingerprint(T.canonical(spark, sf)).filter("source = 'no such source'")
    return quality.quality_scores(none, T.AS_OF)


@query
def incremental_analysis(spark, sf):
    """Q1-Q8, M1-M3 from the counters of three runs against a scan of the whole store"""
    tables = _new_tables(spark, "counters")
    for k, raw in enumerate((T.raw_a, T.raw_b, T.raw_c)):
        run_ingestion(spark, tables, [frame_source(f"Source {'ABC'[k]}", k + 1, raw(spark, sf), "pos")],
                      run_id=k + 1, as_of=T.AS_OF, forest=False)
    counters, records = tables.read("run_counters"), tables.records()
    shown = ["overall_score", "completeness", "validity", "consistency", "uniqueness", "freshness"]
    kinds = [("counters", quality.snapshot_of(counters, None, 3, T.AS_OF), value_stats_of(counters)),
             ("records", quality.quality_snapshot(records, 3, T.AS_OF),
              anomaly.value_stats(records, records.limit(0)))]
    return reduce(DataFrame.unionByName, [
        snap.select(F.lit(kind).alias("kind"), *shown,
                    F.expr("cast(details['total_records_evaluated'] as bigint)").alias("evaluated"),
                    *[F.round(stats.select(c).scalar(), 4).alias(c) for c in ("mean", "std", "high")])
        for kind, snap, stats in kinds])


@query
def quality_first_read(spark, sf):
    """The first read computes a snapshot and stores it, the second finds it"""
    tables = _new_tables(spark, "first")
    rows = dedupe.with_fingerprint(validate.valid_records(T.feed(spark, sf, "Source A")))
    tables.save_records(dedupe.first_occurrences(rows), 1)
    one = quality_or_compute(tables, T.AS_OF).first()
    two = quality_or_compute(tables, "2025-01-01 00:00:00").first()
    return tables.read("quality_metrics").agg(F.count(F.lit(1)).alias("snapshots")).select(
        "snapshots", F.lit(one["timestamp"] == two["timestamp"]).alias("same"),
        F.lit(one["details"]["total_records_evaluated"]).cast("bigint").alias("records"))


@query
def run_state_repeated(spark, sf):
    """A run that ended PARTIAL first and was then repeated"""
    rows = events.lifecycle_events(T.runs_with_results(spark, sf))
    early = rows.withColumns({"timestamp": F.expr("timestamp - interval 1 day"), "status": F.when(
        F.col("event") == "INGESTION_COMPLETED", "PARTIAL"), "records": F.lit(None).cast("bigint")})
    return iso(events.run_state(early.unionByName(rows)), "last_at")


@query
def stream_ingest(spark, sf):
    """7.5, D5: feed C as a stream into tables; the kept records"""
    root = shared_folder(spark, "stream")
    tables = Tables(spark, root, "millrace_" + root.rsplit("-", 1)[1].lower()).create()
    arriving = T.table_stream(spark, sf, "events")
    rows = normalize.normalize_feed(T.as_feed_c(arriving), "Source C", 3, as_of=T.AS_OF)
    streaming.start_ingest(spark, tables, rows, f"{root}/checkpoint",
                           as_of=T.AS_OF).awaitTermination()
    return tables.records().select("record_hash", "record_id", "email")


@query
def stream_three_feeds(spark, sf):
    """7.5, S1, D1: all feeds in one stream; the lowest source rank keeps a record"""
    tables = _new_tables(spark, "feeds")
    shaped = [("customer", T.as_feed_a), ("orders", T.as_feed_b), ("events", T.as_feed_c)]
    rows = normalize.union_feeds([
        normalize.normalize_feed(as_feed(T.table_stream(spark, sf, name)), f"Source {'ABC'[k]}", k + 1,
                                 as_of=T.AS_OF) for k, (name, as_feed) in enumerate(shaped)])
    streaming.start_ingest(spark, tables, rows, f"{tables.root}/checkpoint",
                           as_of=T.AS_OF).awaitTermination()
    return tables.records().select("record_hash", "record_id", "email", "source")


@query
def stream_run_state_updates(spark, sf):
    """E2 in update mode over several micro-batches"""
    root = shared_folder(spark, "updates")
    rows = events.lifecycle_events(T.runs_with_results(spark, sf)).drop("seq")
    rows.repartition(4, "event", "source").write.parquet(f"{root}/events")
    arriving = (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{root}/events"))
    streaming.start_run_state(arriving, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return iso(streaming.read_run_state(spark, f"{root}/state").drop("attempt", "silent"), "last_at")


@query
def run_state_keyed(spark, sf):
    """E2 with keyed state: events of two attempts at every run in shuffled micro-batches; the later
    attempt counts, whichever comes first"""
    root = shared_folder(spark, "keyed")
    rows = events.lifecycle_events(T.runs_with_results(spark, sf)).drop("seq")
    broken = rows.filter("event <> 'INGESTION_COMPLETED'").withColumns({
        "attempt": F.lit(1), "timestamp": F.expr("timestamp + interval 2 days"), "records": F.lit(7).cast("bigint")})
    both = broken.unionByName(rows.withColumn("attempt", F.lit(2)))
    both.repartition(5, F.xxhash64("run_id", "event", "source", "attempt")).write.parquet(f"{root}/events")
    arriving = (spark.readStream.schema(both.schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{root}/events"))
    streaming.start_run_state(arriving, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return iso(streaming.read_run_state(spark, f"{root}/state").drop("silent"), "last_at")


@query
def events_live(spark, sf):
    """A run and its repetition while a stream reads the log: every event of both attempts once"""
    tables = _new_tables(spark, "live")
    specs = [frame_source("Source A", 1, T.raw_a(spark, sf), "pos"),
             frame_source("Source C", 2, T.raw_c(spark, sf), "pos")]
    seen = f"{tables.root}/seen"
    stream = (streaming.event_stream(spark, tables).writeStream.format("parquet")
              .option("checkpointLocation", f"{tables.root}/checkpoint").option("path", seen)
              .trigger(processingTime="1 second").start())
    try:
        for _ in range(2):
            run_ingestion(spark, tables, specs, run_id=1, as_of=T.AS_OF, forest=False)
            stream.processAllAvailable()
    finally:
        stream.stop()
    arrived = spark.read.schema(schemas.EVENTS).parquet(seen)
    return (arrived.groupBy("run_id", "attempt", "seq", "event", "source", "records").count()
            .groupBy("run_id", "attempt", "event").agg(
                F.count(F.lit(1)).alias("events"), F.max("count").alias("times"),
                F.coalesce(F.sum("records"), F.lit(0)).alias("records")))


@query
def compacted_store(spark, sf):
    """K2: twenty appends with compaction in between; files per bucket, and what a reader sees that
    began before a swap"""
    root = shared_folder(spark, "compacted")
    tables = Tables(spark, root, "millrace_" + root.rsplit("-", 1)[1].lower(), buckets=4, files_per_bucket=2).create()
    rows = dedupe.first_occurrences(dedupe.with_fingerprint(validate.valid_records(T.feed(spark, sf, "Source A"))))
    rows = written(rows.withColumn("part", F.col("pos") % 20), "parts", "part")
    before, swaps, same = None, 0, True
    for k in range(20):
        tables.save_records(rows.filter(F.col("part") == k).drop("part"), k + 1)
        before = tables.read("records")
        if tables.compact_if_needed():
            swaps += 1
            same = same and before.count() == tables.read("records").count()
    most = max(tables.record_files().values())
    return tables.read("records").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("record_hash").alias("different"),
        F.countDistinct("run_id").alias("runs")).select(
        "*", F.lit(most <= 2).alias("few_files"), F.lit(swaps > 1).alias("swapped"), F.lit(same).alias("same_for_readers"))


@query
def exact_moments(spark, sf):
    """M1-M3: mean, deviation and bounds over the rows, over the same rows dealt otherwise, and from the
    counters of parts of them, equal to the last bit"""
    rows = dedupe.with_fingerprint(validate.valid_records(T.canonical(spark, sf)))
    parts = reduce(DataFrame.unionByName, [run_counters(rows.filter(F.pmod("pos", F.lit(3)) == k)) for k in range(3)])
    one, two, three = (stats.first() for stats in (
        anomaly.value_stats(rows, rows.limit(0)), anomaly.value_stats(rows.repartition(7, "pos"), rows.limit(0)),
        value_stats_of(parts)))
    stats = anomaly.value_stats(rows, rows.limit(0))
    return stats.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "low", "high")],
                        F.lit(one == two).alias("any_partitioning"), F.lit(one == three).alias("from_counters"))


@query
def incremental_forest(spark, sf):
    """The forest from what three runs have left, against a fit on all their records"""
    tables = _new_tables(spark, "forest")
    for k in range(3):
        rows = dedupe.with_fingerprint(validate.valid_records(T.feed(spark, sf, f"Source {'ABC'[k]}")))
        tables.save_records(dedupe.first_occurrences(rows), k + 1)
        summarise_values(tables, k + 1)
    stored, whole = run_forest(tables, 3), fit_forest(tables.records(), ("record_hash",))
    kept = tables.read("value_counts").agg(F.sum("rows").alias("trained"))
    return kept.select("trained", F.lit(bool(np.array_equal(stored.borders, whole.borders))).alias("same_steps"),
                       F.lit(bool(np.array_equal(stored.scores, whole.scores))).alias("same_scores"),
                       F.lit(bool(stored.threshold == whole.threshold)).alias("same_threshold"),
                       F.lit(stored.intervals() == whole.intervals()).alias("same_ranges"))


@query
def health_first_read(spark, sf):
    """The first read computes the health of the stored runs and stores it, the second finds it"""
    tables = _new_tables(spark, "health")
    some = T.runs(spark, sf)
    tables.save_run(some)
    tables.save_source_status(T.source_log(spark, sf))
    first = health_or_compute(tables, T.AS_OF).first()
    again = health_or_compute(tables, "2025-01-01 00:00:00")
    return again.select(
        "overall_score", "availability", "latency", "validation", "reliability", "status",
        (F.col("updated_at") == F.lit(first["updated_at"])).alias("same"),
        tables.read("pipeline_health").agg(F.count(F.lit(1))).scalar().alias("snapshots"))


@query
def alerts_reraised(spark, sf):
    """Anomalies of the first half of the runs, scanned twice, then those of all: the second scan
    raises nothing, the later one raises the cluster again"""
    tables = _new_tables(spark, "reraised")
    none, log = T.runs(spark, sf).limit(0), T.source_log(spark, sf).limit(0)
    found = _anomalies(spark, sf)
    first = found.filter(F.col("run_id") <= 15)
    scans = []
    for rows in (first, first, found):
        tables.save_alerts(alerts.scan_alerts(log, none, rows, as_of=T.AS_OF))
        scans.append(tables.alerts().count())
    return tables.alerts().groupBy("severity", "source", "status").agg(F.count(F.lit(1)).alias("alerts")).select(
        "*", F.lit(scans[0]).alias("after_first"), F.lit(scans[1]).alias("after_repeat"))


@query
def stream_recent_duplicates(spark, sf):
    """D5 in a stream: within the watermark each fingerprint passes once"""
    root = shared_folder(spark, "recent")
    arriving = T.table_stream(spark, sf, "events")
    rows = normalize.normalize_feed(T.as_feed_c(arriving), "Source C", 3, as_of=T.AS_OF)
    (streaming.drop_recent_duplicates(rows).writeStream.format("parquet")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
     .start(f"{root}/out").awaitTermination())
    return spark.read.parquet(f"{root}/out").select("record_hash", "record_id")


@query
def stream_run_state(spark, sf):
    """E2 over the event table as a stream"""
    root = shared_folder(spark, "events")
    rows = events.lifecycle_events(T.runs_with_results(spark, sf)).drop("seq")
    rows.write.mode("overwrite").parquet(f"{root}/events")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{root}/events")

    newest = []

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/state/{batch_id}")
        newest[:] = [batch_id]

    (streaming.stream_run_state(arriving).writeStream.outputMode("complete")
     .foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return iso(spark.read.parquet(f"{root}/state/{newest[0]}"), "last_at")
