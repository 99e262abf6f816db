"""Lifecycle events (E1), their texts (P13, P14), feed (R16) and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K

EVENT_COLUMNS = ["event", "run_id", "timestamp", "source", "records", "duration_ms",
                 "error", "status"]


def _event(name: Column | str, at: Column, *, source=None, records=None, duration_ms=None,
           error=None, status=None) -> Column:
    def value(v, kind: str) -> Column:
        return (F.lit(v) if v is None else v).cast(kind)

    return F.struct((F.lit(name) if isinstance(name, str) else name).alias("event"),
                    at.cast("timestamp").alias("timestamp"),
                    value(source, "string").alias("source"),
                    value(records, "bigint").alias("records"),
                    value(duration_ms, "double").alias("duration_ms"),
                    value(error, "string").alias("error"),
                    value(status, "string").alias("status"))


def _after(start: Column, ms: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + F.round(ms * 1000).cast("bigint"))


def lifecycle_events(runs: DataFrame) -> DataFrame:
    """The events of each run, from its row alone: started, per source started
    and completed or failed, finished. ``seq`` is the order within a run."""
    return one_by_one(event_lists(runs))


def one_by_one(lists: DataFrame) -> DataFrame:
    """Rows of event_lists() as one row per event; columns beside the list stay."""
    beside = [c for c in lists.columns if c not in ("run_id", "events")]
    return (lists.select("run_id", *beside, F.posexplode("events").alias("seq", "_e"))
            .select(F.col("_e.event").alias("event"), "run_id", "_e.timestamp", "_e.source",
                    "_e.records", "_e.duration_ms", "_e.error", "_e.status", "seq", *beside))


def event_lists(runs: DataFrame) -> DataFrame:
    """run_id and the list of its events, in order."""
    start = F.col("started_at")

    def of_source(r: Column) -> Column:
        ok = r["status"] == "SUCCESS"
        done = _event(F.when(ok, "SOURCE_COMPLETED").otherwise("SOURCE_FAILED"),
                      _after(start, r["duration_ms"]), source=r["source"],
                      records=F.when(ok, r["received"]), duration_ms=r["duration_ms"],
                      error=F.when(~ok, r["error"]))
        return F.array(_event("SOURCE_STARTED", start, source=r["source"]), done)

    inner = F.array_sort(F.flatten(F.transform("source_results", of_source)),
                         lambda a, b: F.when(a["timestamp"] < b["timestamp"], -1)
                         .when(a["timestamp"] > b["timestamp"], 1).otherwise(0))
    finish = F.coalesce("completed_at", _after(start, F.coalesce("duration_ms", F.lit(0.0))))
    first = F.array(_event("INGESTION_STARTED", start))
    last = F.array(_event("INGESTION_COMPLETED", finish, status=F.col("status"),
                          duration_ms=F.col("duration_ms")))
    return runs.select("run_id", F.concat(first, inner, last).alias("events"))


def event_json(events: DataFrame) -> DataFrame:
    """JSON text of each event without its null fields."""
    from millrace.functions.instants import iso_format
    fields = [iso_format(c).alias(c) if c == "timestamp" else F.col(c) for c in EVENT_COLUMNS]
    return events.withColumn("message", F.to_json(F.struct(*fields)))


def describe_events(events: DataFrame) -> DataFrame:
    """Readable line and tone of each event."""
    source, run = F.col("source"), F.col("run_id").cast("string")
    count = F.coalesce("records", F.lit(0)).cast("string")
    cause = F.coalesce(F.concat(F.lit(" — "), F.nullif("error", F.lit(""))), F.lit(""))
    done = F.coalesce("status", F.lit("unknown"))
    kind = F.col("event")
    text = (F.when(kind == "INGESTION_STARTED", F.concat(F.lit("Run #"), run, F.lit(" started")))
            .when(kind == "SOURCE_STARTED", F.concat(source, F.lit(" started")))
            .when(kind == "SOURCE_COMPLETED",
                  F.concat(source, F.lit(" completed — "), count, F.lit(" records")))
            .when(kind == "SOURCE_FAILED", F.concat(source, F.lit(" failed"), cause))
            .when(kind == "INGESTION_COMPLETED",
                  F.concat(F.lit("Run #"), run, F.lit(" finished — "), done))
            .otherwise("Ingestion event received"))
    failed = (kind == "SOURCE_FAILED") | ((kind == "INGESTION_COMPLETED") & (done == "FAILED"))
    good = kind.isin("SOURCE_COMPLETED", "INGESTION_COMPLETED")
    tone = F.when(failed, "error").when(good, "success").otherwise("info")
    return events.withColumn("message", text).withColumn("tone", tone)


def activity_feed(events: DataFrame, limit: int = K.ACTIVITY_ITEMS) -> DataFrame:
    """The newest events with their texts, as a top-k."""
    order = [F.desc("timestamp"), F.desc("run_id")]
    order += [F.desc("seq")] if "seq" in events.columns else []
    return describe_events(events.orderBy(*order).limit(limit))


def _sources(event: str) -> Column:
    """How many sources have the event; a repeated run says it again of the same ones."""
    own = F.collect_set(F.when(F.col("event") == event, F.col("source")))
    return F.size(own).cast("bigint")


def run_state(events: DataFrame) -> DataFrame:
    """Current state of each run, folded from its events; works on a stream."""
    # Of events at the same instant the one later in the life of a run counts.
    at = F.struct("timestamp", F.array_position(
        F.array(*[F.lit(e) for e in K.EVENT_TYPES]), F.col("event")).alias("n"))
    return events.groupBy("run_id").agg(
        F.max_by("event", at).alias("last_event"), F.max("timestamp").alias("last_at"),
        F.max(F.col("event") == "INGESTION_COMPLETED").alias("finished"),
        F.max_by("status", F.when(F.col("status").isNotNull(), at)).alias("status"),
        _sources("SOURCE_COMPLETED").alias("sources_completed"),
        _sources("SOURCE_FAILED").alias("sources_failed"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"))


def source_state(events: DataFrame) -> DataFrame:
    """Current state of each source, folded from its events; works on a stream."""
    at = F.struct("timestamp", F.array_position(
        F.array(*[F.lit(e) for e in K.EVENT_TYPES]), F.col("event")).alias("n"), "run_id")
    return events.filter(F.col("source").isNotNull()).groupBy("source").agg(
        F.max_by("event", at).alias("last_event"), F.max("run_id").alias("last_run"),
        F.max("timestamp").alias("last_at"),
        F.count_if(F.col("event") == "SOURCE_FAILED").alias("failures"))
