"""Record lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K
from millrace.functions.rules import error_list


def _details(**pairs: Column | str) -> Column:
    items: list[Column] = []
    for key, value in pairs.items():
        items += [F.lit(key), F.lit(value) if isinstance(value, str) else value.cast("string")]
    return F.create_map(*items)


def _step(number: int, status: Column | str, at: Column, details: Column) -> Column:
    return F.struct(F.lit(number).alias("stage_no"),
                    F.lit(K.LINEAGE_STAGES[number - 1]).alias("stage"),
                    (F.lit(status) if isinstance(status, str) else status).alias("status"),
                    details.alias("details"), at.alias("timestamp"))


def _stored_steps() -> Column:
    """G1: the six stages of a record that was stored."""
    at = F.col("ingested_at")
    source = F.coalesce(F.nullif("source", F.lit("")), F.lit("Unknown Source"))
    return F.array(
        _step(1, "SUCCESS", F.coalesce("created_at", at),
              _details(source=source, raw_id=F.col("record_id"))),
        _step(2, "SUCCESS", at, _details(received_by=K.LINEAGE_RECEIVER)),
        _step(3, "SUCCESS", at, _details(rule_set=K.LINEAGE_RULE_SET, result="PASSED")),
        _step(4, "SUCCESS", at, _details(schema=K.LINEAGE_SCHEMA,
                                         transformed_fields="email,value,created_at")),
        _step(5, "SUCCESS", at, _details(fingerprint_hash=F.coalesce(
            F.nullif("record_hash", F.lit("")), F.lit(K.LINEAGE_NO_HASH)))),
        _step(6, "SUCCESS", at, _details(persisted_to=K.LINEAGE_STORE)))


def _explode(rows: DataFrame, steps: Column) -> DataFrame:
    run = (F.col("run_id") if "run_id" in rows.columns else F.lit(None)).cast("bigint")
    digest = F.col("record_hash") if "record_hash" in rows.columns else F.lit(None).cast("string")
    return (rows.select("record_id", digest.alias("record_hash"), "source", run.alias("run_id"),
                        F.explode(steps).alias("_s"))
            .select("record_id", "record_hash", "source", "run_id", "_s.*"))


def lineage_steps(records: DataFrame) -> DataFrame:
    """G1 for all stored records: six rows each, made in place without a shuffle."""
    return _explode(records, _stored_steps())


def final_status(last_stage: Column, last_status: Column) -> Column:
    """STORED when the storage stage succeeded, else the last stage's status."""
    return F.when((last_stage == "STORAGE") & (last_status == "SUCCESS"), "STORED").otherwise(
        last_status)


def _by_time(a: Column, b: Column) -> Column:
    """Order of two steps; details are a map, which has no order of its own."""
    x, y = (F.struct(s["timestamp"], s["stage_no"]) for s in (a, b))
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def nest_lineage(steps: DataFrame) -> DataFrame:
    """One object per stored record with its steps in order.

    Groups are one fingerprint of one record id, which the store holds once, so a
    group has a handful of steps however often a record id occurs.
    """
    step = F.struct("timestamp", "stage_no", "stage", "status", "details", "source", "run_id")
    nested = (steps.groupBy("record_id", "record_hash")
              .agg(F.array_sort(F.collect_list(step), _by_time).alias("steps")))
    first, last = F.element_at("steps", 1), F.element_at("steps", -1)
    return nested.select(
        "record_id", "record_hash", first["source"].alias("source"),
        first["run_id"].alias("run_id"), first["timestamp"].alias("received_at"),
        final_status(last["stage"], last["status"]).alias("final_status"), "steps")


def lineage_summary(steps: DataFrame) -> DataFrame:
    """G2 without the step list, per record id: combines before the shuffle, so it
    holds for an id that a third of all rows carry."""
    at = F.struct("timestamp", "stage_no")
    return (steps.groupBy("record_id").agg(
        F.min_by(F.struct("source", "run_id", "timestamp"), at).alias("_f"),
        F.max_by(F.struct("stage", "status"), at).alias("_l"),
        F.count(F.lit(1)).alias("step_count"))
        .select("record_id", F.col("_f.source").alias("source"),
                F.col("_f.run_id").alias("run_id"), F.col("_f.timestamp").alias("received_at"),
                final_status(F.col("_l.stage"), F.col("_l.status")).alias("final_status"),
                "step_count"))


def lineage_with_fallback(stored: DataFrame, records: DataFrame,
                          record_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored steps, and steps rebuilt for records that have none stored.
    Returns (all steps, the rebuilt ones to be saved); one id or all of them.
    Presence is tested by fingerprint, which the records table holds once."""
    if record_id is not None:
        stored = stored.filter(F.col("record_id") == record_id)
        records = records.filter(F.col("record_id") == record_id)
    known = stored.select("record_hash").distinct()
    rebuilt = lineage_steps(records.join(known, "record_hash", "left_anti"))
    return stored.unionByName(rebuilt), rebuilt


def run_lineage(canonical: DataFrame, kept: DataFrame, at: Column | None = None) -> DataFrame:
    """What happened to every raw row of a batch, rejected and duplicate rows too.

    ``canonical`` is the normalised batch with ``record_hash``, ``kept`` the rows
    that survived deduplication. They meet on the row's place in the batch, which
    is unique, so no join key is frequent.
    """
    place = [c for c in ("run_id",) if c in kept.columns] + ["source_rank", "pos"]
    marks = kept.select(*place, F.lit(True).alias("_kept"))
    rows = canonical.join(marks, place, "left").withColumn("errors", error_list())
    invalid = F.size("errors") > 0
    stored = F.coalesce("_kept", F.lit(False))
    at = F.col("ingested_at") if at is None else at
    checked = F.when(invalid, "FAILED").otherwise("SUCCESS")
    dedup = (F.when(invalid, "SKIPPED").when(stored, "SUCCESS").otherwise("DUPLICATE"))
    saved = F.when(stored & ~invalid, "SUCCESS").otherwise("SKIPPED")
    result = F.when(invalid, F.array_join("errors", "; ")).otherwise("PASSED")
    steps = F.array(
        _step(1, "SUCCESS", F.coalesce("created_at", at),
              _details(source=F.col("source"), raw_id=F.col("record_id"))),
        _step(2, "SUCCESS", at, _details(received_by=K.LINEAGE_RECEIVER)),
        _step(3, checked, at, _details(rule_set=K.LINEAGE_RULE_SET, result=result)),
        _step(4, "SUCCESS", at, _details(schema=K.LINEAGE_SCHEMA,
                                         transformed_fields="email,value,created_at")),
        _step(5, dedup, at, _details(fingerprint_hash=F.col("record_hash"))),
        _step(6, saved, at, _details(persisted_to=K.LINEAGE_STORE)))
    return _explode(rows, steps)
