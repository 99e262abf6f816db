"""Keyed writes as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_by_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """K3: the current row of every key of a log of versions, all columns replaced.

    An aggregate, so each task keeps one row per key before the shuffle.
    """
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return log.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*log.columns)


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """K3: ``current`` with ``changes`` applied; the later row of a key wins, and
    on equal order the change does."""
    versions = (current.withColumn("_v", F.lit(0))
                .unionByName(changes.withColumn("_v", F.lit(1)), allowMissingColumns=True))
    return latest_by_key(versions, keys, [*order, "_v"]).drop("_v")


def merge_source_status(log: DataFrame, strict: bool = False) -> DataFrame:
    """K4: current status of each source from a log of per-run rows.

    The last success and failure are the latest known ones; ``strict`` replaces
    them by the newest row's values, null included.
    """
    if strict:
        return latest_by_key(log, ["source"], ["run_id", "updated_at"])
    newest = F.max_by(F.struct(*log.columns), F.struct("run_id", "updated_at")).alias("_new")
    seen = (log.groupBy("source").agg(newest, F.max("last_success").alias("_success"),
                                      F.max("last_failure").alias("_failure")))
    known = {"last_success": "_success", "last_failure": "_failure"}
    return seen.select(*[F.col(known.get(c, f"_new.{c}")).alias(c) for c in log.columns])


def insert_absent(batch: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """K8, K9: rows of the batch whose id is not stored, one per id. Ids come from
    row content, so the rows of one id are equal and any of them will do."""
    return batch.dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def apply_status(items: DataFrame, status_log: DataFrame) -> DataFrame:
    """Items with their latest logged state; ids that are not items change nothing."""
    latest = status_log.groupBy("id").agg(F.max_by("status", "at").alias("_status"))
    return (items.join(latest, "id", "left")
            .withColumn("status", F.coalesce("_status", "status")).drop("_status")
            .select(*items.columns))
