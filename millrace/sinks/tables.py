"""Tables of the pipeline (K1-K10) on Spark's catalog, stored as Parquet.

All writes append. Tables with a key are logs of versions that readers resolve to
the newest version of each key, so a reader never sees a half-applied change and a
repeated write changes nothing. ``records`` is bucketed by fingerprint: finding out
what is new then shuffles the batch but not the store. Every run adds a file to a bucket;
compact_records() rewrites them bucket by bucket and swaps the folder as a whole.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from millrace import schemas
from millrace.functions.asof import AsOf, as_instant
from millrace.operators.dedupe import new_records
from millrace.operators.events import one_by_one
from millrace.operators.upsert import (apply_status, insert_absent, latest_by_key,
                                       merge_source_status)
from millrace.operators.validate import require_hash
from millrace.session import SETTINGS
from millrace.sinks.versions import Folder, Versions

RUN_ORDER = ["completed_at"]
# Tables with one folder per run: writing a run again replaces its rows.
PER_RUN = {"rejects", "duplicates", "run_counters", "forest_samples", "value_counts", "page_counts"}
# Tables with one row per run, the newest; rows without a run are one each. What orders them:
SNAPSHOTS = {"quality_metrics": "timestamp", "pipeline_health": "updated_at"}
FILES_PER_BUCKET = 8
# Columns that lookups are made by: files carry a Bloom filter of them, so a lookup reads the row groups
# that can have the value. Large tables are bucketed as well, by the column that joins or lookups use.
LOOKUP = {"records": "source_record_id", "anomalies": "id", "alerts": "id", "data_lineage": "record_id"}
BUCKETED = {"records": "record_hash", "data_lineage": "record_id"}


class Tables:
    """The tables of one database under one shared folder."""

    def __init__(self, spark: SparkSession, root: str, database: str = "millrace",
                 buckets: int | None = None, files_per_bucket: int = FILES_PER_BUCKET) -> None:
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.files_per_bucket, self._located = files_per_bucket, None
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @property
    def raw_root(self) -> str:
        return f"{self.root}/raw"

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def in_session(self, spark: SparkSession) -> "Tables":
        """The same tables, read and written by another session."""
        return Tables(spark, self.root, self.database, self.buckets, self.files_per_bucket)

    def create(self) -> "Tables":
        """K1: create what is missing; existing files are picked up again."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
                       f"LOCATION '{self.root}/tables'")
        for table, schema in schemas.TABLES.items():
            if table in PER_RUN:
                continue
            location = self._records_folder() if table == "records" else self.folder(table)
            self._create(table, schema, location, table)
        # The table decides, not the session that opens it.
        self.buckets = self._bucket_count() or self.buckets
        return self

    def _create(self, table: str, schema: T.StructType, location: str, like: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        key, looked_up = BUCKETED.get(like), LOOKUP.get(like)
        clustered = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS" if key else ""
        filtered = f"OPTIONS ('parquet.bloom.filter.enabled#{looked_up}' = 'true')" if looked_up else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) "
                       f"USING parquet {filtered} {clustered} LOCATION '{location}'")

    def _bucket_count(self) -> int | None:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name('records')}")
        found = rows.filter("col_name = 'Num Buckets'").first()
        return int(found["data_type"]) if found else None

    def folder(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def read(self, table: str) -> DataFrame:
        """A table's rows: of snapshots the newest of each run, of ``events`` those of each run's
        last attempt."""
        if table == "events":
            log = latest_by_key(self.read("event_log"), ["run_id"], ["attempt"])
            return one_by_one(log).select(*schemas.EVENTS.names)
        if table not in PER_RUN:
            if table == "records":
                self._locate_records()
            # Files may come from another session, such as that of a stream.
            self.spark.catalog.refreshTable(self.name(table))
            rows = self.spark.table(self.name(table))
            return self._newest(rows, SNAPSHOTS[table]) if table in SNAPSHOTS else rows
        try:
            return self.spark.read.schema(schemas.TABLES[table]).parquet(self.folder(table))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schemas.TABLES[table])

    @staticmethod
    def _newest(rows: DataFrame, at: str) -> DataFrame:
        alone = F.concat(F.lit("at "), F.col(at).cast("string"))
        keyed = rows.withColumn("_key", F.coalesce(F.col("run_id").cast("string"), alone))
        return latest_by_key(keyed, ["_key"], [at]).drop("_key")

    def replace_run(self, table: str, rows: DataFrame, run_id: int) -> None:
        """Rows of one run, in a folder of its own that a repeated run overwrites."""
        fields = [f for f in schemas.TABLES[table].fields if f.name != "run_id"]
        (self._shaped(rows, fields).write.mode("overwrite")
         .parquet(f"{self.folder(table)}/run_id={run_id}"))

    @staticmethod
    def _shaped(rows: DataFrame, fields: list[T.StructField]) -> DataFrame:
        have = set(rows.columns)
        return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None))
                             .cast(f.dataType).alias(f.name) for f in fields])

    def append(self, table: str, rows: DataFrame) -> None:
        """K5-K7 and the base of every other write."""
        if table == "records":
            self._locate_records()
        shaped = self._shaped(rows, schemas.TABLES[table].fields)
        if table in BUCKETED and table != "records":
            # One file for each bucket; the records come in their buckets already.
            shaped = shaped.repartition(self.buckets, BUCKETED[table])
        shaped.write.mode("append").insertInto(self.name(table))

    # -- records -------------------------------------------------------------

    def records(self) -> DataFrame:
        """Stored records under their canonical names (P10)."""
        return self.read("records").withColumnRenamed("source_record_id", "record_id")

    def save_records(self, batch: DataFrame, run_id: int | None = None) -> int:
        """Append the records the store does not have; returns how many."""
        run = F.lit(run_id) if run_id is not None else (
            F.col("run_id") if "run_id" in batch.columns else F.lit(None))
        added = Observation()
        fresh = new_records(require_hash(batch), self.read("records"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            # Else the rows already lie in as many partitions as there are buckets.
            fresh = fresh.repartition(self.buckets, "record_hash")
        fresh = (fresh.withColumn("run_id", run.cast("bigint"))
                 .withColumnRenamed("record_id", "source_record_id")
                 .observe(added, F.count(F.lit(1)).alias("rows")))
        self.append("records", fresh)
        return int(added.get["rows"])

    def _versions(self) -> Versions:
        return Versions(self.spark, f"{self.root}/tables/records_versions")

    def _records_folder(self) -> str:
        return self._versions().current() or self.folder("records")

    def _locate_records(self) -> None:
        """Point the catalog at the current version of the records, which another session
        may have compacted."""
        current = self._records_folder()
        if current != self._located:
            self.spark.sql(f"ALTER TABLE {self.name('records')} SET LOCATION '{current}'")
            self._located = current

    def record_files(self) -> dict[int, int]:
        """Data files of each bucket of the records."""
        names = (re.search(r"_(\d{5})\.c\d+", n) for n in Folder(self.spark, self._records_folder()).names())
        return dict(Counter(int(m[1]) for m in names if m))

    def compact_records(self, attempts: int = 3) -> bool:
        """K2: the records rewritten with one file per bucket, without a shuffle: every task reads one
        bucket and writes it. The new folder becomes current in one step; readers that have begun
        keep the old one. Where a run has added files meanwhile, the rewrite is done again."""
        versions = self._versions()
        # A bucket must be read by one task even where nothing above the scan asks for it.
        session = self.spark.newSession()
        for key, value in {**SETTINGS, "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}.items():
            session.conf.set(key, value)
        for _ in range(attempts):
            before = self._records_folder()
            files = Folder(self.spark, before).names()
            target = versions.new()
            table = "records_" + target.rsplit("-", 1)[1]
            self._create(table, schemas.TABLES["records"], target, "records")
            try:
                self._locate_records()
                session.catalog.refreshTable(self.name("records"))
                session.table(self.name("records")).write.mode("append").insertInto(self.name(table))
            finally:
                # The folder stays, it belongs to no catalog.
                self.spark.sql(f"DROP TABLE {self.name(table)}")
            if self._records_folder() == before and Folder(self.spark, before).names() == files:
                versions.publish(target)
                self._locate_records()
                return True
            Folder(self.spark, target).remove()
        return False

    def compact_if_needed(self) -> bool:
        """compact_records(), once buckets have more than ``files_per_bucket`` files on average."""
        if sum(self.record_files().values()) <= self.files_per_bucket * self.buckets:
            return False
        return self.compact_records()

    # -- runs and sources ----------------------------------------------------

    def runs(self) -> DataFrame:
        """K3: newest version of every run."""
        return latest_by_key(self.read("ingestion_runs"), ["run_id"], RUN_ORDER)

    def save_run(self, run: DataFrame) -> None:
        """K3: a later version of a run replaces all columns of the earlier one."""
        self.append("ingestion_runs", run)

    def next_run_id(self) -> int:
        newest = self.read("ingestion_runs").agg(F.max("run_id")).first()[0]
        return (newest or 0) + 1

    def sources(self, strict: bool = False) -> DataFrame:
        """K4: current status of every source."""
        return merge_source_status(self.read("sources"), strict)

    def save_source_status(self, rows: DataFrame) -> None:
        self.append("sources", rows)

    def log_events(self, lists: DataFrame, run_id: int) -> None:
        """The events of one more attempt at a run. The log only grows, by one file per
        attempt, so a stream over it reads every event once."""
        tried = self.read("event_log").filter(F.col("run_id") == run_id).agg(F.max("attempt")).scalar()
        self.append("event_log", lists.withColumn("attempt", F.coalesce(tried, F.lit(0)) + 1))

    # -- anomalies and alerts ------------------------------------------------

    def anomalies(self) -> DataFrame:
        return self.read("anomalies")

    def save_anomalies(self, rows: DataFrame) -> None:
        """K8"""
        self.append("anomalies", insert_absent(rows, self.read("anomalies")))

    def alerts(self) -> DataFrame:
        """Alerts in their current state."""
        return apply_status(self.read("alerts"), self.read("alert_status"))

    def save_alerts(self, rows: DataFrame) -> None:
        """K9"""
        self.append("alerts", insert_absent(rows, self.read("alerts")))

    def set_alert_status(self, changes: DataFrame, as_of: AsOf = None) -> None:
        """Changes (id, status) for alerts that exist; others do nothing."""
        at: Column = as_instant(as_of)
        known = changes.join(self.read("alerts").select("id"), "id", "left_semi")
        self.append("alert_status", known.select("id", "status").withColumn("at", at))

    # -- snapshots -----------------------------------------------------------

    def save_quality(self, row: DataFrame) -> None:
        self.append("quality_metrics", row)

    def save_health(self, row: DataFrame, run_id: int | None = None) -> None:
        self.append("pipeline_health", row.withColumn("run_id", F.lit(run_id).cast("bigint")))

    def save_lineage(self, steps: DataFrame) -> None:
        self.append("data_lineage", steps)

    # -- upkeep --------------------------------------------------------------

    def drop_staged(self, run_id: int) -> None:
        """Remove what a run staged, once its records are stored."""
        Folder(self.spark, f"{self.root}/staged").remove(f"run_id={run_id}")

    def drop_unused_raw(self, run_id: int, used: list[str]) -> None:
        """Remove the raw folders of a run's attempts that did not become its outcome."""
        keep = {"/".join(path.rstrip("/").split("/")[-3:]) for path in used}
        raw = Folder(self.spark, self.raw_root)
        for path in raw.matching(f"source=*/run_id={run_id}/attempt=*"):
            name = "/".join(path.split("/")[-3:])
            if name not in keep:
                raw.remove(name)
