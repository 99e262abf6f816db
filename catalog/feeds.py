"""Feeds, runs and source logs derived from the test tables, over all their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.operators.dedupe import first_occurrences, with_fingerprint
from millrace.operators.normalize import normalize_feed, union_feeds
from millrace.operators.quality import quality_by_group
from millrace.operators.runs import run_status
from millrace.operators.validate import valid_records

AS_OF = "2024-01-31 00:00:00"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
DAY_ONE = "2024-01-01"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream. Written as a glob, the path may be a file or a folder."""
    return (spark.readStream.schema(table(spark, sf, name).schema)
            .parquet(f"{sf}/{name}.parque[t]"))


def instant(column: str):
    return F.col(column).cast("timestamp")


def raw_a(spark: SparkSession, sf: str) -> DataFrame:
    return as_feed_a(table(spark, sf, "customer"))


def as_feed_a(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    day = F.date_add(F.lit(DAY_ONE).cast("date"), (key % 28).cast("int"))
    host = F.when(key % 50 == 7, ".example.com").otherwise("@EXAMPLE.COM")
    return customers.select(
        F.concat(F.lit(" C-"), key, F.lit(" ")).alias("id"),
        F.concat(F.lit(" "), "c_name").alias("name"),
        F.concat(F.lit("CUST"), key, host).alias("email"),
        F.when(key % 97 == 5, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("amount"),
        F.date_format(day, "dd-MM-yyyy").alias("created"), key.alias("pos"))


def raw_b(spark: SparkSession, sf: str) -> DataFrame:
    return as_feed_b(table(spark, sf, "orders"))


def as_feed_b(orders: DataFrame) -> DataFrame:
    key = F.col("o_custkey")
    return orders.select(
        F.concat(F.lit("C-"), key).alias("customer_id"),
        F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0")).alias("full_name"),
        F.concat(F.lit("cust"), key, F.lit("@example.com")).alias("email_address"),
        F.col("o_totalprice").alias("value"),
        F.date_format(instant("o_orderdate"), ISO_SECONDS).alias("timestamp"),
        F.col("o_orderkey").alias("pos"))


def raw_c(spark: SparkSession, sf: str) -> DataFrame:
    return as_feed_c(table(spark, sf, "events"))


def as_feed_c(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        F.concat(F.lit("U-"), user).alias("userId"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("User "), user)).alias("username"),
        F.concat(F.lit("user"), user, F.lit("@example.com")).alias("mail"),
        F.col("value").alias("transaction_value"),
        F.date_format(instant("ts"), ISO_SECONDS).alias("createdAt"),
        F.col("event_id").alias("pos"))


def _arrived(canonical: DataFrame) -> DataFrame:
    """Rows arrive at their business time, so that freshness is repeatable."""
    return canonical.withColumn("ingested_at", F.col("created_at"))


def feed(spark: SparkSession, sf: str, source: str) -> DataFrame:
    raw, rank = {"Source A": (raw_a, 1), "Source B": (raw_b, 2), "Source C": (raw_c, 3)}[source]
    return _arrived(normalize_feed(raw(spark, sf), source, rank, as_of=AS_OF))


SOURCES = ("Source A", "Source B", "Source C")


def canonical(spark: SparkSession, sf: str, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    return union_feeds([feed(spark, sf, s) for s in sources])


def valid(spark: SparkSession, sf: str, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Valid rows of the feeds asked for; others are not read."""
    return with_fingerprint(valid_records(canonical(spark, sf, sources)))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """What the store holds after one run over all feeds."""
    return first_occurrences(valid(spark, sf))


def run_day(column: str = "created_at"):
    return (F.datediff(F.col(column), F.lit(DAY_ONE).cast("date")) + 1).cast("bigint")


def feed_c_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "Source C").withColumn("run_id", run_day())


def mixed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """All feeds as JSON objects of differing schemas, and the events' own JSON."""
    parts = [raw.select(F.to_json(F.struct(*[c for c in raw.columns if c != "pos"]),
                                  {"ignoreNullFields": "false"}).alias("payload"),
                        "pos", F.lit(rank).alias("rank"))
             for rank, raw in enumerate((raw_a(spark, sf), raw_b(spark, sf), raw_c(spark, sf)), 1)]
    props = table(spark, sf, "events").select(
        F.col("props").alias("payload"), F.col("event_id").alias("pos"), F.lit(4).alias("rank"))
    return union_feeds([*parts, props])


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run per day of events."""
    ok = F.col("event_type") != "error"
    day = table(spark, sf, "events").withColumn("run_id", run_day("ts")).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_received"), F.count_if(ok).alias("_valid"),
        F.count_distinct(F.when(ok, F.col("user_id"))).alias("total_processed"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("_cents"))
    run = F.col("run_id")
    failed = F.when(run % 7 == 0, 3).when(run % 4 == 0, 1).otherwise(0).cast("bigint")
    start = F.timestamp_seconds(F.unix_timestamp(F.lit(DAY_ONE).cast("timestamp"))
                                + (run - 1) * 86400)
    ms = F.round(F.col("_cents") / 100.0) / 10.0
    return day.select(
        "run_id", run_status(failed, F.lit(3)).alias("status"), "total_received",
        "total_processed", (F.col("_valid") - F.col("total_processed")).alias("total_duplicates"),
        failed.alias("total_failed"), ms.alias("duration_ms"), start.alias("started_at"),
        F.timestamp_micros(F.unix_micros(start) + F.round(ms * 1000).cast("bigint"))
        .alias("completed_at"))


def spiky_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of which every tenth took three times as long."""
    return runs(spark, sf).withColumn("duration_ms", F.when(
        F.col("run_id") % 10 == 0, F.col("duration_ms") * 3).otherwise(F.col("duration_ms")))


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Source outcomes: per day one source for each type of event."""
    per = (table(spark, sf, "events").withColumn("run_id", run_day("ts"))
           .groupBy("run_id", F.col("event_type").alias("source"))
           .agg(F.count(F.lit(1)).alias("received"),
                F.count_distinct("user_id").alias("users")))
    bad = (F.col("run_id") + F.length("source")) % 5 == 0
    error = F.when(bad & (F.col("run_id") % 2 == 1),
                   F.concat(F.lit("feed "), "source", F.lit(" unavailable")))
    return per.select("run_id", "source", F.when(bad, "FAILED").otherwise("SUCCESS")
                      .alias("status"), "received", "users",
                      F.col("received").cast("double").alias("duration_ms"),
                      error.alias("error"))


def source_log(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows of every source and run, as the table of sources logs them."""
    ok = F.col("status") == "SUCCESS"
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(DAY_ONE).cast("timestamp"))
                             + F.col("run_id") * 86400)
    return outcomes(spark, sf).select(
        "source", F.when(ok, "HEALTHY").otherwise("DEGRADED").alias("status"),
        F.when(ok, at).alias("last_success"), F.when(~ok, at).alias("last_failure"),
        F.col("received").alias("records_received"), F.col("users").alias("records_processed"),
        (F.col("received") - F.col("users")).alias("duplicates"),
        F.col("error").alias("error_message"), "run_id", at.alias("updated_at"))


def runs_with_results(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with their source outcomes nested (one entry per type of event)."""
    fields = {f.name: f.dataType for f in schemas.SOURCE_RESULT.fields}
    have = outcomes(spark, sf)
    result = F.struct(*[(F.col(n) if n in have.columns else F.lit(None)).cast(t).alias(n)
                        for n, t in fields.items()])
    nested = have.groupBy("run_id").agg(F.array_sort(F.collect_list(result))
                                        .alias("source_results"))
    return runs(spark, sf).join(nested, "run_id")


def quality_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of feed C per day, as snapshots of the runs of those days."""
    rows = with_fingerprint(feed_c_by_day(spark, sf))
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(DAY_ONE).cast("timestamp"))
                             + F.col("run_id") * 86400)
    return quality_by_group(rows, ("run_id",), AS_OF).withColumn("timestamp", at)
