"""Queries that use their records many times compute them once."""

import pytest
from pyspark.sql import functions as F

from catalog import queries as Q


@pytest.fixture
def small(spark, tmp_path):
    sf = str(tmp_path / "in")
    ids = spark.range(60)
    ids.select(F.col("id").alias("c_custkey"), F.concat(F.lit("Name "), "id").alias("c_name"),
               F.col("id").cast("double").alias("c_acctbal")).write.parquet(f"{sf}/customer.parquet")
    ids.select(F.col("id").alias("o_orderkey"), (F.col("id") % 20).alias("o_custkey"), F.lit(5.0).alias("o_totalprice"),
               F.lit("2024-01-02").cast("date").alias("o_orderdate")).write.parquet(f"{sf}/orders.parquet")
    ids.select(F.col("id").alias("event_id"), (F.col("id") % 30).alias("user_id"), F.lit("view").alias("event_type"),
               F.lit(1.5).alias("value"), F.lit("2024-01-03 04:05:06").cast("timestamp").alias("ts")
               ).write.parquet(f"{sf}/events.parquet")
    return sf


def test_appends_read_written_rows(spark, small, monkeypatch):
    read, save = [], Q.Tables.save_records
    monkeypatch.setattr(Q.Tables, "save_records", lambda self, batch, run: read.extend(batch.inputFiles()) or save(self, batch, run))
    row = Q.QUERIES["compacted_store"](spark, small).first()
    assert row["records"] == row["different"] > 40 and row["runs"] == 20
    assert read and not any(small in f for f in read)


def test_a_deep_page_reads_written_rows(spark, small, monkeypatch):
    read, at = [], Q.reads.records_page_at
    monkeypatch.setattr(Q.reads, "records_page_at", lambda rows, counts, *more: read.extend(
        [*rows.inputFiles(), *counts.inputFiles()]) or at(rows, counts, 2, 7))
    got = [tuple(r) for r in Q.QUERIES["records_page_deep"](spark, small).collect()]
    want = Q.iso(Q.reads.records_page(Q.T.records(spark, small), 2, 7).select(*Q.PAGE), "ingested_at")
    assert got == [tuple(r) for r in want.collect()] and len(got) == 7
    assert read and not any(small in f for f in read)
