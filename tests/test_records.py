"""Normalisation, validation and deduplication."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from millrace import schemas
from millrace.operators import dedupe, normalize, validate

AS_OF = "2026-09-23 00:00:00"
CANON = "record_id string, name string, email string, value double, source string, " \
        "created_at string, source_rank int, pos long"


def canon(spark, rows):
    return spark.createDataFrame(rows, CANON).withColumn(
        "created_at", F.col("created_at").try_cast("timestamp"))


def test_feeds(spark):
    a = spark.createDataFrame([(" Q-77 ", " Nadia ", "NADIA@Mail.ORG", "812", "03-02-2025", 0),
                               (None, "", None, "not-a-number", "x", 1)],
                              T.StructType([*schemas.RAW_A.fields,
                                            T.StructField("pos", T.LongType())]))
    rows = normalize.normalize_feed(a, "Source A", 1, as_of=AS_OF).orderBy("pos").collect()
    assert tuple(rows[0])[:5] == ("Q-77", "Nadia", "nadia@mail.org", 812.0, "Source A")
    assert str(rows[0]["created_at"]) == "2025-02-03 00:00:00"
    assert tuple(rows[1])[:6] == ("", None, None, None, "Source A", None)
    c = spark.createDataFrame([("C-1", "Cy", "c@x.y", "41.5", "2025-02-03T08:15:00", 0)],
                              "userId string, username string, mail string, "
                              "transaction_value string, createdAt string, pos long")
    row = normalize.normalize_feed(c, "Source C", 3, as_of=AS_OF).first()
    assert (row["value"], str(row["created_at"])) == (41.5, "2025-02-03 08:15:00")
    assert normalize.normalize_feed(c.drop("mail"), "Source C", 3).first()["email"] is None


def test_mixed(spark):
    payloads = ['{"id": null, "name": "x", "amount": 1500}', '{"customer_id": "B", "value": 2.5}',
                '{"userId": 7, "mail": " M@X.Y "}', '{"record_id": " r1 ", "name": "n"}',
                '{"id": "a", "customer_id": "b"}', '{"k": 1}', 'broken']
    raw = spark.createDataFrame(list(enumerate(payloads)), "pos long, payload string")
    rows = normalize.normalize_mixed(raw, as_of=AS_OF).orderBy("pos").collect()
    assert [r["source"] for r in rows] == ["Source A", "Source B", "Source C", "Unknown",
                                           "Source A", "Unknown", "Unknown"]
    assert [r["record_id"] for r in rows] == ["", "B", "7", "r1", "a", "", ""]
    assert (rows[0]["value"], rows[1]["value"], rows[2]["email"], rows[3]["name"]) == (
        1500.0, 2.5, "m@x.y", None)
    assert [r["source"] for r in normalize.detect_schema(raw.limit(4)).collect()] == [
        "Source A", "Source B", "Source C", "Unknown"]


def test_passthrough(spark):
    raw = spark.createDataFrame([("1", None, None, 0), (None, "2", "s", 1), (None, None, None, 2)],
                                "id string, record_id string, source string, pos long")
    rows = normalize.passthrough(raw, as_of=AS_OF).orderBy("pos").collect()
    assert [(r["record_id"], r["source"]) for r in rows] == [
        ("1", "unknown"), ("2", "s"), ("unknown-2", "unknown")]


GOOD = ("A-1", "Al", "a@b.c", 1.0, "Source A", "2026-09-22", 1, 0)


@pytest.mark.parametrize("field, value, message", [
    (0, "", "Missing record_id"), (0, "  ", "Missing record_id"), (1, None, "Missing name"),
    (2, None, "Invalid email"), (2, "no at sign", "Invalid email"), (2, "a b@c.d", "Invalid email"),
    (2, "a　b@c.d", "Invalid email"), (2, "a@b@c.d", "Invalid email"),
    (3, None, "Value must be numeric"), (3, -5.0, "Value must not be negative"),
    (5, "someday", "Invalid or missing created_at")])
def test_rules(spark, field, value, message):
    row = list(GOOD)
    row[field] = value
    frame = canon(spark, [GOOD, tuple(row)])
    assert [r["errors"] for r in validate.rejected_records(frame).collect()] == [[message]]
    assert validate.valid_records(frame).count() == 1


def test_special_values_pass(spark):
    rows = [(*GOOD[:3], v, *GOOD[4:]) for v in (float("nan"), float("inf"), 0.0)]
    rows.append((GOOD[0], GOOD[1], "ü@é.中", *GOOD[3:]))
    assert validate.valid_records(canon(spark, rows)).count() == 4


def test_counts_and_guard(spark):
    frame = canon(spark, [GOOD, ("", None, *GOOD[2:])])
    assert tuple(validate.validation_counts(frame).first()) == (2, 1, 1)
    assert {r["reason"]: r["rows"] for r in validate.reject_reasons(frame).collect()} == {
        "Missing record_id": 1, "Missing name": 1}
    with pytest.raises(PySparkException, match="refused"):
        validate.require_hash(frame.withColumn("record_hash", F.lit(None).cast("string"))).collect()
    items = spark.createDataFrame([("s", "HIGH"), ("t", "LOW")], "source string, severity string")
    assert validate.items_where(items, source="", severity=None).count() == 2
    assert validate.items_where(items, source="s").count() == 1
    assert validate.records_of(items, "").count() == 0


def _random_rows(n, keys, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
        rank = rng.randrange(1, 4)
        rows.append((key, "n", f"{key}@x.y", 1.0, f"Source {'ABC'[rank - 1]}", "2026-09-22", rank, i))
    return rows


@pytest.mark.parametrize("hot_keys, hot_copies", [(20_000, 10_000), (1, 2), (3, 5)])
def test_duplicates_brute_force(spark, hot_keys, hot_copies):
    rows = _random_rows(400, 60, hot_keys)
    frame = dedupe.with_fingerprint(canon(spark, rows).repartition(5))
    first, report = {}, []
    for r in sorted(rows, key=lambda r: (r[6], r[7])):
        if r[0] in first:
            report.append((first[r[0]][4], r[4], r[0], r[7]))
        else:
            first[r[0]] = r
    got = dedupe.duplicate_report(frame, hot_keys=hot_keys, hot_copies=hot_copies).select(
        "original_source", "duplicate_source", "record_id", "pos").collect()
    assert sorted(map(tuple, got)) == sorted(report)
    kept = dedupe.first_occurrences(frame).select("record_id", "pos").collect()
    assert sorted(map(tuple, kept)) == sorted((k, r[7]) for k, r in first.items())
    pairs = {}
    for a, b, *_ in report:
        pairs[a, b] = pairs.get((a, b), 0) + 1
    assert {(r[0], r[1]): r[2] for r in dedupe.duplicate_pairs(frame).collect()} == pairs
    assert dedupe.duplicate_count(frame).first()["duplicates"] == len(report)


def test_dedupe_by_id_and_store(spark):
    rows = [(k, "n", "e@x.y", 1.0, "Source A", "2026-09-22", 1, i)
            for i, k in enumerate(["K-1", "K-1", "K-2", "K-3", "K-3"])]
    frame = dedupe.with_fingerprint(canon(spark, rows))
    assert dedupe.first_occurrences(frame, ("record_id",)).count() == 3
    stored = frame.filter(F.col("record_id") == "K-2")
    fresh = dedupe.new_records(frame, stored)
    assert sorted(r["pos"] for r in fresh.collect()) == [0, 3]
    assert dedupe.new_records(frame.limit(0), stored).count() == 0


def test_first_wins_keeps_one_row_per_partition_before_the_shuffle(spark):
    plan = dedupe.first_occurrences(dedupe.with_fingerprint(canon(spark, [GOOD]))
                                    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_a_filter_on_the_source_reads_one_feed(spark, tmp_path):
    frames = []
    for rank, (name, column) in enumerate([("Source A", "amount"), ("Source B", "value")], 1):
        fields = schemas.RAW[name].fieldNames()
        path = str(tmp_path / name[-1])
        spark.createDataFrame([tuple("1" for _ in fields)], schemas.RAW[name]).write.parquet(path)
        frames.append(normalize.normalize_feed(
            spark.read.parquet(path).withColumn("pos", F.lit(0)), name, rank, as_of=AS_OF))
    rows = validate.valid_records(normalize.union_feeds(frames)).filter(F.col("source") == "Source B")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "customer_id" in plan
