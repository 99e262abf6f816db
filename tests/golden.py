"""The small golden data set: three feeds, 31 raw rows."""

# Test rows of the three feeds.
FEED_A = [
    ("A-001", "Alice Johnson", "alice.johnson@example.com", "1500", "22-09-2026"),
    ("A-002", "Bob Smith", "bob.smith@example.com", "2200.50", "20-09-2026"),
    ("A-003", "Carol Davis", "carol.davis@example.com", "875", "18-09-2026"),
    ("A-004", "David Lee", "david.lee@example.com", "3000", "15-09-2026"),
    ("A-005", "Eve Turner", "eve.turner@example.com", "450.25", "10-09-2026"),
    ("A-006", "Frank Wright", "frank.wright@example.com", "1200", "05-09-2026"),
    ("A-007", "Grace Kim", "grace.kim@example.com", "990.75", "01-09-2026"),
    ("A-008", "Heidi Brown", "heidi.brown@example.com", "1675", "28-08-2026"),
    ("A-009", "Ivan Chen", "ivan.chen@example.com", "2500", "25-08-2026"),
    ("A-010", "Judy Patel", "judy.patel@example.com", "610", "20-08-2026"),
    ("A-011", "Invalid Record", "not-an-email", "-50", "19-08-2026"),
]
FEED_B = [
    ("A-001", " Alice Johnson ", "alice.johnson@example.com", 1500.0, "2026-09-22T10:30:00"),
    ("A-002", "Bob Smith", "BOB.SMITH@EXAMPLE.COM", 2200.5, "2026-09-20T09:15:00"),
    ("A-003", "Carol Davis", "carol.davis@example.com", 875.0, "2026-09-18T14:00:00"),
    ("A-004", "David Lee", "david.lee@example.com", 3000.0, "2026-09-15T11:45:00"),
    ("B-001", "Karen White", "karen.white@example.com", 1100.0, "2026-09-14T08:00:00"),
    ("B-002", "Leo Martins", "leo.martins@example.com", 1800.0, "2026-09-13T16:20:00"),
    ("B-003", "Mona Iyer", "mona.iyer@example.com", 950.0, "2026-09-12T12:00:00"),
    ("B-004", "Nate Cole", "nate.cole@example.com", 2100.0, "2026-09-11T09:00:00"),
    ("B-005", "Olivia Shah", "olivia.shah@example.com", 700.0, "2026-09-10T13:30:00"),
    ("B-006", "Peter Nolan", "peter.nolan@example.com", 3300.0, "2026-09-09T07:45:00"),
]
FEED_C = [
    ("A-001", "Alice Johnson", "ALICE.JOHNSON@EXAMPLE.COM", 1500.0, "2026-09-22T10:30:00"),
    ("A-005", "Eve Turner", "eve.turner@example.com", 450.25, "2026-09-10T18:00:00"),
    ("B-001", "Karen White", "karen.white@example.com", 1100.0, "2026-09-14T08:00:00"),
    ("B-002", "Leo Martins", "leo.martins@example.com", 1800.0, "2026-09-13T16:20:00"),
    ("C-001", "Wendy Ross", "wendy.ross@example.com", 1250.0, "2026-09-08T10:00:00"),
    ("C-002", "Xavier Cruz", "xavier.cruz@example.com", 875.5, "2026-09-07T09:30:00"),
    ("C-003", "Yara Ahmed", "yara.ahmed@example.com", 1990.0, "2026-09-06T11:15:00"),
    ("C-004", "Zane Foster", "zane.foster@example.com", 620.0, "2026-09-05T14:45:00"),
    ("C-005", "Amara Singh", "amara.singh@example.com", 1430.0, "2026-09-04T16:00:00"),
    ("C-006", "Ben Okafor", "ben.okafor@example.com", 2050.0, "2026-09-03T08:20:00"),
]


def specs(spark, partitions: int = 1):
    from millrace import schemas
    from millrace.sources.feeds import frame_source
    from pyspark.sql import types as T
    out = []
    for rank, (name, rows) in enumerate(
            [("Source A", FEED_A), ("Source B", FEED_B), ("Source C", FEED_C)], start=1):
        schema = T.StructType([*schemas.RAW[name].fields, T.StructField("seq", T.LongType())])
        frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)
        out.append(frame_source(name, rank, frame.repartition(partitions), "seq"))
    return out


def canonical(spark, partitions: int = 1, as_of="2026-09-23 00:00:00"):
    from millrace.operators.normalize import union_feeds
    return union_feeds([s.canonical(s.raw(spark), as_of) for s in specs(spark, partitions)])
