import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as pipeline


def test_a_stage_called_alone_hands_texts_over_in_small_batches(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.range(0, 3_500, 1, 1).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        kept = pipeline.drop_toxic(spark, docs, str(tmp_path))
        found = [r["n"] for r in kept.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    assert sum(found) == 3_500 and max(found) <= pipeline.BATCH_ROWS
