"""The pipeline stage by stage on a small table."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from concordia.llm.common import drop_stored, stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == names
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and len(left) > 100
        ids = left
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {i for r in packed for i in r.doc_ids} == ids
    drop_stored(spark)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_few_bytes_pass_to_python_at_a_time(spark, sf_dir, stage):
    key, docs = "spark.sql.execution.arrow.maxBytesPerBatch", spark.read.parquet(f"{sf_dir}/documents.parquet")
    spark.conf.unset(key)
    try:
        stage[1](spark, docs, sf_dir)
        rows = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("x"), 4000).alias("text"))
        sizes = rows.mapInArrow(lambda found: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in found), "n long")
        assert sizes.agg(F.max("n")).first()[0] < 1.1 * corpus_pipeline.BATCH_BYTES
    finally:
        spark.conf.unset(key)
