"""Splits by rows: a file of few row groups."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from covaria import session


def test_spread_sees_splits_without_rows(spark, tmp_path, monkeypatch):
    pq.write_table(pa.table({"id": list(range(40_000))}), f"{tmp_path}/t.parquet", row_group_size=20_000)
    monkeypatch.setattr(session, "SPLIT_ROWS", 2_000)
    monkeypatch.setattr(session, "MOST_SPLIT_ROWS", 5_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        df = spark.read.parquet(f"{tmp_path}/t.parquet")
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        sizes = [r.n for r in session.spread(df, "id").groupBy(F.spark_partition_id()).agg(F.count("id").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(sizes) == 40_000 and max(sizes) <= 5_000
