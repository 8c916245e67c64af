"""Small tables between jobs do not come in as many files as a shuffle has partitions."""

import pytest
from pyspark.sql import functions as F

from covaria import session
from covaria.llm import common, decontaminate, simhash

from .helpers import awkward, documents


@pytest.fixture
def many_partitions(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def noted(monkeypatch, module):
    files = []

    def cut(df, *rows):
        files.append(len((out := session.cut_lineage(df, *rows)).inputFiles()))
        return out

    monkeypatch.setattr(module, "cut_lineage", cut)
    return files


def test_rounds_of_components_write_few_files(spark, monkeypatch, many_partitions):
    files = noted(monkeypatch, common)
    edges = spark.range(600).filter("id % 100 != 99").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = {r.node: r.root for r in common.components(edges).collect()}
    assert found == {i: i // 100 * 100 for i in range(600)}
    # The first table's rows are not known before it is written.
    assert len(files) > 4 and max(files[1:]) <= spark.sparkContext.defaultParallelism


def test_keep_one_writes_few_files(spark, monkeypatch, many_partitions):
    files = noted(monkeypatch, simhash)
    rows = awkward() + [(100 + i, f"text {i} of its own words {i * 7} and {i * 11}") for i in range(200)]
    kept = sorted(r.doc_id for r in simhash.keep_one(documents(spark, rows), by_row=True).collect() if r.doc_id is not None)
    assert len(files) == 4 and max(files[1:]) <= spark.sparkContext.defaultParallelism
    assert kept[:3] == [0, 1, 2] and 24 not in kept and 25 not in kept


def test_rows_beyond_a_file_keep_more_files(spark, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 10)
    assert len(session.cut_lineage(spark.range(1000).repartition(40), 300).inputFiles()) == 30


def test_scan_of_few_documents_has_few_partitions(spark, monkeypatch, many_partitions):
    rows = awkward()
    benchmark = spark.createDataFrame([("b", rows[3][1])], "item_id string, text string")
    found = decontaminate.scan(documents(spark, rows), benchmark)
    cores = spark.sparkContext.defaultParallelism
    assert found.rdd.getNumPartitions() <= cores
    got = found.collect()
    assert len(got) == len(rows) and sorted(r.id for r in got if r["items"]) == [3, 25, 26]
    monkeypatch.setattr(session, "FILE_ROWS", 1)
    assert decontaminate.scan(documents(spark, rows), benchmark).rdd.getNumPartitions() == len(rows)
