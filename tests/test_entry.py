import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_points.registry.queries()

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@needs_data
def test_flagship(spark):
    assert entry_points.entry(spark).columns == ["word", "count"]
    assert entry_points.entry(spark).count() == 5


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"ingest_ledger"}))
def test_no_python_in_the_plan(spark, name):
    shown = plan(QUERIES[name](spark, FOLDER))
    assert "EvalPython" not in shown and "InPandas" not in shown
    assert "CartesianProduct" not in shown and "NestedLoopJoin" not in shown


@needs_data
@pytest.mark.parametrize("name", ["mart_review", "mart_tip_text", "ins_category_words", "ins_top_words_by_sentiment_all", "dq_orphans"])
def test_same_rows_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    assert duckdb
    from checks.compare import compare, connect

    assert compare(spark, connect(FOLDER), name, FOLDER).startswith("ok")


def test_words_per_review_are_counted_in_small_parts(spark, tmp_path):
    from checks.standins import Standins

    documents = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 1_000).alias("text"))
    documents.coalesce(1).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/documents.parquet")
    reviews = documents.select(F.lit("same").alias("review_id"), "text")
    dealt = entry_points.registry.in_small_parts(Standins(spark, str(tmp_path)), reviews.unionByName(reviews))
    parts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.length("text")).alias("n")).collect()
    assert sum(p["n"] for p in parts) == 800 * 128_000
    assert len(parts) > 1 and dealt.rdd.getNumPartitions() >= 4
