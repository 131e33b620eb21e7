import pytest
from pyspark.sql import functions as F

from bizlens.operators.joins import estimated_bytes, fits_broadcast, lookup_join, might_match, runtime_join, top_k
from tests.conftest import plan, rows


def sides(spark):
    """A third of the rows share one key, some keys and lookup rows are null or without partner."""
    big = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("key"),
        (F.col("id") % 5).alias("value"),
    ).repartition(6)
    lookup = spark.createDataFrame(
        [("hot", 1), ("k1", 2), ("k1", 3), ("k2", 4), (None, 5), ("unused", 6)], "key string, info int"
    )
    return big, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [1_000, 0])
def test_lookup_join_equals_plain_join(spark, how, max_rows):
    big, lookup = sides(spark)
    joined = lookup_join(big, lookup, "key", how, max_rows=max_rows)
    plain = big.join(lookup, "key", how)
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)
    assert ("BroadcastHashJoin" in plan(joined)) or max_rows == 0


def test_salted_join_splits_the_hot_key(spark):
    big, lookup = sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(big, lookup, "key", max_rows=0, salts=8)
        assert "_salt" in plan(joined)
        hot = joined.filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("filter_from", [10**99, 0])
def test_runtime_join_equals_plain_join(spark, how, filter_from):
    big, lookup = sides(spark)
    joined = runtime_join(big, lookup, "key", how, filter_from=filter_from)
    plain = big.join(lookup, "key", how)
    assert joined.columns == plain.columns and rows(joined) == rows(plain)
    two = big.withColumn("b", F.col("value") % 2), lookup.withColumn("b", F.lit(1).cast("long"))
    assert rows(runtime_join(*two, ["key", "b"], how, filter_from=filter_from)) == rows(two[0].join(two[1], ["key", "b"], how))
    assert runtime_join(big, lookup.limit(0), "key", how, filter_from=filter_from).count() == 0
    with pytest.raises(ValueError):
        runtime_join(big, lookup, "key", "left")


def test_the_filter_keeps_matches_and_little_else(spark):
    some, all_rows = spark.range(0, 40_000, 40), spark.range(40_000)
    kept = all_rows.filter(might_match(some, ["id"], words=1024))
    assert kept.join(some, "id").count() == 1000 and kept.count() < 2_000
    other = all_rows.withColumnRenamed("id", "other").filter(might_match(some, ["id"], ["other"], words=1024))
    assert sorted(r[0] for r in other.collect()) == sorted(r[0] for r in kept.collect())


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_the_lookup_is_computed_once(spark, tmp_path, how):
    """Its shuffle serves the filter and the join."""
    spark.range(5000).selectExpr("id % 700 as key", "id as n").write.parquet(f"{tmp_path}/lookup")
    lookup = spark.read.parquet(f"{tmp_path}/lookup")
    assert estimated_bytes(lookup) < 10**6
    if how == "inner":
        lookup = lookup.groupBy("key").agg(F.count(F.lit(1)).alias("weight")).filter("weight > 0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = runtime_join(spark.range(3000).withColumnRenamed("id", "key"), lookup, "key", how, filter_from=0)
        assert len(joined.collect()) == 700
        shown = joined._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in shown or shown.count("parquet") == 1, shown
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=9)
    assert not fits_broadcast(df, max_bytes=1000)
    assert fits_broadcast(df.limit(0), max_rows=0)


def test_top_k(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", 9), ("d", 1)], "word string, count int")
    order = [F.desc("count"), F.asc("word")]
    assert [r[0] for r in top_k(df, order, 2).collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan(top_k(df, order, 2))
    grouped = df.unionByName(df.withColumn("word", F.upper("word"))).withColumn("g", F.col("word") < "a")
    top = top_k(grouped, order, 2, within=["g"])
    assert rows(top.select("word")) == [("A",), ("C",), ("a",), ("c",)]
    shown = plan(top)
    assert "WindowGroupLimit" in shown and "Partial" in shown
