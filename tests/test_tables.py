import pytest
from pyspark.sql import functions as F

from bizlens import session
from bizlens.plans import insights
from bizlens.schemas import TABLES, create_tables
from bizlens.session import materialize, new_folder, scratch_root
from bizlens.sources.tables import append_table, buckets_for, preview, read_tables, register, save_bucketed, sql, write_bucketed, write_table
from tests.conftest import plan, rows


def test_create_tables_and_replace(spark, tmp_path):
    create_tables(spark, ["business_category", "script_log"], str(tmp_path))
    table = spark.table("business_category")
    assert table.columns == TABLES["business_category"].schema.fieldNames() and table.count() == 0
    spark.createDataFrame([("b1", "Bars")], "business_id string, category string").write.insertInto("business_category")
    assert spark.table("business_category").count() == 1
    create_tables(spark, ["business_category"], str(tmp_path))
    assert spark.table("business_category").count() == 0


def test_append_fits_rows_to_the_declared_table(spark, tmp_path):
    path = f"{tmp_path}/user_elite"
    years = spark.createDataFrame([("2018", "u1", "x")], "year string, user_id string, extra string")
    append_table(years, "user_elite", path)
    append_table(years, "user_elite", path)
    stored = read_tables(spark, str(tmp_path), ["user_elite"])["user_elite"]
    assert rows(stored) == [("u1", 2018), ("u1", 2018)]
    write_table(stored.limit(1), f"{tmp_path}/once")
    assert write_table(stored.limit(1), f"{tmp_path}/once").count() == 1


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    reviews = spark.range(50).selectExpr("cast(id as string) review_id", "concat('b', id % 3) business_id")
    words = spark.range(200).selectExpr("cast(id % 50 as string) review_id", "concat('w', id % 9) word")
    left = write_bucketed(words, "t_words", f"{tmp_path}/w", "review_id", 4)
    right = write_bucketed(reviews, "t_reviews", f"{tmp_path}/r", "review_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "review_id")
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        shown = plan(insights.word_counts(right, left, ["business_id"], selective=False))
        assert shown.count("Exchange hashpartitioning") == 1  # only the one for the words of a business
        assert rows(insights.top_words(right, left)) == rows(insights.top_words(reviews, words))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distribution_keys_bucket_parent_and_child_alike(spark, tmp_path):
    tables = {
        "user": spark.createDataFrame([("u1", "Ann")], "user_id string, name string"),
        "user_elite": spark.createDataFrame([("u1", 2018)], "user_id string, year int"),
    }
    saved = save_bucketed(tables, str(tmp_path), 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = saved["user"].join(saved["user_elite"], "user_id")
        assert "Exchange" not in plan(joined) and rows(joined) == [("u1", "Ann", 2018)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clustered_write_keeps_rows_and_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', concat('b', id % 50)) business_id", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        written = write_table(df, f"{tmp_path}/c", cluster_by=["business_id", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows(written) == rows(df)
    files = written.groupBy(F.input_file_name()).agg(F.min("business_id"), F.max("business_id")).collect()
    spans = sorted((r[1], r[2]) for r in files)
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_sql_parameters_are_values(spark):
    register({"business": spark.createDataFrame([("b1",), ("' or 1=1 --",)], "business_id string")})
    text = "select count(*) n from business where business_id = :id"
    assert sql(spark, text, id="' or 1=1 --").first().n == 1
    assert sql(spark, "select 1 x").first().x == 1


def test_preview(spark):
    assert rows(preview(spark.range(10), 2, ["id"])) == [(0,), (1,)]
    assert preview(spark.range(10)).count() == 2


def test_intermediate_tables_go_to_the_shared_folder(spark):
    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    kept = materialize(spark.range(3))
    assert scratch_root(spark) in kept.inputFiles()[0]


def test_a_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "app-1"
        getConf = staticmethod(Conf)

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext, conf = Context, Conf()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.scratch_root(Session)
    Context.master = "local[2]"
    assert session.scratch_root(Session) == session.scratch_root(Session)


def test_buckets_grow_with_the_stored_table(spark, tmp_path, monkeypatch):
    few, many = (write_table(spark.range(n).withColumn("word", F.sha2(F.col("id").cast("string"), 256)), f"{tmp_path}/{n}") for n in (10, 20_000))
    monkeypatch.setattr("bizlens.sources.tables.BUCKET_BYTES", 100_000)
    assert buckets_for(few, few) == 4  # as many as there are shuffle partitions
    assert buckets_for(few, many) == buckets_for(many) > 4
