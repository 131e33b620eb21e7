from bizlens.operators import quality
from bizlens.schemas import TABLES


def found(df):
    return {(r["check"], r["table"], r["column"]): (r["n"], r["passed"]) for r in df.collect()}


def frames(spark):
    review = spark.createDataFrame(
        [("r1", "u1", "b1", "POSITIVE"), ("r1", "u9", "b9", "ODD"), ("r2", None, "b1", None), ("r" * 33, "u1", "b9", "NEUTRAL")],
        "review_id string, user_id string, business_id string, sentiment string",
    )
    return {
        "review": review,
        "user": spark.createDataFrame([("u1", "Ann"), (None, "Nobody")], "user_id string, name string"),
        "business": spark.createDataFrame([("b1", "x" * 300)], "business_id string, name string"),
    }


def test_nulls_and_domain_and_rows(spark):
    tables = frames(spark)
    nulls = found(quality.null_counts({k: tables[k] for k in ("review", "user")},
                                      [("review", "user_id"), ("user", "user_id"), ("user", "name")]))
    assert nulls == {("nulls", "review", "user_id"): (1, False), ("nulls", "user", "user_id"): (1, False),
                     ("nulls", "user", "name"): (0, True)}
    assert found(quality.null_counts({"user": tables["user"]})) == {("nulls", "user", "user_id"): (1, False)}
    assert found(quality.domain_counts({"review": tables["review"]})) == {("domain", "review", "sentiment"): (1, False)}
    assert found(quality.row_counts({**tables, "user": tables["user"].limit(0)})) == {
        ("rows", "review", "*"): (4, True), ("rows", "user", "*"): (0, False), ("rows", "business", "*"): (1, True),
    }


def test_keys_and_parents(spark):
    tables = frames(spark)
    assert found(quality.duplicate_keys(tables)) == {
        ("duplicate_keys", "review", "review_id"): (1, False),
        ("duplicate_keys", "user", "user_id"): (0, True),
        ("duplicate_keys", "business", "business_id"): (0, True),
    }
    assert found(quality.orphans(tables)) == {
        ("orphans of user", "review", "user_id"): (1, False),
        ("orphans of business", "review", "business_id"): (2, False),
    }


def test_lengths_and_dirty_feeds(spark):
    tables = frames(spark)
    lengths = found(quality.too_long({"user": tables["user"]}))
    assert lengths == {("length", "user", "user_id"): (0, True), ("length", "user", "name"): (0, True)}
    long_key = tables["review"].select("review_id", "user_id", "business_id", "sentiment")
    assert found(quality.too_long({"review": long_key}))[("length", "review", "review_id")] == (1, False)
    feed = spark.createDataFrame([(None,), ("",), ("x",)], "text string")
    assert found(quality.missing_text({"tip": feed})) == {("missing_text", "tip", "text"): (2, False)}
    business = spark.createDataFrame([(0,), (1,), (None,)], "is_open int")
    assert found(quality.closed_businesses(business)) == {("closed", "business", "is_open"): (1, False)}


def test_declared_constraints_cover_the_model():
    assert TABLES["review"].not_null == ["review_id", "user_id", "business_id"]
    assert TABLES["user_elite"].not_null == ["user_id", "year"]
    assert {n for n, t in TABLES.items() if t.key} == {"business", "review", "tip", "user"}


def test_one_scan_report_holds_all_column_checks(spark):
    tables = {k: v for k, v in frames(spark).items() if k != "business"}
    report = found(quality.table_report(tables))
    parts = [quality.row_counts(tables), quality.null_counts(tables), quality.too_long(tables),
             quality.domain_counts({"review": tables["review"]})]
    expected = {}
    for part in parts:
        expected.update(found(part))
    assert report == expected
