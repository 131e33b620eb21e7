import json

from bizlens.operators import quality
from bizlens.plans import marts
from bizlens.schemas import CORRUPT, FEEDS
from bizlens.session import new_folder
from bizlens.sources.feeds import good_records, quarantined, read_feed
from tests.conftest import rows

BUSINESSES = [
    {"business_id": "b1", "name": "One", "is_open": 1, "categories": "Tailors, Laundry", "latitude": 1.5},
    {"business_id": "b2", "name": "Two", "is_open": 0, "categories": "Bars"},
    {"business_id": "b3", "name": "Three", "is_open": 1, "categories": None},
    {"business_id": None, "name": "Nobody", "is_open": 1, "categories": "Bars"},
    {"business_id": "b4", "name": "Four", "is_open": 1, "categories": ["Bars", "Cafes"]},
]


def write_lines(folder, records, extra=()):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(r) for r in records] + list(extra)
    (folder / "part.json").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_business_feed_from_json(spark, tmp_path):
    half = json.dumps(BUSINESSES[0])[:40]
    feed = read_feed(spark, "business", write_lines(tmp_path / "b", BUSINESSES, [half]))
    assert feed.schema.fieldNames() == FEEDS["business"].fieldNames()
    good = good_records(feed)
    assert CORRUPT not in good.columns
    assert rows(marts.business(good).select("business_id", "name", "latitude")) == [
        ("b1", "One", 1.5), ("b3", "Three", None), ("b4", "Four", None),
    ]
    assert rows(marts.business_category(good)) == [
        ("b1", "Laundry"), ("b1", "Tailors"), ("b4", "Bars"), ("b4", "Cafes"),
    ]
    assert [r[CORRUPT] for r in quarantined(feed).collect()] == [half]
    report = quality.broken_records({"business": feed}, {"business": "business_id"})
    assert {r["column"]: r["n"] for r in report.collect()} == {CORRUPT: 1, "business_id": 1}


def test_checkin_feed_from_csv_with_header(spark, tmp_path):
    (tmp_path / "checkin.csv").write_text(
        'business_id,date\nb1,"2019-02-28 07:05:00, 2019-03-01 00:00:59"\nb1,2019-02-28\nb1,\n,"2019-02-28 07:05:00"\n'
    )
    feed = good_records(read_feed(spark, "checkin", str(tmp_path / "checkin.csv"), "csv"))
    found = [(b, d and str(d)) for b, d in rows(marts.checkin(feed))]
    assert found == [("b1", None), ("b1", "2019-02-28 07:05:00"), ("b1", "2019-03-01 00:00:59")]
    lenient = marts.checkin(feed, formats=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"))
    assert ("b1", "2019-02-28 00:00:00") in [(b, d and str(d)) for b, d in rows(lenient)]


def test_inference_is_an_option_only(spark, tmp_path):
    path = write_lines(tmp_path / "t", [{"text": "hi", "compliment_count": 1}])
    inferred = read_feed(spark, "tip", path, infer=True)
    assert set(inferred.columns) == {"text", "compliment_count"}
    declared = read_feed(spark, "tip", path)
    assert declared.schema.fieldNames() == FEEDS["tip"].fieldNames()


def test_text_survives_json_and_csv(spark):
    texts = ['say "hi",\nthen go', "été | naïve", "", None]
    feed = spark.createDataFrame([(str(i), "u", "b", 1.0, "d", t) for i, t in enumerate(texts)],
                                 "review_id string, user_id string, business_id string, stars double, date string, text string")
    path = new_folder(spark, "texts")
    feed.write.json(path)
    back = good_records(read_feed(spark, "review", path))
    assert rows(back) == rows(feed)
