import json

import pytest

from bizlens.plans import marts
from bizlens.schemas import FEED_TABLES
from bizlens.sources import commits, records
from bizlens.sources.tables import read_tables
from bizlens.streaming import ingest
from bizlens.streaming.ingest import FeedLoader, ingest_all, next_file, start_ingest
from tests.conftest import rows


def read_ledger(spark, root):
    return ingest.read_ledger(spark, root).drop("file_path")


def put(folder, name, records, broken=()):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([json.dumps(r) for r in records] + list(broken)) + "\n")


def checkin(n):
    return [{"business_id": f"b{n}", "date": "2018-01-01 10:00:00, 2018-01-02 10:00:00"}]


def run(spark, tmp_path, feed, **options):
    query = start_ingest(spark, feed, f"{tmp_path}/in/{feed}/x*", f"{tmp_path}/out", f"{tmp_path}/cp/{feed}", **options)
    query.awaitTermination()


def test_one_file_per_batch_and_nothing_twice(spark, tmp_path):
    feed = tmp_path / "in" / "checkin"
    put(feed, "x00", checkin(0))
    put(feed, "x01", checkin(1), broken=['{"business_id": "b7", "da'])
    run(spark, tmp_path, "checkin")
    assert rows(read_ledger(spark, f"{tmp_path}/out")) == [("checkin", 0), ("checkin", 1)]
    run(spark, tmp_path, "checkin")
    assert rows(read_ledger(spark, f"{tmp_path}/out")) == [("checkin", 0), ("checkin", 1)]
    put(feed, "x02", checkin(2))
    run(spark, tmp_path, "checkin")
    assert rows(read_ledger(spark, f"{tmp_path}/out")) == [("checkin", 0), ("checkin", 1), ("checkin", 2)]
    loaded = read_tables(spark, f"{tmp_path}/out", ["checkin"])["checkin"]
    assert sorted(r["business_id"] for r in loaded.collect()) == ["b0", "b0", "b1", "b1", "b2", "b2"]
    broken = records.quarantine(spark, f"{tmp_path}/out", "checkin")
    assert [r["_corrupt_record"] for r in broken.collect()] == ['{"business_id": "b7", "da']


def test_a_repeated_batch_replaces_itself(spark, tmp_path, lexicon):
    batch = spark.createDataFrame(
        [("nice tacos", "2018-01-01 00:00:00", 0, "b1", "u1", None)] * 2,
        "text string, date string, compliment_count int, business_id string, user_id string, _corrupt_record string",
    )
    load = FeedLoader("tip", f"{tmp_path}/out", lexicon)

    def tables():
        return read_tables(spark, f"{tmp_path}/out", ["tip", "tip_text"])

    load(batch, 0)
    first = rows(tables()["tip"])
    load(batch, 0)
    assert rows(tables()["tip"]) == first
    load(batch, 1)
    tips, words = tables().values()
    assert tips.count() == 4 and tips.select("tip_id").distinct().count() == 4
    assert rows(words.select("tip_id").distinct()) == rows(tips.select("tip_id"))


RECORDS = {
    "business": [{"business_id": "b1", "name": "One", "is_open": 1, "categories": "Bars, Cafes"}],
    "checkin": checkin(1),
    "review": [{"review_id": f"r{i}", "user_id": "u1", "business_id": "b1", "stars": 4.0,
                "date": "2018-01-01 00:00:00", "text": f"Great tacos {i} times"} for i in range(7)],
    "tip": [{"text": "good", "business_id": "b1", "user_id": "u1"}] * 9,
    "user": [{"user_id": "u1", "name": "Ann", "elite": "2018", "friends": "u2, u3"}],
}
WRONG = ['{"user_id": "u1", "busi', '{"text": "no keys"}', "not json", '{"stars": "x"}']


def test_five_feeds_side_by_side_equal_a_full_load(spark, tmp_path, lexicon):
    for feed, rs in RECORDS.items():
        for k in range(3):
            put(tmp_path / "in" / feed, f"x{k:02}", rs[k::3], broken=WRONG[: 2 * k])
    paths = {feed: f"{tmp_path}/in/{feed}/x*" for feed in RECORDS}
    whole, parts = f"{tmp_path}/whole", f"{tmp_path}/out"
    ingest_all(spark, paths, parts, f"{tmp_path}/cp", files_per_batch=2, lexicon=lexicon)
    marts.write_all({feed: records.read_records(spark, feed, path) for feed, path in paths.items()}, whole, lexicon=lexicon)
    names = [t for tables in FEED_TABLES.values() for t in tables]
    loaded, full = read_tables(spark, parts, names), read_tables(spark, whole, names)
    for name in names:
        assert rows(loaded[name]) == rows(full[name]), name
    for feed, rs in RECORDS.items():
        lost = rows(records.quarantine(spark, parts, feed))
        assert lost == rows(records.quarantine(spark, whole, feed)) and len(lost) == 6
        assert records.accepted(spark, parts, feed).count() == len(rs)
    assert rows(read_ledger(spark, parts)) == sorted(
        (feed, k) for feed, rs in RECORDS.items() for k in range(3) if rs[k::3] or WRONG[: 2 * k]
    )
    assert loaded["tip"].select("tip_id").distinct().count() == 9


def test_tables_are_made_from_the_store(spark, tmp_path, lexicon):
    put(tmp_path / "in" / "user", "x00", RECORDS["user"], broken=WRONG)
    raw = records.read_records(spark, "user", f"{tmp_path}/in/user")
    stored = records.stage(raw, "user", f"{tmp_path}/out")
    for df in [*marts.feed_tables("user", stored).values(), records.quarantine(spark, f"{tmp_path}/out", "user")]:
        assert df.inputFiles() and all("/records/user/" in f for f in df.inputFiles())
    found = records.quarantine(spark, f"{tmp_path}/out", "user")
    assert {(r["_corrupt_record"], r["reason"]) for r in found.collect()} == set(
        zip(WRONG, ["unreadable", "no user_id", "unreadable", "no user_id"], strict=True)
    )


def test_a_batch_that_fails_half_way_shows_no_table(spark, tmp_path, lexicon, monkeypatch):
    put(tmp_path / "in" / "review", "x00", RECORDS["review"])
    names = FEED_TABLES["review"]
    words = marts.WORD_TABLES["review"]
    run(spark, tmp_path, "review", lexicon=lexicon)
    before = {name: rows(df) for name, df in read_tables(spark, f"{tmp_path}/out", names).items()}
    put(tmp_path / "in" / "review", "x01", [{**r, "review_id": f"s{k}"} for k, r in enumerate(RECORDS["review"])])

    def fail(*args):
        raise RuntimeError("planted")

    monkeypatch.setitem(marts.WORD_TABLES, "review", fail)
    with pytest.raises(Exception, match="planted"):
        run(spark, tmp_path, "review", lexicon=lexicon)
    assert (tmp_path / "out" / "review" / "batch_id=1").is_dir()
    assert {name: rows(df) for name, df in read_tables(spark, f"{tmp_path}/out", names).items()} == before
    assert rows(read_ledger(spark, f"{tmp_path}/out")) == [("review", 0)]
    monkeypatch.setitem(marts.WORD_TABLES, "review", words)
    run(spark, tmp_path, "review", lexicon=lexicon)
    after = read_tables(spark, f"{tmp_path}/out", names)
    assert after["review"].count() == 14 and after["review_text"].select("review_id").distinct().count() == 14


def test_a_committed_batch_is_not_run_again(spark, tmp_path, lexicon):
    load = FeedLoader("tip", f"{tmp_path}/out", lexicon)
    batch = spark.createDataFrame([("good", "b1", "u1")], "text string, business_id string, user_id string")
    load(batch, 0)
    load(batch.limit(0), 0)
    assert read_tables(spark, f"{tmp_path}/out", ["tip"])["tip"].count() == 1


def test_merged_batches_read_the_same(spark, tmp_path, lexicon):
    for k in range(4):
        put(tmp_path / "in" / "tip", f"x{k:02}", RECORDS["tip"], broken=WRONG[:k])
    run(spark, tmp_path, "tip", lexicon=lexicon)
    root = f"{tmp_path}/out"

    def everything():
        found = {name: rows(df) for name, df in read_tables(spark, root, FEED_TABLES["tip"]).items()}
        return found | {"ledger": rows(read_ledger(spark, root)), "lost": rows(records.quarantine(spark, root, "tip"))}

    before = everything()
    commits.merge_batches(spark, root, "tip")
    assert commits.folders(spark, root, "tip") == ["merged=0-3"] and everything() == before
    put(tmp_path / "in" / "tip", "x04", RECORDS["tip"][:1])
    run(spark, tmp_path, "tip", lexicon=lexicon)
    assert commits.folders(spark, root, "tip") == ["merged=0-3", "batch_id=4"]
    commits.merge_batches(spark, root, "tip")
    assert commits.folders(spark, root, "tip") == ["merged=0-4"] and len(everything()["tip"]) == len(before["tip"]) + 1


def cut(text, sizes):
    data, at, pieces = text.encode(), 0, []
    while at < len(data):
        size = next(sizes)
        pieces.append(data[at : at + size])
        at += size
    return pieces


@pytest.mark.parametrize("size, files_per_batch", [(7, None), (40, None), (90, None), (200, None), (40, 5), (90, 3), (200, 1)])
def test_records_cut_by_a_byte_wise_split_are_rejoined(spark, tmp_path, size, files_per_batch):
    users = [{"user_id": f"u{i}", "name": f"Žofie “é” 😀 {i}", "friends": None, "elite": "2018"} for i in range(9)]
    text = "".join(json.dumps(u, ensure_ascii=bool(i % 2)) + "\n" for i, u in enumerate(users))
    folder = tmp_path / "in" / "user"
    folder.mkdir(parents=True)
    pieces = cut(text, iter(lambda: size, None))
    for k, piece in enumerate(pieces):
        (folder / f"x{k:03}").write_bytes(piece)
    root = f"{tmp_path}/out"
    if files_per_batch:
        run(spark, tmp_path, "user", files_per_batch=files_per_batch)
    else:
        records.stage(records.read_records(spark, "user", str(folder)), "user", root)
    found = records.accepted(spark, root, "user").select("user_id", "name").collect()
    assert sorted(map(tuple, found)) == sorted((u["user_id"], u["name"]) for u in users)
    assert records.quarantine(spark, root, "user").count() == 0


def test_pieces_that_do_not_belong_together_stay_in_quarantine(spark, tmp_path):
    folder = tmp_path / "in" / "user"
    folder.mkdir(parents=True)
    lines = {
        "x00": '{"user_id": "a", "name": "A"}\n{"user_id": "b", ',  # goes on in x02, and x01 is missing
        "x02": '"name": "B"}\n{"user_id": "c"}\n{"broken": ',
        "x03": '{"user_id": "d"}\n{"user_id": "e"',  # x03 begins with a whole record
        "x04": '}{"user_id": "f"}\n',  # more than one value
    }
    for name, text in lines.items():
        (folder / name).write_text(text)
    root = f"{tmp_path}/out"
    stored = records.stage(records.read_records(spark, "user", str(folder)), "user", root)
    assert sorted(r["user_id"] for r in stored.collect()) == ["a", "c", "d"]
    assert records.quarantine(spark, root, "user").count() == 5


def test_a_failing_feed_is_reported_after_the_others(spark, tmp_path):
    put(tmp_path / "in" / "tip", "x00", [{"text": "good"}])
    put(tmp_path / "in" / "checkin", "x00", checkin(1))
    paths = {feed: f"{tmp_path}/in/{feed}/x*" for feed in ("tip", "checkin")}
    with pytest.raises(Exception, match="lexicon"):
        ingest_all(spark, paths, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert rows(read_ledger(spark, f"{tmp_path}/out")) == [("checkin", 0)]


def test_next_file(spark):
    ledger = spark.createDataFrame([("tip", 0), ("tip", 8), ("user", 99)], "script_name string, processed_file int")
    scripts = spark.createDataFrame([("tip",), ("user",), ("review",)], "script_name string")
    assert rows(next_file(ledger, scripts)) == [("review", 0, "review/x00"), ("tip", 9, "tip/x09"), ("user", 100, "user/x100")]


def test_a_larger_feed_makes_no_more_files(spark, tmp_path):
    from checks.queries import FEED_FILES, write_feed

    feed = spark.range(500).repartition(40).selectExpr("cast(id as string) as user_id")
    write_feed(feed, f"{tmp_path}/user")
    assert len(list((tmp_path / "user").glob("part-*"))) <= FEED_FILES
    assert rows(spark.read.json(f"{tmp_path}/user")) == rows(feed)
