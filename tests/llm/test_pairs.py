"""Operators on pairs against brute force: near copies, lines, decontamination, components."""

import collections
import random

from pyspark.sql import functions as F

from bizlens.llm import bagminhash, common, decontam, lines
from bizlens.session import discard, materialize, scratch_root

WORDS = [f"w{k}" for k in range(400)]
#: Extra columns whose names the operators use inside.
EXTRA = "_id int, _key int, _row int, _all int, node int, bucket int, key int, row int, removed int, kept int"


def texts():
    rng = random.Random(5)
    made = []
    for base in range(6):
        words = rng.choices(WORDS, k=120)
        made.append(" ".join(words))
        for _ in range(5):
            near = list(words)
            for _ in range(rng.choice((0, 1, 2, 8))):
                near[rng.randrange(len(near))] = rng.choice(WORDS)
            made.append(" ".join(near))
    made += ["a b", "a b", "", None, "  \n ", "same same same same same same same " * 3, "same same same same same same same " * 4]
    made.append(" ".join(rng.choices(WORDS, k=60_000)))
    made.append(made[-1])
    return made


def weighted(text):
    words = (text or "").lower().split()
    width = min(5, len(words))
    return collections.Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else collections.Counter()


def brute_classes(rows):
    bags = [weighted(t) for _, t in rows]
    root = list(range(len(rows)))

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            shared = sum((a & b).values())
            if a and b and shared >= 0.8 * (sum(a.values()) + sum(b.values()) - shared):
                x, y = sorted((of(i), of(j)))
                root[y] = x
    return {rows[i][0]: rows[of(i)][0] for i in range(len(rows))}


def table(spark, rows, schema="doc_id long, text string"):
    return materialize(spark.createDataFrame(rows, schema), "given")


def test_near_copies_as_by_brute_force(spark):
    rows = list(enumerate(texts()))
    got = bagminhash.classes(table(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(rows)
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.kept} == set(brute_classes(rows).values())


def test_one_near_copy_stays_with_clashing_columns_and_nulls(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "ONE two three four five six"),
            (None, "nobody has an id for this text"), (None, "nobody has an id for this text"), (4, None), (5, "")]
    docs = table(spark, [(*r, *range(10)) for r in rows], f"doc_id long, text string, {EXTRA}")
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in got) == [(0, rows[3][1]), (1, rows[0][1]), (4, ""), (5, "")]
    assert {tuple(r)[2:] for r in got} == {tuple(range(10))}


def test_near_copies_of_nothing(spark):
    empty = table(spark, [])
    assert bagminhash.classes(empty).count() == bagminhash.keep_one(empty).count() == 0


def test_signatures_estimate_weighted_similarity():
    import numpy as np

    elements = common.mix(np.arange(40, dtype=np.uint64))
    a, b = np.full(40, 3), np.where(np.arange(40) < 20, 3, 1)
    found = bagminhash.signatures([(elements, a), (elements, b)], slots=20_000)
    assert abs((found[0] == found[1]).mean() - 80 / 120) < 0.02


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001 + k) for k in range(100)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    near = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in sorted(near):
        stack = [start] if start not in want else []
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = start
                stack += near[x]
    assert got == want


def test_a_star_is_one_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(common, "materialize", lambda df, label="table": written.append(label) or materialize(df, label))
    got = common.components(spark.createDataFrame([(1, k) for k in range(2, 9)] + [(20, 21)], "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**dict.fromkeys(range(1, 9), 1), 20: 20, 21: 20}
    assert written == ["links"] * 2


def shingled(line):
    line = " ".join(line.lower().split())
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def test_lines_as_by_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices(WORDS, k=14)) for _ in range(8)]
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(120))
    address = "https://example.org/" + "".join(rng.choices("abcdefghij", k=80))
    long = " ".join(rng.choices(WORDS, k=20_000))
    pool = base + [b.upper() for b in base[:3]] + [b[:-4] + " zzz" for b in base[3:6]]
    pool += [han, "\u597d" + han[1:], address, "x" + address[1:], "share this page with friends ok", "abc", "abd", long, long + " end"]
    rows = [(d, "\n".join([*rng.sample(pool, 6), "short", "  ", ""])) for d in range(16)] + [(16, None), (17, ""), (None, base[0]), (None, None)]
    rows += [(18, "one row given twice\nwith two lines of it")] * 2
    places, roots, blank = [], [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for pos, line in enumerate((text or "").split("\n")):
            if line.split():
                places.append((d, pos, shingled(line)))
                roots.append(len(roots))
            else:
                blank += 1

    def of(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i, a in enumerate(places):
        for j in range(i):
            both = len(a[2] & places[j][2])
            if both >= 0.8 * len(a[2] | places[j][2]):
                x, y = sorted((of(i), of(j)))
                roots[y] = x
    gone = sorted((str(d), pos) for i, (d, pos, _) in enumerate(places) if of(i) != i)
    assert len(gone) < len(places) and blank
    docs = table(spark, [(d, t, len(t or ""), *range(10)) for d, t in rows], f"doc_id long, text string, n_chars int, {EXTRA}")
    got = lines.removed_lines(docs).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), pos) for r in got for pos in r.removed) == gone
    assert all(r.n_removed == len(r.removed) and list(r.removed) == sorted(r.removed) for r in got)
    shorter = lines.dedup_lines(docs)
    assert shorter.columns == docs.columns
    want = collections.Counter()
    left = collections.Counter(gone)
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=True):
        held = None if text is None else []
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            if left[str(d), pos]:
                left[str(d), pos] -= 1
            else:
                held.append(line)
        held = None if held is None else "\n".join(held)
        want[d, held, len(held or "")] += 1
    found = shorter.collect()
    assert collections.Counter((r.doc_id, r.text, r.n_chars) for r in found) == want
    assert {tuple(r)[3:] for r in found} == {tuple(range(10))}


def test_bitmaps_rule_out_no_pair_that_passes(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    sets = []
    for size in (0, 1, 9, 60, 300, 5000):
        one = common.mix(rng.integers(0, 2**62, size, dtype=np.uint64))
        sets += [one, one[: int(size * 0.8)], one[int(size * 0.1) :], np.append(one[: int(size * 0.9)], common.mix(rng.integers(0, 2**62, size // 9, dtype=np.uint64)))]
    rows = [(k, {"size": len(s), "bits": common.parity(s, 8).tolist()}) for k, s in enumerate(sets)]
    kind = "struct<size:long, bits:array<long>>"
    left = spark.createDataFrame(rows, f"a long, x {kind}")
    right = spark.createDataFrame(rows, f"b long, y {kind}")
    near = left.join(right, F.col("a") < F.col("b")).filter(common.may_pass(F.col("x"), F.col("y"), 8, 0.8)).select("a", "b")
    near = {tuple(r) for r in near.collect()}
    passing = set()
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            shared = len(np.intersect1d(a, sets[j]))
            if shared and shared >= 0.8 * (len(a) + len(sets[j]) - shared):
                passing.add((i, j))
    assert passing and passing <= near
    assert len(near) < len(sets) * (len(sets) - 1) / 4


def test_lines_of_nothing(spark):
    assert lines.removed_lines(table(spark, [])).count() == lines.dedup_lines(table(spark, [])).count() == 0


def test_items_in_documents(spark):
    rng = random.Random(4)
    items = [(k, " ".join(rng.choices(WORDS, k=n))) for k, n in enumerate((5, 8, 20, 60, 200))] + [(8, None), (9, "too short"), (None, "an item without an id here")]
    long = rng.choices(WORDS, k=30_000)
    docs = [(0, " ".join([*long, *items[2][1].upper().split(), *long])), (1, " ".join(long)), (2, None), (3, ""), (None, items[4][1]),
            (5, items[0][1]), (5, items[1][1] + "!"), (6, " ".join(items[3][1].split()[:50])), (7, " ".join(items[3][1].split()[:40]))]

    def sets(text):
        words = (text or "").lower().replace("!", " ").split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    want = sorted(
        (str(d), str(k), len(sets(t) & sets(i)), len(sets(i)))
        for d, t in docs for k, i in items if sets(i) and len(sets(t) & sets(i)) >= 0.8 * len(sets(i))
    )
    given = table(spark, [(*d, *range(10)) for d in docs], f"doc_id long, text string, {EXTRA}")
    questions = table(spark, items, "item_id long, text string")
    got = decontam.contained(given, questions).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_item) for r in got) == want
    clean = decontam.clean(given, questions)
    assert clean.columns == given.columns
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 7]
    assert decontam.contained(table(spark, []), questions).count() == 0
    assert decontam.clean(given, questions.filter(F.lit(False))).count() == len(docs)


def test_pairs_of_a_bucket_are_not_met_in_every_round(spark):
    rng = random.Random(3)
    held = {bucket: rng.sample(range(60), size) for bucket, size in ((1, 45), (2, 45), (3, 6), (4, 2), (5, 2), (6, 1))}
    sized = common.shared_buckets(spark.createDataFrame([(b, n) for b, nodes in held.items() for n in nodes], "bucket long, node long"))
    sketches = spark.createDataFrame([(n, (1, [0])) for n in range(60)], "node long, sketch struct<size:long, bits:array<long>>")
    seen = []

    def verify(pairs):
        seen.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return pairs.filter("a < 0")

    roots = common.linked(sized, verify, sketches, lambda a, b: a["size"] == b["size"])
    wanted = {(a, b) for nodes in held.values() for a in nodes for b in nodes if a < b}
    assert roots.isEmpty() and set(seen) == wanted
    # Not again in each later round; only pairs of the first round may be met once more, in another bucket.
    assert len(seen) <= len(wanted) + len(held)


def test_sketches_of_many_lines_at_once():
    import numpy as np

    rng = np.random.default_rng(2)
    sets = [common.mix(rng.integers(0, most, size, dtype=np.uint64)) for size, most in ((0, 9), (40, 20), (1, 9), (300, 2**62), (5000, 2**62), (0, 9))]
    sets += [np.append(sets[3][30:], sets[4][:9]), sets[4][500:]]
    sizes, bits = common.sketched(np.concatenate(sets), np.array([len(s) for s in sets]), 8)
    assert sizes.tolist() == [len(set(s.tolist())) for s in sets]
    for k, s in enumerate(sets):  # not dependent on what else is sketched
        alone = common.sketched(np.tile(s, 2), np.array([2 * len(s)]), 8)
        assert alone[0][0] == sizes[k] and (alone[1][0] == bits[k]).all()
    for a, x in zip(sets, bits):
        for b, y in zip(sets, bits):
            differ = sum(bin(int(w)).count("1") for w in (x ^ y).view(np.uint64))
            only_one = len(set(a.tolist()) ^ set(b.tolist()))
            assert differ <= only_one and differ % 2 == only_one % 2


def test_long_lines_have_longer_bitmaps(spark):
    import pyarrow as pa

    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts = [" ".join(words[k : k + 400]) for k in (0, 5, 400, 1200)] + [" ".join(words[:20])]
    signed = next(lines._signed(iter([pa.RecordBatch.from_pydict({"text": texts})]))).to_pylist()
    assert [r["f0"] is None for r in signed] == [False] * 4 + [True]
    rows = [(k, (r["extent"], [r[f"s{i}"] for i in range(lines.BITMAP)], [r[f"f{i}"] for i in range(lines.FINE)])) for k, r in enumerate(signed[:4])]
    kind = "struct<size:long, bits:array<long>, fine:array<long>>"
    left, right = spark.createDataFrame(rows, f"a long, x {kind}"), spark.createDataFrame(rows, f"b long, y {kind}")
    pairs = left.join(right, F.col("a") < F.col("b"))
    assert pairs.filter(common.may_pass(F.col("x"), F.col("y"), lines.BITMAP, 0.8)).count() == 6
    assert [(r.a, r.b) for r in pairs.filter(common.may_pass_fine(F.col("x"), F.col("y"), 0.8)).collect()] == [(0, 1)]


def test_a_bucket_keeps_rows_that_have_one_of_a_near_size(spark):
    rows = [(1, 1, 10), (1, 2, 12), (1, 3, 100), (1, 4, 15), (2, 5, 7), (3, 6, 8), (3, 7, 11), (4, 8, 5), (4, 9, 5), (4, 10, 200), (4, 11, 160)]
    sized = common.shared_buckets(spark.createDataFrame(rows, "bucket long, node long, extent long"), 0.8)
    want = {(b, n) for b, n, e in rows for c, m, f in rows if b == c and n != m and min(e, f) >= 0.8 * max(e, f)}
    assert {(r.bucket, r.node) for r in sized.collect()} == want
    assert {(r.bucket, r.size) for r in sized.collect()} == {(1, 3), (4, 4)}


def folders(spark):
    import os

    root = scratch_root(spark)
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_lines_leave_only_what_their_result_is_read_from(spark):
    earlier = folders(spark)
    docs = materialize(table(spark, [(d, f"the same line in all of them\nline {d} is much like the others {d}\n{d}") for d in range(30)]), "docs")
    before = folders(spark)
    gone = lines.removed_lines(docs)
    assert {name.split("-")[0] for name in folders(spark) - before} <= {"links", "named", "removed"}
    assert gone.agg(F.sum("n_removed")).first()[0] >= 29
    discard(docs)
    mine = {name for name in before - earlier if name.startswith("docs-")}
    assert mine and not mine & folders(spark)


def test_shuffle_files_of_a_stored_table_go_at_once(spark):
    import time

    def held():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    before = held()
    stored = materialize(spark.range(5000).repartition(3, "id"), "dealt")
    end = time.time() + 20
    while held() > before and time.time() < end:
        time.sleep(0.2)
    assert held() <= before and stored.count() == 5000


def test_a_task_hands_on_a_line_once():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"text": [f"same line\nonly {k}\nSAME  line"]}) for k in range(3)]
    found = [row["line"] for batch in lines._spelled(iter(batches)) for row in batch.to_pylist()]
    assert sorted(found) == ["only 0", "only 1", "only 2", "same line"]


def test_lines_too_many_for_a_broadcast_are_joined_without_copies(spark, monkeypatch):
    rows = [(d, "\n".join(["the very same line in each", f"a line that only number {d} has", f"nearly the same line in each of them {d}"])) for d in range(40)]
    docs = table(spark, rows)
    spread = docs.repartition(4)
    key = spread.select("text").mapInArrow(lines._spelled, "key binary, line string").dropDuplicates(["key"])
    wanted = materialize(key.select("key", F.monotonically_increasing_id().alias("node")), "wanted")
    monkeypatch.setattr(lines, "fits_broadcast", lambda df: False)
    texts = lines.spelled(spread, wanted)
    assert sorted(r.line for r in texts.collect()) == sorted({line for _, t in rows for line in t.split("\n")})
    assert "_salt" not in texts._jdf.queryExecution().optimizedPlan().toString()
