"""Near copies of documents by weighted Jaccard similarity of five-word shingles (BagMinHash)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import WordHashes, chunks, linked, may_pass, mix, parity, shared_buckets, shingles, text_of, wrapped
from bizlens.operators.joins import lookup_join
from bizlens.session import materialize

WIDTH = 5
THRESHOLD = 0.8
ROWS = 4
BANDS = 24
#: Longs of the bitmap of a text's shingles that rules out pairs.
BITMAP = 8


def bag(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and how often each occurs."""
    return np.unique(hashes, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = ROWS * BANDS) -> np.ndarray:
    """A BagMinHash signature for each bag of (element, whole weight); rows of empty bags hold infinity.

    The weight axis is cut into [0, 1), [1, 2), [2, 4), [4, 8) ... An element has, for each piece that its weight
    reaches into, a Poisson process whose rate is the length of the piece. A point has a time, a place in the piece
    (found by halving: its leading bits) and a slot, all made from the element, so that bags with the element share
    its points; those beyond the weight are thinned out. Each slot keeps its earliest point. A process ends once it is
    later than every slot's earliest point, hence the speed. Two bags agree in a slot with probability
    sum(min) / sum(max) of their weights.
    """
    sizes = np.array([len(e) for e, _ in bags], np.int64)
    best = np.full((len(bags), slots), np.inf)
    if not sizes.sum():
        return best
    owner = np.repeat(np.arange(len(bags)), sizes)
    element = np.concatenate([e for e, _ in bags])
    weight = np.concatenate([w for _, w in bags]).astype(np.int64)
    octaves = np.ceil(np.log2(weight.astype(np.float64))).astype(np.int64) + 1
    octave = np.arange(octaves.sum()) - np.repeat(np.cumsum(octaves) - octaves, octaves)
    owner, element, weight = (np.repeat(x, octaves) for x in (owner, element, weight))
    low = np.where(octave == 0, 0, 1 << np.maximum(octave - 1, 0))
    length = np.maximum(low, 1).astype(np.float64)
    state = mix(element ^ (octave.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    time = np.zeros(len(state))
    flat = best.reshape(-1)
    while len(state):
        state = mix(state)
        other = mix(state ^ np.uint64(0xA0761D6478BD642F))
        time = time - np.log1p(-(state >> np.uint64(11)).astype(np.float64) * 2.0**-53) / length
        place = low + ((other & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32) * length
        slot = ((other >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        kept = place < weight
        np.minimum.at(flat, owner[kept] * slots + slot[kept], time[kept])
        alive = time < best.max(axis=1)[owner]
        owner, weight, low, length, state, time = (x[alive] for x in (owner, weight, low, length, state, time))
    return best


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    out = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(rows):
        out = mix(out ^ mix(bits[:, :, k]))
    return out.view(np.int64)


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """Sorted hashes of (element, its how-manieth occurrence): overlaps of these sets are overlaps of the bags."""
    element, count = bag(hashes)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.unique(mix(np.repeat(element, count) ^ mix(nth.astype(np.uint64))))


def _shingled(batch: pa.RecordBatch, words: WordHashes) -> list[np.ndarray]:
    return [shingles(words.of(text.lower().split()), WIDTH) for text in batch.column("text").to_pylist()]


def _band_rows(batches):
    words = WordHashes()
    for batch in chunks(batches, "text", 4 << 20):
        bags = [bag(s) for s in _shingled(batch, words)]
        some = np.array([len(e) > 0 for e, _ in bags], bool)
        lists = pa.array([k if ok else None for k, ok in zip(band_keys(signatures(bags)), some, strict=True)], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), lists], ["key", "doc_id", "bands"])


def _bag_rows(batches):
    words = WordHashes()
    kind = pa.struct([("size", pa.int64()), ("bits", pa.list_(pa.int64()))])
    for batch in chunks(batches, "text", 4 << 20):
        bags = [occurrences(s) for s in _shingled(batch, words)]
        brief = pa.array([{"size": len(x), "bits": parity(x, BITMAP)} for x in bags], kind)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([x.tobytes() for x in bags], pa.binary()), brief], ["node", "bag", "sketch"])


def _overlaps(batches):
    for batch in batches:
        kept = []
        for a, b in zip(batch.column("bag_a").to_pylist(), batch.column("bag_b").to_pylist(), strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
                kept.append(False)
                continue
            both = np.concatenate((x, y))
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            kept.append(shared >= THRESHOLD * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def content_key(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(text.cast("binary")))


def classes(docs: DataFrame) -> DataFrame:
    """Near-duplicate class of every row of ``docs(doc_id, text)``: ``doc_id, class_id, n_copies, kept``.

    Two texts are linked if the weighted Jaccard similarity of their bags of five-word shingles (lower case, words by
    white space) is at least 0.8; classes are the connected components of all links. ``class_id`` is the smallest
    doc_id of the class, ``n_copies`` the number of rows with this very text, and ``kept`` is true for one row of each
    class: that with the smallest doc_id (nulls last; of several equal rows, one). At a similarity of 0.8 a pair shares
    one of the 24 bands of 4 values with a probability above 0.99999.

    Exact copies fold into one text first, so a text that a third of the rows share is handled once. A text of fewer
    than five words is one shingle. Null and empty texts, and texts of white space alone, have no shingles: each such
    row is a class of its own, with a null class_id if its doc_id is null. Other columns are ignored. An empty
    table gives no rows.
    """
    return _classes(docs).drop("key")


def _classes(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("key", content_key(F.col("text")))
    marked = materialize(rows.mapInArrow(_band_rows, "key binary, doc_id long, bands array<long>"), "bands")
    texts = marked.filter("bands is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands")
    )
    texts = materialize(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    buckets = texts.select("node", F.posexplode("bands").alias("band", "bucket"))
    sized = shared_buckets(buckets.select("node", F.xxhash64("band", "bucket").alias("bucket")))
    wanted = texts.select("key", "node").join(sized.select("node").distinct(), "node", "left_semi")
    bags = lookup_join(rows.select("key", "text"), wanted, "key")
    bags = bags.select("node", "text").mapInArrow(_bag_rows, "node long, bag binary, sketch struct<size:long, bits:array<long>>")
    bags = materialize(bags.dropDuplicates(["node"]), "bags")

    def verify(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), "a")
        sides = sides.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")
        return sides.mapInArrow(_overlaps, "a long, b long")

    def close(a: Column, b: Column) -> Column:
        return may_pass(a, b, BITMAP, THRESHOLD)

    roots = linked(sized, verify, bags.select("node", "sketch"), close, THRESHOLD)
    if roots is None:
        named = texts.select("key", "n_copies", F.col("first_id").alias("class_id"))
    else:
        full = texts.select("key", "node", "first_id", "n_copies").join(roots, "node", "left")
        full = full.withColumn("root", F.coalesce("root", "node"))
        smallest = full.groupBy("root").agg(F.min("first_id").alias("class_id"))
        named = full.join(smallest, "root").select("key", "n_copies", "class_id")
    named = materialize(named, "classes")
    # One row of each class stays: the smallest id; rows that share it are told apart by where they stand.
    placed = marked.select("key", "doc_id", F.col("bands").isNull().alias("bare"), F.monotonically_increasing_id().alias("row"))
    placed = materialize(placed.join(named, "key", "left"), "placed")
    heirs = placed.filter("not bare and doc_id <=> class_id").groupBy("class_id").agg(F.min("row").alias("heir"))
    # A class without any id has a null class_id; its texts are told apart by their key.
    named_heirs = heirs.filter("class_id is not null").select("heir")
    null_heirs = placed.filter("not bare and class_id is null").groupBy("key").agg(F.min("row").alias("heir")).select("heir")
    kept = named_heirs.unionByName(null_heirs).withColumnRenamed("heir", "row").withColumn("chosen", F.lit(True))
    return placed.join(kept, "row", "left").select(
        "key", "doc_id",
        F.when(F.col("bare"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.col("bare") | F.coalesce("chosen", F.lit(False))).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``classes`` keeps, with all their columns.

    A row is found again by its doc_id and text. Of rows that agree in both, the class keeps one at most. Rows without words
    all stay. Other columns may have any names.
    """
    verdict = _classes(docs).groupBy("doc_id", "key").agg(
        F.sum(F.col("kept").cast("long")).alias("keep"), F.count(F.lit(1)).alias("all")
    ).filter("keep > 0")
    verdict = materialize(verdict.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "keep", "all"), "kept")
    keyed = wrapped(docs).withColumn("_key", content_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    whole = keyed.join(verdict.filter("keep = all").drop("keep", "all"), "_key").filter(same)
    first = keyed.join(verdict.filter("keep < all").drop("keep", "all"), "_key").filter(same)
    return whole.unionByName(first.dropDuplicates(["_id", "_key"])).select("_all.*")
