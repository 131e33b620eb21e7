"""Benchmark decontamination: short test items found inside long documents by MinHash containment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import WordHashes, chunks, mix, shingles, text_of, wrapped
from bizlens.session import materialize

WIDTH = 5
THRESHOLD = 0.8
#: Minima taken of an item; at containment 0.8 all are absent with probability 0.2 ** 16 at most if they differ.
MINIMA = 16
#: Items are searched in blocks of at most so many characters, so that a block's index has a fixed size.
BLOCK_CHARS = 8_000_000
WORDS = r"[\p{L}\p{N}_]+"

PAIRS = "doc_id long, item_id long, n_shared long, n_item long, row long"


class Index:
    """MinHash signatures of a block of items, by size class.

    Class c holds the items with 2^c to 2^(c+1) - 1 distinct shingles. Of each item the index keeps the shingles
    that are smallest under ``MINIMA`` hash functions. The share of them that a document holds estimates the
    containment of the item in it, whatever the document's length; an item is a candidate as soon as one is there.
    A document with fewer shingles than 0.8 of the smallest item of a class doesn't look at that class.
    """

    def __init__(self, items: list[tuple[int, str]]) -> None:
        words = WordHashes()
        self.ids, self.sets, by_class = [], [], {}
        for item_id, joined in items:
            tokens = joined.split(" ") if joined else []
            if len(tokens) < WIDTH:
                continue
            own = np.unique(shingles(words.of(tokens), WIDTH))
            minima = {int(own[np.argmin(mix(own ^ mix(np.full(1, j, np.uint64))))]) for j in range(MINIMA)}
            place = len(self.ids)
            self.ids.append(item_id)
            self.sets.append(own)
            by_class.setdefault(len(own).bit_length() - 1, []).extend((m, place) for m in minima)
        self.classes = []
        for c in sorted(by_class):
            pairs = sorted(by_class[c])
            keys = np.array([k for k, _ in pairs], np.uint64)
            places = np.array([p for _, p in pairs], np.int64)
            least = min(len(self.sets[p]) for p in places)
            self.classes.append((int(np.ceil(THRESHOLD * least)), keys, places))
        self.seen = np.zeros(1 << 20, bool)
        for _, keys, _ in self.classes:
            self.seen[keys & np.uint64(0xFFFFF)] = True

    def search(self, own: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item_id, shared shingles, shingles of the item) of items contained in a document with these shingles."""
        maybe = own[self.seen[own & np.uint64(0xFFFFF)]]
        if not len(maybe):
            return
        found = set()
        for least, keys, places in self.classes:
            if len(own) < least:
                continue
            low, high = np.searchsorted(keys, maybe, "left"), np.searchsorted(keys, maybe, "right")
            for a, b in zip(low[high > low], high[high > low], strict=True):
                found.update(places[a:b].tolist())
        if found:
            own = np.unique(own)
        for place in sorted(found):
            item = self.sets[place]
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[at] == item).sum())
            if shared >= THRESHOLD * len(item):
                yield self.ids[place], shared, len(item)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about bounded size, dealt by a hash."""
    sized = materialize(items, "items")
    total = sized.agg(F.sum(F.length("joined") + 16)).first()[0] or 0
    n = int(total // BLOCK_CHARS) + 1
    for k in range(n):
        yield [(r.item_id, r.joined) for r in sized.filter(F.pmod(F.xxhash64("item_id", "joined"), F.lit(n)) == k).select("item_id", "joined").collect()]


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Items of ``items(item_id, text)`` inside rows of ``docs(doc_id, text)``: ``doc_id, item_id, n_shared, n_item, row``.

    An item is contained if at least 0.8 of its distinct five-word shingles stand in the document (words are runs
    of letters, digits and _, in lower case). Candidates come from MinHash by size class (``Index``); every candidate
    is verified over all shingles of the whole text. The items are a stated query set: they are taken in blocks of
    8 million characters, each block's index travels with the tasks of one pass over the documents, and the documents
    aren't shuffled. ``row`` is the place of the row in the stored table, so that repeated ids stay apart.

    Items and documents of fewer than five words match nothing, so null and empty texts give no rows. Repeated items give a row
    each. Other columns are ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    words = F.array_join(F.regexp_extract_all(F.lower(text_of(items)), F.lit(WORDS), F.lit(0)), " ")
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), words.alias("joined"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.lower(text_of(docs)).alias("text"),
    )
    found = None
    for block in _blocks(wanted):
        shared = spark.sparkContext.broadcast(Index(block))
        part = rows.mapInArrow(_search(shared), PAIRS)
        found = part if found is None else found.unionByName(part)
    return found


def _search(shared):
    def search(batches):
        import regex

        pattern, words, index = regex.compile(r"[\p{L}\p{N}_]+"), WordHashes(), shared.value
        for batch in chunks(batches, "text", 4 << 20):
            out = [[] for _ in range(5)]
            ids, places = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for doc_id, row, text in zip(ids, places, batch.column("text").to_pylist(), strict=True):
                tokens = pattern.findall(text)
                if len(tokens) < WIDTH:
                    continue
                for item_id, n, size in index.search(shingles(words.of(tokens), WIDTH)):
                    for column, value in zip(out, (doc_id, item_id, n, size, row), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], ["doc_id", "item_id", "n_shared", "n_item", "row"]
            )

    return search


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns (see ``contained``).

    A row goes by its doc_id; a row without one goes by its place in the stored table. Other columns may have any names.
    """
    found = materialize(contained(docs, items), "contained")
    ids = found.filter("doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    out = wrapped(docs).drop("text").withColumnRenamed("doc_id", "_id").withColumn("_row", F.monotonically_increasing_id())
    out = out.join(ids, "_id", "left_anti")
    places = found.filter("doc_id is null").select(F.col("row").alias("_row"))
    return out.join(places, "_row", "left_anti").select("_all.*")
