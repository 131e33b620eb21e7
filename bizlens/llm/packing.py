"""Packing of documents into sequences of bounded length by minimum bin slack."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm.common import chunks, crc_of, text_of
from bizlens.llm.tokens import WORD_LEVEL, encoder, tokenizer_path
from bizlens.session import materialize

CAPACITY = 4096
END = 1
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
SALTS = 64


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of the texts: ``doc_id, piece, start, length, ids_crc32, ids`` (little-endian 32-bit), stored.

    A document's ids and then the end id 1 are one piece, or several of exactly ``capacity`` ids and a shorter last one. A
    null or empty text is the end id alone.
    """
    path = path or tokenizer_path("word_bpe_49k.json")

    def cut(batches):
        encode = encoder(path, WORD_LEVEL, lower=True).encode
        for batch in chunks(batches, "text", 4 << 20):
            out = [[] for _ in range(6)]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist()), strict=True):
                ids = np.append(ids, END).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    for column, value in zip(out, (doc_id, k, start, len(part), crc_of(part), part.tobytes()), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return materialize(rows.mapInArrow(cut, PIECE), "pieces")


def fullest(counts: np.ndarray, room: int, longest: int) -> list[int]:
    """Lengths, each at most as often as it is there, whose sum is the largest up to ``room``.

    Subset sums as bits of one whole number, longest lengths first; it stops as soon as the room can be filled.
    """
    reached, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in range(min(room, longest), 0, -1):
        for _ in range(min(int(counts[length]), room // length)):
            more = (reached | (reached << length)) & mask
            if more == reached:
                break
            steps.append((length, reached))
            reached = more
            if reached >> room & 1:
                break
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Fillings of bins as ``(how many bins, lengths)`` for ``counts[length]`` pieces of each length.

    Minimum bin slack: the longest piece left opens a bin, the fullest combination for the rest is found and removed;
    as many bins as the counts allow are filled alike at once. After each step some length is left less often than the
    combination needs it, at most capacity / length times. So there are fewer than capacity * (ln(capacity) + 2)
    patterns, 43,000 here, however many pieces there are.
    """
    left, out = counts.astype(np.int64).copy(), []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            left[longest] -= 1
            chosen = [longest, *fullest(left, capacity - longest, longest)]
            left[longest] += 1
            lengths, need = np.unique(chosen, return_counts=True)
            times = int((left[lengths] // need).min())
            left[lengths] -= need * times
            out.append((times, chosen))
    return out


def slots(found: list[tuple[int, list[int]]]) -> tuple[np.ndarray, ...]:
    """Where the n-th piece of a length goes: sorted keys (length, first rank), and there bin and offset."""
    used, first, rows = {}, 0, []
    for times, lengths in found:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            used[length] = rank + times
            rows.append((length << 44 | rank, first, offset, rank))
            offset += length
        first += times
    rows.sort()
    return tuple(np.array([r[k] for r in rows], np.int64) for k in range(4))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row of a stored table ``cut(..., length)`` its ``sequence_id`` and ``offset``.

    Only the number of pieces of each length (at most ``capacity`` numbers) comes to the driver, and the patterns made from
    it (bounded, see ``patterns``) go to the tasks. A piece takes the place that its rank among pieces of its length
    has; ranks are counted in salted groups, so that a length that most pieces have meets many tasks.
    """
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row.length] = row.n
    shared = spark.sparkContext.broadcast(slots(patterns(counts, capacity)))
    salts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = cut.drop("ids").withColumn("_row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    groups = numbered.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("n")
    groups = groups.select("length", "_salt", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row"))
    ranked = numbered.withColumn("_n", within).join(groups, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_n") - 1).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "_rank"
    )

    def place(batches):
        keys, bins, offsets, firsts = shared.value
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() << 44 | rank, "right") - 1
            arrays = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            arrays += [pa.array(bins[at] + rank - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(
                arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            )

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pack ``docs(doc_id, text)``: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    A null or empty text takes one place (its end id). Only documents longer than a sequence are cut. Repeated rows are
    packed each; of equal pieces any may take any of their places. Other columns are ignored; an empty table gives no rows.
    """
    return pack(pieces(docs, path, capacity), capacity)


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (array of ids), from ``pieces`` and ``pack``."""
    ids = cut.select("doc_id", "piece", "ids_crc32", "ids").dropDuplicates(["doc_id", "piece", "ids_crc32"])
    same = [placed[c].eqNullSafe(ids[c]) for c in ("doc_id", "piece", "ids_crc32")]
    parts = placed.join(ids, same).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct(placed["offset"], ids["ids"]))).alias("parts")
    )

    def joined(batches):
        for batch in batches:
            rows = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4") for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array([r.astype(np.int64) for r in rows], pa.list_(pa.int64()))],
                ["sequence_id", "ids"],
            )

    return parts.mapInArrow(joined, "sequence_id long, ids array<long>")
