"""Shared steps of the training-data operators: arrow batches, word hashes, and linking of near copies."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.joins import fits_broadcast
from bizlens.session import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
MAX_CACHED_WORDS = 600_000
#: Centres taken from a bucket of candidates, by round: the first, then all up to these ranks.
RANKS = (1, 32)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text as a string; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def wrapped(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the whole row as the struct ``_all``, so that no name of another column clashes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"), F.struct("*").alias("_all"))


def fold(column: str = "doc_id", parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def chunks(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``most_bytes`` of ``column``; one longer row stays whole."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        if not len(sizes):
            continue
        group, start = (np.cumsum(sizes, dtype=np.int64) - sizes) // most_bytes, 0
        for end in [*(np.flatnonzero(np.diff(group)) + 1), len(sizes)]:
            yield batch.slice(start, int(end) - start)
            start = int(end)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number of words."""

    def __missing__(self, word):
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """A hash for each run of ``width`` words; of a shorter non-empty text, one for all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B185EBCA87) + hashes[k : n - width + 1 + k])
    return out


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Distributed union-find: ``(node, root)`` of every node of the edges; the root is the smallest node.

    Large and small stars in turn: each node's neighbours are tied to the smallest one among them, until every node
    has one link and none leads to a node that has one itself. A hub is met by grouped minima and joins only, never by a list of its neighbours. Every round is a
    written table, so a lost executor costs one round. Empty edges give no rows.
    """
    links = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        before, links = links, materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct(),
            "links",
        )
        discard(before)
        ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").isEmpty():
            break
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def parity(elements: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of ``64 * words`` bits: how many of the distinct ``elements`` fall on each bit, modulo 2."""
    ones = np.bincount((elements % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").view(np.int64)


def distinct_in_runs(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """The distinct hashes of runs that are ``counts`` long: sorted, the number of the run before the first bits of the hash; how many bits these are."""
    kept = np.uint64(64 - len(counts).bit_length())
    both = np.repeat(np.arange(len(counts), dtype=np.uint64), counts) << kept | hashes >> (np.uint64(64) - kept)
    both.sort()
    return both[np.append(True, both[1:] != both[:-1])[: len(both)]], kept


def sketched(hashes: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """For runs of well-mixed hashes, ``counts`` long: how many distinct ones a run has, and a parity bitmap of ``words`` longs.

    ``words`` is a power of two. The first bits of a hash name the long, the next the bit. So the XOR of neighbouring longs is a smaller bitmap.
    """
    sizes, bits = np.zeros(len(counts), np.int64), np.zeros((len(counts), words), np.uint64)
    both, kept = distinct_in_runs(hashes, counts)
    if len(both):
        place = both >> (kept - np.uint64(5 + words.bit_length()))  # run, long and bit
        long = place >> np.uint64(6)
        first = np.flatnonzero(np.append(True, long[1:] != long[:-1]))
        bits.reshape(-1)[long[first].astype(np.int64)] = np.bitwise_xor.reduceat(np.uint64(1) << (place & np.uint64(63)), first)
        sizes += np.bincount((both >> kept).astype(np.int64), minlength=len(counts))
    return sizes, bits.view(np.int64)


def may_pass(a: Column, b: Column, words: int, threshold: float) -> Column:
    """False only for pairs of sets whose Jaccard similarity is below ``threshold``, by their sketches (size, bits).

    The bits in which two ``parity`` bitmaps differ are never more than the elements that only one of the sets has, so no
    pair that passes the exact test is lost.
    """
    differ = F.lit(0)
    for k in range(words):
        differ = differ + F.bit_count(a["bits"][k].bitwiseXOR(b["bits"][k]))
    return sizes_pass(a["size"], b["size"], threshold) & (differ * (1 + threshold) <= (a["size"] + b["size"]) * (1 - threshold) + 1e-6)


def may_pass_fine(a: Column, b: Column, threshold: float) -> Column:
    """The same by longer bitmaps ``fine``; slower, for the pairs that the short ones let through."""
    differ = F.aggregate(F.zip_with(a["fine"], b["fine"], lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + F.bit_count(x))
    return differ * (1 + threshold) <= (a["size"] + b["size"]) * (1 - threshold) + 1e-6


def sizes_pass(a: Column, b: Column, threshold: float) -> Column:
    """False only for sets of sizes so different that their Jaccard similarity is below ``threshold``."""
    return F.least(a, b) >= threshold * F.greatest(a, b) - 1e-6


def shared_buckets(buckets: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of ``buckets(bucket, node)`` whose bucket holds two different nodes, with its ``size``; stored.

    With ``threshold``, ``buckets`` also has ``extent``, how many elements a node has, and rows go that have no other one in
    their bucket with which they can reach the threshold: in the order of extents, the one before or behind is the nearest.
    """
    dealt = buckets.repartition("bucket")
    if threshold is not None:
        order = Window.partitionBy("bucket").orderBy("extent")
        beside = dealt.withColumns({"_before": F.lag("extent").over(order), "_behind": F.lead("extent").over(order)})
        near = [F.col(c).isNotNull() & sizes_pass(F.col("extent"), F.col(c), threshold) for c in ("_before", "_behind")]
        close = beside.filter(near[0] | near[1])
        whole = close.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket")))
        return materialize(whole.select("node", "bucket", "size"), "buckets", "zstd")
    # Both columns are used, so that the join takes the same shuffle again.
    several = dealt.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("size"))
    return materialize(dealt.join(several.filter("lo <> hi").select("bucket", "size"), "bucket"), "buckets", "zstd")


def _small(side: DataFrame) -> DataFrame:
    """A side of a join, broadcast if it measures small."""
    return F.broadcast(side) if fits_broadcast(side) else side


def linked(
    sized: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sketches: DataFrame,
    close: Callable[[Column, Column], Column],
    threshold: float = 0.0,
    done_with: Sequence[DataFrame] = (),
) -> DataFrame | None:
    """Classes of nodes, ``(node, root)``, from candidates that share a bucket and an exact test of pairs; None without any.

    ``sized`` comes from ``shared_buckets``; it and the tables ``done_with`` are deleted as soon as they were read. ``verify(pairs(a, b))`` returns the pairs that pass. ``close`` compares two
    rows of ``sketches(node, sketch)`` and may be true for more pairs than pass, but never false for one that passes;
    neither may the sizes in them be further apart than ``threshold`` allows.

    A bucket isn't expanded into all its pairs. Its nodes are ranked by how many nodes they meet over all their
    buckets, since the text that others were copied from meets most. First each node is tested against the node of
    rank 1 of its buckets, unless their sizes or sketches are too far apart. Then classes are formed, and only nodes that stand in
    different classes are compared further, in buckets that have more ranks than were compared: with ranks up to 32, then
    up to 1,024, and so on until the largest bucket is through. In these rounds the
    join itself compares sketches, so that only pairs that may well pass become rows. So every pair of a bucket
    is tested, or shown to be too far apart, or already in one class.

    What is stored is one row for each node, with its sketch and its buckets. In a round every row of an open bucket is
    shuffled once, with its sketch in the later rounds; centres and members are both read from that shuffle.
    """
    largest = sized.agg(F.max("size")).first()[0]
    if not largest:
        discard(sized, *done_with)
        return None
    degree = sized.groupBy("node").agg(F.sum("size").alias("degree"), F.collect_set("bucket").alias("buckets"))
    nodes = materialize(degree.join(sketches, "node").select("node", "degree", "buckets", "sketch"), "met", "zstd")
    discard(sized, *done_with)
    order = Window.partitionBy("bucket").orderBy(F.desc("degree"), "node")
    extent = F.col("sketch.size").alias("extent")
    classes, low, high = None, 0, RANKS[0]
    while low < largest - 1 or low == 0:
        if classes is None:
            current = nodes.select("node", "degree", extent, F.explode("buckets").alias("bucket")).withColumn("root", F.col("node"))
        else:
            rooted = nodes.join(_small(classes), "node", "left").withColumn("root", F.coalesce("root", "node"))
            met = rooted.select("root", F.explode("buckets").alias("bucket"))
            met = met.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"))
            open_buckets = materialize(met.filter(F.col("size") > low + 1).filter("lo <> hi").select("bucket", "size"), "open")
            current = rooted.select("node", "degree", extent, "sketch", "root", F.explode("buckets").alias("bucket"))
            current = current.join(_small(open_buckets.select("bucket")), "bucket", "left_semi")
        current = current.repartition("bucket")
        centres = current.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= high).filter(F.col("rank") > low)
        centres = centres.drop("rank").withColumnsRenamed({c: f"c_{c}" for c in current.columns})
        met = F.col("root") != F.col("c_root")
        met &= F.struct(-F.col("c_degree"), "c_node") < F.struct(-F.col("degree"), "node")
        met &= sizes_pass(F.col("extent"), F.col("c_extent"), threshold)
        if low:
            met &= close(F.col("sketch"), F.col("c_sketch"))
        # Within coalesce no condition on one side alone follows, which would make the two read different shuffles.
        pairs = (
            current.join(centres, (F.col("bucket") == F.col("c_bucket")) & F.coalesce(met, F.lit(False)))
            .select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()
        )
        if not low:
            for side in ("a", "b"):
                pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)
            pairs = pairs.filter(close(F.col("sketch_a"), F.col("sketch_b"))).select("a", "b")
        pairs = materialize(pairs, "pairs")
        last = False
        if low and pairs.isEmpty():
            last = open_buckets.filter(F.col("size") > high + 1).isEmpty()
        else:
            found = materialize(verify(pairs), "verified")
            # The classes so far stand for all links that made them.
            links = found if classes is None else found.unionByName(classes.select(F.col("node").alias("a"), F.col("root").alias("b")))
            before, classes = classes, materialize(components(links), "classes")
            discard(before, found)
        discard(pairs, open_buckets if low else None)
        if last:
            break
        low, high = high, high * RANKS[1]
    discard(nodes)
    return classes
