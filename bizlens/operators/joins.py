"""Joins against lookup sides, and top-k, written to hold up when one key is very hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
#: The longs of a run-time filter, and the estimated size from which a lookup gets one.
FILTER_WORDS = 65_536
FILTER_FROM_BYTES = 10 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure ``df`` with one distributed aggregate: rows, and bytes of its columns as text."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    rows, size_bytes = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum((size + 16).cast("long")), F.lit(0))
    ).first()
    return rows <= max_rows and size_bytes <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join a large side to a lookup side (inner, left, left_semi or left_anti).

    A lookup that measures small is broadcast, so the large side is not shuffled. Any other lookup
    is joined by shuffle: each of its rows is copied to every salt while a large-side row takes the
    salt of its input partition, so a hot key is met by ``salts`` tasks. The salt is a function of
    the partition number only, hence the same when a task is run again.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup, max_rows=max_rows):
        return rows.join(F.broadcast(lookup), keys, how)
    salted_rows = rows.withColumn("_salt", F.spark_partition_id() % salts)
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")


def estimated_bytes(df: DataFrame) -> int:
    """What Spark's planner takes the size of ``df`` to be, from file sizes; no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _bit(keys: Sequence[Column], words: int) -> tuple[Column, Column]:
    """The word and the bit that a key sets in a filter of ``words`` longs."""
    hashed = F.xxhash64(*keys)
    place = F.pmod(hashed, F.lit(words)).cast("int")
    return place, F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))


def might_match(lookup: DataFrame, on: Sequence[str], rows_on: Sequence[str] | None = None, words: int = FILTER_WORDS) -> Column:
    """A condition that holds for every row with a partner in ``lookup`` and for few others, found out while the query runs.

    It is a Bloom filter of one hash: a scalar subquery sets a bit per key of the lookup, the scan of the large side tests it.
    Its size is fixed (512 KB); a lookup of very many keys fills it, and then it lets all rows through.
    """
    spark, keys = lookup.sparkSession, [F.col(c) for c in on]
    word, bit = _bit(keys, words)
    bits = lookup.select(word.alias("word"), bit.alias("bit"))
    blank = spark.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bit"))
    filled = bits.unionByName(blank).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    whole = filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("f"))
    place, mine = _bit([F.col(c) for c in rows_on or on], words)
    found = F.get(whole.scalar(), place).bitwiseAND(mine) != 0
    # The partition's number keeps the planner from copying the condition to the other side of a join, whose shuffle would differ then.
    return F.when(F.spark_partition_id() < 0, F.lit(False)).otherwise(found)


def runtime_join(rows: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "inner", filter_from: int = FILTER_FROM_BYTES) -> DataFrame:
    """Join a large side to a lookup (inner or left_semi) without measuring the lookup first.

    A lookup whose files are small is broadcast by the planner. Before any other one the large side is cut down by
    ``might_match``, so that only rows that may match are shuffled; adaptive execution then broadcasts the lookup if it turns out
    small and splits skewed partitions if not. Building the plan starts no job, and the shuffle that makes the lookup's keys
    distinct serves the filter and the join, so the lookup is computed once. (For an inner join that holds if the lookup
    is an aggregate that no column pruning can thin out.)
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left_semi"):
        raise ValueError("how is 'inner' or 'left_semi'")
    if estimated_bytes(lookup) > filter_from:
        for key in keys:
            lookup = lookup.filter(F.col(key).isNotNull())
        if how == "left_semi":
            # Without the count the planner would drop the grouping on the side of the join.
            lookup = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0").drop("_n")
        rows = rows.filter(might_match(lookup, keys))
    return rows.join(lookup, keys, how)


def top_k(df: DataFrame, order: Sequence[Column], k: int, within: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows by ``order``, of the whole frame or of each group.

    The grouped form filters on ``row_number``, for which Spark cuts each group to ``k`` rows
    before the shuffle, so no task ever holds a whole group.
    """
    if not within:
        return df.orderBy(*order).limit(k)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")
