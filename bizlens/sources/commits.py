"""The commit log of incremental loads: which folders of which tables a reader may see.

A batch writes one folder below each of its tables, and last of all one line to the log. That line is a single file, so all
tables of the batch appear at once; folders of a batch that failed half-way are never read, and the batch replaces them
when it runs again. Merged batches are one more line, which hides the lines it covers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.schemas import FEED_TABLES
from bizlens.session import path_exists

_LINE = "feed string, first long, last long, folder string"


def batch_folder(batch_id: int) -> str:
    return f"batch_id={batch_id}"


def commit(spark: SparkSession, root: str, feed: str, first: int, last: int, folder: str) -> None:
    """Make ``folder``, which holds the batches ``first`` to ``last``, visible in all tables of the feed."""
    line = spark.range(1).select(
        F.lit(feed).alias("feed"), F.lit(first).cast("long").alias("first"), F.lit(last).cast("long").alias("last"), F.lit(folder).alias("folder")
    )
    line.coalesce(1).write.mode("overwrite").json(f"{root}/commits/{feed}-{first}-{last}")


def log(spark: SparkSession, root: str) -> list[tuple[str, int, int, str]]:
    """All visible lines ``(feed, first, last, folder)``, one for each batch that is not merged, in order."""
    if not path_exists(spark, f"{root}/commits"):
        return []
    lines = [tuple(r) for r in spark.read.schema(_LINE).json(f"{root}/commits", recursiveFileLookup=True).distinct().collect()]
    # A line is hidden by one that covers it and more.
    return sorted(a for a in lines if not any(a[0] == b[0] and a != b and b[1] <= a[1] and a[2] <= b[2] for b in lines))


def folders(spark: SparkSession, root: str, feed: str) -> list[str]:
    return [folder for name, _, _, folder in log(spark, root) if name == feed]


def holds(spark: SparkSession, root: str, feed: str, batch_id: int) -> bool:
    return any(name == feed and first <= batch_id <= last for name, first, last, _ in log(spark, root))


def datasets(feed: str) -> list[str]:
    """Everything a batch of the feed writes, as paths below the root."""
    records = [f"records/{feed}/{part}" for part in ("checked", "edges", "stitched")]
    return [*FEED_TABLES[feed], f"script_log/feed={feed}", *records]


def read_folders(spark: SparkSession, path: str, names: Iterable[str], schema: T.StructType | str) -> DataFrame:
    """The rows of some folders below ``path``; without any, no rows."""
    paths = [f"{path}/{name}" for name in names]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batches(spark: SparkSession, root: str, feed: str) -> None:
    """Write the visible batches of a feed as one folder per table, and then show that folder in their place.

    Many small files become few: Spark packs them into partitions of ``spark.sql.files.maxPartitionBytes``, and nothing is
    shuffled. The old folders stay for readers that have begun; remove them when none is left.
    """
    lines = [line for line in log(spark, root) if line[0] == feed]
    if len(lines) < 2:
        return
    first, last = lines[0][1], max(line[2] for line in lines)
    into = f"merged={first}-{last}"
    for dataset in datasets(feed):
        paths = [f"{root}/{dataset}/{folder}" for _, _, _, folder in lines]
        if dataset.endswith("/checked"):
            parts = [spark.read.parquet(path) for path in paths]
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part)
            whole.write.mode("overwrite").partitionBy("verdict").parquet(f"{root}/{dataset}/{into}")
        else:
            spark.read.parquet(*paths).write.mode("overwrite").parquet(f"{root}/{dataset}/{into}")
    commit(spark, root, feed, first, last, into)
