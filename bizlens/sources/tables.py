"""Table sinks and readers: Parquet folders, bucketed catalog tables, batch partitions, SQL views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.operators.joins import estimated_bytes
from bizlens.schemas import FEED_TABLES, TABLES, conform
from bizlens.sources import commits

BUCKET_BYTES = 4 << 20


def in_order(df: DataFrame, cluster_by: Sequence[str] = ()) -> DataFrame:
    """The rows sorted by range over all partitions, so that a filter on the first column skips most row groups.

    Ending ``cluster_by`` with a unique column lets a hot value span several partitions. Spark samples the rows for the
    bounds, which runs all that ``df`` computes once more: sort before costly columns are added.
    """
    return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Write a Parquet table, sorted by ``cluster_by`` if given (see ``in_order``), and return it as read back."""
    in_order(df, cluster_by).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Append rows to a declared table after fitting them to its columns and types."""
    return write_table(conform(df, table), path, mode="append")


def buckets_for(*tables: DataFrame) -> int:
    """A number of buckets for tables that join on their key: one for each ``BUCKET_BYTES`` of the largest as it is stored.

    Rows of few short columns take about ten times as much memory when a bucket is sorted. There are ``spark.sql.shuffle.partitions`` at least.
    """
    least = int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, *(-(-estimated_bytes(df) // BUCKET_BYTES) for df in tables))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a catalog table bucketed and sorted by ``key``, so that joins on the key need no shuffle."""
    spread = df.repartition(buckets, key)
    writer = spread.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(tables: Mapping[str, DataFrame], root: str, buckets: int) -> dict[str, DataFrame]:
    """Save tables to the catalog, bucketed by their distribution key or else by their unique key."""
    saved = {}
    for name, df in tables.items():
        spec = TABLES[name]
        saved[name] = write_bucketed(df, name, f"{root}/{name}", spec.distribute_by or spec.key, buckets)
    return saved


def read_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Declared tables below ``root``, each with its declared schema.

    Tables that batches were loaded into hold what the commit log shows, so that all tables of a batch appear at once.
    """
    shown: dict[str, list[str]] = {}
    for feed, _, _, folder in commits.log(spark, root):
        shown.setdefault(feed, []).append(folder)
    feed_of = {table: feed for feed, tables in FEED_TABLES.items() for table in tables}
    found = {}
    for name in names:
        folders, schema = shown.get(feed_of.get(name, "")), TABLES[name].schema
        # A feed with no batch yet may have been loaded as a whole.
        found[name] = (
            commits.read_folders(spark, f"{root}/{name}", folders, schema) if folders else spark.read.schema(schema).parquet(f"{root}/{name}")
        )
    return found


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make tables known to SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """Run SQL with named parameters (``:name``), never by pasting values into the text."""
    return spark.sql(text, args=parameters or None)


def preview(df: DataFrame, rows: int = 2, order_by: list[str] | None = None) -> DataFrame:
    """A few rows; give ``order_by`` for a repeatable choice."""
    if order_by:
        df = df.orderBy(*[F.col(c) for c in order_by])
    return df.limit(rows)
