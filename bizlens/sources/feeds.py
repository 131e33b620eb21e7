"""Readers of the raw feeds, and the split into good records and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from bizlens.schemas import CORRUPT, FEEDS, REQUIRED

#: Where a record stands: its file, and the number of its line among those that begin in one block of the file.
ORIGIN = {"_file": "string", "_block": "bigint", "_line": "bigint"}


def raw_records(
    reader: DataFrameReader | DataStreamReader, feed: str, path: str | list[str], file_format: str = "json"
) -> DataFrame:
    """Unparsed lines (JSON) or rows (CSV with a header) of a feed with their file and block, from a batch or stream reader."""
    if file_format == "csv":
        # Without pruning, every plan parses whole rows and so finds the same ones broken.
        reader = reader.option("header", True).option("escape", '"').option("multiLine", False).option("columnPruning", False)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(FEEDS[feed])
        df, columns = reader.format("csv").load(path), FEEDS[feed].fieldNames()
    elif file_format == "json":
        df, columns = reader.format("text").load(path), ["value"]
    else:
        raise ValueError(f"unknown format: {file_format}")
    return df.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def parsed(raw: DataFrame, feed: str) -> DataFrame:
    """Lines of JSON as records, blank lines left out; records stay as they are. Unreadable ones keep their raw text."""
    if "value" not in raw.columns:
        return raw
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = raw.filter(F.length(F.trim("value")) > 0)
    return lines.select(F.from_json("value", FEEDS[feed], options).alias("_record"), *raw.columns).select(
        *[F.col(f"_record.{c}").alias(c) for c in FEEDS[feed].fieldNames()], *raw.columns
    )


def read_feed(
    spark: SparkSession, feed: str, path: str | list[str], file_format: str = "json", infer: bool = False
) -> DataFrame:
    """A feed from JSON lines or from CSV with a header, with its declared schema.

    ``path`` is any path or glob Spark can open. Records that do not parse keep their raw text in
    ``_corrupt_record``. With ``infer=True`` Spark reads the data once more to guess the schema.
    """
    if infer:
        reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("inferSchema", True)
        return (reader.option("header", True).option("escape", '"') if file_format == "csv" else reader).format(file_format).load(path)
    return parsed(raw_records(spark.read, feed, path, file_format), feed).select(*FEEDS[feed].fieldNames())


def _broken(feed: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in feed.columns else F.lit(False)


def with_reason(feed: DataFrame, name: str) -> DataFrame:
    """The feed with ``reason``: why a record can't be stored (unreadable, or a required column is null), else null."""
    reason = F.when(_broken(feed), F.lit("unreadable"))
    for key in REQUIRED[name]:
        reason = reason.when(F.col(key).isNull(), F.lit(f"no {key}"))
    return feed.withColumn("reason", reason)


def accepted(feed: DataFrame, name: str) -> DataFrame:
    """The records that the tables of the feed are made of."""
    return with_reason(feed, name).filter(F.col("reason").isNull()).drop("reason", CORRUPT)


def rejected(feed: DataFrame, name: str) -> DataFrame:
    """All other records: whatever fields were found, the raw text of unreadable ones, and the reason."""
    return with_reason(feed, name).filter(F.col("reason").isNotNull())


def good_records(feed: DataFrame) -> DataFrame:
    """Records that parsed, without the raw-text column."""
    if CORRUPT not in feed.columns:
        return feed
    return feed.filter(~_broken(feed)).drop(CORRUPT)


def quarantined(feed: DataFrame) -> DataFrame:
    """Records that did not parse: whatever fields were found, plus the raw text."""
    return feed.filter(_broken(feed))
