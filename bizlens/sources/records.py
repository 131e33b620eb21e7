"""The record store: a raw feed is read and parsed once, and all its tables and its quarantine are read from the store.

Below ``<root>/records/<feed>``, with a folder per load or batch in each:

``checked``   every record as parsed, with its origin, partitioned by ``verdict`` (stored or rejected);
``edges``     a row for each file: its first and last line, with their text where they were rejected;
``stitched``  records put together again from the pieces that a byte-wise split of the feed left at the ends of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.schemas import CORRUPT, FEEDS
from bizlens.sources import commits
from bizlens.sources.feeds import ORIGIN, parsed, raw_records, with_reason

#: The folder of a full load, which has no batches.
FULL = "full"
_PLACE = "struct<_block:bigint,_line:bigint>"
EDGES = f"_file string, first {_PLACE}, last {_PLACE}, first_text string, last_text string"


def read_records(spark: SparkSession, feed: str, path: str | list[str], file_format: str = "json") -> DataFrame:
    """The unparsed records of a feed with their origin, to be staged."""
    return raw_records(spark.read, feed, path, file_format)


def _checked_schema(feed: str) -> T.StructType:
    fields = [T.StructField(c, T.StringType() if kind == "string" else T.LongType()) for c, kind in ORIGIN.items()]
    return T.StructType([*FEEDS[feed].fields, T.StructField("reason", T.StringType()), *fields, T.StructField("verdict", T.StringType())])


def _stitched_schema(feed: str) -> T.StructType:
    pieces = T.ArrayType(T.StructType([T.StructField(c, T.StringType() if kind == "string" else T.LongType()) for c, kind in ORIGIN.items()]))
    fields = [f for f in FEEDS[feed].fields if f.name != CORRUPT]
    return T.StructType([*fields, T.StructField("_file", T.StringType()), T.StructField("pieces", pieces)])


def checked(raw: DataFrame, feed: str) -> DataFrame:
    """Every record with its reason and verdict; rejected lines keep their raw text, whatever was read from them."""
    if "_file" in raw.columns and "_line" not in raw.columns:
        raw = raw.withColumn("_line", F.monotonically_increasing_id())  # in the order of the file within each block
    records = with_reason(parsed(raw, feed), feed)
    text = F.when(F.col("reason").isNotNull(), F.col("value")) if "value" in records.columns else F.col(CORRUPT) if CORRUPT in records.columns else F.lit(None)
    known = {f.name: F.col(f.name).cast(f.dataType) if f.name in records.columns else F.lit(None).cast(f.dataType) for f in FEEDS[feed].fields}
    known[CORRUPT] = text.cast("string")
    origin = {c: F.col(c) if c in records.columns else F.lit(None).cast(kind) for c, kind in ORIGIN.items()}
    verdict = F.when(F.col("reason").isNull(), "stored").otherwise("rejected")
    columns = {**known, "reason": F.col("reason"), **origin, "verdict": verdict}
    return records.select(*[value.alias(name) for name, value in columns.items()])


def _edges(store: DataFrame) -> DataFrame:
    place = F.struct("_block", "_line")
    ends = store.filter(F.col("_file").isNotNull()).groupBy("_file").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    lost = store.filter((F.col("verdict") == "rejected") & F.col("_file").isNotNull()).select("_file", place.alias("place"), CORRUPT)
    for end in ("first", "last"):
        text = lost.withColumnsRenamed({"place": end, CORRUPT: f"{end}_text"})
        ends = ends.join(text, ["_file", end], "left")
    return ends.select("_file", "first", "last", "first_text", "last_text")


def _file_order() -> dict[str, Column]:
    """What sorts files as they were split: the name around its last number, that number, and the number of digits."""
    digits = F.regexp_extract("_file", r"(\d+)\D*$", 1)
    return {
        "_around": F.regexp_replace("_file", r"\d+(?=\D*$)", ""), "_digits": F.length(digits), "_number": digits.try_cast("bigint"),
    }


def _stitched(edges: DataFrame, feed: str) -> DataFrame:
    """Records whose pieces end one file and begin the next, found over ``edges`` with the flag ``_new``.

    Where the last line of a file and the first of the next were both rejected, their texts are joined; files that hold one
    piece only are passed through, so a chain of pieces may hold several records. What makes no JSON value, or none that
    can be stored, stays in quarantine piece by piece. Two files that are numbered alike must have consecutive numbers.
    Records without a piece of a new file were found before. The order of files is found over one row per file, without texts.
    """
    flags = edges.select(
        "_file", F.col("first_text").isNotNull().alias("_head"), F.col("last_text").isNotNull().alias("_tail"),
        (F.col("first") == F.col("last")).alias("_single"),
    ).withColumns(_file_order())
    order = Window.orderBy("_around", "_number", "_digits", "_file")
    following = {c: F.lead(c).over(order).alias(c) for c in ("_file", "_head", "_around", "_digits", "_number")}
    flags = flags.withColumns({f"{c}_next": value for c, value in following.items()}).withColumn("_at", F.row_number().over(order))
    alike = (F.col("_around") == F.col("_around_next")) & (F.col("_digits") == F.col("_digits_next"))
    adjacent = ~alike | (F.col("_number_next") == F.col("_number") + 1)
    flags = flags.withColumn("_open", F.coalesce(F.col("_tail") & F.col("_head_next") & adjacent, F.lit(False)))
    passes = F.col("_single") & F.coalesce(F.lag("_open").over(order), F.lit(False))
    chain = F.sum((F.col("_open") & ~passes).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    seams = flags.withColumn("_chain", chain).filter("_open").select("_chain", "_at", "_file", "_file_next")
    sides = F.explode(F.array(
        F.struct(F.col("_at").alias("at"), F.col("_file").alias("file"), F.lit("last").alias("side")),
        F.struct((F.col("_at") + 1).alias("at"), F.col("_file_next").alias("file"), F.lit("first").alias("side")),
    ))
    pieces = seams.select("_chain", sides.alias("p")).select("_chain", "p.at", F.col("p.file").alias("_file"), "p.side")
    # The two sides of a file that is passed through are the same line.
    pieces = pieces.groupBy("_chain", "at", "_file").agg(F.max("side").alias("side")).join(edges, "_file")
    place, last = F.col("side") == "last", F.col("last_text")
    pieces = pieces.select(
        "_chain", "at", "_file", "_new", F.when(place, F.col("last")).otherwise(F.col("first")).alias("place"),
        F.when(place, last).otherwise(F.col("first_text")).alias("text"),
    )
    parts = F.sort_array(F.collect_list(F.struct("at", "_file", "place", "text", "_new")))
    chains = pieces.groupBy("_chain").agg(parts.alias("parts")).select(F.explode(_whole_values("parts")).alias("r"))
    joined = chains.filter(F.exists("r.pieces", lambda p: p["_new"])).select(
        F.col("r.text").alias("value"), F.get("r.pieces", F.lit(0))["_file"].alias("_file"),  # the file where it begins
        F.transform("r.pieces", lambda p: F.struct(*[p[c] for c in ORIGIN])).alias("pieces"),
    )
    records = with_reason(parsed(joined, feed), feed)
    return records.filter(F.col("reason").isNull()).select(*_stitched_schema(feed).fieldNames())


def _whole_values(parts: str) -> Column:
    """The JSON values that the pieces of a chain make up, each as ``text, pieces``, cut where a value is complete.

    No beginning of an object is an object itself, so the first place where one is complete is its end. What never becomes
    complete is left out.
    """
    pieces_kind = "array<struct<_file:string,_block:bigint,_line:bigint,_new:boolean>>"
    no_pieces = F.from_json(F.lit("[]"), pieces_kind)
    nothing = F.from_json(F.lit("[]"), f"array<struct<text:string,pieces:{pieces_kind}>>")

    def step(state: Column, p: Column) -> Column:
        text = F.concat(state["text"], p["text"])
        piece = F.struct(p["_file"].alias("_file"), p["place"]["_block"].alias("_block"), p["place"]["_line"].alias("_line"), p["_new"].alias("_new"))
        pieces = F.array_append(state["pieces"], piece)
        # Two values in a row, or a rest behind one, make no array.
        complete = F.coalesce(F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1, F.lit(False))
        return F.struct(
            F.when(complete, F.lit("")).otherwise(text).alias("text"),
            F.when(complete, no_pieces).otherwise(pieces).alias("pieces"),
            F.when(complete, F.array_append(state["done"], F.struct(text.alias("text"), pieces.alias("pieces")))).otherwise(state["done"]).alias("done"),
        )

    start = F.struct(F.lit("").alias("text"), no_pieces.alias("pieces"), nothing.alias("done"))
    return F.aggregate(parts, start, step, lambda state: state["done"])


def stage(raw: DataFrame, feed: str, root: str, folder: str = FULL, before: list[str] | None = None) -> DataFrame:
    """Write the records of a feed to the store and return those that tables can be made of.

    ``raw`` comes from ``read_records`` or is any frame with columns of the feed (missing ones are null). It is read once.
    ``before`` names earlier folders whose cut ends may continue here.
    """
    spark, at = raw.sparkSession, f"{root}/records/{feed}"
    checked(raw, feed).write.mode("overwrite").partitionBy("verdict").parquet(f"{at}/checked/{folder}")
    store = spark.read.schema(_checked_schema(feed)).parquet(f"{at}/checked/{folder}")
    _edges(store).write.mode("overwrite").parquet(f"{at}/edges/{folder}")
    now = commits.read_folders(spark, f"{at}/edges", [folder], EDGES).withColumn("_new", F.lit(True))
    earlier = commits.read_folders(spark, f"{at}/edges", before or [], EDGES).withColumn("_new", F.lit(False))
    _stitched(now.unionByName(earlier), feed).write.mode("overwrite").parquet(f"{at}/stitched/{folder}")
    found = accepted(spark, root, feed, [folder])
    return found if "_file" in raw.columns else found.drop("_file")


def accepted(spark: SparkSession, root: str, feed: str, names: list[str] | None = None) -> DataFrame:
    """The stored and stitched records of a feed with the file they come from; by default of all that is visible."""
    at, names = f"{root}/records/{feed}", names or commits.folders(spark, root, feed) or [FULL]
    columns = [*(f.name for f in FEEDS[feed].fields if f.name != CORRUPT), "_file"]
    stored = _all_checked(spark, at, feed, names).filter(F.col("verdict") == "stored")
    stitched = commits.read_folders(spark, f"{at}/stitched", names, _stitched_schema(feed))
    return stored.select(*columns).unionByName(stitched.select(*columns))


def _all_checked(spark: SparkSession, at: str, feed: str, names: list[str]) -> DataFrame:
    whole = None
    for name in names:  # each folder has its own partitions by verdict
        part = spark.read.schema(_checked_schema(feed)).parquet(f"{at}/checked/{name}")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def quarantine(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Rejected records of a feed: what was read of them, the raw text, the reason and the origin.

    Pieces that were stitched, in the same batch or a later one, are no longer in quarantine.
    """
    at, names = f"{root}/records/{feed}", commits.folders(spark, root, feed) or [FULL]
    lost = _all_checked(spark, at, feed, names).filter(F.col("verdict") == "rejected").drop("verdict")
    stitched = commits.read_folders(spark, f"{at}/stitched", names, _stitched_schema(feed))
    used = stitched.select(F.explode("pieces").alias("p")).select("p.*")
    return lost.join(used, list(ORIGIN), "left_anti").select(*[f.name for f in FEEDS[feed].fields], "reason", "_file")


def loaded_files(spark: SparkSession, root: str, feed: str, folder: str) -> DataFrame:
    """``file_path, processed_file`` of the files in a folder of the store; the number is that of a label such as ``x07``, else null."""
    edges = commits.read_folders(spark, f"{root}/records/{feed}/edges", [folder], EDGES)
    label = F.regexp_extract("_file", r"/x(\d+)[^/]*$", 1)
    return edges.select(F.col("_file").alias("file_path"), label.try_cast("bigint").alias("processed_file"))
