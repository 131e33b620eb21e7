"""The five feeds and the lookup tables, derived from the given Parquet tables.

The given tables hold no dirt, so null keys, empty texts, date-only timestamps, unreadable years
and repeated rows are planted by expressions on the row's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bizlens.operators.sentiment import Rules
from bizlens.operators.words import lemma_forms
from bizlens.plans import marts
from bizlens.session import materialize, new_folder
from bizlens.sources.tables import write_table

BUSINESS = "src3"
STANDIN_RULES = Rules(
    negations=("that", "nicht", "que"),
    increasing=("with", "der"),
    decreasing=("for", "les"),
    contrast=("this", "but"),
    phrases=(("and attion", 2.5), ("attion to thanedble", -1.5), ("la de", 1.25)),
    lessening=("de la", "the orre"),
    never=("que", "that"),
    never_so=("with", "der"),
    without=("nicht",),
    doubt=("die", "der"),
    least=("by", "des"),
    not_least=("the", "la"),
    mute_before=(("is", "the"),),
)
RULE_WORDS = sorted(
    {*STANDIN_RULES.negations, *STANDIN_RULES.increasing, *STANDIN_RULES.decreasing, *STANDIN_RULES.contrast, *STANDIN_RULES.least}
)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def given_texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table of texts. A table stored as fewer splits than there are cores is spread by its key;
    a table of many files is taken as it is, without a shuffle."""
    texts = given(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return texts.repartition(cores, key) if texts.rdd.getNumPartitions() < cores else texts


def business_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = given(spark, sf_dir, "documents").select("source").distinct()
    n = F.substring("source", 4, 9).cast("int")
    return sources.select(
        F.when(n % 13 != 12, F.col("source")).alias("business_id"),
        F.col("source").alias("name"),
        F.concat(n.cast("string"), F.lit(" main st")).alias("address"),
        F.concat(F.lit("city"), (n % 3).cast("string")).alias("city"),
        F.concat(F.lit("s"), (n % 4).cast("string")).alias("state"),
        F.lpad(n.cast("string"), 5, "0").alias("postal_code"),
        (n * F.lit(1.5)).alias("latitude"),
        (n * F.lit(-0.25)).alias("longitude"),
        (1 + (n % 9) * F.lit(0.5)).alias("stars"),
        n.alias("review_count"),
        F.when(n % 5 == 0, 0).otherwise(1).alias("is_open"),
        F.when(
            n % 11 != 10, F.format_string("cat%d, cat%d", n % 7, (n + 3) % 7)
        ).alias("categories"),
    )


def checkin_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    no = F.col("event_id")
    first = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    second = F.date_format(F.col("ts") + F.expr("interval 40 days"), "yyyy-MM-dd HH:mm:ss")
    return events.select(
        F.when(no % 53 != 0, F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string"))).alias("business_id"),
        F.when(no % 41 == 0, F.lit(None))
        .when(no % 97 == 1, F.concat(first, F.lit(", 2016-03-09")))
        .when(no % 3 == 0, F.concat(first, F.lit(", "), second))
        .otherwise(first)
        .alias("date"),
    )


def review_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given_texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "source", "text")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    no = F.col("doc_id")
    return documents.join(orders, F.col("doc_id") == F.col("o_orderkey")).select(
        F.when(no % 61 != 7, no.cast("string")).alias("review_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("source").alias("business_id"),
        (1 + no % 5).cast("double").alias("stars"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").substr(F.lit(1), F.when(no % 37 == 5, 10).otherwise(19)).alias("date"),
        F.when(no % 43 == 11, F.lit("")).when(no % 47 != 13, F.col("text")).alias("text"),
    )


def tip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = given(spark, sf_dir, "conversations")
    no, turn = F.col("conv_id"), F.col("turn")
    when = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(conv_id as int), cast(turn as int), 0)")
    copies = F.sequence(F.lit(1), F.when(no % 3 == 0, 2).otherwise(1))
    return said.withColumn("_copy", F.explode(copies)).select(
        F.when(no % 17 == 4, F.lit("")).when(no % 19 != 5, F.col("text")).alias("text"),
        F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("date"),
        turn.cast("int").alias("compliment_count"),
        F.concat(F.lit("src"), (no % 20).cast("string")).alias("business_id"),
        no.cast("string").alias("user_id"),
    )


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.col("c_custkey")
    as_text = [(no + step).cast("string") for step in (4, 8, 2)]
    return given(spark, sf_dir, "customer").select(
        F.when(no % 71 != 3, no.cast("string")).alias("user_id"),
        F.col("c_name").alias("name"),
        (no % 100).cast("int").alias("review_count"),
        F.when(no % 3 == 0, F.concat_ws(", ", *as_text)).when(no % 3 == 1, F.lit("")).alias("friends"),
        F.when(no % 29 == 6, F.lit("None"))
        .when(no % 4 == 0, F.lit("2017,2018"))
        .when(no % 4 == 1, F.lit("2018"))
        .when(no % 4 == 2, F.lit(""))
        .alias("elite"),
    )


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, value``: every document as a line of the review feed."""
    no = F.col("doc_id")
    record = F.struct(
        no.cast("string").alias("review_id"), F.concat(F.lit("u"), (no % 500).cast("string")).alias("user_id"),
        F.col("source").alias("business_id"), (1 + no % 5).cast("double").alias("stars"), "text",
    )
    return given_texts(spark, sf_dir, "documents", "doc_id").select("doc_id", F.to_json(record).alias("value"))


def dirty_review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, and further ones that are broken: halves of records, wrong types, missing keys."""
    lines, no = review_lines(spark, sf_dir), F.col("doc_id")
    broken = [
        (no % 59 == 0, F.expr("left(value, length(value) div 2)")),
        (no % 53 == 5, F.regexp_replace("value", r'"stars":[\d.]+', '"stars":"some"')),
        (no % 61 == 7, F.regexp_replace("value", r'"review_id":"\d+",', "")),
        (no % 43 == 11, F.regexp_replace("value", r'"user_id":"u\d+"', '"user_id":null')),
    ]
    values = F.array_compact(F.array("value", *[F.when(chosen, text) for chosen, text in broken]))
    return lines.select("doc_id", F.explode(values).alias("value"))


def write_labelled(lines: DataFrame, folder: str) -> None:
    """Write ``lines(no, value)`` as one file ``x07`` for each number."""
    spark, made = lines.sparkSession, new_folder(lines.sparkSession, "unlabelled")
    lines.repartition("no").write.partitionBy("no").text(made)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for found in files.globStatus(hadoop.Path(f"{made}/no=*/part-*")):
        number = int(found.getPath().getParent().getName().split("=")[1])
        files.rename(found.getPath(), hadoop.Path(f"{folder}/x{number:02}"))


def cut_by_bytes(lines: DataFrame, files: int = 37) -> DataFrame:
    """``no, value``: the lines of ``lines(doc_id, value)`` in one row, cut into about ``files`` pieces of equal bytes."""
    rows = lines.select("doc_id", F.concat("value", F.lit("\n")).cast("binary").alias("bytes"))
    sizes = rows.select("doc_id", F.octet_length("bytes").cast("long").alias("size"))
    size = max(sizes.agg(F.sum("size")).first()[0] // files, 1)
    before = F.sum("size").over(Window.orderBy("doc_id")) - F.col("size")  # ids and sizes only
    placed = rows.join(sizes.select("doc_id", "size", before.alias("start")), "doc_id")
    spread = placed.withColumn("no", F.explode(F.expr(f"sequence(start div {size}, (start + size - 1) div {size})")))
    part = F.expr(f"substring(bytes, cast(greatest(no * {size} - start, 0L) + 1 as int), cast(least(start + size, (no + 1) * {size}) - greatest(start, no * {size}) as int))")
    parts = spread.select("no", "start", part.cast("string").alias("part"))
    joined = parts.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    return joined.select(F.col("no").cast("int").alias("no"), F.array_join("parts.part", "").alias("value"))


FEED_STANDINS = {
    "business": business_feed,
    "checkin": checkin_feed,
    "review": review_feed,
    "tip": tip_feed,
    "user": user_feed,
}


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain words that occur at least five times in the documents, with their frequency."""
    text = F.lower("text")
    words = given_texts(spark, sf_dir, "documents", "doc_id").select(
        F.explode(F.regexp_extract_all(text, F.lit("[a-z]{3,}"), F.lit(0))).alias("word")
    )
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= 5)


def lexicon(words: DataFrame) -> DataFrame:
    valence = (F.ascii(F.substring(F.md5(F.col("word").cast("binary")), 1, 1)) % 9 - 4).cast("double")
    return (
        words.filter((F.col("n") >= 20) & ~F.col("word").isin(RULE_WORDS))
        .select(F.col("word").alias("term"), valence.alias("valence"))
        .filter(F.col("valence") != 0)
    )


def nouns(words: DataFrame) -> DataFrame:
    return words.select(F.col("word").alias("lemma"))


def exceptions(words: DataFrame) -> DataFrame:
    five = nouns(words).filter(F.length("lemma") == 5)
    return five.select(F.concat("lemma", F.lit("en")).alias("form"), "lemma")


class Standins:
    """Feeds, lookups and written tables of one data folder, made on first use.

    Lookups and tables are written once to the shared folder and read from there, as a dashboard
    reads a warehouse.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def feed(self, name: str) -> DataFrame:
        return FEED_STANDINS[name](self.spark, self.sf_dir)

    def lookup(self, name: str) -> DataFrame:
        if name not in self._made:
            if name == "vocabulary":
                made = vocabulary(self.spark, self.sf_dir)
            elif name == "forms":
                words = self.lookup("vocabulary")
                made = lemma_forms(nouns(words), exceptions(words))
            else:
                made = lexicon(self.lookup("vocabulary"))
            self._made[name] = materialize(made, name)
        return self._made[name]

    def plan(self, name: str) -> DataFrame:
        """A table as a lazy plan over its feed."""
        if name in ("review", "tip"):
            build = {"review": marts.review, "tip": marts.tip}[name]
            return build(self.feed(name), self.lookup("lexicon"), STANDIN_RULES)
        if name == "review_text":
            return marts.review_text(marts.review_staging(self.feed("review")), self.lookup("forms"))
        if name == "tip_text":
            return marts.tip_text(marts.tip_staging(self.feed("tip")), self.lookup("forms"))
        feed = {"business_category": "business", "user_elite": "user", "user_friend": "user"}.get(name, name)
        return getattr(marts, name)(self.feed(feed))

    def table(self, name: str) -> DataFrame:
        """A table as written once and read back."""
        key = f"table {name}"
        if key not in self._made:
            if name == "review_text":
                plan = marts.review_text(self.table("review"), self.lookup("forms"))
            elif name == "tip_text":
                plan = marts.tip_text(self.table("tip"), self.lookup("forms"))
            else:
                plan = self.plan(name)
            self._made[key] = write_table(plan, new_folder(self.spark, name))
        return self._made[key]

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in names}


_known: dict[tuple[str, str], Standins] = {}


def standins(spark: SparkSession, sf_dir: str) -> Standins:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _known:
        _known[key] = Standins(spark, sf_dir)
    return _known[key]
