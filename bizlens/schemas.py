"""Declared schemas: the five raw feeds, the ten tables, and what each table promises.

Types, key columns and length limits are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"



_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _columns(text: str) -> T.StructType:
    """A schema from ``name type [not null], ...``; unlike a DDL parse it needs no session."""
    schema = T.StructType()
    for column in text.split(","):
        name, kind, *constraint = column.split()
        schema.add(name, _TYPES[kind], nullable=not constraint)
    return schema


def _feed(text: str) -> T.StructType:
    return _columns(text).add(CORRUPT, T.StringType())


# Fields that no table has are read as text, so that they can't make a record unreadable.
FEEDS: dict[str, T.StructType] = {
    "business": _feed(
        "business_id string, name string, address string, city string, state string, postal_code string, "
        "latitude double, longitude double, stars string, review_count string, is_open int, categories string"
    ),
    "checkin": _feed("business_id string, date string"),
    "review": _feed(
        "review_id string, user_id string, business_id string, stars double, date string, text string"
    ),
    "tip": _feed("text string, date string, compliment_count string, business_id string, user_id string"),
    "user": _feed(
        "user_id string, name string, review_count string, friends string, elite string"
    ),
}

# Columns without which a record can't be stored.
REQUIRED: dict[str, tuple[str, ...]] = {
    "business": ("business_id",),
    "checkin": ("business_id",),
    "review": ("review_id", "user_id", "business_id"),
    "tip": ("user_id", "business_id"),
    "user": ("user_id",),
}

# Which tables each feed produces.
FEED_TABLES: dict[str, tuple[str, ...]] = {
    "business": ("business", "business_category"),
    "checkin": ("checkin",),
    "review": ("review", "review_text"),
    "tip": ("tip", "tip_text"),
    "user": ("user", "user_elite", "user_friend"),
}


@dataclass(frozen=True)
class TableSpec:
    """A table's columns plus the constraints that Spark does not enforce."""

    schema: T.StructType
    key: str | None = None
    distribute_by: str | None = None
    parents: dict[str, str] = field(default_factory=dict)  # column -> parent table with the same key
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


TABLES: dict[str, TableSpec] = {
    "business": TableSpec(
        _columns(
            "business_id string not null, address string, city string, latitude double, longitude double, "
            "name string, postal_code string, state string"
        ),
        key="business_id",
        max_length={
            "business_id": 32, "address": 256, "city": 256, "name": 256, "postal_code": 256, "state": 32,
        },
    ),
    "business_category": TableSpec(
        _columns("business_id string not null, category string"),
        distribute_by="business_id",
        parents={"business_id": "business"},
        max_length={"business_id": 32, "category": 128},
    ),
    "review": TableSpec(
        _columns(
            "review_id string not null, user_id string not null, business_id string not null, stars double, "
            "date timestamp, text string, sentiment string"
        ),
        key="review_id",
        parents={"user_id": "user", "business_id": "business"},
        max_length={"review_id": 32, "user_id": 32, "business_id": 32, "sentiment": 8},
    ),
    "review_text": TableSpec(
        _columns("review_id string not null, word string"),
        distribute_by="review_id",
        parents={"review_id": "review"},
        max_length={"review_id": 32},
    ),
    "tip": TableSpec(
        _columns(
            "tip_id string not null, user_id string not null, date timestamp, business_id string not null, "
            "text string, sentiment string"
        ),
        key="tip_id",
        parents={"user_id": "user", "business_id": "business"},
        max_length={"tip_id": 36, "user_id": 32, "business_id": 32, "sentiment": 8},
    ),
    "tip_text": TableSpec(
        _columns("tip_id string not null, word string"),
        distribute_by="tip_id",
        parents={"tip_id": "tip"},
        max_length={"tip_id": 36},
    ),
    "checkin": TableSpec(
        _columns("business_id string not null, date timestamp"),
        distribute_by="business_id",
        parents={"business_id": "business"},
        max_length={"business_id": 32},
    ),
    "user": TableSpec(
        _columns("user_id string not null, name string"),
        key="user_id",
        max_length={"user_id": 32, "name": 256},
    ),
    "user_elite": TableSpec(
        _columns("user_id string not null, year int not null"),
        distribute_by="user_id",
        parents={"user_id": "user"},
        max_length={"user_id": 32},
    ),
    "user_friend": TableSpec(
        _columns("user_id string not null, friend_id string not null"),
        distribute_by="user_id",
        parents={"user_id": "user"},
        max_length={"user_id": 32, "friend_id": 32},
    ),
    "script_log": TableSpec(
        # A smallint counter would end after 32,767 files.
        _columns("script_name string not null, processed_file bigint"),
        distribute_by="script_name",
        max_length={"script_name": 32},
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` to the declared columns and types of ``table``."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].schema.fields])


def create_tables(spark: SparkSession, names: list[str] | None = None, root: str | None = None) -> None:
    """Create (or replace) empty catalog tables with the declared columns."""
    for name in names or list(TABLES):
        writer = spark.createDataFrame([], TABLES[name].schema).write.mode("overwrite")
        if root:
            writer = writer.option("path", f"{root}/{name}")
        writer.saveAsTable(name)
