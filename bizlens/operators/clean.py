"""Row filters of the raw feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions.columns import has_text


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def open_businesses(business: DataFrame) -> DataFrame:
    return with_keys(business, "business_id").filter(F.col("is_open") == 1)


def with_text(df: DataFrame) -> DataFrame:
    return df.filter(has_text("text"))


def elite_users(user: DataFrame) -> DataFrame:
    return with_keys(user, "user_id").filter(has_text("elite"))


def elite_users_with_friends(user: DataFrame) -> DataFrame:
    return elite_users(user).filter(has_text("friends"))
