"""Data-quality checks. Every check returns rows (check, table, column, n, passed)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bizlens.schemas import CORRUPT, TABLES

LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL")  # fixed values


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _report(df: DataFrame, table: str, counts: Mapping[tuple[str, str], Column]) -> DataFrame:
    """All counts, keyed by (check, column), in one pass over ``df``; then one row per count."""
    one_row = df.agg(*[counted.alias(f"c{i}") for i, counted in enumerate(counts.values())])
    rows = []
    for i, (check, column) in enumerate(counts):
        n = F.col(f"c{i}")
        fields = {"check": F.lit(check), "table": F.lit(table), "column": F.lit(column), "n": n}
        fields["passed"] = n > 0 if check == "rows" else n == 0
        rows.append(F.struct(*[value.alias(name) for name, value in fields.items()]))
    return one_row.select(F.inline(F.array(*rows)))


Counts = dict[tuple[str, str], Column]


def _nulls(columns: Iterable[str]) -> Counts:
    return {("nulls", c): F.count_if(F.col(c).isNull()) for c in columns}


def _domain(column: str, allowed: Iterable[str]) -> Counts:
    return {("domain", column): F.count_if(~F.col(column).isin(list(allowed)))}


def _rows() -> Counts:
    return {("rows", "*"): F.count(F.lit(1))}


def _lengths(table: str) -> Counts:
    return {("length", c): F.count_if(F.length(c) > n) for c, n in TABLES[table].max_length.items()}


def null_counts(tables: Mapping[str, DataFrame], pairs: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """Nulls per (table, column); by default every column declared NOT NULL."""
    if pairs is None:
        pairs = [(name, c) for name in tables for c in TABLES[name].not_null]
    by_table: dict[str, list[str]] = {}
    for table, column in pairs:
        by_table.setdefault(table, []).append(column)
    return _stack(_report(tables[t], t, _nulls(columns)) for t, columns in by_table.items())


def domain_counts(
    tables: Mapping[str, DataFrame], column: str = "sentiment", allowed: Iterable[str] = LABELS
) -> DataFrame:
    """Values outside the allowed list; a null is not counted."""
    return _stack(_report(df, t, _domain(column, allowed)) for t, df in tables.items())


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; a table passes when it has any."""
    return _stack(_report(df, t, _rows()) for t, df in tables.items())


def too_long(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values longer than the declared limit."""
    return _stack(_report(df, t, _lengths(t)) for t, df in tables.items() if TABLES[t].max_length)


def _table_counts(name: str, columns: Iterable[str]) -> Counts:
    counts = {**_rows(), **_nulls(TABLES[name].not_null), **_lengths(name)}
    if "sentiment" in columns:
        counts.update(_domain("sentiment", LABELS))
    return counts


def table_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row, null, label and length checks of every table together, with one scan per table."""
    return _stack(_report(df, name, _table_counts(name, df.columns)) for name, df in tables.items())


class WriteCounters:
    """The checks of ``table_report``, counted in the pass that writes a table instead of by another scan."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, list[tuple[str, str]]]] = {}

    def watch(self, df: DataFrame, table: str) -> DataFrame:
        """``df``, counted when it is next written."""
        counts = _table_counts(table, df.columns)
        seen = Observation(f"checks of {table}")
        self._seen[table] = (seen, list(counts))
        return df.observe(seen, *[counted.alias(f"c{i}") for i, counted in enumerate(counts.values())])

    def report(self, spark: SparkSession) -> DataFrame:
        """The rows of ``table_report`` for all tables written so far."""
        rows = []
        for table, (seen, counts) in self._seen.items():
            found = seen.get
            for i, (check, column) in enumerate(counts):
                n = found[f"c{i}"]
                rows.append((check, table, column, n, n > 0 if check == "rows" else n == 0))
        return spark.createDataFrame(rows, "check string, table string, column string, n bigint, passed boolean")


def quarantine_counts(quarantines: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected records of each feed by reason; a feed without any has no row."""
    return _stack(
        df.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("quarantine").alias("check"), F.lit(feed).alias("table"), F.col("reason").alias("column"), "n", F.lit(False).alias("passed")
        )
        for feed, df in quarantines.items()
    )


def missing_text(feeds: Mapping[str, DataFrame]) -> DataFrame:
    missing = F.count_if(F.col("text").isNull() | (F.length("text") == 0))
    return _stack(_report(df, t, {("missing_text", "text"): missing}) for t, df in feeds.items())


def broken_records(feeds: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Records of raw feeds that did not parse, and parsed ones without a key, in one pass each."""
    reports = []
    for name, feed in feeds.items():
        key, parsed = keys[name], F.col(CORRUPT).isNull()
        counts = {
            ("broken", CORRUPT): F.count_if(~parsed),
            ("broken", key): F.count_if(parsed & F.col(key).isNull()),
        }
        reports.append(_report(feed, name, counts))
    return _stack(reports)


def closed_businesses(business_feed: DataFrame) -> DataFrame:
    return _report(business_feed, "business", {("closed", "is_open"): F.count_if(F.col("is_open") == 0)})


def duplicate_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once, per table with a declared key."""
    reports = []
    for name, df in tables.items():
        key = TABLES[name].key
        if key is None:
            continue
        repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        reports.append(_report(repeated, name, {("duplicate_keys", key): F.count(F.lit(1))}))
    return _stack(reports)


def orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows whose parent key is missing.

    Child rows are counted per key before the join, so a hot key is one row there.
    """
    reports = []
    for name, df in tables.items():
        for column, parent in TABLES[name].parents.items():
            if parent not in tables:
                continue
            per_key = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
            parents = tables[parent].select(F.col(TABLES[parent].key).alias(column))
            lost = per_key.join(parents, column, "left_anti")
            total = F.coalesce(F.sum("_n"), F.lit(0).cast("long"))
            reports.append(_report(lost, name, {(f"orphans of {parent}", column): total}))
    return _stack(reports)
