"""Row expansion: delimited lists into child rows, copies into numbered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.functions.columns import hash_id, split_list


def explode_list(df: DataFrame, key: str, column: str, into: str, drop_empty: bool = True) -> DataFrame:
    """One row per element of a list column; a null list gives no row."""
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    items = F.col(column) if is_array else split_list(column)
    out = df.filter(F.col(column).isNotNull()).select(key, F.explode(items).alias(into))
    return out.filter(F.length(into) > 0) if drop_empty else out


def with_stable_id(df: DataFrame, id_column: str, salt: str = "", block: int = 10_000) -> DataFrame:
    """Give every row a repeatable id: a hash of its columns and of its number among equal rows.

    Equal rows are interchangeable, so they are first folded to (row, copies), which combines
    before the shuffle, then unfolded to numbered rows. Groups above ``block`` copies are unfolded
    in blocks that a second shuffle spreads over tasks; only those groups pay for it.
    """
    columns = df.columns
    folded = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    small = folded.filter(F.col("_copies") <= block).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_no")
    )
    blocks = folded.filter(F.col("_copies") > block).select(
        *columns,
        "_copies",
        F.explode(F.expr(f"sequence(0L, (_copies - 1) div {block})")).alias("_block"),
    )
    spread = blocks.repartition(F.hash(*columns), "_block")
    large = spread.select(
        *columns,
        F.explode(
            F.expr(f"sequence(_block * {block} + 1, least((_block + 1) * {block}, _copies))")
        ).alias("_no"),
    )
    numbered = small.unionByName(large)
    parts = [F.lit(salt)] if salt else []
    parts += [F.col(c) for c in columns] + [F.col("_no")]
    return numbered.select(hash_id(*parts).alias(id_column), *columns)
