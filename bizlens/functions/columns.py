"""Column helpers: timestamps, delimited lists, labels and ids. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value: the feeds' timestamp layout


def parse_ts(col: Column | str, formats: Sequence[str] = (TIMESTAMP_FORMAT,)) -> Column:
    """Timestamp by the first format that fits, null when none does."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(fmt)) for fmt in formats])


def split_list(col: Column | str) -> Column:
    """``"a, b"`` or ``'["a", "b"]'`` as an array of trimmed strings."""
    col = F.col(col) if isinstance(col, str) else col
    by_comma = F.split(col, r",\s*")
    pieces = F.when(
        F.ltrim(col).startswith("["), F.coalesce(F.from_json(col, "array<string>"), by_comma)
    ).otherwise(by_comma)
    return F.transform(pieces, lambda piece: F.trim(piece))


def year_number(col: Column | str) -> Column:
    """Year as int, null when the text is not a number."""
    col = F.col(col) if isinstance(col, str) else col
    return col.try_cast("int")


def month_label(year: Column | str, month: Column | str) -> Column:
    """``2018/1``: no padding."""
    as_text = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in (year, month)]
    return F.concat_ws("/", *as_text)


def file_label(number: Column | str) -> Column:
    """``x07``, ``x42``, ``x123``: padded to two digits, never cut."""
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.lit("x"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))


def hash_id(*parts: Column) -> Column:
    """A 36-character id from the parts. A null part and an empty part give different ids."""
    marked = [F.coalesce(F.concat(F.lit("v"), p.cast("string")), F.lit("n")) for p in parts]
    digest = F.sha2(F.concat_ws("\u0001", *marked), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def has_text(col: Column | str = "text") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.isNotNull() & (F.length(col) > 0)
