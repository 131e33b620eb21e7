"""Chat formatting with Spark expressions: conversations as marked-up text with a loss mask, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template: each block of turns of one role begins with a header and ends with the close mark; turns of a
#: block are parted by the turn mark. All of them hold # or <, which the escape takes out of roles and texts.
HEADER, COLON, TURN, CLOSE = "### ", ": ", "<turn>", "</turn>\n"
#: Escapes, the backslash first; a colon is escaped in roles only.
ESCAPES = (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"))
COLON_ESCAPE = (":", "\\c")


def escape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, escaped in (*ESCAPES, *more):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    """The inverse: pairs of backslashes are found from the left, and the rest is undone between them."""
    def between(part: Column) -> Column:
        for plain, escaped in (*ESCAPES[1:], COLON_ESCAPE):
            part = F.replace(part, F.lit(escaped), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), between), "\\")


def formatted(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    r"""One text for each conversation of ``conversations(conv_id, turn, role, text)``: ``conv_id, formatted, loss_spans``.

    Turns are sorted by turn (nulls first; ties by role, then text), adjacent turns of one role are merged into one
    block, and blocks are concatenated: ``### role: text<turn>text</turn>\n``. In texts ``\``, ``#`` and ``<`` are written
    ``\\``, ``\h`` and ``\l`` (in roles also ``:`` as ``\c``), so no text can hold a mark. ``loss_spans`` are (start from 0,
    length) in code points of the texts of role ``trained`` as they stand in the format, marks left out.

    A null text or role is empty. Repeated rows are separate turns. A null conv_id is a conversation of its own. Other columns are
    ignored; an empty table gives no rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    grouped = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    grouped = grouped.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where a block begins: at the first turn, and where the role is not that of the turn before.
    last = F.size("turns") - 1
    begins = F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])
    )
    grouped = grouped.withColumn("begins", begins)
    block = F.transform(
        "begins",
        lambda i, b: F.struct(
            F.get("turns", i)["role"].alias("role"),
            F.transform(
                F.slice("turns", i + 1, F.coalesce(F.get("begins", b + 1), F.size("turns")) - i), lambda t: escape(t["text"])
            ).alias("texts"),
        ),
    )
    grouped = grouped.select("conv_id", block.alias("blocks"))
    # Each block as text, and the place of each of its texts in the block.
    head = lambda b: F.concat(F.lit(HEADER), escape(b["role"], COLON_ESCAPE), F.lit(COLON))
    piece = F.transform(
        "blocks",
        lambda b: F.struct(
            b["role"].alias("role"), F.concat(head(b), F.array_join(b["texts"], TURN), F.lit(CLOSE)).alias("text"),
            F.length(head(b)).alias("head"), F.transform(b["texts"], lambda t: F.length(t)).alias("sizes"),
        ),
    )
    grouped = grouped.select("conv_id", piece.alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def of_block(acc: Column, b: Column) -> Column:
        inner = F.aggregate(
            b["sizes"],
            F.struct((acc["at"] + b["head"]).alias("at"), acc["spans"].alias("spans")),
            lambda a, n: F.struct(
                (a["at"] + n + len(TURN)).alias("at"),
                F.array_append(a["spans"], F.struct(a["at"].alias("start"), n.alias("length"))).alias("spans"),
            ),
        )
        return F.struct(
            (acc["at"] + F.length(b["text"])).alias("at"),
            F.when(b["role"] == trained, inner["spans"]).otherwise(acc["spans"]).alias("spans"),
        )

    return grouped.select(
        "conv_id", F.array_join(F.transform("pieces", lambda b: b["text"]), "").alias("formatted"),
        F.aggregate("pieces", start, of_block)["spans"].alias("loss_spans"),
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    blocks = F.filter(F.split(text, CLOSE, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        colon = F.instr(block, COLON)
        role = unescape(F.substring(block, F.lit(len(HEADER) + 1), colon - 1 - len(HEADER)))
        body = F.substring(block, colon + len(COLON), F.length(block))
        return F.transform(F.split(body, TURN, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def trained_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(text, s["start"] + 1, s["length"]))), "")


def digests(texts: DataFrame) -> DataFrame:
    """What reading formatted texts back gives: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    back = texts.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
