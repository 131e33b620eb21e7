"""Token and word rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: word characters (any script), dollar amounts, or any other run of non-blanks.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|\$[\d\.]+|\S+"

# The usual English stop-word list with its contraction stubs.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those
am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then once
here there when where why how all any both each few more most other some such
no nor not only own same so than too very s t can will just don don't should should've now
d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
wasn wasn't weren weren't won won't wouldn wouldn't
""".split()


def tokens(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def is_valid_word(word: Column | str) -> Column:
    """More than one character, not an apostrophe plus one letter, not all digits."""
    word = F.col(word) if isinstance(word, str) else word
    return (F.length(word) > 1) & ~word.rlike(r"^'[a-z|0-9]$") & ~word.rlike(r"^\p{Nd}+$")


def is_stop_word(word: Column | str) -> Column:
    word = F.col(word) if isinstance(word, str) else word
    return word.isin(STOP_WORDS)
