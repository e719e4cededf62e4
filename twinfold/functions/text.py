"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a whole field is
# tested for emptiness or cut into words.
WHITE_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

KEY_CHARS = 64


def filled(c: str | Column) -> Column:
    """Present and not only spaces."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (F.trim(c) != "")


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def folded(c: str) -> Column:
    """The form in which texts count as equal: no case, no outer spaces, never NULL."""
    return F.lower(F.trim(text_or_empty(c)))


def same_text_flag(a: str, b: str) -> Column:
    """1 when both sides agree up to case and outer spaces; two missing values agree."""
    return (folded(a) == folded(b)).cast("int")


def char_count(c: str) -> Column:
    return F.length(text_or_empty(c)).cast("long")


def is_blank(c: str) -> Column:
    """NULL or nothing but white space of any kind."""
    return F.regexp_replace(text_or_empty(c), WHITE_SPACE, "") == ""


def record_tokens(c: str) -> Column:
    """The different space-separated pieces of a text."""
    return F.array_distinct(F.split(F.col(c), " "))


def words(c: Column) -> Column:
    """The white-space-separated words of a text, empty pieces dropped."""
    return F.filter(F.split(c, WHITE_SPACE + "+"), lambda w: w != "")


def char_grams(c: str, n: int) -> Column:
    """All runs of ``n`` characters, in one pass over the text.

    The look-ahead leaves the cursor in place, so runs overlap.  A run may not
    start on the second half of a surrogate pair.
    """
    run = r"(?s)(?=([^\x{DC00}-\x{DFFF}].{%d}))" % (n - 1)
    return F.regexp_extract_all(F.col(c), F.lit(run), 1)


def text_digest(c: str) -> Column:
    """16 bytes of the SHA-256 of a text, NULL for blanks: for comparing texts that are not moved."""
    return F.when(filled(c), F.unhex(F.substring(F.sha2(F.col(c), 256), 1, 32)))


def short_key(c: str | Column) -> Column:
    """An equality key of bounded size.

    Texts of up to 64 characters stand for themselves; longer ones are replaced
    by their SHA-256, marked so that it equals no short text.  Shuffles and
    broadcasts then carry at most 65 characters per key, however long the texts.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) <= KEY_CHARS, c).otherwise(F.concat(F.lit("#"), F.sha2(c, 256)))
