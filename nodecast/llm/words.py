"""Words of texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# every ASCII character but letters and digits ends a word
ENDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are.  ``lower`` is the
    faster way where a text is plain ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), ENDS), "")


def n_words(text: Column) -> Column:
    """How many words ``words`` would give, without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(ANY_CASE_WORD)).cast("long")


def gram(size: int, start: str = "pos", array: str = "words") -> Column:
    """The hash of ``size`` consecutive words."""
    return F.expr("xxhash64(" + ", ".join(f"get({array}, {start} + {i})" for i in range(size)) + ")")
