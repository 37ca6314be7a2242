"""Trigram sets of text, the way trigram indexes on text columns define them.

Text is lower-cased and split into words of letters and digits; every word is padded with
two leading blanks and one trailing blank and cut into runs of three characters; a value's
trigrams are the distinct runs of all its words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words, the padding and the default similarity threshold.
WORD_BREAK = r"[^\p{L}\p{N}]+"
LEADING, TRAILING = "  ", " "
DEFAULT_THRESHOLD = 0.3


def _grams(text: Column, make) -> Column:
    words = F.filter(F.split(F.lower(text), WORD_BREAK), lambda word: word != "")

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit(LEADING), word, F.lit(TRAILING))
        starts = F.sequence(F.lit(1), F.length(word) + 1)
        return F.transform(starts, lambda i: make(F.substring(padded, i, F.lit(3))))

    return F.array_distinct(F.flatten(F.transform(words, of_word)))


def trigrams(text: Column | str) -> Column:
    """Distinct trigrams as strings."""
    return _grams(_column(text), lambda gram: gram)


def trigram_codes(text: Column | str) -> Column:
    """Distinct trigrams as longs: three code points of 21 bits each, so no two collide."""

    def code(gram: Column) -> Column:
        def point(position: int) -> Column:
            return F.ascii(F.substring(gram, position, 1)).cast("long")

        return point(1) * (1 << 42) + point(2) * (1 << 21) + point(3)

    return _grams(_column(text), code)


def similarity(left: Column, right: Column) -> Column:
    """Shared over all trigrams of two trigram arrays; NULL when both are empty."""
    shared = F.size(F.array_intersect(left, right))
    return F.try_divide(shared.cast("double"), F.size(left) + F.size(right) - shared)


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text
