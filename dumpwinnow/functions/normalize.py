"""Unicode-insensitive name keys as one native Spark expression.

``normalize_name`` is: compatibility decomposition (NFKD), drop combining marks, lower
case, strip white space.  Spark has no Unicode normalization function, so the expression
is put together from built-ins whose literals are generated from ``unicodedata``:

* pure ASCII text needs lower + trim only;
* a character that decomposes to one character, or to nothing, goes through ``translate``;
* a character that decomposes to several (ligatures, fractions, Hangul syllables, ...) is
  rare: the distinct ones present in the value are replaced one by one first.

Everything runs in the JVM on the whole value; no Python worker is started.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A code point that is never assigned to a character; real text may hold it all the same,
# which only sends that value down the slower, equally exact branch.
MARKER = "\ufdd0"
SEPARATOR = "\x1f"

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
HANGUL_CLASS = "[\uac00-\ud7a3]"
LEAD_JAMO = "".join(chr(0x1100 + i) for i in range(19))
VOWEL_JAMO = "".join(chr(0x1161 + i) for i in range(21))
TAIL_JAMO = "".join(chr(0x11A8 + i) for i in range(27))


class FoldingTables(NamedTuple):
    """Literals that drive the expression.

    ``translate(source, target)`` folds single characters, turns every expanding one into
    ``MARKER`` and deletes what has no partner.
    """

    source: str
    target: str
    expanding: str
    expansions: tuple[str, ...]


def strip_marks(text: str) -> str:
    """NFKD without characters of a non-zero combining class."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def folding_tables() -> FoldingTables:
    single: dict[str, str] = {}
    deleted: list[str] = []
    several: dict[str, str] = {}
    for code in range(128, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or HANGUL_FIRST <= code <= HANGUL_LAST:
            continue
        char = chr(code)
        if not unicodedata.decomposition(char) and not unicodedata.combining(char):
            continue
        folded = strip_marks(char)
        if folded == char:
            continue
        if len(folded) == 1:
            single[char] = folded
        elif folded:
            several[char] = folded
        else:
            deleted.append(char)
    return FoldingTables(
        source="".join(single) + "".join(several) + "".join(deleted),
        target="".join(single.values()) + MARKER * len(several),
        expanding="".join(several),
        expansions=tuple(several.values()),
    )


def _hangul(char: Column) -> Column:
    index = F.ascii(char) - F.lit(HANGUL_FIRST)
    tail = F.pmod(index, F.lit(28))

    def pick(jamo: str, position: Column) -> Column:
        return F.substring(F.lit(jamo), position.cast("int"), F.lit(1))

    return F.concat(
        pick(LEAD_JAMO, F.floor(index / 588) + 1),
        pick(VOWEL_JAMO, F.floor(F.pmod(index, F.lit(588)) / 28) + 1),
        F.when(tail > 0, pick(TAIL_JAMO, tail)).otherwise(F.lit("")),
    )


def _expand(text: Column) -> Column:
    """Replace each distinct multi-character compatibility form that occurs in ``text``."""
    tables = folding_tables()
    values = F.split(F.lit(SEPARATOR.join(tables.expansions)), SEPARATOR)

    def replacement(char: Column) -> Column:
        return F.when(
            F.ascii(char).between(HANGUL_FIRST, HANGUL_LAST), _hangul(char)
        ).otherwise(F.element_at(values, F.instr(F.lit(tables.expanding), char)))

    pattern = f"[{tables.expanding}{HANGUL_CLASS}]"
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.aggregate(found, text, lambda done, char: F.replace(done, char, replacement(char)))


def is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def _fold(text: Column) -> Column:
    """Fold non-ASCII text; the one-element array binds the translated form once."""
    tables = folding_tables()

    def finish(folded: Column) -> Column:
        expands = F.contains(folded, F.lit(MARKER)) | folded.rlike(HANGUL_CLASS)
        return F.when(
            expands, F.translate(_expand(text), tables.source, tables.target)
        ).otherwise(folded)

    once = F.array(F.translate(text, tables.source, tables.target))
    return F.get(F.transform(once, finish), F.lit(0))


def normalize_name(name: Column | str) -> Column:
    """Normalized form of a name; NULL stays NULL."""
    text = F.col(name) if isinstance(name, str) else name
    folded = F.when(is_ascii(text), text).otherwise(_fold(text))
    return F.btrim(F.lower(folded), F.lit(WHITE_SPACE))
