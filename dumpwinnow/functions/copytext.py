"""The COPY text format as native expressions: escape, unescape and typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARKER = "\\N"

# Two-character escapes of the format and what they stand for.
NAMED_ESCAPES = (
    ("\\b", "\b"),
    ("\\f", "\f"),
    ("\\n", "\n"),
    ("\\r", "\r"),
    ("\\t", "\t"),
    ("\\v", "\x0b"),
)

NUMERIC_ESCAPE = r"\\[0-7xX]"
# One escape or one run of plain characters per piece.
PIECES = r"(?s)\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|[^\\]+"
END_MARK = "\\."

# Stand for an escaped backslash and an escaped tab while the other escapes are replaced; lines
# that hold a NUL are refused before.
NUL = "\x00"
HELD_BACKSLASH = NUL + "b"
HELD_TAB = NUL + "t"

# White space round a number, its sign and digits; a cast alone would also trim control
# characters.
WHOLE_NUMBER = r"^[ \t\n\x0B\f\r]*[+-]?[0-9]+[ \t\n\x0B\f\r]*$"

# Accepted spellings of booleans, including every unambiguous prefix.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")

# Groups of four hex digits, optionally hyphenated, optionally in braces.
UUID_SHAPE = r"^(?:[0-9a-f]{4}-?){7}[0-9a-f]{4}$|^\{(?:[0-9a-f]{4}-?){7}[0-9a-f]{4}\}$"


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once for a body that mentions it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _held(raw: Column) -> Column:
    """Named escapes replaced; backslashes and tabs that they spell are still held back."""
    text = F.replace(raw, F.lit("\\\\"), F.lit(HELD_BACKSLASH))
    for escape, char in NAMED_ESCAPES:
        text = F.replace(text, F.lit(escape), F.lit(HELD_TAB if char == "\t" else char))
    return F.replace(text, F.lit("\\"), F.lit(""))


def _released(text: Column) -> Column:
    tabs = F.replace(text, F.lit(HELD_TAB), F.lit("\t"))
    return F.replace(tabs, F.lit(HELD_BACKSLASH), F.lit("\\"))


def _named(raw: Column) -> Column:
    return _released(_held(raw))


def _numeric(raw: Column) -> Column:
    """Octal and hex escapes give bytes, so the pieces are joined as bytes."""

    def piece_bytes(piece: Column) -> Column:
        digits = F.substring(piece, F.lit(2), F.lit(4))
        return (
            F.when(
                piece.rlike(r"^\\x[0-9A-Fa-f]"),
                F.lpad(F.substring(piece, F.lit(3), F.lit(2)), 2, "0"),
            )
            .when(
                piece.rlike(r"^\\[0-7]"),
                F.lpad(F.hex(F.conv(digits, 8, 10).cast("int").bitwiseAND(F.lit(255))), 2, "0"),
            )
            .when(piece.startswith("\\"), F.hex(F.encode(_named(piece), "UTF-8")))
            .otherwise(F.hex(F.encode(piece, "UTF-8")))
        )

    pieces = F.regexp_extract_all(raw, F.lit(PIECES), F.lit(0))
    return F.unhex(F.array_join(F.transform(pieces, piece_bytes), "")).cast("string")


def decode_field(raw: Column) -> Column:
    """Raw field to value: the null marker, named escapes, octal and hex escapes."""

    def unescape(text: Column) -> Column:
        return F.when(text.rlike(NUMERIC_ESCAPE), _numeric(text)).otherwise(_named(text))

    return (
        F.when(raw == NULL_MARKER, F.lit(None).cast("string"))
        .when(F.instr(raw, F.lit("\\")) == 0, raw)
        .otherwise(_bind(raw, unescape))
    )


def decode_checked(raw: Column) -> Column:
    """Struct of the decoded ``text`` and the ``problem`` that keeps it from being loaded.

    Octal and hex escapes can spell bytes that are no text, so what they give is validated
    after decoding; other fields cannot go wrong there.
    """

    def judged(text: Column) -> Column:
        numeric = raw.rlike(NUMERIC_ESCAPE)
        problem = (
            F.when(malformed(raw), F.lit("malformed escape"))
            .when(numeric & ~F.is_valid_utf8(text), F.lit("invalid utf-8"))
            .when(numeric & F.contains(text, F.lit(NUL)), F.lit("zero byte"))
        )
        return F.struct(text.alias("text"), problem.alias("problem"))

    plain = F.struct(raw.alias("text"), F.lit(None).cast("string").alias("problem"))
    return F.when(F.instr(raw, F.lit("\\")) == 0, plain).otherwise(
        _bind(decode_field(raw), judged)
    )


def has_escapes(raw: Column) -> Column:
    """Whether a raw field is anything but plain text or the null marker."""
    return (F.instr(raw, F.lit("\\")) > 0) & (raw != NULL_MARKER)


def escaped_fields(raw: Sequence[Column]) -> Column:
    """Raw fields that hold escapes as one text with a tab between fields; others are empty."""
    return F.concat_ws("\t", *[F.when(has_escapes(r), r).otherwise("") for r in raw])


def decode_together(escaped: Column) -> Column:
    """For :func:`text_of`: the texts of escaped fields, NULL where each has to be judged alone.

    Named escapes are replaced in all fields at once, in compiled code.  Escapes that spell
    bytes, end marks and lone backslashes are left to :func:`decode_checked`.
    """
    without_pairs = F.replace(escaped, F.lit("\\\\"), F.lit(""))
    odd = (
        F.contains(without_pairs, F.lit(END_MARK))
        | F.contains(without_pairs, F.lit("\\\t"))
        | without_pairs.endswith("\\")
        | escaped.rlike(NUMERIC_ESCAPE)
    )
    return F.when(F.instr(escaped, F.lit("\\")) == 0, F.array().cast("array<string>")).when(
        ~odd, F.split(_held(escaped), "\t", -1)
    )


def text_of(raw: Column, together: Column, i: int) -> Column:
    """Value of a line's field ``i`` out of what :func:`decode_together` gives for the line."""
    return F.when(F.instr(raw, F.lit("\\")) == 0, raw).when(
        raw != NULL_MARKER, _released(F.get(together, F.lit(i)))
    )


def encode_field(value: Column) -> Column:
    """Value to raw field; the inverse of :func:`decode_field`."""
    text = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for escape, char in NAMED_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(escape))
    return F.coalesce(text, F.lit(NULL_MARKER))


def encode_line(*fields: Column) -> Column:
    """One dump line out of column values of any type."""
    return F.concat_ws("\t", *[encode_field(f.cast("string")) for f in fields])


def malformed(raw: Column) -> Column:
    """True where the raw field holds an end-of-data mark, or ends in a lone backslash that
    would swallow the delimiter after it."""

    def unpaired(rest: Column) -> Column:
        return F.contains(rest, F.lit(END_MARK)) | rest.endswith("\\")

    without_pairs = F.replace(raw, F.lit("\\\\"), F.lit(""))
    return (F.instr(raw, F.lit("\\")) > 0) & (raw != NULL_MARKER) & _bind(
        without_pairs, unpaired
    )


def try_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
        word.isin(*FALSE_WORDS), F.lit(False)
    )


def try_uuid(text: Column) -> Column:
    """Canonical lower-case hyphenated form, NULL when malformed."""
    canonical = F.regexp_replace(
        F.regexp_replace(F.lower(text), "[{}-]", ""),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )
    return F.when(F.lower(text).rlike(UUID_SHAPE), canonical)


def try_typed(text: Column, type_name: str) -> Column:
    """Value of the target type, NULL when the text is not one."""
    if type_name == "text":
        return text
    if type_name == "boolean":
        return try_boolean(text)
    if type_name == "uuid":
        return try_uuid(text)
    number = text.try_cast(type_name)
    plain = number.cast("string") == text  # nearly always, and cheaper than the pattern
    return F.when(plain | text.rlike(WHOLE_NUMBER), number)
