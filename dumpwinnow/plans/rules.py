"""Which rows of the catalog the matched artists need."""

from __future__ import annotations

from dumpwinnow.operators.subset import ROOT, KeepRule, KeysOf
from dumpwinnow.sources.specs import TABLE_PREFIX


def _rule(table: str, column: str | None = None, *wanted: KeysOf) -> KeepRule:
    return KeepRule(TABLE_PREFIX + table, column, wanted)


def _kept(table: str, column: str = "id") -> KeysOf:
    return KeysOf(TABLE_PREFIX + table, column)


# Order matters: a rule reads what earlier rules kept.  Countries stay whether or not an
# artist lives in one, so their areas are taken from the table as loaded.
CATALOG_RULES: tuple[KeepRule, ...] = (
    _rule("artist", "id", KeysOf(ROOT)),
    _rule("artist_alias", "artist", KeysOf(ROOT)),
    _rule("artist_tag", "artist", KeysOf(ROOT)),
    _rule("artist_credit_name", "artist", KeysOf(ROOT)),
    _rule("artist_credit", "id", _kept("artist_credit_name", "artist_credit")),
    _rule("release_group", "artist_credit", _kept("artist_credit")),
    _rule("recording", "artist_credit", _kept("artist_credit")),
    _rule("track", "recording", _kept("recording")),
    _rule("medium", "id", _kept("track", "medium")),
    _rule("tag", "id", _kept("artist_tag", "tag")),
    _rule(
        "area",
        "id",
        _kept("artist", "area"),
        _kept("artist", "begin_area"),
        KeysOf(TABLE_PREFIX + "country_area", "area", kept=False),
    ),
    _rule("country_area", "area", _kept("area")),
    _rule("area_type"),
    _rule("gender"),
)
