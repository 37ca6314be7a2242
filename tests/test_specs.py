from dumpwinnow.plans.rules import CATALOG_RULES
from dumpwinnow.operators.subset import ROOT, KeepRule, KeysOf, check_rules, rules_for
from dumpwinnow.sources.specs import ALL_TABLES, DECLARED_TABLES, LOADED_TABLES, sources, spec_for

import pytest


def test_registry_counts_and_unique_names():
    assert (len(LOADED_TABLES), len(DECLARED_TABLES), len(ALL_TABLES)) == (14, 6, 20)
    assert len({s.table for s in ALL_TABLES}) == 20
    assert len({s.dump_file for s in ALL_TABLES}) == 20
    for spec in LOADED_TABLES:
        assert len(spec.positions) == len(spec.columns)


def test_positions_that_reorder():
    assert spec_for("artist").positions == (0, 2, 3, 10, 11, 12, 17, 13)
    assert spec_for("mb_artist_alias").positions == (0, 1, 2, 7, 3, 6, 14)
    assert spec_for("track").positions == (0, 2, 3, 4, 6, 7, 8)
    assert spec_for("artist").column_names[-2:] == ("begin_area", "comment")


def test_source_groups():
    core, derived = set(sources("core")), set(sources("derived"))
    assert (len(core), derived) == (12, {"artist_tag", "tag"})
    assert not core & derived
    assert core | derived == set(sources())


def test_parents_come_before_children():
    place = {s.table: i for i, s in enumerate(LOADED_TABLES)}
    for spec in LOADED_TABLES:
        for _, parent, _ in spec.foreign_keys:
            assert place[parent] < place[spec.table]


def test_constraints():
    assert sum(len(s.foreign_keys) for s in LOADED_TABLES) == 15
    assert sum(c.cascade for s in LOADED_TABLES for c in s.columns) == 4
    assert spec_for("artist_tag").primary_key == ("artist", "tag")
    assert spec_for("artist_credit_name").primary_key == ()


def test_rules_cover_all_tables_in_order():
    check_rules(CATALOG_RULES)
    assert {r.table for r in CATALOG_RULES} == {s.table for s in LOADED_TABLES}
    needed = [r.table for r in rules_for(CATALOG_RULES, ["mb_medium"])]
    assert needed == [
        "mb_artist_credit_name", "mb_artist_credit", "mb_recording", "mb_track", "mb_medium",
    ]


def test_rules_out_of_order_are_refused():
    late = KeepRule("a", "x", (KeysOf("b", "y"),))
    with pytest.raises(ValueError, match="needs"):
        check_rules([late, KeepRule("b", "y", (KeysOf(ROOT),))])
