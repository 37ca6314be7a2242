import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dumpwinnow.operators import quality
from dumpwinnow.operators.compare import changed_keys

SCHEMA = "k int, l string, v double, t array<int>"


def changes_by_hand(before, after):
    one, two = Counter(map(repr, before)), Counter(map(repr, after))
    key_of = {repr(r): (r[0], r[1]) for r in before + after}
    groups = {}
    for side, rows in ((0, one), (1, two)):
        for row, n in rows.items():
            groups.setdefault(key_of[row], ({}, {}))[side][row] = n
    for (k, l), (a, b) in groups.items():
        if a != b:
            what = "added" if not a else "removed" if not b else "changed"
            yield k, l, what, sum(a.values()), sum(b.values())


@pytest.mark.parametrize("levels", [(256, 65_536), (2, 4, 64), ()])
@pytest.mark.parametrize("changes", [0, 3, 200])
def test_changed_keys_equal_brute_force(spark, levels, changes):
    draw = random.Random(changes)
    row = lambda: (draw.choice([None, *range(60)]), draw.choice([None, "x", "y"]), draw.choice([None, 0.5, 1.0]), [1])
    before = [row() for _ in range(300)]
    after = list(before)
    for _ in range(changes):
        place = draw.randrange(len(after))
        after[place : place + 1] = draw.choice([[], [row()], [after[place]] * 2])
    draw.shuffle(after)
    one, two = (spark.createDataFrame(rows, SCHEMA) for rows in (before, after))
    found = changed_keys(one, two.select("t", "v", "l", "k"), ["k", "l"], levels)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, changes_by_hand(before, after)))


def test_a_swap_and_repeats_are_seen(spark):
    """Changes that keep counts, sums and exclusive ors of whole columns."""
    one = spark.createDataFrame([(1, "a", 1.0, [1]), (2, "a", 2.0, [1]), (3, "a", 1.0, [1])], SCHEMA)
    two = spark.createDataFrame([(1, "a", 2.0, [1]), (2, "a", 1.0, [1]), (3, "a", 1.0, [1])] + [(3, "a", 1.0, [1])] * 2, SCHEMA)
    found = changed_keys(one, two, ["k", "l"]).collect()
    assert sorted((r["k"], r["change"], r["rows_before"], r["rows_after"]) for r in found) == [
        (1, "changed", 1, 1), (2, "changed", 1, 1), (3, "changed", 1, 3),
    ]
    empty = one.limit(0)
    assert changed_keys(one, one.orderBy(F.desc("k")), ["k"]).collect() == []
    assert changed_keys(empty, empty, ["k"]).columns == ["k", "change", "rows_before", "rows_after"]
    assert {r["change"] for r in changed_keys(empty, one, ["k"]).collect()} == {"added"}
    with pytest.raises(ValueError, match="columns differ"):
        changed_keys(one, two.drop("t"), ["k"])
    with pytest.raises(ValueError, match="divide"):
        changed_keys(one, two, ["k"], (3, 4))


def test_merged_profiles_are_those_of_all_rows(spark):
    """Sketches of uneven parts, one empty and one without values, against the whole table."""
    table = spark.range(30_000).select(
        (F.col("id") * 7 % 10_007 - 500).alias("n"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 300)).alias("s"),
        (F.col("id") % 97 / 10).cast("decimal(9,2)").alias("d"),
        F.lit(None).cast("int").alias("z"),
        (F.col("id") % 2 == 0).alias("b"),
    )
    parts = [table.filter("n < 0"), table.filter("n between 0 and 8000"), table.filter("n > 8000"), table.limit(0)]
    merged = quality.profile_sketches(parts[0], "t")
    for part in parts[1:]:
        merged = merged.unionAll(quality.profile_sketches(part, "t"))
    found = {r["column"]: r for r in quality.read_profile(quality.merge_profiles(merged), (0.1, 0.5, 0.9)).collect()}
    full = {r["column"]: r for r in quality.profile(table, "t", exact_distinct=True).collect()}
    for column, want in full.items():
        got = found[column]
        assert (got["rows"], got["nulls"]) == (want["rows"], want["nulls"])
        assert (got["low"], got["high"]) == (want["min"], want["max"])
        assert abs(got["distinct"] - want["distinct"]) <= 0.05 * want["distinct"]
    assert found["z"]["quantiles"] is None and found["s"]["quantiles"] is None
    for rank, value in zip((0.1, 0.5, 0.9), found["n"]["quantiles"], strict=True):
        share = table.filter(F.col("n") <= value).count() / 30_000
        assert abs(share - rank) <= 0.02
    assert found["n"]["low"] == "-500"
