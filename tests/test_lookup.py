import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dumpwinnow.operators import lookup
from dumpwinnow.operators.fuzzy import (
    POSTING,
    NameIndex,
    Postings,
    candidate_pairs,
    distinct_names,
    fuzzy_lookup,
    index_names,
    similar_names,
)
from dumpwinnow.operators.keyjoin import frequent_keys, spread_join
from dumpwinnow.plans.build import read_name_index, write_name_index
from dumpwinnow.sources.snapshots import Snapshot
from tests.fixture_rows import FIRST
from tests.test_names import grams_of
from tests.test_subset import frames


def asked(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "request string")


def test_name_and_alias_lookup(spark):
    tables = frames(spark, FIRST)
    requests = asked(spark, "LÖNNA", "lonna", "LÖNNA", "nobody", None)
    rows = lookup.lookup_name_or_alias(requests, tables["mb_artist"], tables["mb_artist_alias"])
    assert {tuple(r) for r in rows.collect()} == {
        ("LÖNNA", 600, "Lönna", "name"),
        ("lonna", 600, "Lonna", "alias"),
    }
    assert rows.count() == 2


def test_key_lookup_and_tags(spark):
    tables = frames(spark, FIRST)
    gid = tables["mb_recording"].filter("id = 2").first()["gid"]
    found = lookup.lookup_key(asked(spark, gid, gid), "request", tables["mb_recording"], "gid")
    assert [r["name"] for r in found.collect()] == ["Glasswork"]
    tags = lookup.tags_of_artists(tables["mb_artist_tag"], tables["mb_tag"])
    of = {a: sorted(r["name"] for r in tags.filter(f"artist = {a}").collect()) for a in (100, 200)}
    assert of == {100: ["electronic", "experimental"], 200: ["experimental", "rock"]}


def scanned(rows):
    """Rows that the file reader gave in the query's run."""
    return rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_few_keys_read_few_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.md5(F.col("id").cast("string")).alias("gid"), (F.col("id") * 7 % 1000).alias("n")
    )
    table = Snapshot(spark, str(tmp_path)).write_clustered("t", rows, "gid", ["gid", "n"], files=20)
    some = [r["gid"] for r in rows.filter("n = 3").limit(2).collect()]
    found = lookup.lookup_few_keys(asked(spark, *some, None, some[0]), "request", table, "gid")
    assert sorted(r["gid"] for r in found.collect()) == sorted(some)
    assert scanned(found) < 3 * 40_000 / 20 * 1.5
    # values inside every file's range, which only the bloom filters can rule out
    nowhere = lookup.lookup_few_keys(asked(spark, "8" * 31 + "x"), "request", table, "gid")
    assert nowhere.collect() == [] and scanned(nowhere) == 0
    many = [r["gid"] for r in rows.limit(50).collect()]
    assert lookup.lookup_few_keys(asked(spark, *many), "request", table, "gid").count() == 50
    assert lookup.lookup_few_keys(asked(spark, None), "request", table, "gid").count() == 0
    # one key with most rows fills several files
    hot = Snapshot(spark, str(tmp_path)).write_clustered("hot", rows.withColumn("gid", F.lit("a")), "gid", files=8)
    assert hot.count() == 40_000 and largest_share(hot.coalesce(100)) < 0.9


def largest_share(rows):
    """Share of the rows in the fullest partition."""
    held = rows.groupBy(F.spark_partition_id().alias("p")).count()
    return held.agg(F.max("count") / F.sum("count")).first()[0]


@pytest.mark.parametrize("side", ["left", "right", "both"])
def test_one_credit_with_half_the_rows(spark, side):
    """Navigation along a credit that half of the members, recordings or both have."""
    members = [(k, 7 if side != "right" and k % 2 else 1000 + k) for k in range(400)]
    works = [(k, 7 if side != "left" and k % 2 else 1000 + k) for k in range(400)]
    credit_names = spark.createDataFrame(members, "artist int, artist_credit int").repartition(3)
    recordings = spark.createDataFrame(
        [(k, f"g{k}", f"n{k}", c, None if k % 3 else k) for k, c in [*works, (998, 7), (999, None)]],
        "id int, gid string, name string, artist_credit int, length int",
    ).repartition(3)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = lookup.recordings_of_artists(credit_names, recordings)
        got = Counter((r["artist"], r["recording"], r["length"]) for r in found.collect())
        assert largest_share(found) < 0.3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows = [r for r in recordings.collect()]
    want = Counter((a, r["id"], r["length"]) for a, c in members for r in rows if r["artist_credit"] == c)
    assert got == want


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_small_side_is_broadcast_as_it_is(spark):
    left = spark.range(1000).select((F.col("id") % 2).alias("x"))
    right = spark.createDataFrame([(0, "a"), (1, "b")], "y long, v string")
    plan = spread_join(left, right, "x", "y")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_row_salt" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [0, 5])
def test_spread_joins_equal_plain_ones(spark, no_broadcast, how, hot):
    draw = random.Random(hot)
    def keys(n, share):
        return [(None if draw.random() < 0.1 else hot if draw.random() < share else draw.randrange(700), k) for k in range(n)]
    left = spark.createDataFrame(keys(2000, 0.4 if hot else 0), "x int, n int")
    right = spark.createDataFrame(keys(300, 0.2 if hot else 0), "y int, m int")
    for one, two in ((left, right), (left, right.filter("y <> 5")), (left.limit(0), right), (left, right.limit(0))):
        got = spread_join(one, two, "x", "y", how)
        want = one.join(two, one["x"] == two["y"], how)
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="spread"):
        spread_join(left, right, "x", "y", "full")


def test_frequent_keys_are_all_found(spark):
    """A value is frequent above 1/256 of the rows, among very many rare ones."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 100 == 0, F.lit("a")).when(F.col("id") % 100 == 1, F.lit("b"))
        .when(F.col("id") % 1000 == 2, F.lit("c")).otherwise(F.concat(F.lit("x"), "id")).alias("k")
    )
    assert sorted(frequent_keys(rows, "k")) == ["a", "b"]
    assert frequent_keys(rows.limit(0), "k") == []
    numbers = spark.range(5000).select((F.col("id") % 2).cast("int").alias("k"))
    assert sorted(frequent_keys(numbers, "k")) == [0, 1]


def test_navigation(spark):
    t = frames(spark, FIRST)
    recordings = lookup.recordings_of_artists(t["mb_artist_credit_name"], t["mb_recording"])
    assert recordings.filter("artist = 300").first()["name"] == "Home, Again"
    tracks = lookup.tracks_of_recordings(t["mb_track"], t["mb_recording"], t["mb_medium"])
    assert tracks.count() == 5
    areas = lookup.areas_of_artists(t["mb_artist"], t["mb_area"], t["mb_area_type"])
    assert tuple(areas.filter("artist = 100").first()) == (100, 221, "United Kingdom", "Country")
    assert areas.count() == 7


WORDS = ["red", "blue", "bluebird", "the", "a", "ring", "rings", "zürich", "日本", "x", "redo"]


def random_names(n, seed):
    chosen = random.Random(seed)
    return [" ".join(chosen.choices(WORDS, k=chosen.randint(0, 4))) for _ in range(n)]


def brute(requests, names, threshold):
    found = {}
    for r in {x.lower() for x in requests}:
        for n in {x.lower() for x in names}:
            a, b = grams_of(r), grams_of(n)
            if a and b:
                score = len(a & b) / len(a | b)
                if score >= threshold:
                    found[r, n] = round(score, 9)
    return found


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.55, 1.0])
@pytest.mark.parametrize("rows_per_task", [10**6, 3])
def test_fuzzy_pairs_against_all_pairs(spark, threshold, rows_per_task):
    names, requests = random_names(120, 1), random_names(60, 2) + ["RED ring", "!!"]
    catalog = spark.createDataFrame([(n,) for n in names], "name string")
    index = index_names(catalog)
    pairs = similar_names(
        distinct_names(asked(spark, *requests), "request"), index, threshold, rows_per_task
    )
    rows = pairs.collect()
    got = {(r["request_key"], r["name_key"]): round(r["similarity"], 9) for r in rows}
    assert len(got) == len(rows)
    assert got == brute(requests, names, threshold)


def test_the_order_does_not_change_the_pairs(spark):
    names = random_names(80, 3)
    catalog = spark.createDataFrame([(n,) for n in names], "name string")
    index = index_names(catalog)
    requests = distinct_names(catalog, "name")
    results = []
    for frequent in (index.frequent, (), tuple(reversed(index.frequent))[:5]):
        pairs = similar_names(requests, NameIndex(index.names, frequent))
        results.append(sorted((r[0], r[1]) for r in pairs.collect()))
    assert results[0] == results[1] == results[2]
    assert results[0] == sorted(brute(names, names, 0.3))


def test_fuzzy_lookup_returns_every_row(spark):
    catalog = spark.createDataFrame(
        [(i, "Nora Feldt") for i in range(50)] + [(99, "Melodrift"), (98, None)],
        "id int, name string",
    )
    rows = fuzzy_lookup(asked(spark, "nora felt", "NORA FELT"), catalog)
    assert rows.count() == 100
    assert rows.select("id").distinct().count() == 50
    assert rows.filter(F.col("similarity") < 0.3).isEmpty()


def test_stored_postings_are_not_shuffled(spark, tmp_path):
    """815 requests against a written index: its postings meet them bucket by bucket."""
    names, requests = random_names(3000, 5), random_names(815, 6)
    target = Snapshot(spark, str(tmp_path))
    target.write("mb_artist", spark.createDataFrame(list(enumerate(names)), "id int, name string"))
    write_name_index(target)
    spark.sql(f"DROP TABLE {target._bucketed_name('_postings')}")  # as in another session
    index = read_name_index(target)
    asked_names = distinct_names(asked(spark, *requests), "request")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for threshold in (0.3, 0.6):
            pairs = similar_names(asked_names, index, threshold)
            got = {(r[0], r[1]): round(r[2], 9) for r in pairs.collect()}
            assert got == brute(requests, names, threshold)
            plan = pairs._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan
            moved = [x for x in plan.splitlines() if "Exchange" in x and "slot#" in x]
            assert moved and all("r_slot#" in x for x in moved)  # the requests' side alone
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lower = similar_names(asked_names, index, 0.2).collect()  # below what is stored
    assert {(r[0], r[1]): round(r[2], 9) for r in lower} == brute(requests, names, 0.2)


def long_names(n, seed):
    """Names of some 45 trigrams each, all from the same few syllables."""
    chosen = random.Random(seed)
    parts = ["re", "lou", "tion", "ea", "ment", "ois", "qu", "sch", "ver", "er", "nd", "th"]
    word = lambda: "".join(chosen.choices(parts, k=chosen.randint(1, 3)))
    return list({" ".join(word() for _ in range(9)) for _ in range(n)})


def test_few_unlike_pairs_leave_the_join(spark):
    """What is shuffled after the join grows with the result, not with all pairs."""
    names = long_names(400, 7)
    index = index_names(spark.createDataFrame([(n,) for n in names], "name string"))
    wanted = brute(names, names, 0.45)
    passed = candidate_pairs(index.names, index, 0.45)
    assert 400 < len(wanted) <= passed.count() < 2 * len(wanted)
    pairs = similar_names(index.names, index, 0.45).collect()
    assert {(r[0], r[1]): round(r[2], 9) for r in pairs} == wanted


def test_postings_of_an_earlier_version_are_made_again(spark):
    names = random_names(60, 8)
    index = index_names(spark.createDataFrame([(n,) for n in names], "name string"))
    old = spark.createDataFrame([], ", ".join(f"{c} long" for c in POSTING[:8]))
    pairs = similar_names(index.names, NameIndex(index.names, index.frequent, Postings(old)))
    assert {(r[0], r[1]): round(r[2], 9) for r in pairs.collect()} == brute(names, names, 0.3)


def test_threshold_is_checked(spark):
    with pytest.raises(ValueError, match="threshold"):
        similar_names(None, NameIndex(None, ()), 0)
