import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dumpwinnow.functions.normalize import WHITE_SPACE, normalize_name, strip_marks
from dumpwinnow.functions.trigrams import similarity, trigram_codes, trigrams
from dumpwinnow.operators.matching import (
    library_keys,
    match_entities,
    match_statistics,
)


def folded(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    keys = rows.select("i", normalize_name("t").alias("k")).collect()
    return [r["k"] for r in sorted(keys, key=lambda r: r["i"])]


def expected(text):
    return strip_marks(text).lower().strip(WHITE_SPACE)


def test_known_names(spark):
    cases = {
        "Ostrevane": "ostrevane",
        "Melodrift": "melodrift",
        "Nora Feldt": "nora feldt",
        "Lönna": "lonna",
        "Vetur Nós": "vetur nos",
        "Hélène Varda Quist": "helene varda quist",
        "カモメ・バンド": "カモメ・ハント",
        "  Spaced Out  ": "spaced out",
        "UPPER CASE": "upper case",
        "café": "cafe",
        "naïve": "naive",
    }
    assert folded(spark, cases) == list(cases.values())


def test_expanding_characters(spark):
    texts = ["ﬁn", "½ Ⅳ …", "한국어", "ガ", "ﷺ", "ß Ø", "　 x\xa0", "﷐é", "İΣΑΣ", None]
    assert folded(spark, texts) == [expected(t) if t is not None else None for t in texts]


def test_every_code_point_of_the_lower_planes(spark):
    texts = [
        f"a{chr(c)}B"
        for c in range(1, 0x20000)
        if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"
    ]
    rows = spark.createDataFrame([(t, expected(t)) for t in texts], "t string, e string")
    assert rows.filter(~normalize_name("t").eqNullSafe(F.col("e"))).take(5) == []


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"])), max_size=40))
def test_any_text(spark, texts):
    assert folded(spark, texts) == [expected(t) for t in texts] if texts else True


def artists_and_aliases(spark):
    artists = spark.createDataFrame(
        [(1, "Lönna"), (2, "Other"), (3, " 　"), (4, "x"), (5, None)], "id int, name string"
    )
    aliases = spark.createDataFrame(
        [(4, "LONNA "), (1, "lonna"), (2, "another"), (9, "Lönna")], "artist int, name string"
    )
    return artists, aliases


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "artist string")


def test_library_edge_rules(spark):
    library = names(spark, "", "   ", "Lönna", "LÖNNA", "lonna ")
    assert sorted(r["key"] for r in library_keys(library).collect()) == ["", "lonna"]
    assert [r["key"] for r in library_keys(library, drop_blank=True).collect()] == ["lonna"]
    with_null = names(spark, "a", None)
    with pytest.raises(Exception, match="NULL"):
        library_keys(with_null).collect()
    assert [r["key"] for r in library_keys(with_null, mode="tolerant").collect()] == ["a"]


@pytest.mark.parametrize("key_rows", [None, 2, 10**9])
def test_match_by_name_and_alias(spark, key_rows):
    artists, aliases = artists_and_aliases(spark)
    keys = library_keys(names(spark, "lönna", "  "))
    matched = match_entities(artists, aliases, keys, key_rows)
    assert sorted(tuple(r) for r in matched.collect()) == [
        (1, True, True),
        (3, True, False),
        (4, False, True),
        (9, False, True),
    ]
    assert tuple(match_statistics(matched).first()) == (2, 2, 4)


def grams_of(text):
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = ""
    return {f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)}


def test_trigrams(spark):
    texts = ["word", "Two words", "", "!?", "aaa", "é日本", "a-b a", "x1_y"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select(
        "t", trigrams("t").alias("g"), F.size(trigram_codes("t")).alias("n")
    ).collect():
        assert set(r["g"]) == grams_of(r["t"])
        assert len(r["g"]) == r["n"] == len(grams_of(r["t"]))
    pair = spark.range(1).select(similarity(trigrams(F.lit("word")), trigrams(F.lit("two words"))))
    assert pair.first()[0] == pytest.approx(4 / 11)
