from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dumpwinnow.functions.copytext import (
    decode_checked,
    decode_field,
    encode_field,
    malformed,
    try_boolean,
    try_typed,
    try_uuid,
)
from dumpwinnow.sources.dump import STRICT, TOLERANT, load_all, load_table, parse_lines, read_lines
from dumpwinnow.sources.listing import latest_stamp, missing_files
from dumpwinnow.sources.specs import Column, TableSpec, spec_for
from tests.fixture_rows import FIRST, FIRST_LOADED, write_dump

PAIR = TableSpec("pair", "pair", (Column("id", "int", 0), Column("text", "text", 1)), ("id",))


def lines_of(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def parsed(spark, *lines, spec=PAIR, mode=STRICT):
    return [tuple(r) for r in parse_lines(lines_of(spark, *lines), spec, mode).rows.collect()]


def write_bytes(path, data):
    path.write_bytes(data)
    return str(path)


def test_reorders_and_keeps_trailing_empties(spark):
    spec = TableSpec("t", "t", (Column("b", "text", 3), Column("a", "int", 0)))
    assert parsed(spark, "7\tx\ty\t", spec=spec) == [("", 7)]


def test_short_rows_are_dropped_in_both_modes(spark):
    for mode in (STRICT, TOLERANT):
        result = parse_lines(lines_of(spark, "1\ta", "3", ""), PAIR, mode)
        assert [tuple(r) for r in result.rows.collect()] == [(1, "a")]
        assert sorted(tuple(r) for r in result.rejects.collect()) == [
            ("", "short row"),
            ("3", "short row"),
        ]


def test_line_endings(spark, tmp_path):
    path = write_bytes(tmp_path / "pair", b"1\ta\r\n2\tx\ry\n3\tlast")
    rows = parse_lines(read_lines(spark, path), PAIR).rows.collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a"), (2, "x\ry"), (3, "last")]


def test_null_empty_and_escaped_null(spark):
    assert parsed(spark, "1\t\\N", "2\t", "3\t\\\\N") == [(1, None), (2, ""), (3, "\\N")]


@pytest.mark.parametrize(
    ("raw", "value"),
    [
        (r"a\tb", "a\tb"),
        (r"\b\f\n\r\v", "\b\f\n\r\x0b"),
        (r"a\\tb", r"a\tb"),
        (r"\\\\", r"\\"),
        (r"\\\t", "\\\t"),
        (r"\q\"", 'q"'),
        (r"\101\x42\x4", "AB\x04"),
        (r"\303\251\xc3\xa9", "éé"),
        (r"\\x41", r"\x41"),
        (r"\xg", "xg"),
        (r"\7\1012", "\x07A2"),
        ("plain é", "plain é"),
    ],
)
def test_escapes(spark, raw, value):
    row = lines_of(spark, raw).select(decode_field(F.col("value"))).first()
    assert row[0] == value


def test_encode_then_decode(spark):
    values = ["", "a\tb\nc\rd", "\\", "\\N", "\\\\n", "é\x0b\f\b", None, "\\.", "x\\"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    back = rows.select("v", decode_field(encode_field(F.col("v"))).alias("w")).collect()
    assert all(r["v"] == r["w"] for r in back)


def test_malformed_fields(spark):
    cases = {r"\.": True, r"a\.b": True, r"\\.": False, "x\\": True, r"x\\": False, "\\N": False,
             r"\\\.": True, "a.b": False}
    rows = lines_of(spark, *cases).select("value", malformed(F.col("value")).alias("bad"))
    assert {r["value"]: r["bad"] for r in rows.collect()} == cases


def test_a_long_field_with_many_escapes(spark):
    text = "tab\there \\ and " * 20000
    lines = spark.createDataFrame([(1, text)], "id int, text string").select(
        F.concat_ws("\t", "id", encode_field(F.col("text"))).alias("value")
    )
    assert parse_lines(lines, PAIR).rows.first()["text"] == text


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ("x\ta", "bad value: id"),
        ("1.0\ta", "bad value: id"),
        ("99999999999\ta", "bad value: id"),
        ("\\N\ta", "missing value: id"),
        ("1\t\\.", "malformed escape: text"),
    ],
)
def test_what_cannot_be_loaded(spark, line, reason):
    lines = lines_of(spark, line, "5\tgood")
    result = parse_lines(lines, PAIR, TOLERANT)
    assert [tuple(r) for r in result.rejects.collect()] == [(line, reason)]
    assert [tuple(r) for r in result.rows.collect()] == [(5, "good")]
    with pytest.raises(Exception, match="pair: "):
        parse_lines(lines, PAIR, STRICT).rows.collect()


def test_invalid_utf8(spark, tmp_path):
    path = write_bytes(tmp_path / "pair", b"1\tgood\n2\tb\xffd\n")
    lines = read_lines(spark, path)
    result = parse_lines(lines, PAIR, TOLERANT)
    assert [r["reason"] for r in result.rejects.select("reason").collect()] == ["invalid utf-8"]
    assert result.rows.count() == 1
    with pytest.raises(Exception, match="INVALID_UTF8|UTF-8|UTF8"):
        parse_lines(lines, PAIR, STRICT).rows.collect()


def test_booleans(spark):
    words = {"t": True, "TRUE": True, "tr": True, "on": True, "yes": True, "1": True, " y ": True,
             "f": False, "off": False, "of": False, "no": False, "0": False,
             "o": None, "2": None, "": None}
    rows = lines_of(spark, *words).select("value", try_boolean(F.col("value")).alias("b"))
    assert {r["value"]: r["b"] for r in rows.collect()} == words


def test_uuids(spark):
    canonical = "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    words = {
        canonical: canonical,
        canonical.upper(): canonical,
        "{" + canonical + "}": canonical,
        canonical.replace("-", ""): canonical,
        "a0ee-bc99-9c0b-4ef8-bb6d-6bb9-bd38-0a11": canonical,
        "{" + canonical: None,
        canonical[:-1]: None,
        "g" + canonical[1:]: None,
    }
    rows = lines_of(spark, *words).select("value", try_uuid(F.col("value")).alias("u"))
    assert {r["value"]: r["u"] for r in rows.collect()} == words


def test_golden_load(spark, tmp_path):
    folder = write_dump(tmp_path, FIRST)
    tables = load_all(spark, folder)
    assert {t: p.rows.count() for t, p in tables.items()} == FIRST_LOADED
    artists = {r["id"]: r for r in tables["mb_artist"].rows.collect()}
    ostrevane, lonna = artists[100], artists[600]
    assert (ostrevane["type"], ostrevane["area"], ostrevane["gender"], ostrevane["begin_area"]) == (
        2, 221, None, 1000,
    )
    assert (lonna["name"], lonna["sort_name"], lonna["area"], lonna["gender"]) == (
        "Lönna", "Lonna", None, 2,
    )
    recording = tables["mb_recording"].rows.filter("id = 1").first()
    assert recording["gid"] == FIRST["mb_recording"][0][1]
    for table, result in tables.items():
        assert result.rows.schema.simpleString() == spec_for(table).schema.simpleString()
        assert result.rejects.isEmpty()


def test_fields_decoded_together_as_one_by_one(spark):
    """Every mix of escapes in neighbouring fields gives what each field gives by itself."""
    pieces = ["", "a", "\\N", "\\\\N", "x\\N", "\\t", "\\\\", "\\\\\\", "\\n;", "\\x41", "\\101", "\\.", "\\q", "é;b", "\\\\;", "\\\\b"]
    rows = [(f"{a}\t{b}", a, b) for a in pieces for b in pieces]
    spec = TableSpec("t", "t", (Column("a", "text", 0), Column("b", "text", 1)))
    lines = spark.createDataFrame(rows, "value string, a string, b string")
    parsed = parse_lines(lines, spec, TOLERANT)
    alone = lines.select(
        "value", decode_checked(F.col("a")).alias("x"), decode_checked(F.col("b")).alias("y")
    ).collect()
    kept = [(r["x"]["text"], r["y"]["text"]) for r in alone if not (r["x"]["problem"] or r["y"]["problem"])]
    assert Counter(map(tuple, parsed.rows.collect())) == Counter(kept)
    bad = {r["value"] for r in alone if r["x"]["problem"] or r["y"]["problem"]}
    assert {r["line"] for r in parsed.rejects.collect()} == bad and bad


def test_numbers_in_odd_spelling(spark):
    """What the cast alone would take or refuse, beside canonical numbers."""
    words = {"7": 7, "-7": -7, "+7": 7, "007": 7, " 7\t": 7, "-0": 0, "7.0": None, "\x017": None, "": None, "99999999999": None}
    rows = spark.createDataFrame([(w,) for w in words], "value string")
    found = rows.select("value", try_typed(F.col("value"), "int").alias("n")).collect()
    assert {r["value"]: r["n"] for r in found} == words


def test_missing_file_is_an_empty_table(spark, tmp_path):
    folder = write_dump(tmp_path, FIRST, skip=("mb_gender", "mb_tag"))
    assert missing_files(spark, folder) == ["gender", "tag"]
    assert missing_files(spark, folder, "derived") == ["tag"]
    loaded = load_table(spark, spec_for("gender"), folder)
    assert loaded.rows.columns == ["id", "name"]
    assert loaded.rows.isEmpty()


def test_latest_stamp(spark):
    page = '<a href="20260101-001000/">x</a><a href="20260405-002000/">y</a><a href="20269999/">'
    pages = spark.createDataFrame([(page,), ("<p>none</p>",)], "html string")
    assert latest_stamp(pages, "html").first()["stamp"] == "20260405-002000"
    with pytest.raises(Exception, match="no snapshot"):
        latest_stamp(pages.filter("html LIKE '%none%'"), "html").collect()


def test_what_escapes_spell_is_validated(spark):
    spec = TableSpec("t", "t", (Column("id", "int", 0), Column("body", "text", 1)))
    lines = lines_of(
        spark, "1\tfine\\x41", "2\t\\377", "3\t\\303", "4\ta\\000b", "5\t\\303\\251", "\x016\tx", "7\ta\x00b"
    )
    parsed = parse_lines(lines, spec, TOLERANT)
    assert {tuple(r) for r in parsed.rows.collect()} == {(1, "fineA"), (5, "é")}
    assert sorted(r["reason"] for r in parsed.rejects.collect()) == [
        "bad value: id", "invalid utf-8: body", "invalid utf-8: body", "zero byte", "zero byte: body",
    ]
    for k in (1, 2, 3):
        with pytest.raises(Exception, match="invalid utf-8|zero byte"):
            parse_lines(lines.limit(k + 1).subtract(lines.limit(k)), spec).rows.collect()


def test_fields_are_decoded_once_under_a_join(spark):
    spec = TableSpec("t", "t", (Column("id", "int", 0), Column("body", "text", 1)))
    lines = lines_of(spark, "1\ta", "2\tb")
    keys = spark.createDataFrame([(1,)], "key int")
    for mode in (STRICT, TOLERANT):
        rows = parse_lines(lines, spec, mode).rows
        joined = rows.join(keys, rows["id"] == keys["key"])
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1
        assert [r["body"] for r in joined.collect()] == ["a"]


@pytest.mark.parametrize("mode", [STRICT, TOLERANT])
def test_parsing_is_made_of_methods_that_the_machine_compiles(spark, mode, tmp_path):
    """A method of 8,000 bytes or more is interpreted, several times slower."""
    (tmp_path / "lines").write_text("1\n")
    lines = read_lines(spark, str(tmp_path / "lines"))
    for spec in map(spec_for, ("track", "artist", "recording")):
        plan = parse_lines(lines, spec, mode).verdicts(Observation())._jdf.queryExecution()
        parts = plan.debug().codegenToSeq()
        sizes = [parts.apply(k)._3().maxMethodCodeSize() for k in range(parts.length())]
        assert sizes and max(sizes) < 8000, spec.table


def test_the_first_problem_of_a_line_is_told(spark):
    spec = TableSpec(
        "t",
        "t",
        (Column("id", "int", 0), Column("n", "int", 1), Column("body", "text", 2, required=True)),
        ("id",),
    )
    lines = lines_of(
        spark, "1\t\\N\ta", "x\ty\t\\N", "1\ty\t\\N", "1\t2\t\\N", "\\N\ty\ta", "1\t\\061\tb\\x41", "1\t\\062\t\\N"
    )
    parsed = parse_lines(lines, spec, TOLERANT)
    assert sorted(tuple(r) for r in parsed.rows.fillna(0).collect()) == [(1, 0, "a"), (1, 1, "bA")]
    assert {r["line"]: r["reason"] for r in parsed.rejects.collect()} == {
        "x\ty\t\\N": "bad value: id",
        "1\ty\t\\N": "bad value: n",
        "1\t2\t\\N": "missing value: body",
        "\\N\ty\ta": "missing value: id",
        "1\t\\062\t\\N": "missing value: body",
    }
