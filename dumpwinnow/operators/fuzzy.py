"""Batch trigram lookup: all requests against all names in one set-similarity join.

Two trigram sets of sizes a and b reach similarity t only if they share at least
t/(1+t) * (a+b) trigrams.  If both sets are put in one common order, sets that similar share
a trigram within their first ``size - ceil(t * size) + 1`` elements.  So only these leading
trigrams are joined on; with rare trigrams first in the order, the frequent ones, which
would pair nearly everything with everything, are mostly never joined on at all.

* Copies of a name are folded into one before anything is shuffled.
* A leading trigram's row, a posting, has a name's number, its size, the trigram's place and a
  bitmap of the set, in which the most frequent trigrams have a bit each.  These bound what a
  pair can share, and where few trigrams make up most names, nearly exactly; the sets themselves
  are joined back only to pairs that pass, each once, and intersected.
* Trigrams that stay frequent are salted: their postings are spread over several tasks and the
  requests copied to each.
* Postings can be stored in buckets of their trigrams; lookups then read them in place and
  shuffle the requests alone.

Order and salts steer the work only; any choice of either gives the same pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwinnow.functions.once import once
from dumpwinnow.functions.trigrams import DEFAULT_THRESHOLD, trigram_codes
from dumpwinnow.sources.snapshots import scratch_snapshot

# The most frequent trigrams are put last in the order; all others tie as rare.
RANKED_TRIGRAMS = 1024

# Names under one trigram that one task should have to hold.
ROWS_PER_TASK = 1_000_000

# 64-bit words in a set's bitmap: the most frequent trigrams have a bit each in the first ones,
# all others flip hashed bits of the last ones.  Bits in which two bitmaps differ are at most
# the trigrams in which the sets differ, which bounds what they can share.  Compiled joins get
# slow when these words, compared one by one, make a method too long to be compiled further.
RANKED_WORDS = 8
HASHED_WORDS = 4
SIGNATURE_WORDS = RANKED_WORDS + HASHED_WORDS

# Guards the integer bounds against binary fractions such as 0.1 * 3; a bound that comes
# out too low only lets a pair through to the exact test.
SLACK = 1e-9


@dataclass(frozen=True)
class Postings:
    """Stored postings (slot, id, place, size, bitmap) of all names.

    They serve lookups at ``threshold`` or above; ``rows_per_task`` fixed their salts.  Postings
    with other bitmaps, as an earlier version stored them, serve none.
    """

    rows: DataFrame
    threshold: float = DEFAULT_THRESHOLD
    rows_per_task: int = ROWS_PER_TASK


@dataclass(frozen=True)
class NameIndex:
    """Distinct lower-cased names with their trigram codes, and the trigram order.

    ``names`` is (name_key, grams); ``frequent`` is (code, n), most frequent first.  Without
    stored postings each lookup makes its own.
    """

    names: DataFrame
    frequent: tuple[tuple[int, int], ...]
    postings: Postings | None = None


def distinct_names(table: DataFrame, name: str) -> DataFrame:
    """(name_key, grams) of the distinct lower-cased names; NULL counts as empty.

    Names take few bytes but much comparing, so they are spread over all cores instead of
    being coalesced by size.
    """
    spark = table.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    return (
        table.select(F.coalesce(F.lower(name), F.lit("")).alias("name_key"))
        .distinct()
        .repartition(parts, F.xxhash64("name_key"))
        .select("name_key", trigram_codes("name_key").alias("grams"))
    )


def frequent_trigrams(names: DataFrame, limit: int = RANKED_TRIGRAMS) -> DataFrame:
    """(code, n) of the most frequent trigrams, most frequent first; at most ``limit`` rows."""
    return (
        names.select(F.explode("grams").alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "code")
        .limit(limit)
    )


def index_names(table: DataFrame, name: str = "name") -> NameIndex:
    """Index of a table's names, written to the session's shared folder for this lookup."""
    names = scratch_snapshot(table.sparkSession).write("names", distinct_names(table, name))
    return NameIndex(names, collect_order(frequent_trigrams(names)))


def collect_order(frequent: DataFrame) -> tuple[tuple[int, int], ...]:
    """The bounded trigram order as literals, so that both join sides use the same one."""
    return tuple((row["code"], row["n"]) for row in frequent.collect())


def _case(groups: dict[int, list[int]], default: int) -> str:
    """SQL that maps a trigram code ``g`` to the number of its group."""
    if not groups:
        return str(default)
    branches = " ".join(
        f"WHEN g IN ({', '.join(f'{c}L' for c in codes)}) THEN {number}"
        for number, codes in sorted(groups.items())
    )
    return f"CASE {branches} ELSE {default} END"


def _in_order(frequent: tuple[tuple[int, int], ...]) -> Column:
    """``grams`` with rare trigrams first; frequent ones in bands that double in size."""
    bands: dict[int, list[int]] = {}
    last = len(frequent).bit_length()
    for rank, (code, _) in enumerate(frequent, start=1):
        bands.setdefault(last - rank.bit_length() + 1, []).append(code)
    band = _case(bands, 0)
    return F.expr(
        "transform(array_sort(transform(grams, "
        f"g -> named_struct('band', {band}, 'code', g))), s -> s.code)"
    )


def _salts(frequent: tuple[tuple[int, int], ...], rows_per_task: int) -> str:
    """SQL for the number of salts of a trigram code ``g``: powers of two, mostly one."""
    groups: dict[int, list[int]] = {}
    for code, n in frequent:
        salts = 1 << max(0, ceil(n / rows_per_task) - 1).bit_length()
        if salts > 1:
            groups.setdefault(salts, []).append(code)
    return _case(groups, 1)


def _bits(frequent: tuple[tuple[int, int], ...]) -> Column:
    """The bit of the set's bitmap that each of ``grams`` flips."""
    ranked = ", ".join(f"{code}L" for code, _ in frequent[: 64 * RANKED_WORDS])
    ranks = f"CAST(array({ranked}) AS array<bigint>)"
    return F.expr(
        f"transform(transform(grams, g -> named_struct('g', g, 'rank', array_position({ranks}, g))), "
        "s -> CAST(CASE WHEN s.rank > 0 THEN s.rank - 1 "
        f"ELSE {64 * RANKED_WORDS} + pmod(xxhash64(s.g), {64 * HASHED_WORDS}) END AS int))"
    )


def _signature(word: int) -> Column:
    """One 64-bit word of the set's parity bitmap: every trigram flips one bit."""
    return F.expr(
        f"aggregate(filter(flipped, b -> b DIV 64 = {word}), 0L, "
        "(bits, b) -> bits ^ shiftleft(1L, b % 64))"
    )


def _lead(size: Column, threshold: float) -> Column:
    """How many leading trigrams of a set can decide about a pair."""
    return size - F.ceil(size * threshold - SLACK).cast("int") + 1


def _leading(
    names: DataFrame, frequent: tuple[tuple[int, int], ...], threshold: float, rows_per_task: int
) -> DataFrame:
    """One row per leading trigram ``g`` of a name, with what the join condition needs.

    Every column is declared non-null and the generator is the outer one, since the optimizer
    would otherwise push null and emptiness tests, and with them the building of the trigram
    arrays, below the deduplication of the names.
    """
    words = [
        F.coalesce(_signature(word), F.lit(0).cast("long")).alias(f"bits{word}")
        for word in range(SIGNATURE_WORDS)
    ]
    no_grams = F.array().cast("array<bigint>")
    sets = names.select(
        F.xxhash64("name_key").alias("id"),
        F.coalesce(_in_order(frequent), no_grams).alias("grams"),
        F.coalesce(F.size("grams"), F.lit(0)).alias("size"),
        _bits(frequent).alias("flipped"),
    ).select("id", "grams", "size", *words)
    leading = F.posexplode_outer(F.slice("grams", 1, _lead(F.col("size"), threshold)))
    return (
        sets.select("*", leading.alias("place", "g"))
        .drop("grams")
        .select("*", F.expr(_salts(frequent, rows_per_task)).alias("salts"))
    )


def _slot(salt: Column) -> Column:
    """What postings and requests are joined on: the trigram, or one salt of a frequent one."""
    return F.when(F.col("salts") == 1, F.col("g")).otherwise(F.xxhash64("g", salt))


POSTING = ("slot", "id", "place", "size", *[f"bits{word}" for word in range(SIGNATURE_WORDS)])


def postings(
    names: DataFrame,
    frequent: tuple[tuple[int, int], ...],
    threshold: float = DEFAULT_THRESHOLD,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The inverted list of names: a row for each leading trigram of each name."""
    rows = _leading(names, frequent, threshold, rows_per_task)
    salt = F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")
    return rows.filter(F.col("g").isNotNull()).withColumn("slot", _slot(salt)).select(*POSTING)


def similar_names(
    requests: DataFrame,
    index: NameIndex,
    threshold: float = DEFAULT_THRESHOLD,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(request_key, name_key, similarity) of all pairs at or above the threshold.

    ``requests`` is a :func:`distinct_names` result.  ``rows_per_task`` counts only where no
    stored postings serve the threshold.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    pairs = candidate_pairs(requests, index, threshold, rows_per_task)
    # names that share a number, if any do, are all judged by their sets
    one = requests.select(
        F.xxhash64("name_key").alias("r_id"),
        F.col("name_key").alias("request_key"),
        F.col("grams").alias("r_grams"),
    )
    two = index.names.select(F.xxhash64("name_key").alias("id"), "name_key", "grams")
    both = (F.size("r_grams") + F.size("grams")).alias("both")
    shared = once(F.size(F.array_intersect("r_grams", "grams"))).alias("shared")
    score = (F.col("shared") / (F.col("both") - F.col("shared"))).alias("similarity")
    return (
        pairs.join(two, "id")
        .join(one, "r_id")
        .select("request_key", "name_key", both, shared)
        .select("request_key", "name_key", score)
        .filter(F.col("similarity") >= threshold)
    )


def candidate_pairs(
    requests: DataFrame, index: NameIndex, threshold: float, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(r_id, id) of the pairs that sizes, places and bitmaps do not rule out, each once."""
    stored = index.postings
    if (
        stored is not None
        and threshold >= stored.threshold
        and set(POSTING) <= set(stored.rows.columns)
    ):
        held, rows_per_task = stored.rows, stored.rows_per_task
        if threshold > stored.threshold:
            held = held.filter(F.col("place") < _lead(F.col("size"), threshold))
    else:
        held = postings(index.names, index.frequent, threshold, rows_per_task)
    asked = _leading(requests, index.frequent, threshold, rows_per_task)
    asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    asked = asked.withColumn("slot", _slot(F.col("salt")))
    asked = asked.select(*[F.col(c).alias(f"r_{c}") for c in POSTING])
    sizes = F.col("r_size") + F.col("size")
    needed = F.ceil(sizes * (threshold / (1 + threshold)) - SLACK)
    still_ahead = F.least(F.col("r_size") - F.col("r_place"), F.col("size") - F.col("place"))
    differing = sum(
        F.bit_count(F.col(f"r_bits{word}").bitwiseXOR(F.col(f"bits{word}")))
        for word in range(SIGNATURE_WORDS)
    )
    return (
        asked.join(
            held,
            (F.col("r_slot") == F.col("slot"))
            & (still_ahead >= needed)
            & (sizes - differing >= 2 * needed),
        )
        .select("r_id", "id")
        .distinct()
    )


def fuzzy_lookup(
    requests: DataFrame,
    catalog: DataFrame,
    index: NameIndex | None = None,
    request: str = "request",
    entity: str = "id",
    name: str = "name",
    threshold: float = DEFAULT_THRESHOLD,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(request, id, name, similarity) of every catalog row similar to a request.

    An index that was written earlier saves the passes that build one.
    """
    index = index or index_names(catalog, name)
    asked = requests.select(F.col(request).alias("request")).distinct()
    # written, as the requests are read once for their trigrams and once for their sets
    names = scratch_snapshot(requests.sparkSession).write("names", distinct_names(asked, "request"))
    pairs = similar_names(names, index, threshold, rows_per_task)
    rows = catalog.select(F.col(entity).alias("id"), F.col(name).alias("name"))
    return (
        pairs.join(asked, F.lower("request") == F.col("request_key"))
        .join(rows, F.lower("name") == F.col("name_key"))
        .select("request", "id", "name", "similarity")
    )
