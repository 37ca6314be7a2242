"""Shards of equally many documents that keep linked documents together.

Documents of equal text are linked.  Balanced label propagation: every document has a shard,
at first by hash.  In each round linked documents look at the shards of their neighbours;
those whose shard holds fewer neighbours than another one with room want to move there.  A
shard's quota is the room it has left, and the movers' hashes decide who is admitted, whole
groups at a time.  Groups that could fill much of a shard go first, spread over just as many
shards as they need; smaller ones make way for them.  At the end unlinked documents, which cut
no edge wherever they are, are dealt from shards that hold too many to those that hold too
few, so that counts differ by one at most.

The neighbours of a group are counted by shard, so links are never listed as pairs.  Rows are
numbered within a shard in small hash buckets with the counts of the buckets before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

SHARDS = 40
ROUNDS = 6
#: Rows of a shard that are numbered together, about.
NUMBERED = 500


def numbered(rows: DataFrame, total: int, group: str | None, first: str | None = None) -> DataFrame:
    """Add `place`: gapless numbers from 0 within each value of `group` (or in all rows).

    Rows with a smaller `first` come first.  Rows need a unique `node`.
    """
    parts = 1 + total // NUMBERED // (SHARDS if group else 1)
    keys = [F.col(group) if group else F.lit(0), F.col(first) if first else F.lit(0)]
    dealt = rows.withColumns(
        {"of": keys[0], "tier": keys[1], "part": F.pmod(F.xxhash64("node"), F.lit(parts))}
    )
    # one row for each bucket
    before = (
        dealt.groupBy("of", "tier", "part")
        .agg(F.count("*").alias("held"))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("held").over(
                    Window.partitionBy("of").orderBy("tier", "part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("held")
    )
    inside = F.row_number().over(Window.partitionBy("of", "tier", "part").orderBy("node"))
    return (
        dealt.withColumn("inside", inside)
        .join(before, ["of", "tier", "part"])
        .withColumn("place", F.col("before") + F.col("inside") - 1)
        .drop("of", "tier", "part", "before", "inside")
    )


def chance(*parts) -> Column:
    """A number from 0 to 1 that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def by_shard(values: list[float], shard: Column) -> Column:
    """The value of a shard, from one literal for each shard."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def wishes(state: DataFrame, loads: list[int], small: list[int], capacity: int, salt: int) -> DataFrame:
    """Add `want`, the shard that a document would rather be in, or null.

    A group takes as many shards as it needs, those with room that hold most of it.  A small
    group moves where more of it is; from a shard that holds too much, as much as is too much
    moves anywhere with room.
    """
    roomy = [s for s, n in enumerate(loads) if n < capacity]
    leave = [max(0, n - capacity) / max(1, m) for n, m in zip(loads, small, strict=True)]
    votes = state.groupBy("group", "shard").agg(F.count("*").alias("votes"))
    # at most one entry for each shard; written, so that a large group can be split in the join
    entry = F.struct("votes", F.xxhash64("group", "shard").alias("tie"), "shard")
    held = written(votes.groupBy("group").agg(F.sort_array(F.collect_list(entry), False).alias("held")))
    joined = state.join(held, "group")
    own = F.col("shard")
    here = F.filter("held", lambda x: x["shard"] == own)[0]
    open_ = F.filter("held", lambda x: x["shard"].isin(roomy) if roomy else F.lit(False))
    needed = F.ceil(F.col("members") / F.lit(capacity)).cast("int")
    targets = F.slice(open_, F.lit(1), F.greatest(needed, F.lit(1)))
    top = F.get(targets, F.lit(0))
    anywhere = F.get(
        F.array(*[F.lit(s) for s in roomy]).cast("array<int>"),
        F.pmod(F.xxhash64("group", F.lit(salt)), F.lit(max(1, len(roomy)))).cast("int"),
    )
    crowded = chance("group", F.lit(salt + 1)) < by_shard(leave, own)
    better = (top["votes"] > here["votes"]) | ((top["votes"] == here["votes"]) & (top["tie"] > here["tie"]))
    one = F.when(crowded, F.when(top["shard"] != own, top["shard"]).otherwise(anywhere)).when(
        better & (top["shard"] != own), top["shard"]
    )
    spread = F.get(targets, F.pmod(F.xxhash64("node"), F.greatest(F.size(targets), F.lit(1))).cast("int"))
    several = F.when(~F.exists(targets, lambda x: x["shard"] == own), spread["shard"])
    return joined.select("node", "group", "members", "shard", F.when(F.col("large"), several).otherwise(one).alias("want"), "large")


def propagate(linked: DataFrame, shards: int, capacity: int, rounds: int) -> DataFrame:
    """(node, shard) after rounds of moves under quotas: large groups first, then the others."""
    state = linked.withColumn("large", F.col("members") * 4 >= capacity)
    for k in range(rounds):
        loads, small = [0] * shards, [0] * shards
        large_turn = k < rounds // 3
        for r in state.groupBy("shard").agg(F.count("*").alias("n"), F.count_if("large").alias("l")).collect():
            loads[r["shard"]] = r["l"] if large_turn else r["n"]  # one row for each shard
            small[r["shard"]] = r["n"] - r["l"]
        turn = F.col("large") if large_turn else ~F.col("large")
        asked = written(
            wishes(state.where(turn), loads, small, capacity, 1000 * k).unionByName(
                state.where(~turn).withColumn("want", F.lit(None).cast("int"))
            )
        )
        wanted = {r["want"]: r["count"] for r in asked.where("want is not null").groupBy("want").count().collect()}
        room = [max(0, capacity - loads[s]) / wanted.get(s, 1) for s in range(shards)]
        lot = F.when(F.col("large"), chance("node", F.lit(k))).otherwise(chance("group", F.lit(k)))
        moves = F.col("want").isNotNull() & (lot < by_shard(room, F.col("want")))
        state = asked.withColumn("shard", F.when(moves, F.col("want")).otherwise(F.col("shard"))).drop("want")
    return state.select("node", "shard")


def balance(placed: DataFrame, total: int, shards: int) -> DataFrame:
    """(node, shard) with counts at most one apart; rows of tier 1 are moved before tier 0."""
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    wanted = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("shard") + 1)
    ranked = written(numbered(placed, total, "shard", "tier"))
    held = {r["shard"]: r["count"] for r in ranked.groupBy("shard").count().collect()}
    ends, end = [], 0  # holes of each shard, end to end
    for s in range(shards):
        end += max(0, quota[s] - held.get(s, 0))
        ends.append(end)
    stay = ranked.where(F.col("place") < wanted).select("node", "shard")
    move = numbered(ranked.where(F.col("place") >= wanted).select("node"), max(end, 1), None)
    hole = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("place")))
    return stay.unionByName(move.select("node", hole.alias("shard")))


def shard_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law (`rows`), shard, slot, grown_shard (null).

    Counts of any two shards differ by one at most; slots run from 0 without gaps.  Null and
    empty texts are equal texts of size 16.  A group too large for a shard fills several.
    Rows are numbered as they are read, so shards depend on how the table's files are split.
    Null and repeated ids are rows like any other.  Columns other than the two named are
    ignored.
    """
    words = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("node"),
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(words) + 16).cast("long").alias("size"),
            F.crc32(words).alias("text_crc32"),
            F.md5(words).alias("group"),
        )
    )
    total = rows.count()
    dealt = rows.select(
        "node", "group", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")
    )
    groups = written(rows.groupBy("group").agg(F.count("*").alias("members")).where("members > 1"))
    linked = written(dealt.join(groups, "group"))
    gathered = propagate(linked, shards, max(1, total // shards), rounds)
    placed = gathered.select("node", "shard", F.lit(0).alias("tier")).unionByName(
        dealt.join(groups, "group", "left_anti").select("node", "shard", F.lit(1).alias("tier"))
    )
    final = written(numbered(written(balance(placed, total, shards)), total, "shard"))
    return rows.join(final, "node").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("place").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
