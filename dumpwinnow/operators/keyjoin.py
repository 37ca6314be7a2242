"""Keep rows by key, and join on keys that a large share of the rows may hold.

The semi-join that every other operator is made of has three forms with one result:

* ``key_rows`` known (the caller wrote the keys and counted them), of fixed width and few:
  broadcast, so the big table is neither shuffled nor sorted;
* ``key_rows`` known and many: one shuffled semi-join on (key, salt), in which the rows of the
  most frequent keys are spread over several salts and only those keys are copied to each;
* size unknown: a plain semi-join; the optimizer's size estimate and adaptive execution
  choose the strategy and split skewed partitions.

:func:`spread_join` does the same for inner, left, semi and anti joins, whichever side is skewed.
Frequent keys come from one pass with a mergeable frequent-items sketch of bounded size.  Which
keys count as frequent only decides the path a row takes, so any choice gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

KEY = "key"

# A broadcast table of numbers takes some 20 bytes a row: 2 million rows are about 40 MB.
# Strings have no such bound and are left to the optimizer's size check.
BROADCAST_ROWS = 2_000_000

# A key that holds more than 1/256 of the rows is frequent.  The sketch tracks many more items than
# there can be such keys, so that it misses none.
HOT_KEYS = 256
TRACKED = 16_384
# Salts of a key that is frequent on one side, and on each side where it is on both.
SALTS = 16
SALTS_OF_BOTH = 4


def distinct_keys(table: DataFrame, column: str) -> DataFrame:
    """The non-null values of a column as a one-column key set, deduplicated map-side."""
    return table.select(F.col(column).alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()


def keep_by_keys(
    rows: DataFrame,
    column: str,
    keys: DataFrame,
    key_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows whose ``column`` is in ``keys`` (a :func:`distinct_keys` result)."""
    if key_rows is None:
        return _semi(rows, column, keys)
    if key_rows > broadcast_rows:
        return _keep_salted(rows, column, keys)
    if isinstance(keys.schema[KEY].dataType, StringType):
        return _semi(rows, column, keys)
    return _semi(rows, column, F.broadcast(keys))


def drop_by_keys(rows: DataFrame, column: str, keys: DataFrame, spread: bool = False) -> DataFrame:
    """Rows whose ``column`` is not in ``keys``; a NULL is in no key set.

    ``spread`` first looks for values that many rows hold and spreads these.
    """
    if spread:
        return spread_join(rows, keys, column, KEY, "left_anti", right_unique=True)
    return rows.join(keys, rows[column] == keys[KEY], "left_anti")


def _semi(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    return rows.join(keys, rows[column] == keys[KEY], "left_semi")


def _keep_salted(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Semi-join in which the rows of frequent keys never meet in one task."""
    return spread_join(rows, keys, column, KEY, "left_semi", right_unique=True, known_large=True)


def frequent_keys(rows: DataFrame, column: str) -> list:
    """The values that more than 1/HOT_KEYS of the rows hold; at most HOT_KEYS of them.

    Tasks keep a sketch of fixed size, and these merge into one.  Counts are lower bounds up to
    a small share of all rows, so nothing frequent is missed.
    """
    top = F.expr(f"approx_top_k({KEY}, {HOT_KEYS}, {TRACKED})")
    found = (
        rows.select(F.col(column).alias(KEY))
        .filter(F.col(KEY).isNotNull())
        .agg(F.count(F.lit(1)).alias("n"), top.alias("top"))
        .first()
    )
    return [item["item"] for item in found["top"] or () if item["count"] * HOT_KEYS > found["n"]]


def _is_broadcast(rows: DataFrame) -> bool:
    """Whether the optimizer's own size check lets it broadcast these rows."""
    spark = rows.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    right_unique: bool = False,
    known_large: bool = False,
) -> DataFrame:
    """Join on one column of each side; rows of a frequent key never meet in one task.

    ``how`` is inner, left, left_semi or left_anti.  The rows of a key that is frequent on one
    side are dealt to salts there and copied to each salt on the other; where it is frequent on
    both sides, each is dealt, and each pair of salts meets in a task of its own.  Except in an
    inner join, and with ``right_unique``, the right side is never dealt.  A row's salt depends
    on its values alone, so a re-run repeats it.  Nothing is spread, nor looked for, where the
    optimizer broadcasts a side, as no rows are shuffled then; ``known_large`` says that both
    sides are too large for that.  Column names must differ between
    the sides in the result, as in any join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a join of kind {how!r}")
    if not known_large and (_is_broadcast(right) or (how == "inner" and _is_broadcast(left))):
        return left.join(right, left[left_key] == right[right_key], how)
    hot_left = frequent_keys(left, left_key)
    deals_right = how == "inner" and not right_unique
    hot_right = frequent_keys(right, right_key) if deals_right else []
    if not hot_left and not hot_right:
        return left.join(right, left[left_key] == right[right_key], how)

    def salts(key: str, own: list, other: list) -> Column:
        both = [k for k in own if k in set(other)]
        column = F.col(key)
        count = F.when(column.isin(both), SALTS_OF_BOTH) if both else None
        if own:
            count = (F if count is None else count).when(column.isin(own), SALTS)
        return F.lit(1) if count is None else count.otherwise(1)

    def dealt(rows: DataFrame, count: Column) -> Column:
        return F.pmod(F.xxhash64(*rows.columns), count).cast("int")

    def copied(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    a, b, c, d = "_row_salt", "_other_row_salt", "_key_salt", "_other_key_salt"
    one = left.withColumn(a, dealt(left, salts(left_key, hot_left, hot_right)))
    two = right.withColumn(c, copied(salts(right_key, hot_left, hot_right)))
    on = (one[left_key] == two[right_key]) & (F.col(a) == F.col(c))
    if hot_right:
        one = one.withColumn(b, copied(salts(left_key, hot_right, hot_left)))
        two = two.withColumn(d, dealt(right, salts(right_key, hot_right, hot_left)))
        on = (one[left_key] == two[right_key]) & (F.col(a) == F.col(c)) & (F.col(b) == F.col(d))
    return one.join(two, on, how).drop(a, b, c, d)
