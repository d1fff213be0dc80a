"""Joins between two systems on differently named keys.

Keys of different types are both compared as text: under ANSI rules a mixed
text/number comparison would fail on the first id that is not a number.
Columns must not overlap; give one side a role suffix first.

No side is ever marked for broadcast here: Spark broadcasts by size on its own.
AQE splits skewed partitions of a single join, but not where a second join
follows on the same key; `match_hot` salts the few keys that hold much of the
data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted

# A key is hot from a fair partition's share on, within these bounds.
HOT_SHARE, MOST_SHARES = 64, 4096
HOT_SALTS = 64
# Sketch size per share; its error is far below the share of a hot key.
TRACKED_KEYS, TRACKED_PER_SHARE = 8192, 64


def _no_overlap(left: DataFrame, right: DataFrame) -> None:
    shared = sorted(set(left.columns) & set(right.columns))
    if shared:
        raise ValueError(f"columns on both sides of the join, rename first: {shared}")


def _keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> tuple[Column, Column]:
    """Both keys, for sides aliased as l and r; by name, so one frame may be both."""
    left_col, right_col = F.col(f"l.`{left_key}`"), F.col(f"r.`{right_key}`")
    if left.schema[left_key].dataType != right.schema[right_key].dataType:
        return left_col.cast("string"), right_col.cast("string")
    return left_col, right_col


def _equi(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    if how not in ("left_semi", "left_anti"):
        _no_overlap(left, right)
    left_col, right_col = _keys(left, right, left_key, right_key)
    return left.alias("l").join(right.alias("r"), left_col == right_col, how)


def match_inner(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return _equi(left, right, left_key, right_key, "inner")


def match_left(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return _equi(left, right, left_key, right_key, "left")


def match_semi(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return _equi(left, pick_key(right, right_key).distinct(), left_key, right_key, "left_semi")


def pick_key(df: DataFrame, key: str) -> DataFrame:
    return df.select(quoted(key))


def match_anti(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: Sequence = ()
) -> DataFrame:
    """Left rows without a match; a null left key never matches and is kept.

    `hot` lists left keys that hold much of the data, see `hot_keys`.
    """
    left_col, right_col = quoted(left_key), quoted(right_key)
    if left.schema[left_key].dataType != right.schema[right_key].dataType:
        left_col, right_col = left_col.cast("string"), right_col.cast("string")
        hot = [str(value) for value in hot if value is not None]
    return anti_on(left, right, [(left_col, right_col)], hot)


def anti_on(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]], hot: Sequence = ()
) -> DataFrame:
    """Left rows for which no right row agrees on every pair of expressions.

    Null keys may be most of the left side, and would all hash to one
    partition. They get one more key, taken from the row's content, that
    spreads them; so do rows whose first key is `hot`. On the right that key
    is 0, or every possible value for a hot key.
    """
    names, values = [f"_k{n}" for n in range(len(pairs))], [f"_v{n}" for n in range(len(pairs))]
    keyed = left.withColumns({name: pair[0] for name, pair in zip(names, pairs)})
    spread = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])
    content = F.pmod(F.xxhash64(*map(quoted, left.columns)), F.lit(HOT_SALTS))
    spread = spread | _is_hot(F.col(names[0]), hot)
    keyed = keyed.withColumn("_spread", F.when(spread, content).otherwise(F.lit(0)))
    right = right.select(*[pair[1].alias(value) for value, pair in zip(values, pairs)]).dropna().distinct()
    # Not a plain 0: a constant would not be used as a join key.
    zero = F.pmod(F.xxhash64(*values), F.lit(1))
    if any(value is not None for value in hot):
        every = F.sequence(F.lit(0), F.lit(HOT_SALTS - 1)).cast("array<long>")
        right = right.distinct()
        zero = F.explode(F.when(_is_hot(F.col(values[0]), hot), every).otherwise(F.array(zero)))
    right = right.withColumn("_spread_r", zero)
    agree = [F.col(name) == F.col(value) for name, value in zip(names, values)]
    agree.append(F.col("_spread") == F.col("_spread_r"))
    joined = keyed.join(right, reduce(lambda a, b: a & b, agree), "left_anti")
    return joined.drop(*names, "_spread")


def match_anti_where(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, column: str, value
) -> DataFrame:
    """Left rows without a match among right rows where `column` = `value`."""
    return match_anti(left, right.where(quoted(column) == F.lit(value)), left_key, right_key)


def match_differs(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows for which some right value differs from the left value.

    Some value differs exactly when the smallest or the largest does, so two
    scalars replace the nested loop; nulls compare as unknown on both sides.
    """
    bounds = right.agg(F.min(quoted(right_key)).alias("lo"), F.max(quoted(right_key)).alias("hi"))
    low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    return left.where((quoted(left_key) != low) | (quoted(left_key) != high))


def match_either(
    left: DataFrame, right: DataFrame, left_key: str, first_key: str, second_key: str
) -> DataFrame:
    """Inner join on `left_key` equal to either right key; each pair once.

    An OR condition would be a nested loop over all pairs, so this is the
    equi-join on the first key plus the one on the second key without the
    pairs that the first has matched.
    """
    _no_overlap(left, right)
    by_first = _equi(left, right, left_key, first_key, "inner")
    only_second = right.where(~quoted(second_key).eqNullSafe(quoted(first_key)))
    return by_first.unionByName(_equi(left, only_second, left_key, second_key, "inner"))


def hot_share(spark: SparkSession) -> int:
    """One over the share of the rows from which a key is hot: that of a fair shuffle partition.

    With 10,000 partitions a key with a 64th of the rows would be 150 times a fair
    partition, so the share follows the session's number of partitions.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(HOT_SHARE, min(partitions, MOST_SHARES))


def hot_keys(df: DataFrame, key: str, share: int | None = None) -> list:
    """Keys, null included, that each hold at least 1/`share` of the rows, counted now.

    At most `share` keys can, so the list is bounded whatever the data. A
    frequent-items sketch finds them in one pass without a shuffle by key.
    """
    share = share or hot_share(df.sparkSession)
    tracked = max(TRACKED_KEYS, share * TRACKED_PER_SHARE)
    top = F.expr(f"approx_top_k(k, {share}, {tracked})").alias("top")
    row = df.select(quoted(key).alias("k")).select(top, F.count("*").alias("n")).first()
    return [item["item"] for item in row["top"] if item["count"] * share >= row["n"]]


def _is_hot(key: Column, hot: Sequence, as_text: bool = False) -> Column:
    known = [str(value) if as_text else value for value in hot if value is not None]
    return key.isin(known) if known else F.lit(False)


def match_hot(
    hot_side: DataFrame,
    other: DataFrame,
    hot_key: str,
    other_key: str,
    how: str = "inner",
    hot: Sequence | None = None,
    salts: int = HOT_SALTS,
) -> DataFrame:
    """Equi-join whose left side may have hot keys; exact for inner and left.

    Rows of a hot key get a salt from their content and the few matching rows
    of the other side are repeated once per salt. Other keys are untouched,
    and without hot keys this is the plain join. `hot` is the list of hot keys
    where it is known already; else the left side is counted, so it should be
    a stored table. A hot null matters to a left join only.
    """
    _no_overlap(hot_side, other)
    hot = hot_keys(hot_side, hot_key) if hot is None else hot
    hot_null = how == "left" and None in hot
    if not hot_null and all(value is None for value in hot):
        return _equi(hot_side, other, hot_key, other_key, how)
    left_col, right_col = _keys(hot_side, other, hot_key, other_key)
    as_text = hot_side.schema[hot_key].dataType != other.schema[other_key].dataType
    salted = _is_hot(left_col, hot, as_text) | (left_col.isNull() if hot_null else F.lit(False))
    content = F.pmod(F.xxhash64(*map(quoted, hot_side.columns)), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    # Not a plain 0: a constant would not be used as a join key.
    zero = F.pmod(F.xxhash64(right_col), F.lit(1)).cast("int")
    repeated = F.when(_is_hot(right_col, hot, as_text), every).otherwise(F.array(zero))
    left = hot_side.alias("l").withColumn("_salt", F.when(salted, content).otherwise(F.lit(0)))
    right = other.alias("r").withColumn("_salt_r", F.explode(repeated))
    agree = (left_col == right_col) & (F.col("_salt") == F.col("_salt_r"))
    return left.alias("l").join(right.alias("r"), agree, how).drop("_salt", "_salt_r")
