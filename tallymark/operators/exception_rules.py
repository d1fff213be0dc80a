"""Exception rules held as data: suppress rows or force the duplicate mark.

A rule says `attr1 = val1`, or `attr1 = val1 AND attr2 = val2` where attr2 is
not null. Values are text, so the tested columns are compared as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallymark.functions.predicates import not_both, quoted
from tallymark.operators.matching import anti_on
from tallymark.session import written_once

RULE_COLUMNS = ["attr1", "val1", "attr2", "val2"]
# So many rules at most become one expression; more of them are joined.
FEW_RULES = 50


def rules_for(
    filters: DataFrame,
    exceptions: DataFrame,
    exception_controls: DataFrame,
    control_types: DataFrame,
    exception_types: DataFrame,
    control_type: int,
    exception_type: int,
) -> DataFrame:
    """Rules of one control and one exception type.

    Inputs: filters(exception_key, attr1, val1, attr2, val2),
    exceptions(exception_key, exception_type),
    exception_controls(exception_key, control_type), control_types(control_type),
    exception_types(exception_type).
    """
    return (
        filters.join(exceptions, "exception_key")
        .join(exception_controls, "exception_key")
        .join(control_types, "control_type")
        .join(exception_types, "exception_type")
        .where((F.col("control_type") == control_type) & (F.col("exception_type") == exception_type))
        .select(*RULE_COLUMNS)
    )


def _text(name: str) -> Column:
    return quoted(name).cast("string")


def _hit(rule: Row) -> Column:
    first = _text(rule.attr1) == F.lit(rule.val1).cast("string")
    if rule.attr2 is None:
        return first
    return first & (_text(rule.attr2) == F.lit(rule.val2).cast("string"))


def _miss(rule: Row) -> Column:
    first = _text(rule.attr1) == F.lit(rule.val1).cast("string")
    if rule.attr2 is None:
        return ~first
    return not_both(first, _text(rule.attr2) == F.lit(rule.val2).cast("string"))


def _as_text(rules: DataFrame) -> DataFrame:
    return rules.select(*[F.col(name).cast("string") for name in RULE_COLUMNS])


def _few(rules: DataFrame, inline: bool | None) -> list[Row] | None:
    """The rules where there are few; FEW_RULES + 1 rows at most are fetched."""
    if inline is False:
        return None
    found = rules.limit(FEW_RULES + 1).collect()
    if len(found) <= FEW_RULES:
        return found
    if inline:
        raise ValueError(f"more than {FEW_RULES} rules: leave out inline")
    return None


def _attribute_pairs(rules: DataFrame) -> list[Row]:
    """Distinct tested columns and which of their values may be null.

    Bounded by the pairs of columns that rules name.
    """
    no_first, no_second = F.col("val1").isNull(), F.col("val2").isNull()
    return (
        rules.groupBy("attr1", "attr2")
        .agg(
            F.bool_or(no_first).alias("null_first"),
            F.bool_or(no_second).alias("null_second"),
            F.bool_or(no_first & no_second).alias("null_both"),
        )
        .collect()
    )


def _of_pair(rules: DataFrame, pair: Row) -> DataFrame:
    return rules.where(
        (F.col("attr1") == pair.attr1) & F.col("attr2").eqNullSafe(F.lit(pair.attr2))
    ).select("val1", "val2")


def suppress(df: DataFrame, rules: DataFrame, inline: bool | None = None) -> DataFrame:
    """Rows that match no rule for certain.

    As with SQL NOT, a comparison with null is unknown and the row goes: a
    null in the tested column drops the row, a null rule value drops every
    row. No rules leave the frame as it is. Up to FEW_RULES rules become one
    expression; more are joined as a table, written once. `inline` insists on
    the one or, False, on the other; the result is the same.
    """
    rules = _as_text(rules)
    few = _few(rules, inline)
    if few is not None:
        return df.where(reduce(lambda a, b: a & b, map(_miss, few))) if few else df
    rules = written_once(rules, "rules")
    for pair in _attribute_pairs(rules):
        apply = _suppress_single if pair.attr2 is None else _suppress_double
        df = apply(df, pair, _of_pair(rules, pair))
    return df


def _suppress_single(df: DataFrame, pair: Row, rules: DataFrame) -> DataFrame:
    if pair.null_first:
        return df.where(F.lit(False))
    tested = df.where(quoted(pair.attr1).isNotNull())
    return anti_on(tested, rules.distinct(), [(_text(pair.attr1), F.col("val1"))])


def _suppress_double(df: DataFrame, pair: Row, rules: DataFrame) -> DataFrame:
    """Drop rows where some rule is true or unknown on both of its columns."""
    if pair.null_both:
        return df.where(F.lit(False))
    first, second = _text(pair.attr1), _text(pair.attr2)
    df = df.where(first.isNotNull() | second.isNotNull())
    if pair.null_first:
        free = rules.where("val1 IS NULL").distinct()
        df = anti_on(df.where(second.isNotNull()), free, [(second, F.col("val2"))])
    if pair.null_second:
        free = rules.where("val2 IS NULL").distinct()
        df = anti_on(df.where(first.isNotNull()), free, [(first, F.col("val1"))])
    # A rule hits rows with both its values, and rows with one of them where
    # the other column is null: three keys per rule, one key per row.
    keys = F.explode(
        F.array(
            F.struct(F.lit("both").alias("kind"), F.col("val1").alias("x"), F.col("val2").alias("y")),
            F.struct(F.lit("first").alias("kind"), F.col("val1").alias("x"), F.lit("").alias("y")),
            F.struct(F.lit("second").alias("kind"), F.lit("").alias("x"), F.col("val2").alias("y")),
        )
    )
    wanted = rules.dropna().select(keys.alias("key")).select("key.*").distinct()
    kind = F.when(second.isNull(), "first").when(first.isNull(), "second").otherwise("both")
    blank = F.lit("")
    return anti_on(
        df,
        wanted,
        [(kind, F.col("kind")), (F.coalesce(first, blank), F.col("x")), (F.coalesce(second, blank), F.col("y"))],
    )


def mark_duplicates(
    df: DataFrame, rules: DataFrame, mark: str = "isDuplicate", inline: bool | None = None
) -> DataFrame:
    """Set the mark to 1 on rows that match any rule; other rows keep theirs. `inline` as in `suppress`."""
    rules = _as_text(rules)
    few = _few(rules, inline)
    if few is not None:
        if not few:
            return df
        return df.withColumn(
            mark, F.when(reduce(lambda a, b: a | b, map(_hit, few)), 1).otherwise(quoted(mark))
        )
    columns = df.columns
    hits = []
    rules = written_once(rules, "rules")
    pairs = _attribute_pairs(rules)
    if not pairs:
        return df
    for i, pair in enumerate(pairs):
        values = _of_pair(rules, pair)
        keys = [(pair.attr1, "val1")] + ([] if pair.attr2 is None else [(pair.attr2, "val2")])
        distinct = values.select(*[F.col(v).alias(f"_{v}{i}") for _, v in keys]).distinct()
        distinct = distinct.dropna().withColumn(f"_hit{i}", F.lit(True))
        condition = reduce(lambda x, y: x & y, [_text(c) == F.col(f"_{v}{i}") for c, v in keys])
        df = df.join(distinct, condition, "left")
        hits.append(F.col(f"_hit{i}").isNotNull())
    marked = df.withColumn(mark, F.when(reduce(lambda a, b: a | b, hits), 1).otherwise(quoted(mark)))
    return marked.select(*[quoted(c) for c in columns])
