"""Row predicates whose null behaviour matters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark import fixed_values as fv


def quoted(name: str) -> Column:
    """Column by exact name, also when the name contains a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def outside(column: Column, values: Iterable) -> Column:
    """`NOT IN`: a null operand is unknown, so a filter drops the row."""
    return ~column.isin(list(values))


def lacks_prefix_or_null(column: Column, prefix: str) -> Column:
    """True without the prefix and also for null (kept on purpose)."""
    return column.isNull() | ~column.startswith(prefix)


def has_prefix(column: Column, prefix: str) -> Column:
    """True with the prefix; null is unknown."""
    return column.startswith(prefix)


def equals_any(column: Column, values: Iterable) -> Column:
    """Disjunction of equalities."""
    return column.isin(list(values))


def named(column: Column) -> Column:
    """Has a usable name: neither null nor one of the blank markers."""
    return column.isNotNull() & outside(column, fv.BLANK_NAMES)


def since(column: Column, as_of: dt.date, days: int) -> Column:
    """Timestamp not older than `days` days before `as_of`."""
    return column >= F.date_sub(F.lit(as_of), days)


def not_both(first: Column, second: Column) -> Column:
    """Negated conjunction under three-valued logic."""
    return ~(first & second)


def monitored_table(name: Column) -> Column:
    """Table whose runs are reported: no warning, pre-sales or history table."""
    kept = ~name.startswith(fv.STATUS_SKIP_PREFIX)
    for fragment in fv.STATUS_SKIP_FRAGMENTS:
        kept = kept & ~name.contains(fragment)
    return kept


def user_relation(schema: Column, kind: Column) -> Column:
    """Relation outside the catalog schemas that is not an index."""
    return (
        outside(schema, fv.CATALOG_SCHEMAS)
        & (kind != fv.INDEX_KIND)
        & ~schema.rlike(fv.CATALOG_SCHEMA_PATTERN)
    )
