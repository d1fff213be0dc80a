"""Text clean-up expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark import fixed_values as fv

# Characters outside the YAML printable set, as a Java character class.
UNPRINTABLE = r"[^\x09\x0A\x0D\x20-\x7E\x85\xA0-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def service_label(name: Column) -> Column:
    """Service name up to `Instance`, then up to `#`; a trailing space stays."""
    return F.substring_index(F.substring_index(name, "Instance", 1), "#", 1)


def last_segment(dotted: Column) -> Column:
    """Text after the last dot."""
    return F.substring_index(dotted, ".", -1)


def plain_status(status: Column) -> Column:
    """Decorated status as a plain label; any other status becomes null."""
    result = F.lit(None).cast("string")
    for ending, pattern, label in reversed(fv.STATUS_RULES):
        result = F.when(
            status.endswith(ending), F.regexp_replace(status, pattern, label)
        ).otherwise(result)
    return result


def decorated(status: Column) -> Column:
    """Status with a known decoration; all others have no plain label."""
    return reduce(lambda a, b: a | b, [status.endswith(ending) for ending, _, _ in fv.STATUS_RULES])


def type_label(type_id: Column, labels: Mapping[int, str] = fv.TYPE_LABELS) -> Column:
    """Label of a known type id; an unknown id passes through as text."""
    result = type_id.cast("string")
    for known, label in labels.items():
        result = F.when(type_id == F.lit(known), F.lit(label)).otherwise(result)
    return result


def replace_at(text: Column, index: int, replacement: str = "") -> Column:
    """Text with the character at a zero-based position replaced."""
    return F.concat(
        F.substring(text, 1, index),
        F.lit(replacement),
        text.substr(F.lit(index + 2), F.length(text)),
    )


def printable(text: Column) -> Column:
    """Text without unprintable characters."""
    return F.regexp_replace(text, UNPRINTABLE, "")


def decoded(content: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 are dropped.

    Invalid bytes are marked with U+FFFD and the marks dropped. Genuine ones are
    written as an escape meanwhile, a control character and a digit.
    """
    text = content.cast("string")
    for found, escape in [("\x01", "\x010"), ("\ufffd", "\x011")]:
        text = F.replace(text, F.lit(found), F.lit(escape))
    text = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    for found, escape in [("\ufffd", "\x011"), ("\x01", "\x010")]:
        text = F.replace(text, F.lit(escape), F.lit(found))
    return text
