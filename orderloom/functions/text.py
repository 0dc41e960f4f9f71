"""Text and number parsing, as plain Column -> Column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def trimmed(c: Column | str) -> Column:
    return F.trim(col(c).cast("string"))


def trimmed_or_null(c: Column | str) -> Column:
    return blank_to_null(trimmed(c))


def kv_value(payload: Column | str, key: str) -> Column:
    """First value of `key` in a "k:v, k:v" payload; spaces around separators are allowed."""
    pattern = rf"(?:^|,) *{re.escape(key)} *:([^,]*)"
    return trimmed_or_null(F.regexp_extract(col(payload), pattern, 1))


def list_part(payload: Column | str, position: int) -> Column:
    """1-based part of a comma-separated payload."""
    return trimmed_or_null(F.split_part(col(payload), F.lit(","), F.lit(position)))


def whole_number(c: Column | str, kind: str = "bigint") -> Column:
    """Integer text to a number; anything else (also "3.7" and "1e3") is NULL."""
    return col(c).try_cast(kind)


def decimal_number(c: Column | str) -> Column:
    """Plain or scientific number text to double; type suffixes, inf and nan are NULL."""
    return F.when(col(c).rlike(_NUMBER), col(c).try_cast("double"))
