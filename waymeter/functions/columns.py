"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PREFIX_PATTERN = r"^\d+\.\s*"
BLANKS = " \t\n\r\f\v"


def quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds a dot or a quote."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_prefix(c: Column) -> Column:
    """``"2. Spring"`` → ``"Spring"``."""
    return F.regexp_replace(c, PREFIX_PATTERN, "")


def strip_blanks(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def choose(c: Column, table: Mapping[str, object], default: object) -> Column:
    """A short lookup as one CASE expression; null and unknown values give ``default``."""
    out = None
    for key, value in table.items():
        hit = c == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def one_of(c: Column, values: Iterable[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(c.isin(*values), F.lit(False))


def with_default(c: Column, default: object) -> Column:
    """``c`` unless it is null or zero."""
    return F.coalesce(F.nullif(c, F.lit(0).cast("double")), F.lit(default))


def absent(c: Column, is_float: bool) -> Column:
    """Null, or NaN where the type has one."""
    return (c.isNull() | F.isnan(c)) if is_float else c.isNull()
