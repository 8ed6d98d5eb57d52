"""String and cast helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_query(url: Column | str) -> Column:
    """URL up to the first ``?`` (the whole URL when there is none)."""
    return F.substring_index(_c(url), "?", 1)


def counter(s: Column | str) -> Column:
    """Counter text to BIGINT.

    Integers pass; an integral number written with a fraction (``"23.0"``)
    passes too; anything else (``"1.5"``, ``"many"``) is NULL.
    """
    s = _c(s).cast("string")
    as_long = s.try_cast("bigint")
    as_double = s.try_cast("double")
    integral = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(as_long, integral)


def id_text(c: Column | str) -> Column:
    """Ids compared as text (``str(id)``): numbers and strings meet here."""
    return _c(c).cast("string")
