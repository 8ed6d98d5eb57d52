"""JSON helpers that keep Python's distinction between an absent key and a
``null`` value (``get_json_object`` alone cannot tell them apart)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_keys(j: Column | str) -> Column:
    """Top-level keys of a JSON object; NULL for non-objects and bad JSON."""
    return F.json_object_keys(_c(j))


def key_count(j: Column | str) -> Column:
    """``len(obj)`` for a JSON object; NULL when the value is not an object."""
    return F.size(json_keys(j))


def has_key(j: Column | str, key: str) -> Column:
    """``key in obj``: true even when the value is ``null``; NULL for non-objects."""
    return F.array_contains(json_keys(j), F.lit(key))


def _path(keys: Sequence[str]) -> str:
    return "$" + "".join(f"['{k}']" if not k.isidentifier() else f".{k}" for k in keys)


def safe_path(j: Column | str, keys: Sequence[str] | str, default: str | None = "") -> Column:
    """Nested lookup that returns ``default`` on any miss.

    A miss is an absent key, or a parent that is not an object.  A key that is
    present with a JSON ``null`` gives NULL (not the default), exactly like a
    ``try: d[k1][k2] except: default`` loop.  The value comes back as JSON
    text (objects and arrays stay raw JSON, strings are unquoted).
    """
    if isinstance(keys, str):
        keys = keys.split(".")
    j = _c(j)
    parent = j if len(keys) == 1 else F.get_json_object(j, _path(keys[:-1]))
    value = F.get_json_object(j, _path(keys))
    found = F.coalesce(has_key(parent, keys[-1]), F.lit(False))
    dflt = F.lit(default) if default is not None else F.lit(None).cast("string")
    return F.when(found, value).otherwise(dflt)
