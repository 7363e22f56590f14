"""Symbol lists and object names."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_symbol_list(raw: Any) -> tuple[str, ...]:
    """Read a JSON list, a comma-separated text or a Python sequence; trim, upper-case, drop blanks."""
    items = raw
    if isinstance(raw, str):
        try:
            items = json.loads(raw)
        except ValueError:
            pass
    if isinstance(items, str):
        items = items.split(",")
    if not isinstance(items, (list, tuple)):
        raise TypeError(f"not a symbol list: {raw!r}")
    cleaned = (str(item).strip().upper() for item in items)
    return tuple(symbol for symbol in cleaned if symbol)


def symbols_in_text(text: Column) -> Column:
    """The same for a text column: an array of cleaned symbols."""
    from_json = F.from_json(text, "array<string>")
    items = F.coalesce(from_json, F.split(text, ","))
    cleaned = F.transform(items, lambda item: F.upper(F.trim(item)))
    return F.filter(cleaned, lambda item: item != "")


def clean_symbol(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


# Fixed value: the characters that an object name cannot hold; each becomes ``_``.
_UNSAFE = "[^A-Za-z0-9_]"


def safe_symbol(symbol: Column) -> Column:
    """Symbol as part of an object name."""
    return F.regexp_replace(symbol, _UNSAFE, "_")


def safe_name(symbol: str) -> str:
    """The same for a symbol of the settings."""
    return re.sub(_UNSAFE, "_", symbol)
