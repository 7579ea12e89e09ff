"""Column-name matching. Works on the schema only, never on data."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable


def plain_header(name: str) -> str:
    """Header of a cost list: trimmed, lower case, no spaces or underscores."""
    return name.strip().lower().replace(" ", "").replace("_", "")


def token(name: str) -> str:
    """Header of a sales file: lower case words joined by one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def by_token(columns: Iterable[str]) -> dict[str, str]:
    """Token to column name; of several columns with one token the first wins."""
    found: dict[str, str] = {}
    for name in columns:
        found.setdefault(token(name), name)
    return found


def collisions(columns: Iterable[str]) -> dict[str, list[str]]:
    """Tokens that more than one column maps to, such as ``Margin`` and ``Margin%``."""
    groups: dict[str, list[str]] = defaultdict(list)
    for name in columns:
        groups[token(name)].append(name)
    return {key: names for key, names in groups.items() if len(names) > 1}


def pick(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First candidate that names a column, as that column is really called."""
    known = by_token(columns)
    return next((known[token(c)] for c in candidates if token(c) in known), None)
