"""All registered queries of the library and their oracle SQL."""

from __future__ import annotations

from .queries import activity, history, learning, named, reading, texts, whole

AREAS = (texts, reading, activity, whole, history, learning, named)


def queries() -> dict:
    return {name: fn for area in AREAS for name, fn in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.SQL.items()}
