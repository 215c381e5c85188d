"""Small helpers for fixtures."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime


def d(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def rows(df, *columns) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]


def counted(df, *columns) -> Counter:
    return Counter(rows(df, *columns))
