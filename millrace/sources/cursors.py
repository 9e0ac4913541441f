"""Where a source goes on: pure functions from the cursor, the page and what it said. None: from the start again."""

from __future__ import annotations

from collections.abc import Sequence


def opaque(said: str | None) -> str | None:
    """A token that the service gives."""
    return said or None


def mark(cursor: str | None, said: str | None) -> str | None:
    """A token that stands still at the end."""
    return said if said and said != (cursor or "*") else None


def offset(cursor: str | None, found: int, total: int) -> str | None:
    at = int(cursor or 0) + found
    return str(at) if found and at < total else None


def full_page(cursor: str | None, found: int, limit: int) -> str | None:
    return str(int(cursor or 0) + found) if found == limit else None


def page(cursor: str | None, found: int, limit: int, total: int, first: int = 1) -> str | None:
    at = int(cursor or first)
    return str(at + 1) if found and (at - first) * limit + found < total else None


def page_of(cursor: str | None, pages: int) -> str | None:
    at = int(cursor or 0)
    return str(at + 1) if at + 1 < pages else None


def date_offset(cursor: str | None, start: str, found: int, total: int) -> str | None:
    """date/offset: the date stays while its results last."""
    date, _, at = (cursor or f"{start}/0").rpartition("/") if "/" in (cursor or "/") else (cursor, "", "0")
    done = int(at or 0) + found
    return f"{date or start}/{done}" if found and done < total else None


def newest(cursor: str | None, published: Sequence[str | None]) -> str | None:
    """The latest time seen; strings compare as they stand."""
    return max([p for p in published if p] + ([cursor] if cursor else []), default=None)


def before(urls: Sequence[str], cursor: str | None) -> list[str]:
    """A list with the newest first: what stands before the last one seen, all if that is gone."""
    return list(urls[: urls.index(cursor)]) if cursor in urls else list(urls)


def after(urls: Sequence[str], cursor: str | None) -> list[str]:
    """A fixed list: what stands after the last one seen."""
    return list(urls[urls.index(cursor) + 1 :]) if cursor in urls else list(urls)


def title_after(titles: Sequence[str], done: str | None) -> str | None:
    return done if titles and done != titles[-1] else None


def row_offset(cursor: str | None, limit: int, any_items: bool) -> str | None:
    return str(int(cursor or 0) + limit) if any_items else cursor


def last_id(ids: Sequence[int], limit: int) -> str | None:
    return str(ids[-1]) if ids and len(ids) == limit else None
