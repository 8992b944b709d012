"""Plans for fetching: date ranges whose results fit the API's limit."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta

# Results that one query may page through, and what packed months stay under.
LIMIT, PACKED = 9_999, 9_900
OVERLAP = 7  # days before the latest fetch that are fetched again, for records that were dated back


def parse_date(text: str) -> date:
    if not (m := re.fullmatch(r"(\d{4})/(\d{1,2})/(\d{1,2})", text)):
        raise ValueError(f"not a date YYYY/MM/DD: {text!r}")
    return date(*map(int, m.groups()))


def check_range(start: str, end: str) -> tuple[date, date]:
    a, b = parse_date(start), parse_date(end)
    if a > b:
        raise ValueError("the start lies after the end")
    return a, b


def months(start: date, end: date) -> list[tuple[date, date]]:
    """The whole months from that of the start to that of the end."""
    out, at = [], start.replace(day=1)
    while at <= end:
        after = (at + timedelta(days=32)).replace(day=1)
        out.append((at, after - timedelta(days=1)))
        at = after
    return out


def pack(counted: list[tuple[date, date, int]], most: int = PACKED) -> list[tuple[date, date, int]]:
    """Neighbouring months together while their counts stay within ``most``; a larger one stands alone."""
    out: list[tuple[date, date, int]] = []
    for a, b, n in counted:
        if out and out[-1][2] + n <= most:
            out[-1] = (out[-1][0], b, out[-1][2] + n)
        else:
            out.append((a, b, n))
    return out


def halves(start: date, end: date) -> tuple[tuple[date, date], tuple[date, date]]:
    middle = start + timedelta(days=(end - start).days // 2)
    return (start, middle), (middle + timedelta(days=1), end)


def divide(start: date, end: date, total: int, count: Callable[[date, date], int]) -> Iterator[tuple[date, date, int]]:
    """A range as it is if its results fit, else its halves' ranges, down to single days.

    A day may have more than fit; its results are then fetched by their ids (``id_chunks``)."""
    if total <= LIMIT or start == end:
        if total:
            yield start, end, total
        return
    for a, b in halves(start, end):
        yield from divide(a, b, count(a, b), count)


def plan_queries(start: date, end: date, count: Callable[[date, date], int]) -> list[tuple[date, date, int]]:
    """Ranges with their counts; a month that can't be counted counts as empty."""

    def counted(a: date, b: date) -> int:
        try:
            return count(a, b)
        except Exception:  # noqa: BLE001  any transport's failure
            return 0

    whole = [(a, b, counted(a, b)) for a, b in months(start, end)]
    return [part for a, b, n in pack(whole) for part in divide(a, b, n, count)]


def id_chunks(ids: list[str], batch: int, most: int = 200) -> list[list[str]]:
    """The different ids in their order, in chunks of ``batch``, ``most`` at most."""
    once, size = list(dict.fromkeys(ids)), max(1, min(batch, most))
    return [once[k : k + size] for k in range(0, len(once), size)]


def resume_from(latest: str | None, first: str = "2000/01/01") -> str:
    """Where to go on: some days before the latest fetch date, given as ISO text; else the beginning."""
    if not latest:
        return first
    return (date.fromisoformat(latest[:10]) - timedelta(days=OVERLAP)).strftime("%Y/%m/%d")
