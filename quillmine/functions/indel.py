"""Similarity of two strings by insertions and deletions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillmine.functions.arrow import with_columns


def _shared(a: str, b: str) -> int:
    """How many characters both strings begin with, by bisection."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def indel_ratio(a: str | None, b: str | None) -> float:
    """200 times the longest common subsequence over both lengths; two empty strings are alike.

    The subsequence's length by bit-parallel dynamic programming over Python's integers (Hyyrö, 2004); what both
    begin and end with belongs to it.
    """
    a, b = a or "", b or ""
    if not a and not b:
        return 100.0
    if a == b:
        return 100.0
    size = len(a) + len(b)
    if a.startswith(b) or b.startswith(a):
        return 200.0 * min(len(a), len(b)) / size
    same = _shared(a, b)
    a, b = a[same:], b[same:]
    end = _shared(a[::-1], b[::-1])
    a, b, same = a[: len(a) - end], b[: len(b) - end], same + end
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b if a else "":
        u = row & at.get(c, 0)
        row = (row + u | row - u) & full
    return 200.0 * (same + len(a) - row.bit_count()) / size


def with_ratio(pairs: DataFrame, a: str, b: str, name: str = "ratio") -> DataFrame:
    return with_columns(pairs, [a, b], f"{a} string, {b} string, {name} double", lambda x, y: (x, y, indel_ratio(x, y)))
