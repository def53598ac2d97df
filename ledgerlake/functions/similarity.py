"""String likeness (0 to 100) as Arrow-batched functions over two columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def indel(a: str, b: str) -> float:
    """200 * longest common subsequence / total length, by bit-parallel rows."""
    if not a and not b:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & masks.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return 200.0 * (len(a) - bin(row).count("1")) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    full = [f"{both} {left}".strip(), f"{both} {right}".strip()]
    return max(indel(both, full[0]) if both else 0.0, indel(both, full[1]) if both else 0.0, indel(*full))


def _starts(a: str, b: str) -> list[int]:
    """The longest common subsequence of ``a`` and each start of ``b``, from one character on, in one pass."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, out = (1 << len(a)) - 1, []
    row = full
    for c in b:
        u = row & masks.get(c, 0)
        row = ((row + u) | (row - u)) & full
        out.append(len(a) - row.bit_count())
    return out


def partial(a: str, b: str) -> float:
    """The best likeness of the shorter text to any stretch of the longer one; of texts of one length, either way round.

    Stretches at an end of the longer text are starts of it or, read backwards, of its reverse.
    """
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    ways = [(short, long)] if n < len(long) else [(a, b), (b, a)]
    ends = [(x, y[:n]) for x, y in ways] + [(x[::-1], y[::-1][:n]) for x, y in ways]
    best = max(200.0 * l / (n + k) for x, y in ends for k, l in enumerate(_starts(x, y), 1))
    # between the ends all stretches are as long as the shorter text
    for i in range(1, len(long) - n):
        if best == 100.0:
            break
        best = max(best, indel(short, long[i : i + n]))
    return best


def name_score(a: str, b: str) -> float:
    sort, set_ = token_sort(a, b), token_set(a, b)
    score = 0.55 * sort + 0.25 * set_ + 0.20 * partial(a, b)
    if min(len(a), len(b)) < 0.55 * max(len(a), len(b)) and set_ > sort + 15:
        score *= 0.75
    return max(score, 0.0)


def _pair(score):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([score(x or "", y or "") for x, y in zip(a, b)], dtype="float64")

    return run


token_sort_ratio, token_set_ratio, partial_ratio, name_match_score = (_pair(f) for f in (token_sort, token_set, partial, name_score))
