"""String kernels that Spark lacks, and their vectorised UDFs: Jaro-Winkler, Indel, token ratios, OSA.

Each UDF scores distinct value pairs of a batch once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free, hits_a = [True] * len(b), []
    matched_b = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                hits_a.append(c)
                matched_b.append(j)
                break
    m = len(hits_a)
    if not m:
        return 0.0
    swaps = sum(x != b[j] for x, j in zip(hits_a, sorted(matched_b))) // 2  # pairs of letters out of order
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro, raised by the common prefix of up to four letters where it exceeds 0.7."""
    s = jaro(a, b)
    if s <= 0.7:
        return s
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return s + prefix * weight * (1 - s)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    whole = row = (1 << len(a)) - 1
    for c in b:
        hit = row & place.get(c, 0)
        row = (row + hit | row - hit) & whole
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 1.0 if not total else 2 * common_subsequence(a, b) / total


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best of the ratios between the shared tokens and the shared tokens with each side's rest; 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 1.0
    shared, one, two = " ".join(both), " ".join(both + left), " ".join(both + right)
    rates = [indel_ratio(one, two)]
    if shared:
        rates += [indel_ratio(shared, one), indel_ratio(shared, two)]
    return max(rates)


def osa(a: str, b: str) -> int:
    """Edits with swaps of neighbours, no piece edited twice."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


def soft_tokens(a: list[tuple[str, float]], b: list[tuple[str, float]], threshold: float = 0.9) -> float:
    """Soft TF-IDF: equal tokens, then mutually best pairs of the rest whose Jaro-Winkler reaches threshold."""
    x, y = dict(a), dict(b)
    norm = (sum(w * w for w in x.values()) * sum(w * w for w in y.values())) ** 0.5
    if not norm:
        return 0.0
    total = sum(x[t] * y[t] for t in x.keys() & y.keys())
    left, right = sorted(x.keys() - y.keys()), sorted(y.keys() - x.keys())
    near = {(s, t): v for s in left for t in right if (v := jaro_winkler(s, t)) >= threshold}
    best_l = {s: max(((v, t) for (p, t), v in near.items() if p == s), default=None) for s in left}
    best_r = {t: max(((v, s) for (s, q), v in near.items() if q == t), default=None) for t in right}
    for s, found in best_l.items():
        if found and best_r[found[1]] and best_r[found[1]][1] == s:
            total += x[s] * y[found[1]] * found[0]
    return min(1.0, max(0.0, total / norm))


def _pairwise(kernel: Callable, a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = list(zip(a.fillna(""), b.fillna("")))
    known = {p: float(kernel(*p)) if p[0] and p[1] else 0.0 for p in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype="float64")


#: Pairs that the batched kernel lays out at once, and letters beyond which pairs go one by one.
ROWS, LETTERS = 4096, 128


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, one row each, and their lengths."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    width = max(1, int(lengths.max(initial=1)))
    return np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width), lengths


def jaro_winkler_batch(a: list[str], b: list[str], weight: float = 0.1) -> np.ndarray:
    """jaro_winkler() of many pairs: each step takes one letter of all left texts and finds its partner in all right ones."""
    out = np.zeros(len(a))
    size = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b)), dtype=np.int64, count=len(a))
    ended = np.fromiter((x[-1:] == "\0" or y[-1:] == "\0" for x, y in zip(a, b)), dtype=bool, count=len(a))
    single = (size > LETTERS) | ended  # NumPy's texts end where NULs begin
    for i in np.flatnonzero(single):
        out[i] = jaro_winkler(a[i], b[i], weight)
    order = np.flatnonzero(~single)
    order = order[np.argsort(size[order], kind="stable")]  # rows of like width
    for lo in range(0, len(order), ROWS):
        part = order[lo : lo + ROWS]
        (x, la), (y, lb) = _letters([a[i] for i in part]), _letters([b[i] for i in part])
        reach = np.maximum(0, np.maximum(la, lb) // 2 - 1)
        place, rows = np.arange(y.shape[1]), np.arange(len(part))
        free = place < lb[:, None]
        hit, taken = np.zeros(x.shape, dtype=bool), np.zeros(y.shape, dtype=bool)
        for i in range(x.shape[1]):
            near = free & (y == x[:, i : i + 1]) & (np.abs(place - i) <= reach[:, None]) & (i < la)[:, None]
            found = near.any(axis=1)
            at = near.argmax(axis=1)
            hit[:, i] = found
            free[rows[found], at[found]] = False
            taken[rows[found], at[found]] = True
        m = hit.sum(axis=1)
        # the matched letters of both sides in their order, side by side
        left, right = np.argsort(~hit, axis=1, kind="stable"), np.argsort(~taken, axis=1, kind="stable")
        width = int(m.max(initial=0))
        unlike = (np.take_along_axis(x, left[:, :width], 1) != np.take_along_axis(y, right[:, :width], 1)) & (np.arange(width) < m[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where(m > 0, (m / la + m / lb + (m - unlike.sum(axis=1) // 2) / m) / 3, 0.0)
        both = min(4, x.shape[1], y.shape[1])
        alike = (x[:, :both] == y[:, :both]) & (np.arange(both) < np.minimum(la, lb)[:, None])
        prefix = np.logical_and.accumulate(alike, axis=1).sum(axis=1)
        s = np.where(s > 0.7, s + prefix * weight * (1 - s), s)
        equal = np.fromiter((a[i] == b[i] for i in part), dtype=bool, count=len(part))
        out[part] = np.where(equal, (la > 0).astype(float), s)
    return out


@pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = list(zip(a.fillna(""), b.fillna("")))
    distinct = [p for p in dict.fromkeys(pairs) if p[0] and p[1]]
    known = dict(zip(distinct, jaro_winkler_batch([p[0] for p in distinct], [p[1] for p in distinct]).tolist()))
    return pd.Series([known.get(p, 0.0) for p in pairs], dtype="float64")


@pandas_udf(DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairwise(indel_ratio, a, b)


@pandas_udf(DoubleType())
def token_set_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairwise(token_set_ratio, a, b)


@pandas_udf(DoubleType())
def token_sort_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairwise(token_sort_ratio, a, b)


@pandas_udf(DoubleType())
def osa_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairwise(osa, a, b)
