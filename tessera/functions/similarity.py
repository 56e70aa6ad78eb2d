"""String similarities that SQL lacks, in one Arrow-batched function for each field.

Published algorithms: bit-parallel longest common subsequence, sliding windows, Jaro and Winkler. Scores run from 0
to 1. Repeated pairs within a batch are computed once, and many pairs of short texts at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf


def _places(a: str) -> dict[str, int]:
    """For each character the bits of its places."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    return where


def _lcs(where: dict[str, int], n: int, b: str) -> int:
    """lcs of b and a text of n characters that stand at the given places."""
    row = full = (1 << n) - 1
    for ch in b:
        if hit := row & where.get(ch, 0):
            row = (row + hit | row - hit) & full
    return n - row.bit_count()


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: a bit for each character of a, one addition for each of b."""
    if a == b:
        return len(a)
    return _lcs(_places(a), len(a), b) if a and b else 0


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2 * lcs(a, b) / total if total else 1.0


@lru_cache(1 << 12)
def _in_order(a: str) -> str:
    return " ".join(sorted(a.split()))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(_in_order(a), _in_order(b))


def token_set_ratio(a: str, b: str) -> float:
    """Best of the common tokens against each side's, and of the two sides' differences behind the common tokens."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (x <= y or y <= x):
        return 1.0
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    n = len(" ".join(sorted(both)))
    gap = 1 if n else 0
    total = 2 * (n + gap) + len(left) + len(right)
    best = 1 - (len(left) + len(right) - 2 * lcs(left, right)) / total if total else 1.0
    if n:
        best = max(best, *(1 - (gap + len(d)) / (2 * n + gap + len(d)) for d in (left, right)))
    return best


def token_ratio(a: str, b: str) -> float:
    return max(token_sort_ratio(a, b), token_set_ratio(a, b))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against a window of the longer one; windows may hang over its ends."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) == len(b):
        return max(_windows(a, b), _windows(b, a))
    return _windows(*sorted((a, b), key=len))


def _windows(short: str, long: str) -> float:
    """The best window that ends at each place in turn. From one window to the next the subsequence grows by one at most, so
    after a poor window those that cannot reach the best are left out."""
    m, n, best, end = len(short), len(long), 0.0, 1
    where = _places(short)
    while end < n + m:
        start = max(0, end - m)
        size = min(end, n) - start
        common = _lcs(where, m, long[start : start + size])
        best = max(best, 2 * common / (m + size))
        if best == 1.0:
            break
        at, end = end, end + 1
        while end < n + m and 2 * (common + end - at) <= best * (m + min(end, n) - max(0, end - m)):
            end += 1
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 1.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def weighted_ratio(a: str, b: str) -> float:
    """Ratio, token and partial forms, the latter for lower weights the more the lengths differ."""
    if not a or not b:
        return 0.0
    times = max(len(a), len(b)) / min(len(a), len(b))
    if times < 1.5:
        return max(ratio(a, b), 0.95 * token_ratio(a, b))
    k = 0.9 if times <= 8 else 0.6
    return max(ratio(a, b), k * partial_ratio(a, b), 0.95 * k * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    where, free, left = _places(b), (1 << len(b)) - 1, []
    for i, ch in enumerate(a):
        # the first free place of the character within reach
        hit = where.get(ch, 0) & free & (1 << i + reach + 1) - 1
        hit = hit >> (low := max(0, i - reach)) << low
        if hit:
            free ^= hit & -hit
            left.append(ch)
    m = len(left)
    if not m:
        return 0.0
    right = [ch for j, ch in enumerate(b) if not free >> j & 1]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


KINDS = {
    "ratio": ratio,
    "wratio": weighted_ratio,
    "token_sort_ratio": token_sort_ratio,
    "token_set_ratio": token_set_ratio,
    "token_ratio": token_ratio,
    "partial_ratio": partial_ratio,
    "jaro_winkler": jaro_winkler,
}


#: Pairs that are made at once (by windows, by places), the least for which that pays, and the most characters of a text.
AT_ONCE, AT_ONCE_LCS, FEW, FEW_LCS, SHORT = 1 << 11, 1 << 13, 48, 48, 120


def _codes(*sides: list[str], words: int = -1) -> list[np.ndarray]:
    """A row of small numbers for each text, the same ones on all sides, filled up with a number that only this side has; side
    words to a multiple of 64 places."""
    points = [np.frombuffer("".join(x).encode("utf-32-le", "surrogatepass"), np.uint32) for x in sides]
    present = np.zeros(1 + max((int(p.max()) for p in points if len(p)), default=0), bool)
    for p in points:
        present[p] = True
    number = np.cumsum(present) - 1
    top, out = int(number[-1]) + 1, []
    for k, (x, p) in enumerate(zip(sides, points)):
        sizes = np.fromiter(map(len, x), np.int64, len(x))
        width = max(1, int(sizes.max(initial=0)))
        rows = np.full((len(x), -(-width // 64) * 64 if k == words else width), top + k, np.uint8 if top + len(sides) <= 256 else np.uint32)
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = number[p]
        out.append(rows)
    return out


def _bits(where: np.ndarray) -> list[np.ndarray]:
    """Truth values of 64 places each, as numbers."""
    return list(np.packbits(where, axis=1, bitorder="little").view("<u8").T)


def _lcs_many(left: list[str], right: list[str]) -> np.ndarray:
    """lcs of each pair: the additions of _lcs, of a column of right characters at a time."""
    a, b = _codes(left, right, words=0)
    full = ~np.uint64(0)
    rows = [np.full(len(left), full) for _ in range(a.shape[1] // 64)]
    for ch in b.T:
        carry = None
        for w, hits in enumerate(_bits(a == ch[:, None])):
            row = rows[w]
            hit = row & hits
            total = row + hit
            over = total < row
            if carry is not None:
                total += carry
                over |= total < carry
            rows[w], carry = total | row - hit, over.astype(np.uint64)
    return np.sum([64 - np.bitwise_count(row).astype(np.int64) for row in rows], axis=0)


def _combed(short: list[str], long: list[str]) -> tuple[np.ndarray, int]:
    """For each pair (a column) and each place of the long text the strand that leaves the grid there, and the rows of the grid.

    Strands m + i start above place i of the long text. Two strands cross once at most, and never at a match (Tiskin's
    semi-local comparison); so lcs(short, long[i:j]) is j - i less the strands from m + i on that leave before j. Texts
    are filled up with characters that match nothing.
    """
    a, b = (np.ascontiguousarray(x.T) for x in _codes(short, long))
    m, n = len(a), len(b)
    strand = np.uint8 if m + n < 256 else np.uint16
    down = list(np.repeat(np.arange(m, m + n, dtype=strand)[:, None], len(short), 1))
    spare = np.empty(len(short), strand)
    for i in range(m):
        across, other = np.full(len(short), m - 1 - i, strand), np.negative((b != a[i]).astype(strand))
        for j, differ in enumerate(other):
            # the greater strand goes down, at a match the one from across
            v = down[j]
            np.bitwise_and(v, differ, out=spare)
            np.maximum(across, spare, out=spare)
            np.bitwise_xor(across, v, out=across)
            np.bitwise_xor(across, spare, out=across)
            down[j], spare = spare, v
    return np.array(down), m


def _windows_many(short: list[str], long: list[str]) -> np.ndarray:
    """_windows of each pair."""
    down, m = _combed(short, long)
    n, pairs = down.shape
    sizes, lengths = (np.fromiter(map(len, x), np.int64, pairs) for x in (short, long))
    ends, column = np.full((n, pairs), n + m, np.int32), np.arange(pairs)
    place, col = np.nonzero((down >= m) & (np.arange(n)[:, None] < lengths))
    ends[down[place, col].astype(np.int64) - m, col] = place
    lost, best = np.zeros(pairs, np.int64), np.zeros(pairs)
    for end in range(1, n + int(sizes.max())):
        start = np.maximum(0, end - sizes)
        if end <= n:
            lost += (down[end - 1] >= m + np.maximum(0, start - 1)) & (end <= lengths)
        before = np.minimum(start, n) - 1
        lost -= (start > 0) & (start <= n) & (ends[before, column] < np.minimum(end, lengths))
        size = np.minimum(end, lengths) - start
        best = np.maximum(best, np.where(size > 0, 2 * (size - lost) / (sizes + np.maximum(size, 0)), 0.0))
    return best


#: The k lowest bits.
_LOW = np.array([(1 << k) - 1 for k in range(65)], np.uint64)


def _jaro_winkler_many(left: list[str], right: list[str]) -> np.ndarray:
    """jaro_winkler of each pair, place by place of the left texts."""
    a, b = _codes(left, right, words=1)
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    reach = np.maximum(0, np.maximum(n, m) // 2 - 1)
    free = [np.full(len(left), ~np.uint64(0)) for _ in range(b.shape[1] // 64)]
    met = np.zeros(a.shape, bool)
    for i, ch in enumerate(a.T):
        for w, same in enumerate(_bits(b == ch[:, None])):
            low, high = (np.clip(x - 64 * w, 0, 64) for x in (i - reach, i + reach + 1))
            hit = same & free[w] & _LOW[high] & ~_LOW[low]
            hit &= ~hit + np.uint64(1)
            hit[met[:, i]] = 0
            free[w] ^= hit
            met[:, i] |= hit != 0
    used = np.unpackbits(~np.stack(free, 1).astype("<u8").view(np.uint8).reshape(len(left), -1), axis=1, bitorder="little").astype(bool)
    common = met.sum(1)
    swaps = np.bincount(np.nonzero(met)[0], a[met] != b[used], len(left)).astype(np.int64) // 2
    k = np.maximum(common, 1)
    jaro = np.where(common > 0, (common / np.maximum(n, 1) + common / np.maximum(m, 1) + (common - swaps) / k) / 3, 0.0)
    first = min(4, a.shape[1], b.shape[1])
    same = np.cumprod(a[:, :first] == b[:, :first], axis=1).sum(1)
    out = np.where(jaro <= 0.7, jaro, jaro + 0.1 * same * (1 - jaro))
    return np.where((n == 0) & (m == 0), 1.0, out)


class _Asked:
    """Pairs of texts of which a function is wanted, each once, by number; then its values."""

    def __init__(self, one: Callable, many: Callable, at_once: int, least: int):
        self.one, self.many, self.at_once, self.least, self.pairs = one, many, at_once, least, {}

    def __call__(self, a: str, b: str) -> int:
        return self.pairs.setdefault((a, b), len(self.pairs))

    def values(self) -> np.ndarray:
        """Pairs alike in length are made at once; fewer than pay, and long texts, by themselves."""
        pairs = list(self.pairs)
        sizes = np.array([(len(a), len(b)) for a, b in pairs], np.int64).reshape(-1, 2)
        out = np.zeros(len(pairs))
        order = np.lexsort((sizes[:, 1], sizes[:, 0] // 16))
        fits = (sizes <= SHORT).all(1)[order]
        parts = [order[fits][i : i + self.at_once] for i in range(0, int(fits.sum()), self.at_once)]
        for part in parts:
            own = [pairs[i] for i in part.tolist()]
            out[part] = self.many(*map(list, zip(*own))) if len(own) >= self.least else [self.one(a, b) for a, b in own]
        for i in order[~fits].tolist():
            out[i] = self.one(*pairs[i])
        return out


def _max(*values: np.ndarray) -> np.ndarray:
    return np.maximum.reduce(values)


class _Many:
    """KINDS of many pairs: what they ask of lcs and of windows is gathered, made at once, and put together column by column."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.pairs = pairs
        self.common = _Asked(lcs, _lcs_many, AT_ONCE_LCS, FEW_LCS)
        self.best = _Asked(_windows, _windows_many, AT_ONCE, FEW)
        self.sizes = self._lengths([a for a, _ in pairs]), self._lengths([b for _, b in pairs])

    @staticmethod
    def _lengths(texts: list[str]) -> np.ndarray:
        return np.fromiter(map(len, texts), np.int64, len(texts))

    def columns(self, kinds: tuple[str, ...]) -> list[np.ndarray]:
        made: dict = {}

        def get(part: str):
            """Two calls make a part: the first asks, the second tells."""
            if part not in made:
                made[part] = getattr(self, f"_{part}")(get)
            return made[part]

        tell = [get(k) for k in kinds]
        self.lcs, self.windows = self.common.values(), self.best.values()
        return [f() for f in tell]

    def _ratio_of(self, pairs: list[tuple[str, str]]) -> Callable:
        # the shorter text first: its places are bits
        at = np.array([self.common(a, b) if len(a) <= len(b) else self.common(b, a) for a, b in pairs], np.int64)
        total = np.array([len(a) + len(b) for a, b in pairs], np.int64)
        return lambda: np.where(total > 0, 2 * self.lcs[at] / np.maximum(total, 1), 1.0)

    def _partial_of(self, pairs: list[tuple[str, str]], wanted: Iterable[bool]) -> Callable:
        """partial_ratio of the wanted pairs, 0 for the others."""
        fixed, at = np.zeros(len(pairs)), np.full((len(pairs), 2), -1, np.int64)
        for i, ((a, b), w) in enumerate(zip(pairs, wanted)):
            if not w:
                continue
            if not a or not b:
                fixed[i] = 1.0 if a == b else 0.0
            elif len(a) <= len(b):
                at[i] = self.best(a, b), self.best(b, a) if len(a) == len(b) else -1
            else:
                at[i, 0] = self.best(b, a)
        return lambda: _max(fixed, *np.where(at >= 0, np.append(self.windows, 0.0)[at], 0.0).T)

    def _tokens(self, get) -> tuple:
        """Both sides in order, their differences, the length of the common tokens joined, and whether each side, and they, are none."""
        split: dict = {}
        for t in {t for p in self.pairs for t in p}:
            words = sorted(t.split())
            split[t] = " ".join(words), frozenset(words)
        ordered, apart, shared = [], [], np.zeros((len(self.pairs), 3), np.int64)
        for i, (a, b) in enumerate(self.pairs):
            (s, x), (t, y) = split[a], split[b]
            both = x & y
            ordered.append((s, t))
            if both:
                apart.append((" ".join(sorted(x - both)), " ".join(sorted(y - both))))
                shared[i] = sum(map(len, both)) + len(both) - 1, len(both), len(both) == len(x) or len(both) == len(y)
            else:
                apart.append((" ".join(sorted(x)), " ".join(sorted(y))))
                shared[i, 2] = -(not x or not y)
        return ordered, apart, shared

    def _ratio(self, get) -> Callable:
        return self._ratio_of(self.pairs)

    def _token_sort_ratio(self, get) -> Callable:
        return self._ratio_of(get("tokens")[0])

    def _token_set_ratio(self, get) -> Callable:
        _, apart, shared = get("tokens")
        at = np.array([self.common(a, b) if len(a) <= len(b) else self.common(b, a) for a, b in apart], np.int64)
        left, right = (self._lengths(list(x)) for x in zip(*apart))
        n, whole = shared[:, 0], shared[:, 2]

        def tell() -> np.ndarray:
            gap = (n > 0).astype(np.int64)
            total = 2 * (n + gap) + left + right
            best = 1 - (left + right - 2 * self.lcs[at]) / np.maximum(total, 1)
            each = [np.where(n > 0, 1 - (gap + d) / np.maximum(2 * n + gap + d, 1), 0.0) for d in (left, right)]
            return np.where(whole > 0, 1.0, np.where(whole < 0, 0.0, np.where(n > 0, _max(best, *each), best)))

        return tell

    def _token_ratio(self, get) -> Callable:
        order, sets = get("token_sort_ratio"), get("token_set_ratio")
        return lambda: np.maximum(order(), sets())

    def _partial_ratio(self, get) -> Callable:
        return self._partial_of(self.pairs, [True] * len(self.pairs))

    def _wratio(self, get) -> Callable:
        n, m = self.sizes
        some = (n > 0) & (m > 0)
        times = np.where(some, np.maximum(n, m) / np.maximum(np.minimum(n, m), 1), 1.0)
        far = some & (times >= 1.5)
        ratio, token = get("ratio"), get("token_ratio")
        ordered, apart, shared = get("tokens")
        partial = self._partial_of(self.pairs, far.tolist())
        none = (far & (shared[:, 1] == 0)).tolist()
        parts = [self._partial_of(x, none) for x in (ordered, apart)]

        def tell() -> np.ndarray:
            k = np.where(times <= 8, 0.9, 0.6)
            tokens = np.where(shared[:, 1] > 0, 1.0, _max(*(f() for f in parts)))
            long = _max(ratio(), k * partial(), 0.95 * k * tokens)
            return np.where(some, np.where(far, long, _max(ratio(), 0.95 * token())), 0.0)

        return tell

    def _jaro_winkler(self, get) -> Callable:
        asked = _Asked(jaro_winkler, _jaro_winkler_many, AT_ONCE_LCS, FEW_LCS)
        at = np.array([asked(a, b) for a, b in self.pairs], np.int64)
        return lambda: asked.values()[at]


def scores_of(pairs: list[tuple[str, str]], kinds: tuple[str, ...]) -> list[tuple[float, ...]]:
    """KINDS of each pair; each distinct pair is made once."""
    distinct = list(dict.fromkeys(pairs))
    if len(distinct) >= FEW:
        found = dict(zip(distinct, zip(*(c.tolist() for c in _Many(distinct).columns(kinds)))))
    else:
        found = {p: tuple(KINDS[k](*p) for k in kinds) for p in distinct}
    return [found[p] for p in pairs]


def _scorer(kinds: tuple[str, ...]):
    @pandas_udf(", ".join(f"{k} double" for k in kinds))
    def scores(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(scores_of([(x or "", y or "") for x, y in zip(a, b)], kinds), columns=list(kinds), dtype="float64")

    return scores


def similarities(a: Column, b: Column, *kinds: str) -> Column:
    """A struct with one field for each kind; null counts as empty."""
    return _scorer(kinds or tuple(KINDS))(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))
