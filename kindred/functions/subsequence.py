"""Longest common subsequences of very many short string pairs at once (NumPy, one machine word a pair).

The table's rows are bit vectors of the shorter string (Hyyrö's recurrence); step ``j`` takes the ``j``-th character of every
pair's longer string, so a batch costs as many vector steps as its longest string has characters. Strings whose
shorter side has over 64 characters take the same recurrence on Python's integers, pair by pair.
"""

from __future__ import annotations

import numpy as np

#: Cells of one vector step's working set.
_CELLS = 1 << 21
_U = np.uint64


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence of one pair."""
    if a == b:
        return len(a)
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    bit = 1
    for c in a:
        where[c] = where.get(c, 0) | bit
        bit <<= 1
    full = bit - 1
    row = full
    get = where.get
    for c in b:
        hit = get(c, 0)
        if hit:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _codes(strings: list[str], width: int, fill: int) -> np.ndarray:
    """Code points, one row a string, filled up to ``width``."""
    lens = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full((len(strings), width), fill, np.uint32)
    out[np.arange(width)[None, :] < lens[:, None]] = flat
    return out


def _masks(short: list[str], long: list[str]) -> np.ndarray:
    """(pairs, characters of the longer): at which places of the shorter string each character stands, as bits."""
    m, n = max(map(len, short)), max(map(len, long))
    s, t = _codes(short, m, 0xFFFFFFFF), _codes(long, n, 0xFFFFFFFE)
    out = np.zeros(t.shape, _U)
    for i in range(m):
        out |= (s[:, i, None] == t).astype(_U) << _U(i)
    return out


def _ones(lens: np.ndarray) -> np.ndarray:
    return np.where(lens >= 64, ~_U(0), (_U(1) << np.minimum(lens, 63).astype(_U)) - _U(1))


def _chunks(order: np.ndarray, cells: np.ndarray):
    """Consecutive parts of ``order`` whose cells stay under ``_CELLS``."""
    at = 0
    while at < order.size:
        n = 1
        size = int(cells[order[at]])
        while at + n < order.size and (n + 1) * max(size, int(cells[order[at + n]])) <= _CELLS:
            size = max(size, int(cells[order[at + n]]))
            n += 1
        yield order[at : at + n]
        at += n


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of every pair ``(a[i], b[i])``."""
    out = np.zeros(len(a), np.int64)
    turned = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    m = np.array([len(x) for x, _ in turned], np.int64)
    n = np.array([len(y) for _, y in turned], np.int64)
    for i in np.flatnonzero(m > 64):
        out[i] = lcs(*turned[i])
    order = np.flatnonzero((m > 0) & (m <= 64))
    for part in _chunks(order[np.argsort(n[order], kind="stable")], n):
        short, long = [turned[i][0] for i in part], [turned[i][1] for i in part]
        masks, full = _masks(short, long), _ones(m[part])
        row = full.copy()
        for j in range(masks.shape[1]):
            u = row & masks[:, j]
            row = (row + u) | (row - u)
        out[part] = m[part] - np.bitwise_count(row & full)
    return out


def best_window_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Best ratio (0 to 100) of the shorter string of every pair with windows of the longer.

    Windows have the shorter string's length, or fewer characters at either end. Strings of equal length are
    tried both ways. Both empty: 100, one empty: 0.
    """
    out = np.zeros(len(a))
    tasks: list[tuple[int, str, str]] = []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if not x or not y:
            out[i] = 100.0 if x == y else 0.0
            continue
        s, t = (x, y) if len(x) <= len(y) else (y, x)
        if s in t:
            out[i] = 100.0
            continue
        tasks.append((i, s, t))
        if len(s) == len(t):
            tasks.append((i, t, s))
    m = np.array([len(s) for _, s, _ in tasks], np.int64)
    n = np.array([len(t) for _, _, t in tasks], np.int64)
    owner = np.array([i for i, _, _ in tasks], np.int64)
    for k in np.flatnonzero(m > 64):
        out[owner[k]] = max(out[owner[k]], _best_window(tasks[k][1], tasks[k][2]))
    order = np.flatnonzero(m <= 64)
    for part in _chunks(order[np.argsort(n[order], kind="stable")], (n + m) * 2):
        masks = _masks([tasks[k][1] for k in part], [tasks[k][2] for k in part])
        full, sizes, ends = _ones(m[part]), m[part], n[part]
        width = int((ends + sizes - 1).max())
        # Window w of a pair ends at w + 1 or at the end of the string, and begins ``size`` characters before w + 1.
        stop = np.arange(1, width + 1)[None, :]
        begin = np.maximum(stop - sizes[:, None], 0)
        stop = np.minimum(stop, ends[:, None])
        # A window is no better than its neighbour if it begins or ends with a character that the shorter string lacks.
        hit = np.concatenate([masks != 0, np.zeros((part.size, 1), bool)], axis=1)
        inside = begin < stop
        last = np.take_along_axis(hit, np.maximum(stop - 1, 0), axis=1)
        first = np.take_along_axis(hit, np.minimum(begin, masks.shape[1]), axis=1)
        use = inside & np.where(stop < ends[:, None], last, first | (begin == 0) | (stop - begin == sizes[:, None]))
        pair, window = np.nonzero(use)
        begin, stop = begin[pair, window], stop[pair, window]
        row, ones = full[pair], full[pair]
        padded = np.concatenate([masks, np.zeros((part.size, 1), _U)], axis=1)
        flat, base = padded.ravel(), pair * padded.shape[1]
        # Windows by length: those that are done leave the vector.
        by_length = np.argsort(begin - stop, kind="stable")
        base, begin, stop, row = base[by_length], begin[by_length], stop[by_length], row[by_length]
        left = np.searchsorted(-(stop - begin), -np.arange(int((stop - begin).max(initial=0))), side="left")
        for j, alive in enumerate(left.tolist()):
            u = row[:alive] & flat[base[:alive] + begin[:alive] + j]
            row[:alive] = (row[:alive] + u) | (row[:alive] - u)
        pair = pair[by_length]
        common = sizes[pair] - np.bitwise_count(row & ones[by_length])
        score = 200.0 * common / (sizes[pair] + stop - begin)
        np.maximum.at(out, owner[part][pair], score)
    return out


def _best_window(s: str, t: str) -> float:
    """As ``best_window_ratios`` for one pair, windows in order of their bound by characters in common."""
    m, n = len(s), len(t)
    need: dict[str, int] = {}
    for c in s:
        need[c] = need.get(c, 0) + 1
    spare, common, bounds, begin = dict(need), 0, [], 0
    for end in range(1, n + m):
        if end <= n and (c := t[end - 1]) in spare:
            common += spare[c] > 0
            spare[c] -= 1
        if end > m:
            if (c := t[begin]) in spare:
                spare[c] += 1
                common -= spare[c] > 0
            begin += 1
        stop = min(end, n)
        bounds.append((-200.0 * common / (m + stop - begin), begin, stop))
    best = 0.0
    for bound, begin, stop in sorted(bounds):
        if -bound <= best:
            break
        best = max(best, 200.0 * lcs(s, t[begin:stop]) / (m + stop - begin))
    return best
