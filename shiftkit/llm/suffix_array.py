"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array steps.

Suffixes are classified as smaller or larger than their successor; the
leftmost-smaller substrings are sorted by one round of induction and named;
if names repeat, the string of names is sorted by the same function; their
order then induces that of all suffixes in two linear scans.

A scan goes through buckets of equal first symbols.  Consecutive buckets none
of which induces into another are scanned together, and a run of equal
symbols is entered at once, as the wave by wave order in which its suffixes
would induce each other.  So the number of steps hangs on the alphabet and not
on the length, and every level of the recursion uses the same code.
"""

from __future__ import annotations

import numpy as np


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] items, then the same for the next."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


def _stable(keys: np.ndarray, limit: int) -> np.ndarray:
    """Stable order of small non-negative keys; narrow types sort by radix."""
    kind = np.uint8 if limit <= 1 << 8 else np.uint16 if limit <= 1 << 16 else keys.dtype
    return np.argsort(keys.astype(kind, copy=False), kind="stable")


def _batches(t: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Ranges of buckets that can be scanned together: none induces into a larger one of its range."""
    at = np.flatnonzero(t[:-1] > t[1:])
    low, high = t[at + 1].astype(np.int64), t[at].astype(np.int64)
    target = np.full(k, k, np.int64)
    if k <= 1 << 10:
        pairs = np.flatnonzero(np.bincount(low * k + high, minlength=1))
        low, high = pairs // k, pairs % k
    np.minimum.at(target, low, high)
    out, a, least = [], 0, k
    for c, v in enumerate(target.tolist()):
        if c >= least:
            out.append((a, c))
            a, least = c, k
        if v < least:
            least = v
    out.append((a, k))
    return out


def _induce(t: np.ndarray, k: int, batches: list[tuple[int, int]], run_start: np.ndarray, seed_runs: np.ndarray,
            tail: np.ndarray, first: int | None) -> np.ndarray:
    """All positions of the runs ending at ``seed_runs``, in the order of a scan over ascending symbols.

    ``tail`` are the positions that stand at the end of their buckets, in scan
    order; ``first`` is the run end that the end of the text induces.
    """
    room = np.concatenate([[0], np.cumsum(np.bincount(t[seed_runs], minlength=k))])
    seeds = np.empty(len(seed_runs), np.int32)
    head = room[:-1].copy()
    tail_at = np.searchsorted(t[tail], np.arange(k + 1))
    if first is not None:
        seeds[head[t[first]]] = first
        head[t[first]] += 1
    found = []
    for a, b in batches:
        mine = seeds[room[a]:room[b]]
        rest = tail[tail_at[a]:tail_at[b]]
        if len(mine):
            length = mine - run_start[mine] + 1
            if int(length.max()) > 1:
                wave = ragged(np.zeros(len(mine), np.int64), length)
                mine = (np.repeat(mine, length) - wave).astype(np.int32)
                key = (t[mine].astype(np.int64) - a) * (int(length.max())) + wave
                mine = mine[_stable(key, (b - a) * int(length.max()))]
            found.append(mine)
        scan = np.concatenate([mine, rest]) if len(rest) else mine
        if b - a > 1 and len(rest):
            scan = scan[_stable(t[scan] - a, b - a)]
        scan = scan[scan > 0]
        before = scan - 1
        symbol = t[before]
        up = symbol > t[scan]
        before, symbol = before[up], symbol[up]
        if len(before):
            order = _stable(symbol, k)
            before, symbol = before[order], symbol[order]
            edge = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
            count = np.diff(np.append(edge, len(symbol)))
            into = symbol[edge]
            seeds[np.repeat(head[into] - edge, count) + np.arange(len(symbol))] = before
            head[into] += count
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings in text order, equal ones alike, by their sorted order."""
    length = np.empty(len(t), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = -1                                     # it ends with the text, as no other does
    a, b = ordered[:-1], ordered[1:]
    same = np.flatnonzero((length[a] == length[b]) & (length[a] > 0))
    new = np.ones(len(ordered), bool)
    if len(same):
        n = length[a[same]]
        equal = t[ragged(a[same], n)] == t[ragged(b[same], n)]
        new[same + 1] = ~np.logical_and.reduceat(equal, np.cumsum(n) - n)
    name = np.empty(len(t), np.int32)
    name[ordered] = np.cumsum(new) - 1
    return name[lms], int(new.sum())


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of ``text`` (non-negative integers) in ascending order."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    used = np.zeros(int(text.max()) + 1, bool)
    used[text] = True
    k = int(used.sum())
    t = (np.cumsum(used) - 1).astype(np.uint8 if k <= 1 << 8 else np.uint16 if k <= 1 << 16 else np.int32)[text]
    edge = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1])          # run starts
    end = np.append(edge[1:], n) - 1
    smaller = np.zeros(len(edge), bool)                      # the last run is larger than the end of the text
    smaller[:-1] = t[edge[:-1]] < t[edge[1:]]
    run_start = np.repeat(edge, end - edge + 1).astype(np.int32)
    larger_ends, smaller_ends = end[~smaller], end[smaller]
    lms = edge[1:][smaller[1:] & ~smaller[:-1]].astype(np.int32)
    flipped = (t.dtype.type(k - 1) - t).astype(t.dtype)
    up, down = _batches(t, k), _batches(flipped, k)

    def induced(tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        larger = _induce(t, k, up, run_start, larger_ends, tail, n - 1)
        return larger, _induce(flipped, k, down, run_start, smaller_ends, larger[::-1], None)[::-1]

    order = lms[_stable(t[lms], k)]
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        _, small = induced(order)
        names, count = _names(t, lms, small[is_lms[small]])
        if count == len(lms):
            order = np.empty(len(lms), np.int32)
            order[names] = lms
        else:
            order = lms[suffix_array(names)]
    larger, small = induced(order)
    both = np.concatenate([larger, small])
    return both[_stable(t[both], k)]                         # a bucket's larger ones stand before its smaller ones


def permuted_lcp(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For every position, the bytes its suffix shares with the one before it in the suffix array ``sa``.

    Where both suffixes have the same byte before them the value is one less
    than that of the position before; only the others are compared, eight
    bytes at a time.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int32)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    alone = np.ones(n, bool)
    q = before[1:]
    alone[1:] = (q <= 0) | (text[:-1] != text[np.maximum(q, 1) - 1])
    at = np.flatnonzero(alone)
    value = np.zeros(len(at), np.int64)
    padded = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    word = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
    todo = np.flatnonzero(before[at] >= 0)
    while len(todo):
        x, y = at[todo] + value[todo], before[at[todo]] + value[todo]
        left = n - np.maximum(x, y)
        if len(todo) < 16:                                   # few long ones: each by itself, in growing pieces
            for i, p, r in zip(todo.tolist(), x.tolist(), y.tolist(), strict=True):
                size = 64
                while True:
                    m = min(size, n - max(p, r))
                    differ = np.flatnonzero(text[p:p + m] != text[r:r + m])
                    step = int(differ[0]) if len(differ) else m
                    value[i] += step
                    if len(differ) or m < size:
                        break
                    p, r, size = p + m, r + m, 2 * size
            break
        diff = word[x] ^ word[y]
        low = diff & (~diff + np.uint64(1))
        same = np.where(diff == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) >> 3)
        step = np.minimum(same, left)
        value[todo] += step
        todo = todo[(step == 8) & (left > 8)]
    back = np.maximum.accumulate(np.where(alone, np.arange(n), 0))
    rank = np.cumsum(alone) - 1
    return (value[rank] - (np.arange(n) - back)).astype(np.int32)
