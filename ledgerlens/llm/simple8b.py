"""Simple-8b: unsigned integers packed into 64-bit words, the top four bits of a word choosing how.

Selectors 0 and 1 stand for 240 and 120 zeros; 2 to 15 for 60 values of 1 bit down to 1 value of 60 bits (fixed values
below).  A value of more than 60 bits is an escape: selector 15 with all 60 bits set, and the value in the word behind
it; 2**60 - 1 itself is written that way, too.  Words are little-endian.  A stream is cut into groups of ``GROUP``
values that each start a new word; the word offset of every group is kept beside the words, so groups are coded and
decoded side by side as arrays.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: (values, bits) of each selector; fixed values of the format
LAYOUT = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
          (4, 15), (3, 20), (2, 30), (1, 60))
GROUP = 512
ESCAPE = (1 << 60) - 1
_COUNT = np.array([n for n, _ in LAYOUT], np.int64)


_BITS = np.zeros(1 << 16, np.uint8)
for _b in range(16):
    _BITS[1 << _b:] = _b + 1


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; 61 for those that need an escape."""
    if not len(values) or values.max() < 1 << 16:
        return _BITS[values.astype(np.uint16)]
    width = _BITS[(values & U64(0xFFFF)).astype(np.uint16)]
    for b in (16, 32, 48):
        part = ((values >> U64(b)) & U64(0xFFFF)).astype(np.uint16)
        width = np.where(part > 0, _BITS[part] + np.uint8(b), width)
    return np.where(values >= U64(ESCAPE), np.uint8(61), width)


def _first_fit(width: np.ndarray) -> np.ndarray:
    """The first selector a word can have that starts at each value; ``width`` is (groups, values), 0 past the end."""
    groups, n = width.shape
    pad = np.zeros((groups, n + 240), np.uint8)
    pad[:, :n] = width
    # widest value of the next 1, 2, 4, ... values; other lengths are two of those that overlap
    widest = {1: pad}
    size = 1
    while size < 32:
        w = widest[size]
        widest[2 * size] = np.maximum(w, np.pad(w[:, size:], ((0, 0), (0, size))))
        size *= 2
    best = np.full((groups, n), 15, np.uint8)
    for s in range(14, 1, -1):
        count, bits = LAYOUT[s]
        p = 1 << (count.bit_length() - 1)
        most = np.maximum(widest[p][:, :n], widest[p][:, count - p:count - p + n])
        best[most <= bits] = s
    if (width == 0).sum() >= 120:
        for s in (1, 0):
            count = LAYOUT[s][0]
            zeros = np.cumsum(np.pad(pad > 0, ((0, 0), (1, 0))), axis=1, dtype=np.int32)
            free = zeros[:, count:count + n] == zeros[:, :n]
            free[:, max(0, n - count + 1):] = False          # a run of zeros must be full
            best[free[:, :n]] = s
    return best


def encode(values: np.ndarray, group: int = GROUP) -> tuple[np.ndarray, np.ndarray]:
    """(words uint64, word offset of every group and the end) of uint64 values.

    A word may hold fewer values than its selector names if the group ends in it; runs of zeros are always full.
    """
    values = np.ascontiguousarray(values, U64)
    n = len(values)
    if not n:
        return np.zeros(0, U64), np.zeros(1, np.int64)
    groups = -(-n // group)
    flat = np.zeros(groups * group + 60, U64)
    flat[:n] = values
    width = _widths(flat[:groups * group]).reshape(groups, group)
    ends = np.minimum(np.arange(1, groups + 1) * group, n)
    pick = _first_fit(width)
    short = n - (groups - 1) * group                     # zeros past the end must not look like a run
    if short < group:
        tail = pick[-1]
        tail[(tail < 2) & (np.arange(group) + _COUNT[tail] > short)] = 2
    pick = pick.reshape(-1)
    step = _COUNT[pick]
    # follow the words of all groups in step
    at, live, places = np.arange(groups) * group, np.arange(groups), []
    while len(live):
        here = at[live]
        places.append(here)
        here = here + step[here]
        at[live] = here
        live = live[here < ends[live]]
    place = np.sort(np.concatenate(places))
    sel = pick[place]
    words = sel.astype(U64) << U64(60)
    stop = ends[place // group]
    for s in range(2, 16):
        mine = np.flatnonzero(sel == s)
        if not len(mine):
            continue
        count, bits = LAYOUT[s]
        idx = place[mine][:, None] + np.arange(count)
        v = flat[idx]
        v[idx >= stop[mine][:, None]] = 0
        if s == 15:
            v = np.minimum(v, U64(ESCAPE))
        words[mine] |= np.bitwise_or.reduce(v << (U64(bits) * np.arange(count, dtype=U64)), axis=1)
    escaped = (sel == 15) & (flat[place] >= U64(ESCAPE))
    size = 1 + escaped
    where = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), U64)
    out[where] = words
    out[where[escaped] + 1] = flat[place[escaped]]
    return out, np.append(where[np.searchsorted(place, np.arange(groups) * group)], len(out)).astype(np.int64)


def decode(words: np.ndarray, n: int, offsets: np.ndarray, group: int = GROUP) -> np.ndarray:
    """The ``n`` values of ``encode``."""
    if not n:
        return np.zeros(0, U64)
    words = np.ascontiguousarray(words, U64)
    sel = (words >> U64(60)).astype(np.uint8)
    raw = np.zeros(len(words) + 1, bool)                 # words that are escaped values, not codes
    for i in np.flatnonzero(words == U64((15 << 60) | ESCAPE)):
        if not raw[i]:                                   # rare; in order: an escaped value may look like an escape
            raw[i + 1] = True
    head = np.flatnonzero(~raw[:-1])
    sel, body = sel[head], words[head] & U64(ESCAPE)
    count = _COUNT[sel]
    # place of each word's first value: running count within its group
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(head, offsets)))
    total = np.cumsum(count) - count
    place = total - total[np.searchsorted(head, offsets[:-1])][of] + of * group
    end = np.minimum((of + 1) * group, n)
    out = np.zeros(n + 240, U64)
    for s in range(2, 16):
        mine = np.flatnonzero(sel == s)
        if not len(mine):
            continue
        k, bits = LAYOUT[s]
        v = (body[mine][:, None] >> (U64(bits) * np.arange(k, dtype=U64))) & U64((1 << bits) - 1)
        to = place[mine][:, None] + np.arange(k)
        if (place[mine] + k > end[mine]).any():
            inside = to < end[mine][:, None]
            out[to[inside]] = v[inside]
        else:
            out[to] = v
    escaped = np.flatnonzero((sel == 15) & (body == U64(ESCAPE)))
    out[place[escaped]] = words[head[escaped] + 1]
    return out[:n]
