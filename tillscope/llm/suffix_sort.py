"""Numpy kernels of the suffix-array dedup: anchors of byte windows, and deep-shallow sorting of windows.

A window is a suffix of a text seen to a depth of LENGTH bytes. Windows are sorted in buckets that
share an anchor: multikey quicksort (ternary partitions, eight bytes to a character) to a shallow
depth, then blind tries for the groups that agree so far. Both run over all groups at once.
"""

from __future__ import annotations

import numpy as np

LENGTH = 50  # bytes of a repeated string
GRAM = 20  # bytes of an anchor
REACH = LENGTH - GRAM + 1  # anchors a window can choose from
POSITION_BITS = 24  # a buffer holds less than 16 MB
ANCHOR_BITS = 64 - POSITION_BITS
SHALLOW = (0, 8)  # first bytes of the characters that the quicksort looks at
DEEP = (16, 24, 32, 40, 42)  # and of those that the tries look at; the last two overlap
BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on, from halves of doubling length."""
    held, width, parts = raw.astype(np.uint64), 1, {}
    parts[1] = held
    while width * 2 <= GRAM:
        held = held[:-width] * _power(width) + held[width:]
        width *= 2
        parts[width] = held
    total, done = parts[width], width
    rest = GRAM - width
    while rest:
        width //= 2
        if rest & width:
            size = len(raw) - done - width + 1
            total = total[:size] * _power(width) + parts[width][done : done + size]
            done, rest = done + width, rest - width
    return mix(total)


def anchors(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: (first window, number of windows, anchor place, anchor id).

    ``starts`` and ``ends`` bound the texts in the buffer; no window crosses them. The anchor of a
    window is the leftmost of its GRAM-byte strings with the least hash: it depends on the window's
    bytes only, so equal windows have equal anchors at equal places.
    """
    count = len(raw) - LENGTH + 1
    empty = np.zeros(0, np.int64)
    if count <= 0:
        return empty, empty, empty, empty.astype(np.uint64)
    low = np.uint64((1 << POSITION_BITS) - 1)
    best = _gram_hashes(raw)
    best = (best & ~low) | np.arange(len(best), dtype=np.uint64)
    width = 1
    while width * 2 <= REACH:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[:count], best[REACH - width : REACH - width + count])
    edge = np.zeros(len(raw) + 1, np.int32)
    inner = ends - starts >= LENGTH
    np.add.at(edge, starts[inner], 1)
    np.add.at(edge, ends[inner] - LENGTH + 1, -1)
    valid = np.cumsum(edge[:-1])[:count] > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (best[1:] != best[:-1])
    # texts that touch: the first window of a text starts a run of its own
    opening = starts[inner]
    first[opening[opening < count]] = True
    head = np.flatnonzero(first)
    after = np.cumsum(valid)
    bounds = np.concatenate((head, [count]))
    number = after[bounds[1:] - 1] - after[bounds[:-1]] + 1
    # least hashes crowd at the low end; mixed once more, ids are even over their range
    return head, number, (best[head] & low).astype(np.int64), mix(best[head] >> np.uint64(POSITION_BITS)) >> np.uint64(64 - ANCHOR_BITS)


def characters(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number (zeros past the end)."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
    two = (padded[:-1] << np.uint64(8)) | padded[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    return (four[:-4] << np.uint64(32)) | four[4:]


def _heads(keys: np.ndarray) -> np.ndarray:
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    return head


def _shared(head: np.ndarray) -> np.ndarray:
    """Mask of the rows whose group has two rows or more."""
    alone = head.copy()
    alone[:-1] &= head[1:]
    return ~alone


def _quicksort(chars: np.ndarray, order: np.ndarray, head: np.ndarray) -> None:
    """Refine groups in place by one character: three-way partitions round a pivot, all groups at once."""
    live = np.flatnonzero(_shared(head))
    while len(live):
        inner = head[live]
        group = np.cumsum(inner) - 1
        begin = np.flatnonzero(inner)
        size = np.diff(np.append(begin, len(live)))
        value = chars[order[live]]
        pivot = value[begin + size // 2][group]
        side = 1 + (value > pivot).astype(np.int64) - (value < pivot)
        keep = np.logical_or.reduceat(side != 1, begin)[group]
        if not keep.any():
            return
        live, group, side = live[keep], group[keep], side[keep]
        key = group * 3 + side
        turn = np.argsort(key, kind="stable")
        order[live] = order[live][turn]
        key = key[turn]
        head[live] |= _heads(key)
        # the middle parts are equal in this character; the outer ones go on
        live = live[key % 3 != 1]
        live = live[_shared(head[live])]


def _tries(chars: np.ndarray, windows: np.ndarray, order: np.ndarray, head: np.ndarray) -> None:
    """Order groups with a long common prefix by blind tries, all groups at once.

    The first window of a group is the spine of its trie. Every other window leaves the spine at the
    first byte in which it differs (or ends at the same leaf); windows that leave at the same place
    by the same byte are a group of their own. Along the spine, smaller branches come before it from
    the top down and larger ones after it from the bottom up.
    """
    live = np.flatnonzero(_shared(head))
    while len(live):
        inner = head[live]
        group = np.cumsum(inner) - 1
        place = windows[order[live]]
        spine = place[np.flatnonzero(inner)][group]
        depth = np.full(len(live), LENGTH, np.int64)
        branch, larger = np.zeros(len(live), np.int64), np.zeros(len(live), bool)
        open_ = np.ones(len(live), bool)
        for at in DEEP:
            mine, its = chars[place + at], chars[spine + at]
            differ = open_ & (mine != its)
            if differ.any():
                a, b = mine[differ], its[differ]
                byte = np.zeros(len(a), np.int64)
                gap = a ^ b
                for n in range(1, 8):  # leading equal bytes
                    byte += gap < np.uint64(1 << (64 - 8 * n))
                depth[differ] = at + byte
                branch[differ] = ((a >> (np.uint64(8) * (np.uint64(7) - byte.astype(np.uint64)))) & np.uint64(255)).astype(np.int64)
                larger[differ] = a > b
                open_ &= ~differ
        side = np.where(open_, 1, np.where(larger, 2, 0))
        along = np.where(side == 0, depth, np.where(side == 2, LENGTH - depth, 0))
        key = ((group * 3 + side) * 64 + along) * 256 + branch
        turn = np.argsort(key, kind="stable")
        order[live] = order[live][turn]
        head[live] |= _heads(key[turn])
        live = live[side[turn] != 1]
        live = live[_shared(head[live])]


def deep_shallow(raw: np.ndarray, windows: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the windows of each bucket: (order, head), head marking the first of each run of equal windows."""
    order = np.argsort(bucket, kind="stable")
    head = _heads(bucket[order])
    if len(order):
        chars = characters(raw)
        for at in SHALLOW:
            _quicksort(chars[windows + at], order, head)
        _tries(chars, windows, order, head)
    return order, head


def repeats(doc: np.ndarray, order: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose string also starts in a smaller document, and one window per string and smallest document."""
    if not len(order):
        none = np.zeros(0, np.int64)
        return none, none
    ids = doc[order]
    begin = np.flatnonzero(head)
    least = np.minimum.reduceat(ids, begin)
    again = ids > least[np.cumsum(head) - 1]
    return order[again], order[~again]


def common(doc: np.ndarray, order: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose string starts in two documents or more, and those that must be compared further:
    one window for each such string, and all windows of the other strings."""
    if not len(order):
        none = np.zeros(0, np.int64)
        return none, none
    ids = doc[order]
    begin = np.flatnonzero(head)
    several = (np.minimum.reduceat(ids, begin) != np.maximum.reduceat(ids, begin))[np.cumsum(head) - 1]
    return order[several], order[~several | head]
