"""Self-join of fingerprints by a binary trie, inside the cells of a partition.

A trie node is a range of the sorted fingerprints. Pairs of nodes are traversed
together, all pairs of a step at once in numpy; a pair carries the number of bits
in which its two prefixes differ and is dropped beyond the budget. The join wants
the connected components, not every link: a pair of nodes whose members are all
known to be connected is dropped as well, so a large group of near copies costs
little more than its size.
"""

from __future__ import annotations

import numpy as np

LEAF = 32  # pairs of fingerprints below which two nodes are compared outright
CHUNK = 1 << 17  # node pairs in hand at once


def forest(cell: np.ndarray, keys: np.ndarray, group: np.ndarray, budget: int, depth: int = 0):
    """Edges (two arrays of row numbers) that span the components of each cell.

    ``cell``: rows of different cells are never compared. ``keys``: uint64, one row of
    words per fingerprint; inside a cell all share the first ``depth`` bits. ``group``:
    rows of one cell with one group other than -1 are known to be connected.
    """
    n, width = keys.shape
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort([keys[:, w] for w in range(width - 1, -1, -1)] + [cell])
    cell, keys, group = cell[order], keys[order], group[order]
    root = np.arange(n)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.r_[starts[1:], n]

    def linked(root, a, b):
        close = _apart(keys, a, b) <= budget
        return _merged(root, a[close], b[close])

    root = _known(root, cell, group)
    same = np.flatnonzero((cell[1:] == cell[:-1]) & (keys[1:] == keys[:-1]).all(1))
    root = linked(root, same, same + 1)
    # A hub for each cell: whatever lies within the budget of it is connected.
    hub = np.repeat((starts + ends) // 2, ends - starts)
    root = linked(root, np.arange(n), hub)

    many = ends - starts > 1
    stack = [(depth, starts[many], ends[many], starts[many], ends[many], np.zeros(many.sum(), np.int16))]
    while stack:
        at, la, ha, lb, hb, spent = stack.pop()
        if len(la) > CHUNK:
            stack.append((at, la[CHUNK:], ha[CHUNK:], lb[CHUNK:], hb[CHUNK:], spent[CHUNK:]))
            la, ha, lb, hb, spent = la[:CHUNK], ha[:CHUNK], lb[:CHUNK], hb[:CHUNK], spent[:CHUNK]
        changes = np.r_[0, np.cumsum(root[1:] != root[:-1])]
        joined = (changes[ha - 1] == changes[la]) & (changes[hb - 1] == changes[lb]) & (root[la] == root[lb])
        open_ = ~joined
        la, ha, lb, hb, spent = la[open_], ha[open_], lb[open_], hb[open_], spent[open_]
        pairs = (ha - la) * (hb - lb)
        small = (pairs <= LEAF) | (at >= 64 * width)
        if small.any():
            root = linked(root, *_all_pairs(la[small], ha[small], lb[small], hb[small]))
        big = ~small
        if big.any():
            stack.append((at + 1, *_children(keys, at, la[big], ha[big], lb[big], hb[big], spent[big], budget)))
    away = np.flatnonzero(root != np.arange(n))
    return order[away], order[root[away]]


def _apart(keys, a, b):
    return np.bitwise_count(keys[a] ^ keys[b]).sum(1, dtype=np.int32)


def _known(root, cell, group):
    rows = np.flatnonzero(group >= 0)
    by = rows[np.lexsort([group[rows], cell[rows]])]
    same = (cell[by[1:]] == cell[by[:-1]]) & (group[by[1:]] == group[by[:-1]])
    return _merged(root, by[1:][same], by[:-1][same])


def _merged(root, a, b):
    """``root`` (the smallest row of each row's component) after linking a with b."""
    while True:
        ra, rb = root[a], root[b]
        other = ra != rb
        if not other.any():
            return root
        a, b, ra, rb = a[other], b[other], ra[other], rb[other]
        root = root.copy()
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _all_pairs(la, ha, lb, hb):
    wide = hb - lb
    total = (ha - la) * wide
    of = np.repeat(np.arange(len(la)), total)
    at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    a, b = la[of] + at // wide[of], lb[of] + at % wide[of]
    once = a != b
    return a[once], b[once]


def _middle(keys, at, lo, hi):
    """The first row of each range whose bit ``at`` is set (bits before are equal)."""
    word, shift = at // 64, np.uint64(63 - at % 64)
    column = keys[:, word]
    lo, hi = lo.copy(), hi.copy()
    while (going := lo < hi).any():
        mid = (lo + hi) // 2
        one = (column[np.minimum(mid, len(column) - 1)] >> shift) & np.uint64(1) == 1
        hi = np.where(going & one, mid, hi)
        lo = np.where(going & ~one, mid + 1, lo)
    return lo


def _children(keys, at, la, ha, lb, hb, spent, budget):
    ma, mb = _middle(keys, at, la, ha), _middle(keys, at, lb, hb)
    itself = (la == lb) & (ha == hb)
    found = [
        (la, ma, lb, mb, spent),
        (ma, ha, mb, hb, spent),
        (la, ma, mb, hb, spent + 1),
        tuple(x[~itself] for x in (ma, ha, lb, mb, spent + 1)),
    ]
    parts = [np.concatenate(x) for x in zip(*found)]
    good = (parts[0] < parts[1]) & (parts[2] < parts[3]) & (parts[4] <= budget)
    return [x[good] for x in parts]
