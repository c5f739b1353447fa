"""Deep-shallow suffix sorting of byte strings, many groups at a time.

Shallow: multikey quicksort, eight bytes to a key; groups of equal keys go on to the next eight bytes. Deep: what still
shares the shallow depth is put into blind tries. A trie node keeps the depth at which its strings first differ and the
byte they branch on; what lies between two nodes is skipped. All nodes of a level are made together.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every offset as one big-endian number (a view, no copy)."""
    return np.ndarray(shape=(max(0, len(data) - WORD + 1),), dtype=">u8", buffer=data, strides=(1,))


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number of the group of each row, for rows sorted by these keys."""
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _crowded(group: np.ndarray) -> np.ndarray:
    """Rows whose group has more than one row."""
    return np.bincount(group)[group] > 1


def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the strings at a and b, which share ``depth`` bytes already; at most ``limit``."""
    length = depth.copy()
    open_ = np.arange(len(a))
    while len(open_):
        differ = (words[a[open_] + length[open_]] ^ words[b[open_] + length[open_]]).astype(np.uint64)
        same = differ == 0
        lead = np.zeros(len(open_), np.int64)
        for shift in (32, 16, 8):  # leading zero bytes
            high = (differ >> np.uint64(64 - shift)) == 0
            high &= ~same
            lead[high] += shift // 8
            differ[high] <<= np.uint64(shift)
        length[open_] += np.where(same, WORD, lead)
        open_ = open_[same & (length[open_] < limit)]
    return np.minimum(length, limit)


def deep_shallow(data: np.ndarray, starts: np.ndarray, limit: int, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(order, leaf): the suffixes at ``starts`` sorted by their first ``limit`` bytes, and for each sorted place the number of
    its leaf; suffixes equal up to the limit share a leaf. Every suffix has ``limit`` bytes, and the data WORD more at the end.
    """
    words = _words(data)
    order = np.arange(len(starts))
    if len(order) < 2:
        return order, np.zeros(len(order), np.int64)
    leaf = np.zeros(len(starts), np.int64)
    active = order.copy()  # places in order that are in groups of several rows
    group = np.zeros(len(starts), np.int64)
    for depth in range(0, min(shallow, limit - WORD + 1), WORD):
        key = words[starts[order[active]] + depth].astype(np.uint64)
        sort = np.lexsort((key, group[active]))
        order[active], key = order[active][sort], key[sort]
        group = _split(group, active, key)
        active = np.flatnonzero(_crowded(group))
    reached = np.full(len(starts), min(shallow, limit - WORD + 1) // WORD * WORD)
    while len(active):
        place = starts[order[active]]
        own = group[active]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(first, len(own)))
        common = _common(words, place, np.repeat(place[first], size), reached[active], limit)
        branch = np.repeat(np.minimum.reduceat(common, first), size)
        reached[active] = branch
        done = branch >= limit
        active, branch = active[~done], branch[~done]
        if not len(active):
            break
        key = data[starts[order[active]] + branch]
        sort = np.lexsort((key, group[active]))
        order[active], key = order[active][sort], key[sort]
        group = _split(group, active, key)
        active = active[_crowded(group)[active]]
    leaf[:] = group
    return order, leaf


def _split(group: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Groups after the active rows were sorted by a key within their groups; numbers stay in sorted order."""
    new = np.zeros(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    adjacent = (active[1:] == active[:-1] + 1) & (key[1:] != key[:-1])
    new[active[1:][adjacent]] = True
    return np.cumsum(new)
