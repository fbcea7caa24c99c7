"""Suffix array by induced sorting and permuted common prefixes, in numpy.

The scans of induced sorting run bucket by bucket: what a bucket's suffixes
induce is appended to the other buckets in one stable step, and what they induce
inside the bucket is taken in waves, which gives the order of a scan entry by entry.
Positions are 32-bit numbers, which halve a task's memory; a text has fewer than 2**31 bytes.
"""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of ``t`` (uint8), whose last element is its only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    small = _smaller_type(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    first = _induce(t, small, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = first[is_lms[first]]  # leftmost-smaller substrings in order
    if len(order) < 2:
        return first
    following = np.append(lms[1:], np.int32(n - 1))
    end_of = np.empty(n, np.int32)
    end_of[lms] = following + 1
    size = end_of[order] - order
    rank = np.cumsum(np.r_[0, ~_same(t, order[1:], order[:-1], size[1:], size[:-1])])
    if rank[-1] + 1 < len(order):
        name = np.empty(n, np.int32)
        name[order] = rank
        order = lms[_sorted_names(name[lms])]
    return _induce(t, small, order)


def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros behind the end."""
    return np.ndarray(shape=(len(t) + 8,), dtype="<u8", buffer=np.concatenate([t, np.zeros(16, np.uint8)]), strides=(1,))


def _same(t: np.ndarray, x: np.ndarray, y: np.ndarray, x_size: np.ndarray, y_size: np.ndarray) -> np.ndarray:
    """Whether the substrings at ``x`` equal those at ``y``, byte for byte."""
    words = _words(t)
    out = x_size == y_size
    live, at = np.flatnonzero(out), 0
    while len(live):
        left = np.minimum(x_size[live] - at, 8)
        beyond = ((np.uint64(8) - left.astype(np.uint64)) * np.uint64(8))
        differ = ((words[x[live] + at] ^ words[y[live] + at]) << beyond) != 0
        out[live[differ]] = False
        at += 8
        live = live[~differ & (x_size[live] > at)]
    return out


def _smaller_type(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one behind it."""
    step = np.sign(np.diff(t.astype(np.int16)))
    at = np.where(step != 0, np.arange(len(step), dtype=np.int32), np.int32(len(step)))
    at = np.minimum.accumulate(at[::-1])[::-1]
    step = np.append(step, -1)
    return np.append(step[at] > 0, True)


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced string: the same way while its names fit a byte, else by doubling ranks."""
    top = int(names.max())
    if top < 255:
        # the last name is the end mark's, unique and least
        return suffix_array(names.astype(np.uint8))
    rank, width = names.astype(np.int64), 1
    while True:
        behind = np.zeros(len(rank), np.int64)
        behind[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        rank[order] = new
        if new[-1] == len(rank) - 1:
            return order
        width *= 2


def _deal(pred: np.ndarray, char: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Append each entry to the bucket of its character, keeping their order."""
    if not len(pred):
        return
    order = np.argsort(char, kind="stable")
    char, pred = char[order], pred[order]
    cuts = np.flatnonzero(np.diff(char)) + 1
    for c, part in zip(char[np.r_[0, cuts]].tolist(), np.split(pred, cuts), strict=True):
        into[c].append(part)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in the order that ``lms`` (in order within each first character) induces."""
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    smaller: list[list[np.ndarray]] = [[] for _ in range(256)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(lms, t[lms], seeds)
    letters = np.flatnonzero(np.bincount(t, minlength=256)).tolist()
    for c in letters:
        done = []
        while larger[c]:
            wave = np.concatenate(larger[c])
            larger[c] = []
            done.append(wave)
            pred = wave[wave > 0] - 1
            pred = pred[~small[pred]]
            _deal(pred, t[pred], larger)
        larger[c] = done
        for part in seeds[c]:
            pred = part[part > 0] - 1
            _deal(pred, t[pred], larger)
    smaller[0] = [np.array([len(t) - 1], np.int32)]
    for c in reversed(letters):  # from the right: entries of a bucket are held from its right end
        done = []
        while smaller[c]:
            wave = np.concatenate(smaller[c])
            smaller[c] = []
            done.append(wave)
            pred = wave[wave > 0] - 1
            pred = pred[small[pred]]
            _deal(pred, t[pred], smaller)
        smaller[c] = done
        for part in reversed(larger[c]):
            pred = part[::-1]
            pred = pred[pred > 0] - 1
            pred = pred[small[pred]]
            _deal(pred, t[pred], smaller)
    out = []
    for c in letters:
        out += larger[c]
        out += [part[::-1] for part in reversed(smaller[c])]
    return np.concatenate(out)


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of ``sa`` the length of the prefix that its suffix shares with the one before.

    Permuted: compared only where the letters in front differ; every other
    position's value is that of the position in front of it less one.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    front = np.r_[np.uint8(0), t[:-1]]
    top = np.r_[False, front[1:] != front[before[1:]]]
    top |= before <= 0
    top[0] = True
    i = np.flatnonzero(top & (before >= 0))
    plcp = np.zeros(n, np.int32)
    words = _words(t)
    at, x, y, size = i, i, before[i], np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        diff = words[x] ^ words[y]
        equal = diff == 0
        stop = live[~equal]
        d = diff[~equal]
        size[stop] += np.bitwise_count((d & (~d + np.uint64(1))) - np.uint64(1)) // 8
        live = live[equal]
        size[live] += 8
        x, y = at[live] + size[live], before[at[live]] + size[live]
    plcp[i] = size
    place = np.arange(n, dtype=np.int32)
    head = np.maximum.accumulate(np.where(top, place, np.int32(0)))
    plcp = plcp[head] - (place - head)
    return plcp[sa]
