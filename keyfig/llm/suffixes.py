"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The two induction scans visit the first-byte buckets in order.  Within a bucket the scan goes in
rounds (what a round adds to the same bucket is the next round), and a round is a handful of
vector operations, so the work stays linear and the number of rounds is that of equal bytes in a
row.  Leftmost-smaller (LMS) substrings are sorted by one such induction and named; equal names
are told apart by renaming pairs of names again and again, each time twice as far.
"""

from __future__ import annotations

import numpy as np

from keyfig.llm.common import _BYTE, _powers, mix


def classify(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S type); the last one is not."""
    n = len(text)
    differs = np.empty(n, bool)
    differs[-1] = True
    np.not_equal(text[:-1], text[1:], out=differs[:-1])
    ahead = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]  # the end of the run of equal bytes
    smaller = np.zeros(n, bool)
    np.less(text[:-1], text[1:], out=smaller[:-1])
    return smaller[ahead]


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes from LMS positions given in order (order within a first byte is what counts)."""
    n = len(text)
    sizes = np.bincount(text, minlength=256)
    first = np.cumsum(sizes) - sizes
    larges = np.bincount(text[~small], minlength=256)
    order = np.empty(n, np.int32)
    used = np.flatnonzero(sizes)
    lms_by = lms[np.argsort(text[lms], kind="stable")]
    lms_cut = np.searchsorted(text[lms_by], np.arange(257))

    heads = first.copy()

    def put_large(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[~small[before]]
        if len(before):
            byte = text[before]
            if len(before) > 1:
                sort = np.argsort(byte, kind="stable")
                before, byte = before[sort], byte[sort]
            got = np.bincount(byte, minlength=256)
            order[np.arange(len(before)) + (heads - (np.cumsum(got) - got))[byte]] = before
            heads[:] += got

    put_large(np.array([n], np.int32))
    for c in used:
        at = first[c]
        while at < heads[c]:
            a, at = at, heads[c]
            put_large(order[a:at])
        if lms_cut[c] < lms_cut[c + 1]:
            put_large(lms_by[lms_cut[c]:lms_cut[c + 1]])

    tails = first + sizes

    def put_small(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[small[before]]
        if len(before):
            byte = text[before]
            if len(before) > 1:
                sort = np.argsort(byte, kind="stable")
                before, byte = before[sort], byte[sort]
            got = np.bincount(byte, minlength=256)
            order[(tails - 1 + (np.cumsum(got) - got))[byte] - np.arange(len(before))] = before
            tails[:] -= got

    for c in used[::-1]:
        at = first[c] + sizes[c]
        while at > tails[c]:
            a, at = at, tails[c]
            put_small(order[at:a][::-1])
        if larges[c]:
            put_small(order[first[c]:first[c] + larges[c]][::-1])
    return order


def _by_renaming(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names."""
    n, k = len(names), 1
    rank = names.astype(np.int64)
    bits = max(1, int(n + 1).bit_length())
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - k)] = rank[k:] + 1
        if 3 * bits <= 63:  # sorted in one word with its place
            key = np.sort((rank << (2 * bits)) | (after << bits) | np.arange(n))
            order, key = key & ((1 << bits) - 1), key >> bits
        else:
            key = rank * (n + 2) + after
            order = np.argsort(key, kind="stable")
            key = key[order]
        new = np.empty(n, np.int64)
        new[0] = 0
        np.cumsum(key[1:] != key[:-1], out=new[1:])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        k *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The sorted suffixes of a byte string."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = classify(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    if len(lms) < 2:
        return induce(text, small, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_ = induce(text, small, lms)
    sorted_ = sorted_[is_lms[sorted_]]
    # equal LMS substrings (from one LMS position through the next) get equal names
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[text] * up[:n], out=total[1:])
    nth = np.empty(n, np.int32)
    nth[lms] = np.arange(len(lms), dtype=np.int32)
    stop = np.append(lms[1:] + 1, n)
    length = stop - lms
    length[-1] = n + 1  # the one that meets the end is like no other
    key = (total[stop] - total[lms]) * down[lms]
    place = nth[sorted_]
    names = np.empty(len(lms), np.int64)
    new = (key[place][1:] != key[place][:-1]) | (length[place][1:] != length[place][:-1])
    names[place] = np.concatenate([[0], np.cumsum(new)])
    if names[place[-1]] < len(lms) - 1:
        sorted_ = lms[_by_renaming(names)]
    return induce(text, small, sorted_)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Per position: bytes in common with its predecessor in ``order``, within ``room`` of both.

    ``room`` is the distance to the end of the position's segment.  Only positions whose left
    neighbour does not continue the match are compared; from there the value falls by one a byte.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    starts = np.ones(n, bool)  # of segments
    starts[1:] = room[:-1] == 1
    fresh_ = (before <= 0) | starts
    fresh_[1:] |= text[:-1] != text[before[1:] - 1]
    fresh_ |= starts[np.maximum(before, 0)]
    at = np.flatnonzero(fresh_)
    common = np.zeros(n, np.int64)
    live = at[before[at] >= 0]
    most, done = np.minimum(room[live], room[before[live]]), np.zeros(len(live), np.int64)
    open_ = np.flatnonzero(most > 0)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))
    while len(open_):
        a, b = live[open_] + done[open_], before[live[open_]] + done[open_]
        x = np.ascontiguousarray(words[a]).view("<u8").ravel() ^ np.ascontiguousarray(words[b]).view("<u8").ravel()
        low = x & (~x + np.uint64(1))  # its lowest set bit; none: all eight bytes agree
        equal = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        done[open_] += equal
        open_ = open_[(equal == 8) & (done[open_] < most[open_])]
    common[live] = np.minimum(done, most)
    since = np.maximum.accumulate(np.where(fresh_, i, 0))
    return np.maximum(common[since] - (i - since), 0)
