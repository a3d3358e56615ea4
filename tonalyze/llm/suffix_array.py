"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

A suffix is S-type if it is smaller than the next one and L-type otherwise; a
leftmost S-type position starts a leftmost-smaller (LMS) substring.

    1. LMS substrings are sorted by one induced pass from their first symbols
       and named, equal ones alike.
    2. If names repeat, the string of names is sorted: runs of 2, 4, 8, ...
       LMS substrings are named from pairs of names, until every name is one
       of its kind.  This recursion halves what is left to tell apart, and
       each step is one sort.
    3. A second induced pass spreads the order of the LMS suffixes over all
       suffixes.

An induced pass goes through the buckets of the symbols in order.  What a
bucket holds is moved on as one block: the suffixes before its suffixes are
dealt to their buckets in order, those that fall into the same bucket form its
next block.  So the work is linear and a step of it is an array operation.

Permuted common prefixes: PLCP[i] is what suffix i has in common with its
predecessor in the array.  It is compared only where it cannot be derived
(where the symbols before both differ); elsewhere PLCP[i] = PLCP[i-1] - 1.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """Is the suffix at each place S-type?  (The last one is.)"""
    n = len(text)
    at = np.where(text[:-1] != text[1:], np.arange(n - 1), n)
    differs = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(text[differs] < text[differs + 1], True)


def _deal(block: np.ndarray, text: np.ndarray, wanted: np.ndarray, symbols: int):
    """The suffixes before those of ``block`` that are ``wanted``, by bucket:
    (suffixes, their buckets' sizes, places counted inside each bucket)."""
    before = block - 1
    before = before[(before >= 0) & wanted[before]]
    bucket = text[before]
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=symbols)
    inside = np.arange(len(before)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return before[order], bucket[order], sizes, inside


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes, from LMS suffixes that are sorted (at least by their
    first symbol)."""
    sizes = np.bincount(text, minlength=symbols)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    array = np.empty(len(text), np.int64)
    large = ~small
    heads = starts.copy()
    lms_ends = np.cumsum(np.bincount(text[lms], minlength=symbols))
    for c in range(symbols):
        done = starts[c]
        while done < heads[c]:
            block, done = array[done:heads[c]], heads[c]
            suffix, bucket, dealt, inside = _deal(block, text, large, symbols)
            array[heads[bucket] + inside] = suffix
            heads += dealt
        block = lms[lms_ends[c - 1] if c else 0:lms_ends[c]]
        if len(block):
            suffix, bucket, dealt, inside = _deal(block, text, large, symbols)
            array[heads[bucket] + inside] = suffix
            heads += dealt
    tails = ends.copy()
    tails[0] -= 1
    array[0] = len(text) - 1
    for c in range(symbols - 1, -1, -1):
        done = ends[c]
        while done > tails[c]:
            block, done = array[tails[c]:done][::-1], tails[c]
            suffix, bucket, dealt, inside = _deal(block, text, small, symbols)
            array[tails[bucket] - 1 - inside] = suffix
            tails -= dealt
        if heads[c] > starts[c]:
            suffix, bucket, dealt, inside = _deal(array[starts[c]:heads[c]][::-1], text, small, symbols)
            array[tails[bucket] - 1 - inside] = suffix
            tails -= dealt
    return array


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of what the suffixes a[k] and b[k] (not the same) have in common,
    for a text of 16-bit symbols whose last one occurs once."""
    padded = np.append(text, np.zeros(4, np.uint16))
    four = np.ndarray((len(text) + 1,), "<u8", padded, strides=(2,))
    out = np.zeros(len(a), np.int64)
    at = np.arange(len(a))
    while len(at):
        differ = four[a] ^ four[b]
        out[at] += ((differ & 0xFFFF) == 0).astype(np.int64) + ((differ & 0xFFFFFFFF) == 0) + (
            (differ & 0xFFFFFFFFFFFF) == 0) + (differ == 0)
        on = differ == 0
        at, a, b = at[on], a[on] + 4, b[on] + 4
    return out


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names.  A name is a rank: one more
    than the number of names below it.  Names of one kind are left alone."""
    n, span = len(names), 1
    order = np.argsort(names, kind="stable")
    fresh = np.append(True, names[order[1:]] != names[order[:-1]])
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first + 1
    shared = order[~(fresh & np.append(fresh[1:], True))]
    while len(shared):
        after = np.where(shared + span < n, rank[np.minimum(shared + span, n - 1)], 0)
        key = rank[shared] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        shared, key = shared[by], key[by]
        group = rank[shared]
        opens = np.append(True, group[1:] != group[:-1])
        fresh = np.append(True, key[1:] != key[:-1])
        place = np.arange(len(shared))
        rank[shared] = group + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(
            np.where(opens, place, 0))
        shared = shared[~(fresh & np.append(fresh[1:], True))]
        span *= 2
    order[rank - 1] = np.arange(n)
    return order


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Sorted suffixes of a text of 16-bit symbols below ``symbols``; its last
    symbol is 0 and occurs nowhere else."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    small = _types(text)
    is_lms = np.append(False, small[1:] & ~small[:-1])
    lms = np.flatnonzero(is_lms)
    array = _induce(text, small, lms[np.argsort(text[lms], kind="stable")], symbols)
    order = array[is_lms[array]]
    if len(order) > 1:
        length = np.append(np.diff(lms), 0) + 1        # with the first symbol of the next one
        which = np.searchsorted(lms, order)
        a, b = order[:-1], order[1:]
        same = length[which[:-1]] == length[which[1:]]
        same[same] = common_prefixes(text, a[same], b[same]) >= length[which[:-1]][same]
        names = np.empty(len(lms), np.int64)
        names[which] = np.concatenate([[0], np.cumsum(~same)])
        if same.any():
            order = lms[_sorted_names(names)]
    return _induce(text, small, order, symbols)


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """What each suffix has in common with its predecessor, by place in the text."""
    n = len(text)
    previous = np.full(n, -1)
    previous[array[1:]] = array[:-1]
    place = np.arange(n)
    derived = (place > 0) & (previous > 0)
    derived[derived] = text[place[derived] - 1] == text[previous[derived] - 1]
    compared = np.flatnonzero(~derived & (previous >= 0))
    reach = np.zeros(n, np.int64)
    reach[compared] = compared + common_prefixes(text, compared, previous[compared])
    out = np.maximum.accumulate(reach) - place
    out[previous < 0] = 0
    return out
