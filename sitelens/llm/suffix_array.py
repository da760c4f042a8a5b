"""Suffix arrays by induced sorting, and permuted longest common prefixes.

Suffixes are classed as smaller or larger than their right neighbour; the
leftmost smaller ones (LMS) are sorted by their substrings, recursively where
substrings repeat, and all others are induced from them in two linear scans.
A scan over an alphabet of bytes handles a bucket at a time with numpy; the
larger alphabets of the recursion are scanned element by element.
"""

from __future__ import annotations

import numpy as np

_SMALL_ALPHABET = 1024


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour (the last one is)."""
    n = len(s)
    decided = np.append(s[:-1] != s[1:], True)
    rising = np.append(s[:-1] < s[1:], True)
    # An equal stretch takes the class of its last element.
    at = np.where(decided, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return rising[following]


def _place(sa: np.ndarray, ends: np.ndarray, at: np.ndarray, s: np.ndarray) -> None:
    """Put suffixes, given in ascending order, at the ends of their buckets."""
    if not len(at):
        return
    order = np.argsort(s[at], kind="stable")
    at = at[order]
    letters = s[at]
    last = np.append(np.flatnonzero(letters[1:] != letters[:-1]), len(at) - 1)
    count = np.diff(np.append(-1, last))
    ends = ends[letters[last]]
    sa[np.repeat(ends - count + 1, count) + np.arange(len(at)) - np.repeat(last - count + 1, count)] = at


def _induce_buckets(sa: np.ndarray, s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Both scans, a bucket at a time."""
    letters = np.flatnonzero(ends >= starts)
    head = starts.copy()

    def put(found: np.ndarray, pointer: np.ndarray, step: int) -> None:
        letter = s[found]
        order = np.argsort(letter, kind="stable")
        found, letter = found[order], letter[order]
        first = np.flatnonzero(np.append(True, letter[1:] != letter[:-1]))
        count = np.diff(np.append(first, len(letter)))
        rank = np.arange(len(letter)) - np.repeat(first, count)
        sa[np.repeat(pointer[letter[first]], count) + step * rank] = found
        pointer[letter[first]] += step * count

    for c in letters:  # larger suffixes, from the left
        done, fixed = starts[c], ends[c] + 1
        while True:
            if done < head[c]:
                now, done = sa[done:head[c]], head[c]
            elif done < fixed:
                # What is left of the bucket are the smaller suffixes placed before.
                now = sa[done:fixed]
                done = fixed
            else:
                break
            before = now[now > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                put(before, head, 1)
    # The smaller suffixes are induced anew, from the right.
    tail = ends.copy()
    for c in letters:
        sa[head[c]:ends[c] + 1] = -1
    sa[0] = len(s) - 1  # the closing 0 follows from nothing
    for c in letters[::-1]:
        done = ends[c]
        while True:
            if done > tail[c]:
                now, done = sa[tail[c] + 1:done + 1][::-1], tail[c]
            elif done >= starts[c]:
                now, done = sa[starts[c]:done + 1][::-1], starts[c] - 1
            else:
                break
            before = now[now > 0] - 1
            before = before[smaller[before]]
            if len(before):
                put(before, tail, -1)


def _induce_elements(sa: np.ndarray, s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Both scans, an element at a time."""
    out, head, tail = sa.tolist(), starts.tolist(), ends.tolist()
    # For each suffix the bucket its left neighbour belongs to in a scan, -1 for none (also read for the empty place -1).
    larger_of = np.append(np.append(-1, np.where(smaller[:-1], -1, s[:-1]))[:len(s)], -1).tolist()
    smaller_of = np.append(np.append(-1, np.where(smaller[:-1], s[:-1], -1))[:len(s)], -1).tolist()
    for j in out:
        c = larger_of[j]
        if c >= 0:
            h = head[c]
            out[h] = j - 1
            head[c] = h + 1
    for j in reversed(out):
        c = smaller_of[j]
        if c >= 0:
            t = tail[c]
            out[t] = j - 1
            tail[c] = t - 1
    sa[:] = out


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array of ``s`` (int64 in 0..alphabet-1), which ends in a 0 that occurs nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(s, minlength=alphabet)
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    induce = _induce_buckets if alphabet <= _SMALL_ALPHABET else _induce_elements

    def induced(sorted_lms: np.ndarray) -> np.ndarray:
        sa = np.full(n, -1, np.int64)
        _place(sa, ends, sorted_lms, s)
        induce(sa, s, smaller, starts, ends)
        return sa

    sa = induced(lms)
    if len(lms) == 1:
        return sa
    # Name the LMS substrings in their sorted order; equal ones get one name.
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    length = np.zeros(n, np.int64)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    step = 0
    while len(live):
        live = live[length[a[live]] > step]
        differ = s[a[live] + step] != s[b[live] + step]
        same[live[differ]] = False
        live = live[~differ]
        step += 1
    names = np.append(0, np.cumsum(~same))
    if names[-1] + 1 == len(lms):
        return induced(order)
    name_of = np.zeros(n, np.int64)
    name_of[order] = names
    return induced(lms[suffix_array(name_of[lms], int(names[-1]) + 1)])


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, limit: int, room: np.ndarray) -> np.ndarray:
    """For each suffix, in text order, whether it shares ``limit`` bytes with its
    predecessor in the suffix array: the permuted prefix array, cut at
    ``limit`` and compared eight bytes at a time. ``room`` says which suffixes
    have ``limit`` bytes at all."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.zeros(n, np.uint64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for i in range(8):
        words |= padded[i:i + n] << np.uint64(8 * i)
    live = np.flatnonzero((before >= 0) & room)
    live = live[room[before[live]]]
    for step in range(0, limit, 8):
        at = max(0, min(step, limit - 8))
        differ = words[live + at] ^ words[before[live] + at]
        live = live[differ << np.uint64(8 * max(0, 8 - limit)) == 0]
    out = np.zeros(n, bool)
    out[live] = True
    return out


def repeated_starts(strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each string, the starts of its ``width``-byte substrings that start
    anywhere else in the strings too (the same string included)."""
    text = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 2
    sizes = np.array([len(x) for x in strings])
    own = np.repeat(np.arange(len(strings)), sizes)
    s = np.ones(len(text) + len(strings) + 1, np.int64)  # 1 between strings, 0 at the end, bytes from 2
    s[np.arange(len(text)) + own] = text
    s[-1] = 0
    sa = suffix_array(s, 258)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    room = np.zeros(len(s), bool)
    room[np.arange(len(text)) + own] = np.arange(len(text)) + width <= np.repeat(np.cumsum(sizes), sizes)
    shares = permuted_common_prefixes(np.maximum(s - 2, 0).astype(np.uint8), sa, width, room)
    rank = np.empty(len(s), np.int64)
    rank[sa] = np.arange(len(s))
    after = np.append(shares[sa][1:], False)[rank]  # whether the successor shares with this one
    hit = (shares | after) & room
    return [np.flatnonzero(hit[a:a + n]) for a, n in zip(first, sizes)]
