"""Suffix arrays by induced sorting, and permuted common prefixes, over NumPy integers.

``suffix_array`` classifies every suffix as smaller (S) or larger (L) than its right neighbour, sorts and names the
leftmost-smaller (LMS) substrings, sorts the LMS suffixes recursively where names repeat, and induces the order
of all other suffixes in two passes over the buckets.  Over few letters a pass takes whole buckets at a time: its
cost is linear in the text with one vector step for each bucket and each repeat of a bucket's own letter.  Over the many
names of a recursive call it goes place by place.
"""

from __future__ import annotations

import numpy as np

CROWD = 64
"""With fewer suffixes to a bucket than this, on average, a pass goes place by place: the same order, and less work
than a vector step for each bucket."""


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is of S type.  ``t`` ends with its unique smallest letter."""
    n = len(t)
    change = np.flatnonzero(np.diff(t))  # t[k] differs from t[k + 1]
    s = np.ones(n, bool)
    if len(change):
        up = t[change] < t[change + 1]
        s[:change[-1] + 1] = np.repeat(up, np.diff(np.concatenate([[-1], change])))
    return s


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, starts: np.ndarray, l_counts: np.ndarray) -> np.ndarray:
    """Suffix order induced from the ordered LMS suffixes ``lms``.

    ``starts`` are the buckets' first places and ``l_counts`` the number of L suffixes in each bucket.
    """
    n, letters = len(t), len(starts) - 1
    sa = np.full(n, -1, np.int32)
    heads = starts[:-1].copy()          # next place for an L suffix
    tails = starts[1:].copy()           # one past the next place for an S suffix
    lms_first = np.searchsorted(t[lms], np.arange(letters + 1))  # lms is ordered by first letter

    def put_l(sources: np.ndarray, c: int) -> np.ndarray:
        """Place the L suffixes left of ``sources``, which are in order; those in bucket c itself are returned."""
        left = sources[sources > 0] - 1
        left = left[~s[left]]
        if not len(left):
            return left
        letter = t[left]
        order = np.argsort(letter, kind="stable")
        left, letter = left[order], letter[order]
        first = np.flatnonzero(np.concatenate([[True], letter[1:] != letter[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(left)]]))
        kinds = letter[first]
        sa[np.repeat(heads[kinds] - first, sizes) + np.arange(len(left))] = left
        heads[kinds] += sizes
        return left[letter == c]

    for c in range(letters):
        own = sa[starts[c]:heads[c]]    # L suffixes placed so far by smaller letters
        while len(own):
            own = put_l(own, c)
        if lms_first[c] < lms_first[c + 1]:
            put_l(lms[lms_first[c]:lms_first[c + 1]], c)

    def put_s(sources: np.ndarray, c: int) -> np.ndarray:
        """The same for S suffixes, from the largest down: ``sources`` are in descending order."""
        left = sources[sources > 0] - 1
        left = left[s[left]]
        if not len(left):
            return left
        letter = t[left]
        order = np.argsort(letter, kind="stable")
        left, letter = left[order], letter[order]
        first = np.flatnonzero(np.concatenate([[True], letter[1:] != letter[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(left)]]))
        kinds = letter[first]
        sa[np.repeat(tails[kinds] - 1 + first, sizes) - np.arange(len(left))] = left
        tails[kinds] -= sizes
        return left[letter == c]

    for c in range(letters - 1, -1, -1):
        own = sa[tails[c]:starts[c + 1]][::-1]  # S suffixes placed so far by larger letters
        while len(own):
            own = put_s(own, c)
        if l_counts[c]:
            put_s(sa[starts[c]:starts[c] + l_counts[c]][::-1], c)
    sa[0] = n - 1
    return sa


def induce_by_place(t: np.ndarray, s: np.ndarray, lms: np.ndarray, starts: np.ndarray, l_counts: np.ndarray) -> np.ndarray:
    """The result of ``induce``, for many letters: one step for each place, linear in the text whatever its alphabet.

    The walks read places that they have filled themselves: a suffix is always placed ahead of the walk.
    """
    n = len(t)
    sa, letter, smaller = [-1] * n, t.tolist(), s.tolist()
    last = np.bincount(t[lms], minlength=len(starts) - 1)  # the LMS suffixes wait at the ends of their buckets
    at = np.repeat(starts[1:] - np.cumsum(last), last) + np.arange(len(lms))
    for place, i in zip(at.tolist(), lms.tolist()):
        sa[place] = i
    heads = starts[:-1].tolist()
    for i in sa:
        if i > 0 and not smaller[i - 1]:
            c = letter[i - 1]
            sa[heads[c]] = i - 1
            heads[c] += 1
    tails = starts[1:].tolist()
    for i in reversed(sa):
        if i > 0 and smaller[i - 1]:
            c = letter[i - 1]
            tails[c] -= 1
            sa[tails[c]] = i - 1
    sa[0] = n - 1
    return np.array(sa, np.int32)


def name_substrings(t: np.ndarray, s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the LMS substrings, in text order, from their sorted order; and the number of ranks."""
    n = len(t)
    end = np.full(n + 1, n - 1, np.int32)
    end[lms[:-1]] = lms[1:]
    end[lms[-1]] = n - 1
    a, b = ordered[:-1], ordered[1:]
    same = (end[a] - a == end[b] - b)
    alive = np.flatnonzero(same)
    step = 0
    while len(alive):
        x, y = a[alive] + step, b[alive] + step
        inside = x <= end[a[alive]]
        alive_in, x, y = alive[inside], x[inside], y[inside]
        equal = (t[x] == t[y]) & (s[x] == s[y])
        same[alive_in[~equal]] = False
        alive = alive_in[equal]
        step += 1
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.empty(n, np.int32)
    names[ordered] = rank
    return names[lms], int(rank[-1]) + 1


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``t`` in ascending order; ``t`` ends with its unique smallest letter, 0."""
    t = np.asarray(t, np.int32)  # a shard is far below 2 ** 31 letters; half the memory of 64 bits
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    letters = int(t.max()) + 1
    order_from = induce if n >= CROWD * letters else induce_by_place
    s = classify(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]).astype(np.int32) + 1
    counts = np.bincount(t, minlength=letters)
    starts = np.concatenate([[0], np.cumsum(counts)])
    l_counts = np.bincount(t[~s], minlength=letters)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    # LMS suffixes in any order inside their buckets sort the LMS substrings
    rough = order_from(t, s, lms[np.argsort(t[lms], kind="stable")], starts, l_counts)
    ordered = rough[is_lms[rough]]
    names, kinds = name_substrings(t, s, lms, ordered)
    if kinds < len(lms):
        ordered = lms[suffix_array(names)]  # the last name is the sentinel's, the smallest
    return order_from(t, s, ordered, starts, l_counts)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, limit: int, own: np.ndarray | None = None) -> np.ndarray:
    """For each suffix, in text order, how many letters it shares with its left neighbour in ``sa``, up to ``limit``.
    With ``own``, only for those suffixes that are true there, as their left neighbours are; else 0.

    Eight letters are compared at a time, and only by those suffixes that still agree.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([t.astype(np.uint8), np.zeros(limit + 8, np.uint8)])
    words = np.ndarray((n + limit,), "<u8", padded, strides=(1,))  # the eight letters from each place on
    plcp = np.zeros(n, np.int32)
    alive = np.flatnonzero(before >= 0)
    if own is not None:
        alive = alive[own[alive] & own[before[alive]]]
    done = 0
    while len(alive) and done < limit:
        x, y = alive + done, before[alive].astype(np.int64) + done
        inside = np.maximum(x, y) < n
        alive, x, y = alive[inside], x[inside], y[inside]
        differ = words[x] ^ words[y]
        lowest = differ & (~differ + np.uint64(1))
        agree = np.where(differ == 0, 8, (np.bitwise_count(lowest - np.uint64(1)) // 8).astype(np.int64))
        plcp[alive] += agree.astype(np.int32)
        alive = alive[differ == 0]
        done += 8
    return np.minimum(plcp, limit)
