"""Suffix order of token sequences by prefix doubling, and longest previous factors.

``SuffixOrder`` is for the suffixes that repeat: a suffix whose first ``h`` tokens occur only once has its final place
after the round for ``h``. Only classes of two or more go on, so the rounds get cheap quickly. ``sparse_suffix_array`` sorts
chosen suffixes by their first symbols, as many as a match needs.
"""

from __future__ import annotations

import numpy as np


class SuffixOrder:
    """``order``: the suffixes that share ``least`` tokens or more with another one, sorted.

    ``lcp[i]`` is the number of tokens that ``order[i]`` and ``order[i + 1]`` have in common, exactly.
    Texts are told apart by a token of its own behind each text.
    """

    def __init__(self, tokens: np.ndarray, least: int):
        n = len(tokens)
        _, first = np.unique(tokens, return_inverse=True)
        count = np.bincount(first, minlength=1)
        # A rank is the place where a class of equal prefixes starts in suffix order.
        rank = (np.cumsum(count) - count)[first]
        active = np.flatnonzero(count[first] > 1)
        self._levels = [rank]
        width = 1
        while len(active):
            # No suffix of an active class reaches the end: each text's last token is unique.
            pair = rank[active] * n + rank[active + width]
            sort = np.argsort(pair)
            active = active[sort]
            of_class, ahead = np.divmod(pair[sort], n)
            fresh = np.empty(len(active), bool)
            fresh[0] = True
            new_class = of_class[1:] != of_class[:-1]
            fresh[1:] = new_class | (ahead[1:] != ahead[:-1])
            place = np.arange(len(active))
            class_start = np.maximum.accumulate(np.where(np.r_[True, new_class], place, 0))
            sub_start = np.maximum.accumulate(np.where(fresh, place, 0))
            rank = rank.copy()
            rank[active] = of_class + sub_start - class_start
            width *= 2
            self._levels.append(rank)
            alone = fresh & np.r_[fresh[1:], True]
            active = active[~alone]
        self.rank = rank

        self.order = self.lcp = np.zeros(0, np.int64)
        known = least.bit_length() - 1  # the last round that told no more than ``least`` tokens apart
        if known >= len(self._levels):
            return
        place = np.empty(n, np.int64)
        place[rank] = np.arange(n)
        sorted_class = self._levels[known][place]
        near = np.flatnonzero(sorted_class[1:] == sorted_class[:-1])
        shared = self._common(place[near], place[near + 1])
        near, shared = near[shared >= least], shared[shared >= least]
        if not len(near):
            return
        at = np.unique(np.r_[near, near + 1])
        self.order = place[at]
        self.lcp = np.zeros(len(at) - 1, np.int64)
        self.lcp[np.searchsorted(at, near)] = shared

    def _common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens in common, from the ranks of all rounds, longest first."""
        length = np.zeros(len(left), np.int64)
        for level in range(len(self._levels) - 1, -1, -1):
            ranks = self._levels[level]
            # Ranks of a round tell 2**level tokens apart.
            same = ranks[left + length] == ranks[right + length]
            length[same] += 1 << level
        return length

    def deepest(self) -> np.ndarray:
        """For each suffix of ``order``, the depth of the deepest LCP interval it belongs to."""
        if not len(self.order):
            return np.zeros(0, np.int64)
        return np.maximum(np.r_[self.lcp, 0], np.r_[0, self.lcp])


def sparse_suffix_array(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the suffixes at ``starts`` in suffix order, and the LCP of each with the next one.

    Symbols are bytes or 64-bit numbers. ``length`` symbols or more are compared, up to twice the largest power that is
    needed for that; LCP values end there. What stands behind the end of ``data`` is equal to nothing that matters: the
    caller sees to it that ``length`` symbols follow each start.
    """
    if data.dtype == np.uint8:
        padded = np.r_[data, np.zeros(8, np.uint8)]
        first, width = np.ndarray((len(data),), ">u8", padded, strides=(1,)).astype(np.uint64), 8
    else:
        first, width = data, 1
    ranks = [np.unique(first, return_inverse=True)[1].astype(np.int32)]
    n = len(data)
    while 2 * width < length:
        last = ranks[-1]
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = last[width:] + np.int64(1)
        ranks.append(np.unique(last * np.int64(n + 1) + ahead, return_inverse=True)[1].astype(np.int32))
        width *= 2
    last = np.r_[ranks[-1], np.full(width, -1, np.int32)]
    order = np.argsort(last[starts] * np.int64(n + 1) + last[starts + width] + 1, kind="stable")
    left, right = starts[order[:-1]], starts[order[1:]]
    lcp = np.zeros(len(left), np.int64)
    for step, rank in [(width, ranks[-1]), *((width >> i, ranks[-1 - i]) for i in range(len(ranks)))]:
        inside = np.maximum(left, right) + lcp < n
        at = np.flatnonzero(inside)
        at = at[rank[left[at] + lcp[at]] == rank[right[at] + lcp[at]]]
        lcp[at] += step
    if data.dtype == np.uint8:
        # Ranks tell eight bytes apart; the bytes of the next eight that still agree.
        at = np.flatnonzero(np.maximum(left, right) + lcp < n)
        differ = first[left[at] + lcp[at]] ^ first[right[at] + lcp[at]]
        lcp[at] += sum((differ >> np.uint64(64 - 8 * i) == 0).astype(np.int64) for i in range(1, 8))
    return order, lcp


def previous_factors(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factors: for each suffix, in suffix order, the most it has in common with one at a smaller position.

    That one is the nearest in suffix order with a smaller position, before or behind. Both are found for all suffixes at once: each
    points to its neighbour, and while the one pointed at has a larger position, to where that one points.
    """
    n = len(position)
    out = np.zeros(n, np.int64)
    for turned in (False, True):
        place = position[::-1] if turned else position
        shared = np.r_[0, (lcp[::-1] if turned else lcp)]
        smaller = np.arange(n) - 1
        active = np.flatnonzero(smaller >= 0)
        active = active[place[smaller[active]] > place[active]]
        while len(active):
            over = smaller[active]
            # All at once: what is pointed at keeps its values until the round is over.
            least, further = np.minimum(shared[active], shared[over]), smaller[over]
            shared[active], smaller[active] = least, further
            active = active[further >= 0]
            active = active[place[smaller[active]] > place[active]]
        shared[smaller < 0] = 0
        out = np.maximum(out, shared[::-1] if turned else shared)
    return out
