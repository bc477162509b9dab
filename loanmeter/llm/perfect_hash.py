"""A minimal perfect hash: n known 64-bit keys to the numbers 0 to n - 1, without gaps.

Keys fall into buckets; each bucket has a pilot value under which its keys land on free slots. The
few slots beyond n are sent to the gaps that are left below n.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from loanmeter.llm.arrow_text import mix

KEYS_PER_BUCKET = 4
LOAD = 0.97
PILOTS_AT_ONCE = 512


@dataclass(frozen=True)
class PerfectHash:
    pilots: np.ndarray
    slots: int
    moved: np.ndarray
    """New place of each slot from n on."""

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        n = len(keys)
        slots = max(n, int(np.ceil(n / LOAD)))
        buckets = max(1, n // KEYS_PER_BUCKET)
        bucket = _bucket(keys, buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        sizes = np.diff(np.r_[0, ends])
        pilots = np.zeros(buckets, np.uint64)
        taken = np.zeros(slots, bool)
        for b in np.argsort(-sizes, kind="stable"):  # the largest buckets first, while there is room
            if not sizes[b]:
                break
            own, start = keys[by_bucket[ends[b] - sizes[b] : ends[b]]], 0
            while True:
                tried = np.arange(start, start + PILOTS_AT_ONCE, dtype=np.uint64)
                place = np.sort(_slot(own[None, :], tried[:, None], slots), axis=1)
                fits = ~taken[place].any(axis=1) & (np.diff(place, axis=1) > 0).all(axis=1)
                if fits.any():
                    first = int(fits.argmax())
                    pilots[b] = tried[first]
                    taken[place[first]] = True
                    break
                start += PILOTS_AT_ONCE
        moved = np.zeros(slots - n, np.int64)
        moved[np.flatnonzero(taken[n:])] = np.flatnonzero(~taken[:n])
        return cls(pilots, slots, moved)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; an unknown key gets the number of some known one."""
        slot = _slot(keys, self.pilots[_bucket(keys, len(self.pilots))], self.slots)
        n = self.slots - len(self.moved)
        beyond = slot >= n
        slot[beyond] = self.moved[slot[beyond] - n]
        return slot


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys % np.uint64(buckets)).astype(np.int64)


def _slot(keys: np.ndarray, pilot: np.ndarray, slots: int) -> np.ndarray:
    return (mix(keys ^ mix(pilot + np.uint64(1))) % np.uint64(slots)).astype(np.int64)
