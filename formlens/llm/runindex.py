"""A run-length Burrows-Wheeler index of a bounded, repetitive set of strings.

The strings, each with an end mark of its own, are sorted by suffix; the
Burrows-Wheeler transform is kept as runs, with the suffix positions at the
starts and ends of runs.  A suffix whose transform symbol equals that of the
suffix sorted before it shares one character less with its neighbour than the
suffix one place to the left in the text does.  So match lengths are compared
character by character only at the sampled run starts; all others follow by
streaming over the text and taking one off at each step.
"""

from __future__ import annotations

import numpy as np

KEY_BITS = 62


def _packed(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """For each place, the symbols from there to the end mark as one number (the first few of them), and how many fit."""
    alphabet = np.unique(text)
    code = np.zeros(int(alphabet[-1]) + 1, dtype=np.int64)
    code[alphabet] = np.arange(len(alphabet))  # the end mark, 0, stays 0
    bits = max(1, int(len(alphabet) - 1).bit_length())
    count = KEY_BITS // bits
    symbols = np.concatenate([code[text], np.zeros(count, dtype=np.int64)]).astype(np.uint16)
    left = ends - np.arange(len(text), dtype=np.int32)
    key = np.zeros(len(text), dtype=np.int64)
    for k in range(count):
        key <<= bits
        key |= np.where(left >= k, symbols[k : k + len(text)], np.uint16(0))
    return key, count


def suffixes(key: np.ndarray, count: int, ends: np.ndarray) -> np.ndarray:
    """Start of each suffix, in sorted order; ties at end marks go by place.

    ``key``: the first ``count`` symbols of each place as a number; ``ends``:
    for each place, that of the next end mark.  Ranks by twice as many symbols
    are made only for places that still share theirs.
    """
    n = len(key)
    rank = np.unique(key, return_inverse=True)[1]
    times = np.bincount(rank)
    rank = (np.cumsum(times) - times)[rank]  # the number of smaller suffixes, which leaves room for finer ranks
    longest, size = int((ends - np.arange(n)).max(initial=0)), count
    while size <= longest:
        times = np.bincount(rank)
        open_places = np.flatnonzero(times[rank] > 1)
        if not len(open_places):
            break
        at = open_places + size
        further = np.where(at <= ends[open_places], rank[np.minimum(at, n - 1)] + 1, 0)
        pair = rank[open_places] * (n + 1) + further
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        new_group = np.concatenate([[True], pair[1:] != pair[:-1]])
        if int(new_group.sum()) == int((times > 1).sum()):
            break  # nothing was told apart, nor will be
        # within each old rank, the place among its open suffixes where the new group begins
        old = pair // (n + 1)
        old_start = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        within = np.arange(len(pair)) - np.repeat(old_start, np.diff(np.concatenate([old_start, [len(pair)]])))
        begins = np.maximum.accumulate(np.where(new_group, np.arange(len(pair)), 0))
        rank[open_places[order]] = old + within[begins]
        size *= 2
    return np.argsort(rank, kind="stable").astype(np.int32)


def _shared(text: np.ndarray, key: np.ndarray, count: int, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``a`` and ``b`` have in common; end marks differ."""
    out = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    while len(live):  # several symbols at a time
        x, y = a[live] + out[live], b[live] + out[live]
        same = (key[x] == key[y]) & (ends[x] - x >= count) & (ends[y] - y >= count)
        live = live[same]
        out[live] += count
    live = np.arange(len(a))
    while len(live):  # the rest one by one
        x, y = a[live] + out[live], b[live] + out[live]
        live = live[(text[x] == text[y]) & (text[x] != 0)]
        out[live] += 1
    return out


class RunIndex:
    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) + 1 for s in strings], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        marks = self.starts[1:] - 1
        text = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int16) + np.int16(1)
        text[marks] = 0
        self.text = text
        self.ends = np.repeat(marks.astype(np.int32), lengths)
        self.key, self.count = _packed(text, self.ends)
        self.order = suffixes(self.key, self.count, self.ends)
        before = text[self.order - 1]  # the transform; the text ends with a mark, so the first suffix gets one too
        head = np.ones(len(text), dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)  # end marks differ from each other
        self.run_starts = np.flatnonzero(head)
        self.head_samples = self.order[self.run_starts]
        self.end_samples = self.order[self.run_starts[1:] - 1]  # the suffix sorted before each run but the first

    def neighbour_lengths(self) -> np.ndarray:
        """For each place in the text, how much its suffix shares with the one sorted before it."""
        sampled = np.concatenate([[0], _shared(self.text, self.key, self.count, self.ends, self.head_samples[1:], self.end_samples)])
        at = np.zeros(len(self.text), dtype=np.int64)
        at[self.head_samples] = sampled
        known = np.zeros(len(self.text), dtype=bool)
        known[self.head_samples] = True
        last = np.maximum.accumulate(np.where(known, np.arange(len(self.text)), 0))
        return at[last] - (np.arange(len(self.text)) - last)

    def _statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """In sorted order: what each suffix shares with the one before it, and its longest match with any other."""
        shared = self.neighbour_lengths()[self.order]
        return shared, np.maximum(shared, np.concatenate([shared[1:], [0]]))

    def matching_statistics(self) -> np.ndarray:
        """For each place, the length of its longest match with any other place."""
        out = np.empty(len(self.text), dtype=np.int64)
        out[self.order] = self._statistics()[1]
        return out

    def repeats(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where ``size`` bytes start that also start at a smaller place:
        the number of the string, and the place in it."""
        shared, longest = self._statistics()
        group = np.flatnonzero(np.concatenate([[True], shared[1:] < size]))
        first = np.repeat(np.minimum.reduceat(self.order, group), np.diff(np.concatenate([group, [len(self.order)]])))
        later = np.sort(self.order[(longest >= size) & (first != self.order)])
        string = np.searchsorted(self.starts, later, "right") - 1
        return string, later - self.starts[string]
