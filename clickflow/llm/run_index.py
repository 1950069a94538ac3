"""A plain suffix order of many short strings with its Burrows-Wheeler transform, held inside one task.

Next to the runs of the transform (character, where it begins, how many of that character
stand before) it keeps arrays as long as the text: the run of every position, and the borders
of the intervals of suffixes that share ``depth`` bytes.  So it is not compressed by runs;
the samples at run ends serve ``locate``, which only a test uses.  Strings are streamed through it from
their ends, all of them in step: each step is one LF mapping through the run a position lies
in, and lengthens every match by a byte.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys, and each one's dense rank."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, rank


class RunIndex:
    """Index over the strings ``buf[at[i]:at[i + 1]]``; ``owner[i]`` is a number of string i."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, owner: np.ndarray, depth: int = 50):
        lengths = np.diff(at)
        n = len(buf) + len(lengths)
        self.n, self.depth = n, depth
        # symbols 1..256 for bytes, 0 ends a string
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = buf.astype(np.int64) + 1
        string = np.repeat(np.arange(len(lengths)), lengths + 1)
        left = ends[string] - np.arange(n)  # bytes up to the string's end
        # prefix doubling from 7 symbols; what lies beyond a string's end counts as 0
        key = np.zeros(n, U64)
        for i in range(7):
            symbol = np.zeros(n, U64)
            symbol[: n - i] = text[i:].astype(U64)
            symbol[left < i] = 0
            key = (key << U64(9)) | symbol
        rank, width, longest = _ranked(key)[1], 7, int(lengths.max()) + 1
        shared = {7: rank}
        while width < longest:
            second = np.zeros(n, np.int64)
            second[: n - width] = rank[width:] + 1
            second[left < width] = 0
            rank = _ranked(rank * (n + 2) + second)[1]
            width *= 2
            if width <= depth:
                shared[width] = rank
        suffix = np.argsort(rank * n + np.arange(n))  # equal suffixes in the order of their strings
        before = np.zeros(n, np.int64)
        before[1:] = text[:-1]
        self._runs(before[suffix], text, suffix)
        borders = self._borders(shared, left, suffix)
        self.block = np.cumsum(borders) - 1
        self.least = np.minimum.reduceat(owner[string[suffix]], np.flatnonzero(borders))

    def _runs(self, transform: np.ndarray, text: np.ndarray, suffix: np.ndarray) -> None:
        start = np.flatnonzero(np.append(True, transform[1:] != transform[:-1]))
        self.run_char, self.run_start = transform[start], start
        size = np.diff(np.append(start, self.n))
        order = np.argsort(self.run_char, kind="stable")
        total = np.cumsum(size[order]) - size[order]
        first_run = np.searchsorted(self.run_char[order], self.run_char[order])
        self.run_before = np.empty(len(start), np.int64)
        self.run_before[order] = total - total[first_run]
        begin = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=257))])  # the first suffix of each symbol
        self.run_shift = begin[self.run_char] + self.run_before - start
        self.run_of = np.repeat(np.arange(len(start)), size)
        self.run_ends = suffix[start], suffix[start + size - 1]  # samples at both ends of each run
        self.heads = np.flatnonzero(transform == 0)  # whole strings: there is no byte before them
        self.head_at = suffix[self.heads]

    def _borders(self, shared: dict[int, np.ndarray], left: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Where a suffix doesn't share ``depth`` bytes with the one before it."""
        width = max(shared)
        rank, a, b = shared[width], suffix[:-1], suffix[1:]
        at = np.flatnonzero((rank[a] == rank[b]) & (left[a] >= self.depth) & (left[b] >= self.depth))
        covered = width
        while covered < self.depth:  # the rest of the depth in overlapping pieces
            shift = min(covered, self.depth - width)
            at = at[rank[a[at] + shift] == rank[b[at] + shift]]
            covered = shift + width
        border = np.ones(self.n, bool)
        border[1 + at] = False
        return border

    def step(self, position: np.ndarray) -> np.ndarray:
        """LF: the suffixes one byte longer than those at ``position``."""
        return position + self.run_shift[self.run_of[position]]

    def locate(self, position: int) -> int:
        """Where the suffix at a position begins (strings with their ends joined), from the nearest sample."""
        steps = 0
        while True:
            run = self.run_of[position]
            last = (self.run_start[run + 1] if run + 1 < len(self.run_start) else self.n) - 1
            for at, sample in ((self.run_start[run], self.run_ends[0][run]), (last, self.run_ends[1][run])):
                if position == at:
                    return int(sample) + steps
            if self.run_char[run] == 0:
                return int(self.head_at[np.searchsorted(self.heads, position)]) + steps
            position, steps = int(self.step(np.array([position]))[0]), steps + 1

    def least_owners(self, lengths: np.ndarray, most: int) -> np.ndarray:
        """For each window of ``depth`` bytes of each string, the least owner of a string that holds it.

        A string starts at its end mark, which stands at its own number in the index.  After
        ``step`` steps its match is that long; from ``depth`` on, the interval of the suffix says
        who else has the window.  Returns (strings, most windows)."""
        out = np.full((len(lengths), most), np.iinfo(np.int64).max, np.int64)
        live, position = np.arange(len(lengths)), np.arange(len(lengths))
        for step in range(int(lengths.max()) if len(lengths) else 0):
            going = lengths[live] > step
            live, position = live[going], self.step(position[going])
            if step >= self.depth - 1:
                out[live, lengths[live] - 1 - step] = self.least[self.block[position]]
        return out
