"""Column-wise construction of a collection's transform and common prefixes, through sequential files.

The strings are short, right-aligned and grouped by the core they share. Each round inserts one symbol of
every string, from the strings' ends: the new suffixes' places follow from the ranks of their symbols in the
Burrows-Wheeler transform so far, and the common prefix of two suffixes that now stand side by side is
their first symbol's weight plus the least common prefix between the two places they come from. No string is
compared with another. Equal strings are one that
counts twice: the common prefix of a suffix and its twin's is the whole suffix. The state (transform, common prefixes, whose suffix) is read and written in order, a
piece of whole groups at a time; what exceeds RESIDENT bytes is a file, one for each round, in a folder
that outlives the task, and only a piece and a few numbers for each string are in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyarrow import fs

PIECE, RESIDENT = 1 << 16, 1 << 22
CORE = 257  # the symbol of a core; bytes are 1 to 256, 0 ends a string
INDEX = 20  # bits of a place within a piece
SYMBOL = np.uint64(511 << INDEX)


class Sequence:
    """Arrays that are appended and read back in order: in memory up to `resident` bytes, then a file."""

    def __init__(self, folder: str | None, resident: int = RESIDENT):
        self.folder, self.resident = folder, resident
        self.held: list[np.ndarray] = []
        self.bytes, self.out, self.store, self.path = 0, None, None, ""

    def append(self, x: np.ndarray) -> None:
        self.bytes += x.nbytes
        self.held.append(x)
        if self.folder and (self.out or self.bytes > self.resident):
            if not self.out:
                self.store, root = fs.FileSystem.from_uri(self.folder)
                self.path = f"{root}/{uuid.uuid4().hex}"
                self.out = self.store.open_output_stream(self.path)
            for y in self.held:
                self.out.write(np.ascontiguousarray(y).view(np.uint8).data)
            self.held = []

    def read(self, like: list[tuple[int, type]]) -> Iterator[np.ndarray]:
        """The arrays again, by (length, type); the file goes when it has been read."""
        if not self.out:
            yield from self.held
            self.held = []
            return
        self.out.close()
        with self.store.open_input_stream(self.path) as f:
            for n, kind in like:
                yield np.frombuffer(f.read(n * np.dtype(kind).itemsize), kind)
        self.drop()

    def drop(self) -> None:
        self.held = []
        if self.out:
            self.out.close()
            self.out = None
            self.store.delete_file(self.path)


class Piece:
    """Strings of whole groups, and what is known about their suffixes between two rounds.

    The state is a 64-bit number for each suffix, in order: from its lowest bit the common prefix with the one before (16 bits), from
    bit INDEX the symbol before it (9), from bit 32 its length (9) and its string.
    """

    def __init__(self, groups: np.ndarray, lengths: np.ndarray, tails: np.ndarray, twice: np.ndarray):
        _, self.of, self.strings = np.unique(groups, return_inverse=True, return_counts=True)
        self.lengths, self.tails, self.twice, self.place = lengths, tails, twice, np.arange(len(groups))
        self.counts = self.strings.copy()

    def size(self) -> int:
        return int(self.counts.sum())

    def empty(self, ahead: np.ndarray) -> np.ndarray:
        """The state of the empty suffixes, before which stand the strings' last symbols."""
        return (np.arange(len(ahead)) << 41 | ahead.astype(np.int64) << INDEX).view(np.uint64)

    def insert(self, j: int, ahead: np.ndarray, state: np.ndarray, core: int) -> np.ndarray:
        """The state after round j. ahead: the symbol that stands before the inserted one in each string, 0 if none."""
        n, act = len(state), np.flatnonzero(self.lengths > j)
        if not len(act):
            return state
        # Suffixes by group, by the symbol before them and by their order: so the suffixes that these symbols begin are sorted.
        key = np.repeat(np.arange(len(self.counts)) << (9 + INDEX), self.counts)
        key += np.arange(n)
        key += (state & SYMBOL).view(np.int64)
        key.sort()
        order = key & ((1 << INDEX) - 1)
        at = self.place[act]
        fresh, whose = np.zeros(n, bool), np.empty(n, np.int32)
        fresh[at], whose[at] = True, np.arange(len(act))
        hit = np.flatnonzero(fresh[order])
        string = whose[order[hit]]
        # Within a group they follow the empty suffixes; ended strings give none.
        grown = self.counts + np.bincount(self.of[act], minlength=len(self.counts))
        ended = np.bincount(self.of[self.lengths <= j], minlength=len(self.counts))
        shift = (np.cumsum(grown) - grown) + self.strings - ended - (np.cumsum(self.counts) - self.counts)
        new = np.empty(len(act), np.int64)
        new[string] = hit + shift[self.of[act[string]]]
        # A new suffix changes its own common prefix and its successor's, no other.
        near = np.zeros(n + 1, bool)
        near[hit] = near[hit + 1] = True
        side = np.flatnonzero(near[1:n]) + 1
        side = side[key[side] >> INDEX == key[side - 1] >> INDEX]
        side = np.sort(order[side - 1] << INDEX | side) & ((1 << INDEX) - 1)  # by where they come from
        kind = key[side] >> INDEX
        old = np.ones(n + len(act), bool)
        old[new] = False
        out = np.empty(len(old), np.uint64)
        out[old] = state
        out[new] = ((act << 9 | j + 1) << 32 | ahead[act].astype(np.int64) << INDEX).view(np.uint64)
        if len(side):
            lcp = np.append(state.astype(np.uint16), np.uint16(0))
            ends = np.stack([order[side - 1], order[side]], 1).ravel() + 1
            least = np.minimum.reduceat(lcp, ends)[::2].astype(np.int64) + np.where(kind & 511 == CORE, core, 1)
            to = side + shift[kind >> 9]
            out[to] = (out[to] & ~np.uint64(0xFFFF)) | least.astype(np.uint64)
        self.counts, self.place[act] = grown, new
        return out

    def repeated(self, state: np.ndarray, length: int, core: int) -> tuple[np.ndarray, np.ndarray]:
        """(string, place in it) of each suffix that shares `length` bytes with a neighbour or its own twin."""
        string, size = (state >> np.uint64(41)).astype(np.int64), (state >> np.uint64(32)).astype(np.int64) & 511
        lcp = state.astype(np.uint16)
        own = np.where(self.twice[string], size + np.where(size > self.tails[string], core - 1, 0), 0)
        hit = np.flatnonzero(np.maximum(np.maximum(lcp, np.append(lcp[1:], 0)), own) >= length)
        return string[hit], self.lengths[string[hit]] - size[hit]


def pieces_of(groups: np.ndarray, lengths: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """Ranges of strings: whole groups, of `piece` suffixes together where a group isn't larger."""
    starts = np.flatnonzero(np.diff(groups, prepend=-1))
    ends = np.append(starts[1:], len(groups))
    total = np.append(0, np.cumsum(lengths + 1))
    out, lo = [], 0
    for end in ends.tolist():
        if out and lo == out[-1][0] and total[end] - total[lo] <= piece:
            out[-1] = (lo, end)
        else:
            lo = out[-1][1] if out else 0
            out.append((lo, end))
    return out


def repeats(
    groups: np.ndarray, symbols: np.ndarray, lengths: np.ndarray, tails: np.ndarray, twice: np.ndarray, core: int, length: int, folder: str | None = None, piece: int = PIECE, resident: int = RESIDENT
) -> tuple[np.ndarray, np.ndarray]:
    """(string, place) of every suffix that another string of its group, or a copy of its own, shares `length` bytes of.

    groups: ascending, one for each string; symbols: a row for each round (the strings' last symbols first), 0 where a string has
    ended; tails: how many symbols stand behind the core; twice: whether a string occurs more than once.
    """
    cut = [(lo, hi, Piece(*(x[lo:hi] for x in (groups, lengths, tails, twice)))) for lo, hi in pieces_of(groups, lengths, piece)]
    if any(int((lengths[lo:hi] + 1).sum()) >> INDEX for lo, hi, _ in cut):
        raise ValueError("a group is too large for one piece")
    width = len(symbols)
    columns, state = Sequence(folder, resident), Sequence(folder, resident)
    try:
        for column in symbols:
            columns.append(column)
        column = columns.read([(len(groups), np.uint16)] * width)
        ahead = next(column)
        for lo, hi, p in cut:
            state.append(p.empty(ahead[lo:hi]))
        for j in range(width):
            ahead = next(column, None)
            if ahead is None:
                ahead = np.zeros(len(groups), np.uint16)
            before, state = state, Sequence(folder, resident)
            try:
                found = before.read([(p.size(), np.uint64) for _, _, p in cut])
                for lo, hi, p in cut:
                    state.append(p.insert(j, ahead[lo:hi], next(found), core))
            finally:
                before.drop()
        out = []
        found = state.read([(p.size(), np.uint64) for _, _, p in cut])
        for lo, _, p in cut:
            string, place = p.repeated(next(found), length, core)
            out.append((string + lo, place))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
    finally:
        columns.drop()
        state.drop()
