"""Acyclic automata that carry the counts of word sequences.

A transducer reads a path of symbols, all of its paths being equally long (two at least), and adds up
the outputs on the way: the sum is the path's count. It is built from sorted paths, a run
at a time. A state is complete when its run ends; the least output of its arcs
then moves to the arc that leads to it, and states with equal arcs are one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class CountTransducer:
    """``symbols`` ascend; state ``s`` has the arcs ``start[s]`` to ``start[s + 1]``, by ascending label. The last state is the first to read."""

    depth: int
    symbols: list[bytes]
    start: np.ndarray
    label: np.ndarray
    output: np.ndarray
    target: np.ndarray

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All paths in order, a row of symbol numbers each, and their counts."""
        state, total = np.array([len(self.start) - 2]), np.zeros(1, dtype=np.int64)
        found = np.zeros((1, 0), dtype=np.int32)
        for _ in range(self.depth):
            arcs = self.start[state + 1] - self.start[state]
            at = np.repeat(self.start[state] - np.cumsum(arcs) + arcs, arcs) + np.arange(arcs.sum())
            found = np.column_stack([np.repeat(found, arcs, axis=0), self.label[at]])
            total = np.repeat(total, arcs) + self.output[at]
            state = self.target[at]
        return found, total

    def compose(self, asked: CountTransducer) -> np.ndarray:
        """The counts of the paths of ``asked``, in its order; -1 for paths this one does not have."""
        own = {s: i for i, s in enumerate(self.symbols)}
        number = np.array([own.get(s, -1) for s in asked.symbols], dtype=np.int64)
        wanted = number[asked.paths()[0]]
        width = len(self.symbols) + 1
        arcs = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start)) * width + self.label
        state = np.full(len(wanted), len(self.start) - 2, dtype=np.int64)
        total, known = np.zeros(len(wanted), dtype=np.int64), np.ones(len(wanted), dtype=bool)
        for step in range(self.depth):
            at = np.minimum(np.searchsorted(arcs, state * width + wanted[:, step]), len(arcs) - 1)
            known &= (wanted[:, step] >= 0) & (arcs[at] == state * width + wanted[:, step])
            total += self.output[at]
            state = self.target[at].astype(np.int64)
        return np.where(known, total, -1)

    def to_bytes(self) -> bytes:
        lengths = np.array([len(s) for s in self.symbols], dtype="<i4")
        parts = [lengths, self.start.astype("<i4"), self.label.astype("<i4"), self.target.astype("<i4"), self.output.astype("<i8")]
        head = struct.pack("<4i", self.depth, len(lengths), len(self.start), len(self.label))
        return head + zlib.compress(b"".join([*(p.tobytes() for p in parts), *self.symbols]), 1)

    @classmethod
    def from_bytes(cls, blob: bytes) -> CountTransducer:
        depth, n_symbols, n_states, n_arcs = struct.unpack_from("<4i", blob)
        data, at, parts = zlib.decompress(memoryview(blob)[16:]), 0, []
        for n, kind in ((n_symbols, "<i4"), (n_states, "<i4"), (n_arcs, "<i4"), (n_arcs, "<i4"), (n_arcs, "<i8")):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        lengths, start, label, target, output = parts
        ends = at + np.cumsum(lengths)
        symbols = [data[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        return cls(depth, symbols, start.astype(np.int64), label, output, target)


def build(paths: np.ndarray, counts: np.ndarray, symbols: Sequence[bytes]) -> CountTransducer:
    """The transducer of different ``paths``, which ascend, over ascending ``symbols``. It holds the used symbols only.

    Paths that share all but the last symbol are consecutive, and make one state: each such run is looked up
    among the states that the runs before it have made. The runs' common parts, ascending as well, are the paths of the level above.
    """
    seen = np.zeros(len(symbols), dtype=bool)
    seen[paths] = True
    used = np.flatnonzero(seen)
    paths = (np.cumsum(seen) - 1)[paths].astype(np.int32)
    output, target = counts.astype(np.int64), np.zeros(len(paths), dtype=np.int32)
    sizes, labels, outputs, targets, n_states = [], [], [], [], 0
    for level in range(paths.shape[1] - 1, 0, -1):
        prefix, label = paths[:, :level], paths[:, level]
        starts = _starts(prefix)
        length = np.diff(np.r_[starts, len(paths)])
        least = np.minimum.reduceat(output, starts) if len(starts) else output
        output = output - np.repeat(least, length)
        arcs = np.column_stack([label, target, output.astype(np.int32) if not len(output) or output.max() < 1 << 31 else output.view(np.int32).reshape(-1, 2)])
        told, wide = arcs.tobytes(), arcs.strides[0]
        register: dict[bytes, int] = {}
        ends = ((starts + length) * wide).tolist()
        number = np.array([register.setdefault(told[s:e], len(register)) for s, e in zip((starts * wide).tolist(), ends, strict=True)], dtype=np.int32)
        new = np.zeros(len(starts), dtype=bool)
        new[np.unique(number, return_index=True)[1]] = True
        arc = np.repeat(new, length)
        sizes.append(length[new])
        labels.append(label[arc])
        outputs.append(output[arc])
        targets.append(target[arc])
        paths, output, target = prefix[starts], least, number + np.int32(n_states)
        n_states += len(register)
    # The first state keeps the least output: no arc leads to it.
    label, output, target = np.concatenate([*labels, paths[:, 0]]), np.concatenate([*outputs, output]), np.concatenate([*targets, target])
    start = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, [len(paths)]]))])
    return CountTransducer(len(sizes) + 1, [symbols[i] for i in used.tolist()], start.astype(np.int64), label, output, target)


def _starts(paths: np.ndarray) -> np.ndarray:
    """Where another path begins."""
    if not len(paths):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.r_[True, (paths[1:] != paths[:-1]).any(axis=1)])


def union(parts: Sequence[CountTransducer]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All paths of ``parts`` in order, the sums of their counts, and the symbols."""
    symbols = sorted({s for p in parts for s in p.symbols})
    number = {s: i for i, s in enumerate(symbols)}
    read = [p.paths() for p in parts]
    paths = np.concatenate([np.array([number[s] for s in p.symbols], dtype=np.int32)[found] for p, (found, _) in zip(parts, read, strict=True)])
    counts = np.concatenate([c for _, c in read])
    order = np.lexsort(paths.T[::-1])
    paths, counts = paths[order], counts[order]
    starts = _starts(paths)
    return paths[starts], np.add.reduceat(counts, starts) if len(starts) else counts, symbols


def by_range(paths: np.ndarray, symbols: Sequence[bytes], bounds: Sequence[tuple[bytes, ...]]) -> Iterator[tuple[int, int, int]]:
    """``(range, from, to)`` of the ascending ``paths``; a bound is the least path of the next range."""

    def first_from(bound, low):
        high = len(paths)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if tuple(symbols[i] for i in paths[mid].tolist()) < bound else (low, mid)
        return low

    at = 0
    for n, bound in enumerate(bounds):
        end = first_from(bound, at)
        if end > at:
            yield n, at, end
        at = end
    if at < len(paths):
        yield len(bounds), at, len(paths)
