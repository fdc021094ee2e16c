"""Hashes seen once and seen again, by two Bloom filters per segment of the hashes.

Hashes are dealt to segments by their high bits. A segment's first filter knows what it
has seen, the second one what it has seen before; every hash of two rows or more is in
the second, and some others. The second filters of all segments have a bound together
and can be broadcast; hashes that they do not tell apart count as seen again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from pagetide.llm.common import U64, mixed

#: Hashes to a segment, bits of its filters per hash, hash functions.
SEGMENT, PER_HASH, TRIES = 1 << 20, 16, 4
#: Counters of a segment, in each of two rows.
COUNTERS = 1 << 18


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(segments)) >> U64(32)


class Bloom:
    """A bit array that knows every hash put in, and some others."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = max(64, bits)
        self.bytes = np.zeros(-(-self.bits // 8), np.uint8) if words is None else words

    def _places(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = mixed(hashes, 11) | U64(1)
        for i in range(TRIES):
            at = (mixed(hashes + U64(i) * step, 12) % U64(self.bits)).astype(np.int64)
            yield at >> 3, (np.uint8(1) << (at & 7).astype(np.uint8))

    def add(self, hashes: np.ndarray) -> None:
        for at, bit in self._places(hashes):
            np.bitwise_or.at(self.bytes, at, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        known = np.ones(len(hashes), bool)
        for at, bit in self._places(hashes):
            known &= (self.bytes[at] & bit) != 0
        return known


class Counts:
    """Counters that several hashes may share: a hash's count is never too small."""

    def __init__(self):
        self.rows = [np.zeros(COUNTERS, np.int64) for _ in range(2)]

    def add(self, hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The counts of distinct hashes with ``n`` more of each."""
        found = None
        for i, row in enumerate(self.rows):
            at = (mixed(hashes, 21 + i) % U64(COUNTERS)).astype(np.int64)
            np.add.at(row, at, n)
            found = row[at] if found is None else np.minimum(found, row[at])
        return found


def filters_of(
    bits: int,
    read: Callable[[dict], tuple[np.ndarray, ...]],
    levels: tuple[int, ...] = (),
    level_bits: int = 0,
):
    """Of each segment the filter of hashes seen again, ``bits`` wide. The rows of a task
    are its segments one after the other; ``read`` gives the distinct hashes of a row and
    which of them it has seen again itself. With ``levels``, ``read`` gives numbers too, and
    a list of filters, ``level_bits`` wide, has the hashes whose numbers add up to each."""
    once_bits = SEGMENT * PER_HASH

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = once = again = counts = None
        more: list[Bloom] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["segment"] != own:
                    if own is not None:
                        yield _filter_row(own, again, more)
                    own, once, again = row["segment"], Bloom(once_bits), Bloom(bits)
                    more = [Bloom(level_bits) for _ in levels]
                    counts = Counts() if levels else None
                hashes, twice, *numbers = read(row)
                again.add(hashes[twice | once.has(hashes)])
                once.add(hashes)
                if counts is not None:
                    sums = counts.add(hashes, numbers[0])
                    for level, known in zip(levels, more):
                        known.add(hashes[sums >= level])
        if own is not None:
            yield _filter_row(own, again, more)

    return run


def _filter_row(segment: int, again: Bloom, more: list[Bloom]) -> pa.RecordBatch:
    columns = [pa.array([segment], pa.int32()), pa.array([again.bytes.tobytes()], pa.binary())]
    names = ["segment", "filter"]
    if more:
        columns.append(pa.array([[m.bytes.tobytes() for m in more]], pa.list_(pa.binary())))
        names.append("more")
    return pa.record_batch(columns, names)


def known_again(filters: dict[int, bytes], bits: int) -> Callable[[np.ndarray, int], np.ndarray]:
    """A function that tells which hashes the filters have seen again."""
    known = {s: Bloom(bits, np.frombuffer(f, np.uint8)) for s, f in filters.items()}

    def ask(hashes: np.ndarray, segments: int) -> np.ndarray:
        of = segment_of(hashes, segments).astype(np.int64)
        found = np.zeros(len(hashes), bool)
        order = np.argsort(of, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(of[order], prepend=-1) != 0), len(of))
        for a, b in zip(edges[:-1], edges[1:]):
            if (own := known.get(int(of[order[a]]))) is not None:
                found[order[a:b]] = own.has(hashes[order[a:b]])
        return found

    return ask
