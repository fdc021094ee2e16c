"""Best-fit packing of documents into bins of equal capacity, with conflicts.

A bin takes no two documents of one duplicate cluster and at most ``per_source`` of
one source. Bins are kept in order of their free room and carry bitmaps: one of the
clusters they hold, and one for each count of documents they hold of a source. A
document goes to the successor of its size in that order, the tightest bin with room
for it; while the bitmaps forbid a bin, the search goes on to the next tighter one,
so the bin found is the tightest compatible one, and if there is none a new bin is
opened. Larger documents go first.

Documents over the capacity are cut into full pieces, each a bin of its own, and a
rest that is packed like a document. Documents are dealt to packing groups of about
``group_rows`` by hash; groups are packed apart, so work per group is bounded and a
lost task repeats only its groups. Only sizes and keys are shuffled, never texts.

Results for unusual input: documents without words form no piece and are left out
unless ``keep_empty``, where they come back without bin; a null source is a source
of its own; null text is empty; equal texts are one cluster where no cluster column
is given, and a null in that column conflicts with nothing; rows that repeat an id
are packed as documents of their own; ties in size go by id, cluster and source; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.llm.common import whole_groups

SCHEMA = "doc_id long, piece int, pack_group long, bin long, place int, offset int, length int, free int"


class Bins:
    """Open bins in order of free room, with bitmaps of what they hold."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # free room, bin
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # bitmaps of sources held at least once, twice ...
        self.free: list[int] = []

    def put(self, size: int, source: int, cluster: int) -> int:
        """The bin taken. ``source`` and ``cluster`` are single bits, or 0."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            free, found = self.order[at]
            if not self.clusters[found] & cluster and not self.sources[found][-1] & source:
                del self.order[at]
                break
            at += 1
        else:
            found, free = self.open()
        self.clusters[found] |= cluster
        for i, held in enumerate(levels := self.sources[found]):
            if not held & source:
                levels[i] = held | source
                break
        self.free[found] = free - size
        if free > size:
            insort(self.order, (free - size, found))
        return found

    def open(self) -> tuple[int, int]:
        self.clusters.append(0)
        self.sources.append([0] * self.per_source)
        self.free.append(self.capacity)
        return len(self.free) - 1, self.capacity


def _pack_group(rows: list[dict], capacity: int, per_source: int) -> list[tuple]:
    """Rows of one group, packed; largest first."""
    bins = Bins(capacity, per_source)
    seen: dict[int, int] = {}
    for row in rows:
        if row["cluster"] is not None:
            seen[row["cluster"]] = seen.get(row["cluster"], 0) + 1
    shared = {c: 1 << i for i, c in enumerate(sorted(c for c, n in seen.items() if n > 1))}
    names = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, s))
    bit = {s: 1 << i for i, s in enumerate(names)}
    pieces = []
    for row in rows:
        full, rest = divmod(row["size"], capacity)
        pieces += [(capacity, row, i) for i in range(full)]
        if rest:
            pieces.append((rest, row, full))
    pieces.sort(key=lambda p: (-p[0], p[1]["doc_id"] is None, p[1]["doc_id"] or 0, p[1]["cluster"] or 0, str(p[1]["source"]), p[2]))
    placed, count, filled = [], {}, {}
    for size, row, piece in pieces:
        whole = size == capacity
        found = bins.put(size, 0 if whole else bit[row["source"]], 0 if whole else shared.get(row["cluster"], 0))
        placed.append((row["doc_id"], piece, row["pack_group"], found, count.get(found, 0), filled.get(found, 0), size))
        count[found] = count.get(found, 0) + 1
        filled[found] = filled.get(found, 0) + size
    return [(*p, bins.free[p[3]]) for p in placed]


def _packer(capacity: int, per_source: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("piece", pa.int32()), ("pack_group", pa.int64()), ("bin", pa.int64())]
            + [(n, pa.int32()) for n in ("place", "offset", "length", "free")]
        )
        for some in whole_groups(batches, "pack_group"):
            groups: dict[int, list[dict]] = {}
            for row in some.to_pylist():
                groups.setdefault(row["pack_group"], []).append(row)
            for rows in groups.values():
                packed = _pack_group(rows, capacity, per_source)
                for i in range(0, len(packed), 10_000):
                    columns = zip(*packed[i : i + 10_000])
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def best_fit_packing(
    docs: DataFrame,
    size: Column,
    cluster: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    capacity: int = 4096,
    per_source: int = 8,
    group_rows: int = 4096,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per piece: its bin (``pack_group`` and ``bin`` name it), its place and
    offset in the bin, its length, and the room the bin has left in the end.

    ``size`` and ``cluster`` are made from the columns of ``docs``.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        cluster.cast("long").alias("cluster"),
    )
    n = max(1, -(-docs.count() // group_rows))
    group = F.pmod(F.xxhash64(F.lit("pack"), "doc_id", "cluster", "size"), F.lit(n))
    dealt = rows.where("size > 0").withColumn("pack_group", group).repartition("pack_group").sortWithinPartitions("pack_group")
    packed = dealt.mapInArrow(_packer(capacity, per_source), SCHEMA)
    if not keep_empty:
        return packed
    empty = rows.where("size <= 0").select("doc_id")
    return packed.unionByName(empty, allowMissingColumns=True)
