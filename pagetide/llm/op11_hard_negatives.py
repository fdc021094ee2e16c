"""Hard negatives by best-first search in STR-packed R-trees of vectors.

Vectors become integers, ``floor(scale * x)``. All rows are packed by sort and tile:
ranges of (label, first coordinate), in each of which slices by the coordinates of
largest spread fill leaves of ``LEAF`` rows. A tree holds ``TREE`` rows or so and is one
row of a table. Every leaf and every node above has a bounding box: the least and the
greatest value of each coordinate and of the label. For a query vector a box gives an
interval per coordinate, ``[min(q * low, q * high), max(q * low, q * high)]``, and
their sums bound every inner product in it.

A search asks for the ``k`` best rows of the same or of another label with scores
inside a window. Each search takes the box with the greatest upper bound first; it
leaves a box out if its interval misses the window, if its labels cannot do, or if its
upper bound is strictly below the k-th best score so far. Searches that reach one leaf
in the same round meet its rows in one product of matrices.

Two such passes are made: the first finds each anchor's positives, and their scores
give the windows of the second. Anchors travel in large blocks, and each block meets
the trees in streams, whose best rows are merged at the end: what is shuffled are trees
once per block of anchors and ``k`` rows per search and stream, never a row per pair.

Scores are exact: in double precision where sums stay below 2**53, in 64-bit or
unbounded integers beyond. Scores past a long's range count as its end.

Results for unusual input: rows whose label or vector is null or whose vector holds a
null or a non-finite component take no part, nor do rows without id; vectors of
different lengths are not compared, and each length is searched apart; an empty vector
scores 0; rows of one id are never each other's partners, but are rows of their own
as partners of others; of those with one id and label, the one of fewest components
and then the smallest is the anchor; ties go to the smaller id; fewer rows than asked
for give fewer rows; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import (
    LONG, meetings, narrow, packed, products, starts_of, stored, streams_of, unpacked, whole_groups, whole_vectors,
)

#: Rows of a tree, of a leaf, boxes under a node, anchors in a block.
TREE, LEAF, FAN, ANCHORS = 8192, 128, 8, 16384


def _square(vectors: pa.Table | pa.RecordBatch, size: int) -> np.ndarray:
    column = vectors.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def tiled(square: np.ndarray, axes: np.ndarray, leaf: int) -> np.ndarray:
    """Order of rows in which neighbours fill leaves: slabs of equal counts along the
    first axis, in each of them along the next, and so on."""
    rows = np.arange(len(square))
    leaves = -(-len(rows) // leaf)
    if leaves <= 1 or not len(axes):
        return rows
    axis = axes[0]
    order = rows[np.argsort(square[:, axis], kind="stable")]
    slabs = max(2, round(leaves ** (1 / min(len(axes), 3)))) if len(axes) > 1 else leaves
    width = -(-leaves // slabs) * leaf
    return np.concatenate([order[i : i + width][tiled(square[order[i : i + width]], axes[1:], leaf)] for i in range(0, len(order), width)])


def _trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the rows, which come sorted by length, label and leading coordinate."""
    for some in whole_groups(_parted(batches), "size", "part"):
        sizes, parts = some.column("size").to_numpy(), some.column("part").to_numpy()
        edges = starts_of(sizes, parts)
        for a, b in zip(edges[:-1], edges[1:]):
            rows, size = some.slice(a, b - a), int(sizes[a])
            square = _square(rows, size)
            labels, ids = rows.column("label").to_numpy(), rows.column("id").to_numpy()
            axes = np.argsort(-square.astype(np.float64).var(axis=0), kind="stable")[:2] if size else np.zeros(0, int)
            order = []  # tiles of one label, so that most leaves hold one
            by_label = starts_of(labels)
            for c, d in zip(by_label[:-1], by_label[1:]):
                order.append(c + tiled(square[c:d], axes, LEAF))
            order = np.concatenate(order)
            body = packed(ids[order].astype(np.int64), labels[order].astype(np.int64), narrow(square[order]).reshape(-1))
            yield pa.record_batch(
                [pa.array([size], pa.int32()), pa.array([b - a], pa.int64()), pa.array([body], pa.binary())],
                ["size", "n", "body"],
            )


def _parted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with a number that rises after each ``TREE`` rows."""
    seen = 0
    for batch in batches:
        part = (seen + np.arange(batch.num_rows)) // TREE
        seen += batch.num_rows
        yield batch.append_column("part", pa.array(part))


def _anchor_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with their searches' windows as one row per block of one length."""
    for some in whole_groups(batches, "size", "block"):
        sizes, blocks = some.column("size").to_numpy(), some.column("block").to_numpy()
        edges = starts_of(sizes, blocks)
        for a, b in zip(edges[:-1], edges[1:]):
            for c in range(a, b, ANCHORS):  # where one id repeats, a block may hold more
                rows = some.slice(c, min(b, c + ANCHORS) - c)
                square = narrow(_square(rows, int(sizes[a])))
                windows = rows.column("windows").to_pylist()
                counts = np.array([len(w) for w in windows])
                flat = np.array([(w["low"], w["high"]) for ws in windows for w in ws], np.int64).reshape(-1, 2)
                body = packed(
                    rows.column("id").to_numpy().astype(np.int64),
                    rows.column("label").to_numpy().astype(np.int64),
                    square.reshape(-1),
                    counts,
                    np.ascontiguousarray(flat[:, 0]),
                    np.ascontiguousarray(flat[:, 1]),
                )
                yield pa.record_batch(
                    [pa.array([sizes[a]], pa.int32()), pa.array([blocks[a]], pa.int64()), pa.array([body], pa.binary())],
                    ["size", "block", "body"],
                )


class Tree:
    """A packed tree: rows in leaf order, and boxes of leaves and of the nodes above."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, square: np.ndarray):
        self.ids, self.labels, self.square = ids, labels, square
        self.starts = np.append(np.arange(0, len(ids), LEAF), len(ids))
        at, n = self.starts[:-1], len(self.starts) - 1
        wide = square.astype(np.float64)
        low, high = np.minimum.reduceat(wide, at, axis=0), np.maximum.reduceat(wide, at, axis=0)
        least, most = np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at)
        #: Levels from the root's children down to the leaves: boxes, and where each one's children begin.
        self.levels = [(low, high, least, most)]
        while n > FAN:
            at = np.arange(0, n, FAN)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.insert(0, (low, high, least, most))
            n = len(at)


class Searches:
    """Searches of a block of anchors: windows, wanted labels and the best rows so far."""

    def __init__(self, blob: bytes, size: int, k: int, same: bool):
        ids, labels, flat, counts, low, high = unpacked(blob)
        self.anchor = np.repeat(np.arange(len(ids)), counts)
        self.ids, self.labels, self.vectors = ids, labels, flat.reshape(len(ids), size)
        self.low, self.high, self.k, self.same = low, high, k, same
        n = len(self.anchor)
        self.scores = np.full((n, k), -LONG - 1, np.int64)
        self.found = np.zeros((n, k), np.int64)
        self.count = np.zeros(n, np.int64)
        wide = self.vectors.astype(np.float64)
        self.up, self.down = np.maximum(wide, 0), np.minimum(wide, 0)
        self.norm = np.abs(wide).sum(axis=1)

    def _fits(self, search: np.ndarray, box: np.ndarray, level: tuple, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Whether boxes may hold rows of the searches' windows and labels that still count."""
        _, _, least, most = level
        own = self.labels[self.anchor[search]]
        if self.same:
            good = (least[box] <= own) & (own <= most[box])
        else:
            good = (least[box] != own) | (most[box] != own)
        full = self.count[search] >= self.k
        floor = np.maximum(self.low[search], np.where(full, self.scores[search, -1], -LONG - 1))
        return good & (upper >= floor) & (lower <= self.high[search])

    def _bounds(self, anchors: np.ndarray, level: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of the anchors' scores in all boxes of a level, with
        room for rounding."""
        low, high, *_ = level
        upper = self.up[anchors] @ high.T + self.down[anchors] @ low.T
        lower = self.up[anchors] @ low.T + self.down[anchors] @ high.T
        room = 1 + 1e-12 * self.norm[anchors][:, None] * np.maximum(np.abs(low), np.abs(high)).max(axis=1, initial=0)
        return np.maximum(upper + room, -(2.0**63)), np.minimum(lower - room, 2.0**63)

    def meet(self, tree: Tree) -> None:
        """All searches through one tree. The queue of a search is its row of upper
        bounds; every round takes each search's greatest one. A node of an upper level
        is replaced by its children, a leaf is read."""
        n, depth = len(self.anchor), len(tree.levels)
        if not n or not len(tree.ids):
            return
        anchors = np.arange(len(self.ids))
        bounds = [self._bounds(anchors, level) for level in tree.levels]
        # one queue over the boxes of all levels; those not reached yet have no bound
        sizes = [len(level[0]) for level in tree.levels]
        offset = np.r_[0, np.cumsum(sizes)]
        step = max(1, (32 << 20) // (8 * offset[-1]))
        for first in range(0, n, step):
            part = np.arange(first, min(n, first + step))
            queue = np.full((len(part), offset[-1]), -np.inf)
            queue[:, : sizes[0]] = bounds[0][0][self.anchor[part]]
            live = np.arange(len(part))
            while len(live):
                box = queue[live].argmax(axis=1)
                upper = queue[live, box]
                more = upper > -np.inf
                live, box, upper = live[more], box[more], upper[more]
                queue[live, box] = -np.inf
                level = np.searchsorted(offset, box, side="right") - 1
                alive = np.ones(len(live), bool)
                for depth_of in np.unique(level):
                    at = np.flatnonzero(level == depth_of)
                    search, own = part[live[at]], box[at] - offset[depth_of]
                    lower = bounds[depth_of][1][self.anchor[search], own]
                    good = self._fits(search, own, tree.levels[depth_of], upper[at], lower)
                    # the greatest bound is below the k-th best: so are all that follow
                    floor = np.where(self.count[search] >= self.k, self.scores[search, -1], -LONG - 1)
                    alive[at] = upper[at] >= np.maximum(floor, self.low[search])
                    at, search, own = at[good], search[good], own[good]
                    if depth_of == depth - 1:
                        self._read(tree, search, own)
                        continue
                    children = own[:, None] * FAN + np.arange(FAN)
                    inside = children < sizes[depth_of + 1]
                    who = np.repeat(np.arange(len(at)), FAN)[inside.ravel()]
                    child = children[inside]
                    queue[live[at][who], offset[depth_of + 1] + child] = bounds[depth_of + 1][0][self.anchor[search[who]], child]
                live = live[alive]

    def _read(self, tree: Tree, search: np.ndarray, leaf: np.ndarray) -> None:
        order = np.argsort(leaf, kind="stable")
        search, leaf = search[order], leaf[order]
        edges = starts_of(leaf)
        for a, b in zip(edges[:-1], edges[1:]):
            rows = slice(tree.starts[leaf[a]], tree.starts[leaf[a] + 1])
            some = search[a:b]
            anchors, which = np.unique(self.anchor[some], return_inverse=True)
            scores = products(self.vectors[anchors], tree.square[rows])[which]
            own = self.anchor[some]
            same = tree.labels[rows][None, :] == self.labels[own][:, None]
            good = (same == self.same) & (tree.ids[rows][None, :] != self.ids[own][:, None])
            good &= (scores >= self.low[some][:, None]) & (scores <= self.high[some][:, None])
            full = self.count[some] >= self.k
            good &= ~full[:, None] | (scores >= self.scores[some, -1][:, None])
            at, row = np.nonzero(good)
            if len(at):
                self._add(some, at, scores[at, row], tree.ids[rows][row])

    def _add(self, some: np.ndarray, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge new rows into the best ones of the searches ``some[at]``."""
        met = np.unique(at)
        old = np.repeat(met, self.k)
        known = np.tile(np.arange(self.k), len(met))
        has = known < self.count[some[old]]
        old, known = old[has], known[has]
        of = np.r_[at, old]
        scores = np.r_[scores, self.scores[some[old], known]]
        ids = np.r_[ids, self.found[some[old], known]]
        order = np.lexsort((ids, ~scores, of))
        of, scores, ids = of[order], scores[order], ids[order]
        edges = starts_of(of)
        rank = np.arange(len(of)) - np.repeat(edges[:-1], np.diff(edges))
        best = rank < self.k
        search = some[of[best]]
        self.scores[search, rank[best]], self.found[search, rank[best]] = scores[best], ids[best]
        self.count[some[of[edges[:-1]]]] = np.minimum(self.k, np.diff(edges))

    def batch(self) -> pa.RecordBatch:
        search, rank = np.nonzero(np.arange(self.k) < self.count[:, None])
        of = self.anchor[search]
        return pa.record_batch(
            [
                pa.array(self.ids[of]),
                pa.array(self.labels[of]),
                pa.array(self.low[search]),
                pa.array(self.high[search]),
                pa.array(self.found[search, rank]),
                pa.array(self.scores[search, rank]),
            ],
            ["anchor_id", "label", "low", "high", "id", "score"],
        )


def _search(k: int, same: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, searches = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["size"], row["block"], row["stream"]) != key:
                    for some in searches:
                        yield some.batch()
                    key, searches = (row["size"], row["block"], row["stream"]), []
                if row["kind"] == 0:
                    searches.append(Searches(row["body"], row["size"], k, same))
                elif searches:
                    ids, labels, flat = unpacked(row["body"])
                    tree = Tree(ids, labels, flat.reshape(len(ids), row["size"]))
                    for some in searches:
                        some.meet(tree)
        for some in searches:
            yield some.batch()

    return run


_FOUND = "anchor_id long, label long, low long, high long, id long, score long"


def _searched(anchors: DataFrame, trees: DataFrame, k: int, same: bool, streams: int) -> DataFrame:
    """The ``k`` best rows of each search, with their ranks."""
    blocks = max(1, -(-anchors.count() // ANCHORS))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    dealt = dealt.repartition("size", "block").sortWithinPartitions("size", "block", "id")
    asked = dealt.mapInArrow(_anchor_blocks, "size int, block long, body binary")
    found = meetings(asked, trees, blocks, streams).mapInArrow(_search(k, same), _FOUND)
    order = Window.partitionBy("anchor_id", "label", "low", "high").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    every: int = 50,
) -> DataFrame:
    """Per anchor and positive the negatives whose scores lie between ``least`` and
    ``most`` per cent of the positive's.

    Anchors are the rows whose id is divisible by ``every``. Labels are whole numbers.
    """
    label = F.col(label_col).cast("long").alias("label")
    rows = whole_vectors(vectors.where(F.col(label_col).isNotNull()), id_col, vector_col, scale, label)
    lead = F.coalesce(F.get("vector", F.lit(0)), F.lit(0))
    ranged = rows.withColumn("lead", lead)
    ranged = ranged.repartitionByRange("size", "label", "lead", "id").sortWithinPartitions("size", "label", "lead", "id")
    made = stored(ranged.mapInArrow(_trees, "size int, n long, body binary"), "trees")
    streams = streams_of(made.count())
    anchors = rows.where(F.col("id") % every == 0).groupBy("id", "label").agg(F.min(F.struct("size", "vector")).alias("v"))
    anchors = anchors.select("id", "label", "v.size", "v.vector")
    everything = F.array(F.struct(F.lit(-LONG - 1).alias("low"), F.lit(LONG).alias("high")))
    best = _searched(anchors.withColumn("windows", everything), made, positives, True, streams)
    best = stored(best.select("anchor_id", "label", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    positive = F.col("positive_score")
    window = F.struct(
        F.ceil(positive.cast("decimal(38,0)") * least / 100).cast("long").alias("low"),
        F.floor(positive.cast("decimal(38,0)") * most / 100).cast("long").alias("high"),
    )
    pairs = best.withColumn("window", window)
    windows = pairs.where("window.low <= window.high").groupBy(F.col("anchor_id").alias("id"), "label")
    windows = windows.agg(F.collect_set("window").alias("windows"))
    found = _searched(anchors.join(windows, ["id", "label"]), made, negatives, False, streams)
    found = found.select("anchor_id", "label", "low", "high", F.col("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = pairs.select("anchor_id", "label", "positive_id", "positive_score", "window.low", "window.high")
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return pairs.join(found, ["anchor_id", "label", "low", "high"]).select(*columns)
