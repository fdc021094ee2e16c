"""Exact top-k by integer inner product, with columnar branch and bound.

Vectors become integers, ``floor(scale * x)``. Candidates lie in blocks stored
dimension by dimension. For one query, scores of a block grow by a few dimensions
at a time; after each step a candidate stays only if its score so far plus the
most that the remaining dimensions can add (the product of the remaining norms)
still reaches the query's k-th best. The survivors are compacted, so most
candidates are left after a few dimensions.

Queries are rows of the same table. They go out in large blocks, and each block of
queries meets the candidates in streams of blocks, whose k best per query are merged
at the end. Vectors travel as integers of 2, 4 or 8 bytes; a block of candidates is
sent once per 16,384 queries and a block of queries once per stream, and no row per
pair is made. No block depends on another, so a lost task is repeated alone. Blocks
whose sums might not be exact in double precision are scored in whole numbers instead.

Results for unusual input: vectors that are null or hold null or non-finite
components, and rows without id, take no part, neither as query nor as candidate;
vectors of different lengths are not compared; an empty vector scores 0; components and scores are held to a long's range; of rows
with one id, a query meets all but those of its own id, and each such row asks, but
the answers, being equal in id, are merged to the k best; fewer candidates than k
give fewer rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import (
    EXACT, largest_sum, meetings, narrow, packed, products, starts_of, streams_of, unpacked, whole_groups, whole_vectors,
)

#: Vectors of a candidate block, of a query block, dimensions a step.
CANDIDATES, QUERIES, STEP = 4096, 16384, 8


def _pack(width: int):
    """Blocks of vectors of one length, stored dimension by dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches, "size", "block"):
            sizes, blocks, ids = (some.column(c).to_numpy() for c in ("size", "block", "id"))
            vectors = some.column("vector").combine_chunks()
            edges = starts_of(sizes, blocks)
            for first, end in zip(edges[:-1], edges[1:]):
                flat = vectors.slice(first, end - first).flatten().to_numpy(zero_copy_only=False)
                square = flat.astype(np.int64).reshape(end - first, sizes[first])
                for i in range(0, end - first, width):
                    own = ids[first + i : min(end, first + i + width)].astype(np.int64)
                    body = packed(own, narrow(np.ascontiguousarray(square[i : i + width].T)).reshape(-1))
                    yield pa.record_batch(
                        [pa.array([sizes[first]], pa.int32()), pa.array([blocks[first]], pa.int64()), pa.array([body], pa.binary())],
                        ["size", "block", "body"],
                    )

    return run


def _blocks(vectors: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The vectors in blocks of ``width`` or so, and how many blocks there are.

    Ids are dealt by hash, so blocks are alike in size and kind.
    """
    n = max(1, -(-vectors.count() // width))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))
    sorted_ = dealt.repartition("size", "block").sortWithinPartitions("size", "block", "id")
    return sorted_.mapInArrow(_pack(width), "size int, block long, body binary"), n


class _Best:
    """The k best candidates so far of each query in a block."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, k: int):
        vectors = whole.astype(np.float64)
        self.ids, self.whole, self.vectors, self.k = ids, whole, vectors, k
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        size = len(vectors)
        self.cuts = list(range(0, size, STEP)) + [size]
        squares = np.concatenate([np.cumsum((vectors**2)[::-1], axis=0)[::-1], np.zeros((1, len(ids)))])
        self.rest = np.sqrt(squares)

    def meet(self, ids: np.ndarray, whole: np.ndarray) -> None:
        if largest_sum(whole, self.whole, len(whole)) >= EXACT:
            return self._meet_large(ids, whole)
        block = whole.astype(np.float64)
        squares = np.concatenate([np.cumsum((block**2)[::-1], axis=0)[::-1], np.zeros((1, len(ids)))])
        rest = np.sqrt(squares)
        for q in range(len(self.ids)):
            self._meet(q, ids, block, rest)

    def _meet_large(self, ids: np.ndarray, whole: np.ndarray) -> None:
        """The same for components whose sums double precision does not hold exactly."""
        for q in range(len(self.ids)):
            scores = products(self.whole[:, q : q + 1].T, whole.T)[0]
            others = ids != self.ids[q]
            self._keep(q, scores[others], ids[others])

    def _keep(self, q: int, sums: np.ndarray, ids: np.ndarray) -> None:
        scores, found = self.rows[q]
        scores, found = np.r_[scores, sums.astype(np.int64)], np.r_[found, ids]
        order = np.lexsort((found, ~scores))[: self.k]
        self.rows[q] = scores[order], found[order]

    def _meet(self, q: int, ids: np.ndarray, block: np.ndarray, rest: np.ndarray) -> None:
        scores, _ = self.rows[q]
        least = scores[-1] if len(scores) == self.k else -np.inf
        vector = self.vectors[:, q]
        alive = np.flatnonzero(ids != self.ids[q])
        sums = np.zeros(len(alive))
        for low, high in zip(self.cuts[:-1], self.cuts[1:]):
            if len(alive) == len(ids):
                sums = sums + vector[low:high] @ block[low:high]
            else:
                sums = sums + vector[low:high] @ block[low:high, alive]
            bound = sums + self.rest[high, q] * rest[high, alive] * (1 + 1e-9) + 0.5
            stays = bound >= least
            if not stays.all():
                alive, sums = alive[stays], sums[stays]
            if not len(alive):
                return
        if len(alive) > self.k:  # those that tie with the k-th go on too
            top = np.partition(sums, len(sums) - self.k)[len(sums) - self.k]
            alive, sums = alive[sums >= top], sums[sums >= top]
        self._keep(q, sums, ids[alive])

    def batch(self) -> pa.RecordBatch:
        counts = [len(s) for s, _ in self.rows]
        return pa.record_batch(
            [
                pa.array(np.repeat(self.ids, counts), pa.int64()),
                pa.array(np.concatenate([f for _, f in self.rows]), pa.int64()),
                pa.array(np.concatenate([s for s, _ in self.rows]).astype(np.int64), pa.int64()),
            ],
            ["query_id", "vec_id", "score"],
        )


def _search(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["size"], row["block"], row["stream"]) != key:
                    for some in best:
                        yield some.batch()
                    key, best = (row["size"], row["block"], row["stream"]), []
                if row["kind"] == 0 or best:
                    ids, flat = unpacked(row["body"])
                    whole = flat.reshape(row["size"], len(ids))
                    if row["kind"] == 0:
                        best.append(_Best(ids, whole, k))
                    else:
                        for some in best:
                            some.meet(ids, whole)
        for some in best:
            yield some.batch()

    return run


def topk_search(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    every: int = 50,
) -> DataFrame:
    """The ``k`` highest scores of each row whose id is divisible by ``every``."""
    whole = whole_vectors(vectors, id_col, vector_col, scale)
    candidates, n_blocks = _blocks(whole, CANDIDATES)
    queries, query_blocks = _blocks(whole.where(F.col("id") % every == 0), QUERIES)
    met = meetings(queries, candidates.drop("block"), query_blocks, streams_of(n_blocks))
    partial = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = partial.distinct().withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
