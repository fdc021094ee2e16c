"""What the operators of this subpackage share: storing steps, batches, word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide import session
from pagetide.sources import files

#: ASCII white space, the separators of words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that lost executors
    repeat only what comes after, and Python work is not done twice."""
    spark = df.sparkSession
    path = session.run_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries made and run within it delete what they shuffled when they end, not when
    the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def discard(*steps: DataFrame) -> None:
    """Delete stored steps, once what was made of them is stored itself."""
    for step in steps:
        if names := step.inputFiles():
            files.delete(step.sparkSession, names[0].rsplit("/", 1)[0])


def whole_groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Tables holding all neighbouring rows of equal keys, one or more groups each.

    The input is sorted by the keys within the task. A group cut by a batch's end
    is carried over to the next batch.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = _last_start(batch, keys)
        if cut == 0 and rest and _same(rest[-1], -1, batch, 0, keys):
            rest.append(batch)
            continue
        if rest and not _same(rest[-1], -1, batch, 0, keys):
            yield pa.Table.from_batches(rest)
            rest = []
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: tuple[str, ...]) -> bool:
    i = i % a.num_rows
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def _last_start(batch: pa.RecordBatch, keys: tuple[str, ...]) -> int:
    """Where the batch's last group begins."""
    low, high = 0, batch.num_rows - 1
    while low < high:
        middle = (low + high) // 2
        if _same(batch, middle, batch, batch.num_rows - 1, keys):
            high = middle
        else:
            low = middle + 1
    return low


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal rows, with the length as last entry."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), n)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mix of each value, so that neighbours differ in all bits."""
    x = x.astype(U64) + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(256), 7)


class ByteHashes:
    """Hashes of any stretch of a byte buffer from one running sum.

    The sum is a polynomial modulo 2**64 with an odd base, so a stretch's share is
    a difference of two sums times the base's inverse power.
    """

    _up = np.ones(1, U64)
    _down = np.ones(1, U64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(ByteHashes._up) < n:
            ByteHashes._up = np.cumprod(np.r_[U64(1), np.full(n, U64(BASE))])
            ByteHashes._down = np.cumprod(np.r_[U64(1), np.full(n, U64(pow(BASE, -1, 2**64)))])
        self.sums = np.zeros(n, U64)
        np.cumsum(_BYTE[data] * ByteHashes._up[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of bytes ``start`` to ``end``, for each pair."""
        raw = (self.sums[end] - self.sums[start]) * ByteHashes._down[start]
        return mixed(raw + (end - start).astype(U64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size`` bytes."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * ByteHashes._down[:n]) if n > 0 else np.zeros(0, U64)


def packed(*arrays: np.ndarray) -> bytes:
    """One-dimensional arrays as bytes, first bytes of all entries first, so that
    equal high bytes lie together and compress."""
    parts = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        parts += [a.dtype.str.ljust(4).encode(), len(a).to_bytes(8, "little")]
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return b"".join(parts)


def unpacked(raw: bytes) -> list[np.ndarray]:
    arrays, at = [], 4
    for _ in range(int.from_bytes(raw[:4], "little")):
        kind = np.dtype(raw[at : at + 4].decode().strip())
        n = int.from_bytes(raw[at + 4 : at + 12], "little")
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return arrays


#: Sums of products below the first are exact in double precision; a long's end.
EXACT, LONG = 2.0**53, 2**63 - 1


def narrow(square: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    for kind in (np.int16, np.int32):
        if not square.size or (np.iinfo(kind).min <= square.min() and square.max() <= np.iinfo(kind).max):
            return square.astype(kind)
    return square


def largest_sum(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """What no sum of ``size`` products of the two arrays' numbers exceeds."""
    if not a.size or not b.size:
        return 0.0
    return float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * size


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of all pairs, as longs; beyond their range, its ends."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    most = largest_sum(queries, rows, queries.shape[1])
    if most < EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < LONG:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, *more: Column) -> DataFrame:
    """Rows with an id and a vector of finite components, which become
    ``floor(scale * x)``, held to a long's range: ``id``, ``size``, ``vector`` and ``more``."""
    x = F.col(vector_col)
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.size(x).alias("size"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"),
        *more,
    )


def meetings(asked: DataFrame, offered: DataFrame, blocks: int, streams: int) -> DataFrame:
    """Rows ``(size, block, stream, kind, body)`` that bring every block of queries
    (kind 0, first) and every stream of candidate bodies (kind 1) together in a task.

    ``asked`` has ``size, block, body``, ``offered`` has ``size, body``. A block of
    queries is sent once per stream and a body once per block, never one for the other.
    """
    stream = F.explode(F.sequence(F.lit(0), F.lit(streams - 1)))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    queries = asked.select("size", "block", stream.alias("stream"), F.lit(0).alias("kind"), "body")
    own = F.pmod(F.xxhash64("body"), F.lit(streams)).cast("int").alias("stream")
    bodies = offered.select("size", block.alias("block"), own, F.lit(1).alias("kind"), "body")
    keys = ["size", "block", "stream"]
    tasks = min(MOST_TASKS, max(1, blocks * streams))
    return queries.unionByName(bodies).repartition(tasks, *keys).sortWithinPartitions(*keys, "kind")


def streams_of(bodies: int) -> int:
    """Streams for so many bodies: some for parallel work, then one per ``STREAM`` bodies."""
    return max(1, -(-bodies // STREAM), min(bodies, STREAMS))


#: Bodies in a stream, streams that are made even of fewer, tasks that meetings are
#: dealt to at most; each goes through as many as it gets.
STREAM, STREAMS, MOST_TASKS = 16, 64, 4000


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each followed by a line feed, and their starts."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), np.r_[0, np.cumsum(lengths)]


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ASCII white space."""
    inside = np.r_[False, ~SPACE[data], False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def in_chunks(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut where their texts exceed ``most`` bytes, so that a
    task's arrays are bounded whatever the length of texts."""
    for batch in batches:
        values = batch.column(column)
        sizes = np.array([len(x) for x in _buffers(values)], np.int64) if batch.num_rows else np.zeros(0, np.int64)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _buffers(values: pa.Array) -> list[bytes]:
    return [b"" if v is None else v for v in utf8(values)]


def utf8(values: pa.Array) -> list[bytes | None]:
    """The values' bytes; null stays null."""
    kind = pa.large_binary() if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else pa.binary()
    return values.cast(kind).to_pylist()
