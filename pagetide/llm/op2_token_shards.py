"""Token ids in training order, written as fixed-stride binary shards.

Every document becomes tokens and an end mark; a task's documents lie end to end and
are cut into sequences of ``length``, so only the last sequence of a task is not full.
A sequence is numbered by its task and its place there; a keyed Feistel network
permutes these numbers, walking along the cycle until it is back inside the range, so
positions are distinct and their order is the training order. Equal ranges of positions
are shards: each is sorted in one task and written as records of one size. A
sequence's global slot is its record in the shard after all records of earlier shards.
So one pass makes the tokens and one shuffle brings them in order, whatever key or
document dominates the data, and ids may be any numbers, repeated or missing.

A record is its number of tokens and then ``length`` ids, 16 bits each, little
endian, zeros after the last. Slot s of a folder is found by the shards' counts
(:func:`manifest`) and read without what lies before it (:func:`read_slots`). A
shard is written under another name and moved, so a task that is repeated replaces
it by the same bytes. Rows should come from a scan or a stored table, whose tasks see
the same rows when they are repeated; the order is the same in every run over the
same files and splits.

Results for unusual input: null and empty texts have no sequence; very long texts
are encoded whole, over as many sequences as they need; a null id stays null; rows of
one id are documents of their own; an empty table writes no shard and gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import mixed, packed, starts_of, stored, unpacked, whole_groups

#: Bytes to a shard, roughly; words a worker remembers the tokens of.
SHARD, REMEMBERED = 32 << 20, 300_000
#: Tasks that sequences are numbered for; 4 PB of text still fit the numbers' 62 bits.
TASKS = 1 << 20
ROUNDS = 6


class WordEncoder:
    """Byte-level BPE ids, little endian, by space-separated words that are remembered.

    No piece of the splitting pattern spans the end of a word before a single space,
    so words are encoded apart; texts with other runs of white space are encoded whole.
    """

    def __init__(self, ranks_path: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = len(ranks)
        if self.end > 0xFFFF:
            raise ValueError("ids beyond 16 bits")
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()

    def encode(self, text: str) -> bytes:
        head, *words = text.split(" ")
        known = self.known
        new = set(words).difference(known)
        if new:
            if any(not w or w[0].isspace() for w in new):
                return self.plain(text)
            if len(known) > REMEMBERED:
                known.clear()
                new = set(words)
            for word in new:
                known[word] = self.plain(" " + word)
        return b"".join([self.plain(head), *map(known.__getitem__, words)])


class Feistel:
    """A keyed permutation of the numbers below ``size``."""

    def __init__(self, size: int, key: int):
        self.size = max(size, 1)
        self.half = np.uint64(max(1, ((self.size - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.key = key

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for i in range(ROUNDS):
            left, right = right, left ^ (mixed(right, self.key * ROUNDS + i) & self.mask)
        return left << self.half | right

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = self._once(x.astype(np.uint64))
        while (out := x >= np.uint64(self.size)).any():
            x[out] = self._once(x[out])
        return x.astype(np.int64)


class Filler:
    """Cuts documents' tokens, end to end, into sequences of ``length``."""

    def __init__(self, length: int):
        self.length = length
        self.rest = np.zeros(0, "<u2")
        #: Pieces of documents in the sequence being filled: row data, piece, place, tokens.
        self.pieces: list[np.ndarray] = [np.zeros(0, np.int64)] * 5

    def fill(self, tokens: list[np.ndarray], ids: np.ndarray, nulls: np.ndarray, last: bool = False):
        """Full sequences of what there is, with all else after the last document.

        Gives the sequences, their numbers of tokens, and pieces of documents as columns:
        sequence, id, whether it is null, piece of the document, place, tokens.
        """
        sizes = np.array([len(t) for t in tokens], np.int64)
        start = len(self.rest) + np.cumsum(sizes) - sizes
        stream = np.concatenate([self.rest, *tokens])
        low, high = start // self.length, (start + sizes - 1) // self.length
        counts = high - low + 1
        number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        sequence = np.repeat(low, counts) + number
        begin = np.maximum(np.repeat(start, counts), sequence * self.length)
        end = np.minimum(np.repeat(start + sizes, counts), (sequence + 1) * self.length)
        own = [np.repeat(ids, counts), np.repeat(nulls, counts).astype(np.int64), number, begin - sequence * self.length, end - begin]
        held = len(self.pieces[0])
        sequence = np.r_[np.zeros(held, np.int64), sequence]
        pieces = [np.r_[a, b] for a, b in zip(self.pieces, own)]
        full = -(-len(stream) // self.length) if last else len(stream) // self.length
        body = np.zeros(full * self.length, "<u2")
        body[: min(len(stream), len(body))] = stream[: len(body)]
        filled = np.full(full, self.length, np.int64)
        if last and full:
            filled[-1] = len(stream) - (full - 1) * self.length
        done = sequence < full
        self.rest, self.pieces = stream[full * self.length :], [c[~done] for c in pieces]
        return body.reshape(full, self.length), filled, [sequence[done], *(c[done] for c in pieces)]


@lru_cache(maxsize=1)
def _encoder(ranks: str) -> WordEncoder:
    """One encoder for all tasks of a worker, with the words it has seen."""
    return WordEncoder(public_tokenizers.path(ranks))


def _encode(ranks: str, length: int, most: int, size: int, key: int, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, order, filler = _encoder(ranks), Feistel(size, key), Filler(length)
        if (task := TaskContext.get().partitionId()) >= TASKS:
            raise ValueError("more tasks than sequences are numbered for; read larger splits")
        first = task * most
        end = np.array([encoder.end], "<u2")
        none = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                column = part.column("doc_id")
                nulls = column.is_null().to_numpy(zero_copy_only=False)
                ids = column.fill_null(0).to_numpy()
                tokens = [np.append(np.frombuffer(encoder.encode(t), "<u2"), end) for t in part.column("text").to_pylist()]
                found = filler.fill(tokens, ids, nulls)
                if len(found[0]):
                    yield _dealt(found, order, first, width)
                    first += len(found[0])
        found = filler.fill([], none, none, last=True)
        if len(found[0]):
            yield _dealt(found, order, first, width)

    return run


def _dealt(found: tuple, order: Feistel, first: int, width: int) -> pa.RecordBatch:
    """Sequences by shard, with the documents' pieces in them."""
    body, filled, (sequence, *pieces) = found
    place = order((first + np.arange(len(body))).astype(np.uint64))
    shard = place // width
    sort = np.argsort(shard, kind="stable")
    rank = np.empty(len(sort), np.int64)
    rank[sort] = np.arange(len(sort))
    by_rank = np.argsort(rank[sequence], kind="stable")
    at = rank[sequence][by_rank]
    edges = starts_of(shard[sort])
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        own = sort[a:b]
        some = by_rank[np.searchsorted(at, a) : np.searchsorted(at, b)]
        blob = packed(place[own], filled[own].astype(np.uint16), (rank[sequence[some]] - a).astype(np.int32), *(c[some] for c in pieces))
        planes = np.ascontiguousarray(body[own]).view(np.uint8).reshape(-1, 2).T
        rows.append((int(shard[sort[a]]), blob, pa.compress(planes.tobytes(), "zstd", asbytes=True)))
    kinds = pa.int64(), pa.binary(), pa.binary()
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["shard", "about", "records"])


def _write(folder: str, length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for some in whole_groups(batches, "shard"):
            shards = some.column("shard").to_numpy()
            edges = starts_of(shards)
            for a, b in zip(edges[:-1], edges[1:]):
                yield _written(store, root, int(shards[a]), some.slice(a, b - a), length)

    return run


def _written(store: fs.FileSystem, root: str, shard: int, rows: pa.Table, length: int) -> pa.RecordBatch:
    about = [unpacked(x) for x in rows.column("about").to_pylist()]
    sizes = np.array([len(x[0]) for x in about])
    place, filled = (np.concatenate([x[i] for x in about]) for i in range(2))
    base = np.cumsum(sizes) - sizes
    sequence = np.concatenate([x[2] + b for x, b in zip(about, base)])
    owner, nulls, number, inside, tokens = (np.concatenate([x[i] for x in about]) for i in range(3, 8))
    records = np.zeros((len(place), length + 1), "<u2")
    records[:, 0] = filled
    for at, n, body in zip(base, sizes, rows.column("records").to_pylist()):
        raw = np.frombuffer(pa.decompress(body, int(n) * length * 2, "zstd", asbytes=True), np.uint8)
        records[at : at + n, 1:] = np.ascontiguousarray(raw.reshape(2, -1).T).reshape(-1).view("<u2").reshape(n, length)
    order = np.argsort(place, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    name = f"{root}/shard-{shard:08d}.bin"
    with store.open_output_stream(draft := f"{name}.{uuid.uuid4().hex}") as out:
        out.write(np.ascontiguousarray(records[order]).data)
    store.move(draft, name)
    return pa.record_batch(
        [
            pa.array(owner, pa.int64(), mask=nulls == 1),
            pa.array(number, pa.int32()),
            pa.array(np.full(len(owner), shard)),
            pa.array(rank[sequence]),
            pa.array(inside, pa.int32()),
            pa.array(tokens, pa.int32()),
        ],
        ["doc_id", "seq_no", "shard", "record", "place", "n_tokens"],
    )


def token_shards(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = "byte_bpe_50k.tiktoken",
    length: int = 1024,
    key: int = 1,
) -> DataFrame:
    """Write the shards below ``folder``; per document and sequence that holds some of it
    the sequence's slot, where its record lies, and the document's place and tokens there.

    ``folder`` is one that all executors reach, as a path or an address.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text <> ''")
    total, n = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    # no task makes more sequences than all texts have bytes and end marks for
    most = ((total or 0) + n) // length + 1
    size = TASKS * most
    shards = max(1, -(-(total or 0) // SHARD))
    width = -(-size // shards)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    made = rows.mapInArrow(_encode(ranks, length, most, size, key, width), "shard long, about binary, records binary")
    dealt = made.repartition("shard").sortWithinPartitions("shard")
    columns = "doc_id long, seq_no int, shard long, record long, place int, n_tokens int"
    written = stored(dealt.mapInArrow(_write(folder, length), columns), "sequences")
    first = manifest(written).select("shard", "first_slot")
    stride = 2 * (length + 1)
    return written.join(first, "shard").select(
        "doc_id",
        "seq_no",
        (F.col("first_slot") + F.col("record")).alias("slot"),
        "shard",
        (F.col("record") * stride).alias("byte_offset"),
        "place",
        "n_tokens",
    )


def manifest(written: DataFrame) -> DataFrame:
    """Per shard its records and the slot of its first one."""
    counts = written.groupBy("shard").agg((F.max("record") + 1).alias("records"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first_slot", F.coalesce(F.sum("records").over(earlier), F.lit(0)))


def read_slots(folder: str, shards: list[tuple[int, int, int]], start: int, count: int, length: int = 1024) -> Iterator[np.ndarray]:
    """The token ids of ``count`` slots from ``start`` on, in order.

    ``shards`` are the rows of the manifest, ``(shard, records, first_slot)``.
    """
    store, root = fs.FileSystem.from_uri(folder)
    stride = 2 * (length + 1)
    for shard, records, first in sorted(shards):
        low, high = max(start, first), min(start + count, first + records)
        if low >= high:
            continue
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            file.seek((low - first) * stride)
            for _ in range(low, high):
                record = np.frombuffer(file.read(stride), "<u2")
                yield record[1 : 1 + record[0]]
