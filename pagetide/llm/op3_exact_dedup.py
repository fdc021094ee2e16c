"""Exact deduplication by tries that own each distinct text.

Texts meet in partitions by length and content hash. There every byte string is
inserted whole into a compressed radix (Patricia) trie, whose terminal nodes keep
the id that stays and the number of copies, so equality is decided by all bytes
and by no hash. A trie over its memory bound spills its largest subtree to a file
of the task and goes on; the file is read back as a trie of its own at the end.

Before the shuffle each task runs its own rows through such a trie, so a text sends
one row per task however many copies it has: a group of copies with a third of all
rows is never gathered. Each document then finds its group by a plain join that
adaptive execution can split.

Results for unusual input: null text counts as empty, and empty texts are equal to
each other; a null id never stays where the group has any other id, and in a group
of null ids only, one stays; of rows that repeat the id that stays, one stays; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.llm.common import utf8

#: Bytes of labels and nodes that a task's trie holds before it spills.
MEMORY = 64 << 20
_NODE = 200


class _Node:
    __slots__ = ("edges", "owner", "count", "spill")

    def __init__(self, owner=None, count=0):
        self.edges: dict[int, list] = {}
        self.owner, self.count, self.spill = owner, count, None


class OwnerTrie:
    """Distinct byte strings with the id that owns each and how often it came."""

    def __init__(self, largest: bool, memory: int = MEMORY):
        self.pick = max if largest else min
        self.memory, self.size, self.root = memory, 0, _Node()

    def insert(self, key: bytes, owner: int | None, count: int) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((key[at:], owner, count), node.spill)
                return
            if at == len(key):
                self._own(node, owner, count)
                return
            edge = node.edges.get(key[at])
            if edge is None:
                node.edges[key[at]] = [key[at:], _Node(owner, count)]
                self.size += len(key) - at + _NODE
                return
            label = edge[0]
            if not key.startswith(label, at):
                same = _common(label, key, at)
                fork = _Node()
                fork.edges[label[same]] = [label[same:], edge[1]]
                edge[:] = label[:same], fork
                self.size += _NODE
            node, at = edge[1], at + len(edge[0])

    def _own(self, node: _Node, owner: int | None, count: int) -> None:
        known = [x for x in (node.owner, owner) if x is not None]
        node.owner, node.count = self.pick(known) if known else None, node.count + count

    def spill(self) -> None:
        """Move the largest subtree below the first fork to a file."""
        node = self.root
        while len(node.edges) == 1 and not node.count and node.spill is None:
            (edge,) = node.edges.values()
            node = edge[1]
        live = [e for e in node.edges.values() if e[1].spill is None]
        if not live:
            return
        sizes = [sum(len(k) for k, *_ in _terminals(e[1])) + len(e[0]) for e in live]
        edge = live[sizes.index(max(sizes))]
        file = tempfile.TemporaryFile()  # has no name: it ends with the task
        freed = 0
        for tail, owner, count in _terminals(edge[1]):
            pickle.dump((tail, owner, count), file)
            freed += len(tail) + _NODE
        for head, node in _nodes(edge[1]):
            if node.spill is not None:  # a part that was spilled before moves along
                for tail, owner, count in _records(node.spill):
                    pickle.dump((head + tail, owner, count), file)
        edge[1] = _Node()
        edge[1].spill = file
        self.size = max(0, self.size - freed)

    def items(self) -> Iterator[tuple[bytes, int | None, int]]:
        for head, node in _nodes(self.root):
            if node.spill is not None:
                yield from ((head + k, o, c) for k, o, c in self._unspilled(node.spill))
            elif node.count:
                yield head, node.owner, node.count

    def _unspilled(self, file) -> Iterator[tuple[bytes, int | None, int]]:
        trie = OwnerTrie(self.pick is max, self.memory)
        for row in _records(file):
            trie.insert(*row)
            trie.bound()
        yield from trie.items()

    def bound(self) -> None:
        if self.size > self.memory:
            self.spill()


def _records(file) -> Iterator[tuple[bytes, int | None, int]]:
    """What a spill file holds; it is closed at the end."""
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            file.close()
            return


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``, by halving."""
    low, high = 1, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[:middle] == key[at : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _nodes(root: _Node) -> Iterator[tuple[bytes, _Node]]:
    waiting = [(b"", root)]
    while waiting:
        head, node = waiting.pop()
        yield head, node
        waiting += [(head + label, child) for label, child in node.edges.values()]


def _terminals(root: _Node) -> Iterator[tuple[bytes, int | None, int]]:
    return ((head, n.owner, n.count) for head, n in _nodes(root) if n.count)


def _combine(largest: bool, memory: int):
    """Rows of one task with equal texts become one; the trie is emptied at its bound."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = OwnerTrie(largest, memory)
        for batch in batches:
            for key, owner in zip(utf8(batch.column("content")), batch.column("id").to_pylist()):
                trie.insert(key, owner, 1)
                if trie.size > memory:
                    yield from _rows(trie)
                    trie = OwnerTrie(largest, memory)
        yield from _rows(trie)

    return run


def _rows(trie: OwnerTrie) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for row in trie.items():
        rows.append(row)
        held += len(row[0])
        if held > 4 << 20:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple[bytes, int | None, int]]) -> pa.RecordBatch:
    keys, owners, counts = zip(*rows)
    return pa.record_batch(
        [
            pa.array(keys, pa.binary()),
            pa.array([int.from_bytes(hashlib.blake2b(k, digest_size=8).digest(), "big", signed=True) for k in keys], pa.int64()),
            pa.array(owners, pa.int64()),
            pa.array(counts, pa.int64()),
        ],
        ["content", "content_hash", "owner", "copies"],
    )


def _own(largest: bool, memory: int):
    """One row per distinct text of the partition: its digest, owner and copies."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = OwnerTrie(largest, memory)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("content", "owner", "copies"))
            for key, owner, copies in zip(*columns):
                trie.insert(key, owner, copies)
                trie.bound()
        rows = []
        for key, owner, copies in trie.items():
            rows.append((hashlib.sha256(key).hexdigest(), owner, copies))
            if len(rows) == 10_000:
                yield _owners(rows)
                rows = []
        if rows:
            yield _owners(rows)

    return run


def _owners(rows: list[tuple]) -> pa.RecordBatch:
    digests, owners, copies = zip(*rows)
    arrays = [pa.array(digests, pa.string()), pa.array(owners, pa.int64()), pa.array(copies, pa.int64())]
    return pa.record_batch(arrays, ["text_sha256", "keep_id", "group_size"])


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Column | None = None,
    keep: str = "largest",
    memory: int = MEMORY,
) -> DataFrame:
    """One row per document with the id of the copy that stays.

    ``normalise`` is the text to compare, made from the columns of ``docs``; without
    it texts are compared as they are. ``keep`` is ``largest`` or ``smallest`` id.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    content = F.coalesce(F.col(text_col) if normalise is None else normalise, F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), content.cast("binary").alias("content"))
    largest = keep == "largest"
    sent = rows.mapInArrow(_combine(largest, memory), "content binary, content_hash long, owner long, copies long")
    owners = sent.repartition(F.octet_length("content"), "content_hash").mapInArrow(
        _own(largest, memory), "text_sha256 string, keep_id long, group_size long"
    )
    each = rows.select(F.col("id").alias("doc_id"), F.sha2("content", 256).alias("text_sha256"))
    each = each.groupBy("doc_id", "text_sha256").agg(F.count("*").cast("int").alias("times"))
    met = each.join(owners, "text_sha256").withColumn("time", F.explode(F.sequence(F.lit(1), "times")))
    kept = (F.col("time") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return met.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
