"""Removal of repeated lines, with two Bloom filters before an exact comparison.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A
first pass over the texts makes a 64-bit hash of each long enough key and stores
them, once per chunk of texts. The hashes are dealt by their high bits to segments of
bounded size. A segment keeps two Bloom filters, of hashes seen once and of those seen
again: a hash that the first one knows already goes into the second one. Only the
second filters leave their tasks, put together to one bit array of at most ``bits``
bits, whatever the size of the data, which is broadcast. A second pass over the texts
asks it, and only lines that it suspects are shuffled, to be grouped by their whole
keys, counted, and left to the document of largest id. What a document loses goes back
to it as line numbers.

Filters err on one side: every key of two or more documents is suspected, so results
are exact whatever the filters' sizes. With more repeated lines than the broadcast
bits can tell apart, more lines are shuffled, at most each long line once, and no
result changes. A line that a third of all documents hold is one hash per chunk; its
texts are combined before the shuffle, and the join of its rows is one of those that
adaptive execution splits.

Results for unusual input: a null or empty text is one empty line; a line repeated in
one document counts once for it, and all its places go or stay together; rows are
documents of their own, so repeated rows count each, and all rows of the largest id
keep their lines; a null id counts as smaller than any other; ``\\r`` and other white
space at the ends of lines is kept where the line stays; very long lines and texts are
read whole; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.llm.bloom import PER_HASH, SEGMENT, filters_of, known_again, segment_of
from pagetide.llm.common import U64, in_chunks, stored, utf8

#: ASCII white space, stripped from the ends of a line to make its key.
BLANK = b" \t\n\x0b\x0c\r"
#: Bytes of text to a chunk.
CHUNK = 16 << 20


def key_of(line: bytes, least: int) -> bytes | None:
    """The key, or none where it has under ``least`` code points."""
    key = line.strip(BLANK)
    if len(key) < least or (not key.isascii() and len(key.decode()) < least):
        return None
    return key.lower()


def _hashes(least: int):
    """Per chunk of texts the distinct hashes of its keys, those of several rows first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", CHUNK):
            found: list[int] = []
            for text in utf8(batch.column("text")):
                keys = {key_of(line, least) for line in text.split(b"\n")} if text else set()
                keys.discard(None)
                found += map(xxhash.xxh64_intdigest, keys)
            hashes, counts = np.unique(np.array(found, U64), return_counts=True)
            if not len(hashes):
                continue
            yield pa.record_batch(
                [
                    pa.array([len(hashes)], pa.int64()),
                    pa.array([hashes.tobytes()], pa.binary()),
                    pa.array([np.packbits(counts > 1).tobytes()], pa.binary()),
                ],
                ["n", "hashes", "again"],
            )

    return run


def _dealt(segments: int):
    """The chunks' hashes by segment; sorted hashes fall into them in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["hashes"], U64)
                again = np.unpackbits(np.frombuffer(row["again"], np.uint8), count=len(hashes))
                of = segment_of(hashes, segments).astype(np.int64)
                edges = np.append(np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), len(of))
                ends = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                yield pa.record_batch(
                    [
                        pa.array(of[edges[:-1]], pa.int32()),
                        pa.array([hashes[a:b].tobytes() for a, b in ends], pa.binary()),
                        pa.array([np.packbits(again[a:b]).tobytes() for a, b in ends], pa.binary()),
                    ],
                    ["segment", "hashes", "again"],
                )

    return run


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.frombuffer(row["hashes"], U64)
    return hashes, np.unpackbits(np.frombuffer(row["again"], np.uint8), count=len(hashes)) == 1


def _suspects(filters, segments: int, bits: int, least: int):
    """Suspected keys of each row, with the places of their lines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_again(filters.value, bits)
        for batch in in_chunks(batches, "text", CHUNK):
            rows, keys, places, hashes = [], [], [], []
            for i, text in enumerate(utf8(batch.column("text"))):
                if not text:
                    continue
                own: dict[bytes, list[int]] = {}
                for at, line in enumerate(text.split(b"\n")):
                    if (key := key_of(line, least)) is not None:
                        own.setdefault(key, []).append(at)
                rows += [i] * len(own)
                keys += own.keys()
                places += own.values()
                hashes += map(xxhash.xxh64_intdigest, own)
            asked = np.array(hashes, U64)
            suspected = known(asked, segments)
            picked = np.flatnonzero(suspected)
            if not len(picked):
                continue
            of_row = pa.array(np.array(rows, np.int64)[picked])
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(of_row),
                    batch.column("content").take(of_row),
                    pa.array([keys[i] for i in picked], pa.binary()),
                    pa.array([places[i] for i in picked], pa.list_(pa.int32())),
                ],
                ["doc_id", "content", "key", "places"],
            )

    return run


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_chunks(batches, "text", CHUNK):
        n_lines, n_dropped, digests, texts = [], [], [], []
        for text, dropped in zip(utf8(batch.column("text")), batch.column("dropped").to_pylist()):
            text = text or b""
            n_lines.append(text.count(b"\n") + 1)
            if dropped:
                gone = {i for places in dropped for i in places}
                text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)
                n_dropped.append(len(gone))
            else:
                n_dropped.append(0)
            digests.append(hashlib.sha256(text).hexdigest())
            texts.append(text)
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(digests),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"],
        )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 40,
    documents: int = 5,
    bits: int = 1 << 28,
) -> DataFrame:
    """Per row its lines, how many of them go, and what stays, as text and digest.

    Lines whose keys have ``least`` code points and stand in ``documents`` rows go, but
    for those in the row of largest id.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content"))
    chunks = stored(rows.select("text").mapInArrow(_hashes(least), "n long, hashes binary, again binary"), "line_hashes")
    total = chunks.agg(F.sum("n")).first()[0] or 0
    segments = min(bits // 1024, max(1, -(-total // SEGMENT)))
    own_bits = min(SEGMENT * PER_HASH, bits // segments)
    by_segment = chunks.drop("n").mapInArrow(_dealt(segments), "segment int, hashes binary, again binary")
    by_segment = by_segment.repartition("segment").sortWithinPartitions("segment")
    # ``bits`` bits at most come to the driver and go to the executors
    made = by_segment.mapInArrow(filters_of(own_bits, _unpacked), "segment int, filter binary").collect()
    filters = docs.sparkSession.sparkContext.broadcast({r["segment"]: bytes(r["filter"]) for r in made})
    columns = "doc_id long, content long, key binary, places array<int>"
    suspects = stored(rows.mapInArrow(_suspects(filters, segments, own_bits, least), columns), "suspected_lines")
    counted = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    # stored, as only joins of plain shuffles are split where one key is frequent
    repeated = stored(counted.where(F.col("n") >= documents).drop("n"), "repeated_lines")
    goes = ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    dropped = suspects.join(repeated, "key").where(goes)
    # rows of one id and text are alike, and each place of theirs is named once
    dropped = dropped.groupBy(F.col("doc_id").alias("of"), F.col("content").alias("of_content"))
    dropped = dropped.agg(F.collect_set("places").alias("dropped"))
    same = rows["doc_id"].eqNullSafe(dropped["of"]) & (rows["content"] == dropped["of_content"])
    met = rows.join(dropped, same, "left").select("doc_id", "text", "dropped")
    return met.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string")
