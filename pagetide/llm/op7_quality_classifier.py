"""Quality scores from random-indexing word vectors and a small network.

Every word stands for two units, itself and its form (its last bytes, the kinds of
its first and last byte, its length), hashed into two tables of fixed size. By
random indexing each unit has a sparse random index vector, and its word vector is
the sum of the index vectors of the units around it in the learning sample, scaled
to length one. A document is the mean of its units' vectors besides a few shares
(distinct words and lines, words said twice in a row, lengths). A network of two layers, in numpy, gives
its score, whose logit is divided by a temperature fitted on rows kept aside.

The learning sample is at most ``sample`` labelled rows, those of smallest hashed
id with some of either label first, and at most ``SAMPLE_BYTES`` of whole texts, none
of which is over ``LONGEST`` bytes. It is the only thing learnt from, in one task, as its bound allows; the driver sees the model alone, whose size does
not depend on the data. Every document is scored on its whole text, by one pass
without shuffle.

Results for unusual input: null and empty texts get the score of a document without
words; a labelled text of over ``LONGEST`` bytes is scored whole and not learnt from;
a null id is not held out and never learnt from; of repeated labels of one
id the largest counts, and null labels are ignored; rows repeat as they come; where
the sample lacks one of the two labels, every score is the sample's mean label
(0.5 without sample); an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.llm.common import ByteHashes, in_chunks, joined, mixed, stored, utf8, words

#: Labelled rows learnt from, and bytes of their texts: both are bounds of the method.
SAMPLE, SAMPLE_BYTES = 6000, 32 << 20
#: Bytes of a text that is learnt from, and rows of either label that come first.
LONGEST, EACH = SAMPLE_BYTES // 256, 50
#: Least number of learning steps, for small samples.
STEPS = 2000
UNITS, WIDTH, NONZERO, WINDOW, HIDDEN = 1 << 14, 32, 4, 2, 32

#: Kinds of bytes: lower case, upper case, digit, other ASCII, beyond ASCII.
_KIND = np.full(256, 3, np.int64)
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[128:] = 4


class Units:
    """Words of some texts as units of both tables, with the document of each."""

    def __init__(self, texts: list[bytes]):
        data, starts = joined(texts)
        low, high = words(data)
        hashes = ByteHashes(data)
        self.n = len(texts)
        self.doc = np.searchsorted(starts, low, side="right") - 1
        self.word = hashes.of(low, high)
        length = high - low
        form = np.zeros(len(low), np.uint64)
        for back in (1, 2, 3):  # the last bytes, letters of either case as one each
            byte = data[np.maximum(high - back, low)]
            kind = np.where(length >= back, np.where(_KIND[byte] == 3, byte, 128 + _KIND[byte]), 0)
            form = form * np.uint64(256) + kind.astype(np.uint64)
        form = form * np.uint64(25) + (_KIND[data[low]] * 5 + _KIND[data[np.minimum(low + 1, high - 1)]]).astype(np.uint64)
        form = form * np.uint64(16) + np.minimum(length, 15).astype(np.uint64)
        self.units = [(self.word % np.uint64(UNITS)).astype(np.int64), (mixed(form, 1) % np.uint64(UNITS)).astype(np.int64)]
        self.counts = np.bincount(self.doc, minlength=self.n)
        self.lengths = np.diff(starts) - 1
        self.shares = self._shares(data, starts, hashes, length)

    def _shares(self, data, starts, hashes, length) -> np.ndarray:
        ends = np.flatnonzero(data == 10)
        begins = np.r_[0, ends[:-1] + 1] if len(ends) else ends
        line_doc = np.searchsorted(starts, begins, side="right") - 1
        lines = hashes.of(begins, ends)
        columns = [
            _distinct(self.doc, self.word, self.n),
            _distinct(line_doc, lines, self.n),
            np.bincount(self.doc[1:], self._again(), self.n) / np.maximum(self.counts - 1, 1),
            np.log1p(self.counts) / 5,
            np.log1p(self.lengths) / 8,
            np.bincount(self.doc, length, self.n) / np.maximum(self.counts, 1) / 8,
            np.log1p(self.counts / np.maximum(np.bincount(line_doc, minlength=self.n), 1)) / 3,
        ]
        return np.column_stack(columns).astype(np.float32)

    def _again(self) -> np.ndarray:
        """Whether each word but the first repeats the one before it."""
        return (self.word[1:] == self.word[:-1]) & (self.doc[1:] == self.doc[:-1])


def _distinct(doc: np.ndarray, what: np.ndarray, n: int) -> np.ndarray:
    """Share of distinct entries per document; 1 where there are none."""
    order = np.lexsort((what, doc))
    d, w = doc[order], what[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (w[1:] != w[:-1])] if len(d) else np.zeros(0, bool)
    total = np.bincount(doc, minlength=n)
    return np.where(total > 0, np.bincount(d[new], minlength=n) / np.maximum(total, 1), 1.0)


def index_vectors(table: int) -> np.ndarray:
    """Sparse random vectors of one table: a few entries of 1 or -1 each."""
    rng = np.random.default_rng(table + 11)
    vectors = np.zeros((UNITS, WIDTH), np.float32)
    for _ in range(NONZERO):
        vectors[np.arange(UNITS), rng.integers(0, WIDTH, UNITS)] += rng.choice([-1.0, 1.0], UNITS)
    return vectors


def word_vectors(parts: Callable[[], Iterator[Units]]) -> list[np.ndarray]:
    """Sums of the index vectors of neighbours, up to two words away in one document."""
    index = [index_vectors(0), index_vectors(1)]
    out = [np.zeros((UNITS, WIDTH), np.float32) for _ in index]
    for units in parts():
        for mine, other in ((0, 1), (1, 0)):
            for step in range(1, WINDOW + 1):
                same = units.doc[step:] == units.doc[:-step]
                left, right = units.units[mine][:-step][same], units.units[mine][step:][same]
                for here, near in ((left, right), (right, left)):
                    _add(out[mine], here, index[mine][near])
            _add(out[mine], units.units[mine], index[other][units.units[other]])
    return [sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9) for sums in out]


def _add(sums: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0]) if len(rows) else order
    if len(at):
        sums[rows[order][at]] += np.add.reduceat(values[order], at, axis=0)


def pooled(units: Units, vectors: list[np.ndarray]) -> np.ndarray:
    """Means of the word vectors per document, and its shares."""
    filled = np.flatnonzero(units.counts)
    parts = []
    for table, own in zip(vectors, units.units):
        mean = np.zeros((units.n, table.shape[1]), np.float32)
        if len(filled):
            at = np.r_[0, np.cumsum(units.counts[filled])[:-1]]
            mean[filled] = np.add.reduceat(table[own], at, axis=0) / units.counts[filled, None]
        parts.append(mean)
    return np.hstack([*parts, units.shares])


class Network:
    """Two layers and a temperature, learnt by Adam in a number of passes that the
    sample's size sets."""

    def __init__(self, x: np.ndarray, y: np.ndarray, passes: int = 60, seed: int = 5):
        self.rate = float(y.mean()) if len(y) else 0.5
        self.constant = len(set(y.tolist())) < 2
        if self.constant:
            return
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        aside = rng.random(len(y)) < 0.2
        if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
            aside[:] = False
        self._learn(x[~aside], y[~aside], passes, rng)
        kept = (x[aside], y[aside]) if aside.any() else (x, y)
        self.temperature = self._fitted(*kept)

    def _learn(self, x, y, passes, rng) -> None:
        n, d = x.shape
        passes = max(passes, STEPS // max(1, n // 64))
        values = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.log(self.rate / (1 - self.rate))]
        first, second = [0 * v for v in values], [0 * v for v in values]
        steps = 0
        for _ in range(passes):
            for rows in np.array_split(rng.permutation(n), max(1, n // 64)):
                steps += 1
                part, truth = x[rows], y[rows]
                hidden = np.tanh(part @ values[0] + values[1])
                error = (_sigmoid(hidden @ values[2] + values[3]) - truth) / len(rows)
                back = np.outer(error, values[2]) * (1 - hidden**2)
                slopes = [part.T @ back + 1e-3 * values[0], back.sum(0), hidden.T @ error + 1e-3 * values[2], error.sum()]
                for i, slope in enumerate(slopes):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    step = first[i] / (1 - 0.9**steps) / (np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8)
                    values[i] = values[i] - 0.003 * step
        self.values = values

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.values[0] + self.values[1]) @ self.values[2] + self.values[3]

    def _fitted(self, x, y) -> float:
        logit = self._logit(x)
        choices = np.geomspace(0.5, 8, 60)
        losses = [np.mean(np.logaddexp(0, logit / t) - y * logit / t) for t in choices]
        return float(choices[int(np.argmin(losses))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.rate)
        return _sigmoid(self._logit((x - self.mean) / self.scale) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of the whole sample, which comes to one task in order."""
    held = [b for b in batches if b.num_rows]

    def parts() -> Iterator[Units]:
        for batch in in_chunks(held, "text", 1 << 20):
            yield Units([t or b"" for t in utf8(batch.column("text"))])

    vectors = word_vectors(parts)
    x = [pooled(units, vectors) for units in parts()]
    truth = [b.column("truth").to_numpy() for b in held]
    x = np.concatenate(x) if x else np.zeros((0, 1), np.float32)
    network = Network(x.astype(np.float64), np.concatenate(truth) if truth else np.zeros(0))
    yield pa.record_batch([pa.array([pickle.dumps((vectors, network))], pa.binary())], ["model"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str, sample: int = SAMPLE) -> bytes:
    """Vectors and network from at most ``sample`` labelled rows that are not held out, in
    order of hashed id, and of these as many as ``SAMPLE_BYTES`` hold; pickled.

    Texts of over ``LONGEST`` bytes are not learnt from, so that none fills the sample,
    and the first ``EACH`` rows of either label come before all others, so that none
    pushes a label out. ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id``.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~_held_out(F.col("doc_id")))
    truth = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label_col).cast("double").alias("truth"))
    bytes_ = F.coalesce(F.octet_length("text"), F.lit(0))
    short = docs.where(bytes_ <= LONGEST)
    known = stored(short.select("doc_id").join(truth, "doc_id").dropDuplicates(["doc_id"]), "labelled")
    by_hash = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = known.orderBy(*by_hash).limit(sample).withColumn("late", F.lit(1))
    for label in (0.0, 1.0):
        some = known.where(F.col("truth") == label).orderBy(*by_hash).limit(EACH)
        chosen = chosen.unionByName(some.withColumn("late", F.lit(0)))
    chosen = chosen.groupBy("doc_id", "truth").agg(F.min("late").alias("late"))
    order = F.col("late"), *by_hash, F.col("text")
    one = short.join(chosen, "doc_id").select("doc_id", "text", "truth", "late").orderBy(*order).limit(sample)
    bytes_ = F.sum(bytes_).over(Window.orderBy(*order))
    bounded = one.withColumn("bytes", bytes_).where(F.col("bytes") <= SAMPLE_BYTES).select("text", "truth")
    learnt = bounded.mapInArrow(_learn, "model binary").first()
    return learnt.model if learnt else next(_learn([])).column("model")[0].as_py()  # no rows, no task


def _scorer(model: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = pickle.loads(model)
        for batch in in_chunks(batches, "text", 2 << 20):
            units = Units([t or b"" for t in utf8(batch.column("text"))])
            score = network.score(pooled(units, vectors).astype(np.float64))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*map(batch.column, names), pa.array(score, pa.float64())], [*names, "score"])

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    threshold: float = 0.3,
    keep_row: bool = False,
) -> DataFrame:
    """Per document whether it was held out, its score, and the label at ``threshold``;
    with ``keep_row`` also all its columns, as the struct ``row``."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_row else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *row)
    model = fit(rows.select("doc_id", "text"), labels.select(F.col(id_col).alias("doc_id"), label_col), label_col, sample)
    marked = rows.withColumn("held_out", _held_out(F.col("doc_id")))
    schema = marked.drop("text").schema.add("score", "double")
    scored = marked.mapInArrow(_scorer(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
