"""Near duplicates by the Jaccard similarity of word n-grams, with a chosen-path join.

Every text is its set of shingles, n lower-cased words in a row. Texts of one set
are one node. A node is embedded as ``TOKENS`` minimum hashes; two nodes agree in
each with the probability of their similarity. A run splits all nodes by one such
sampled shared token. A bucket of at most ``LIMIT`` nodes is compared by brute
force; a larger one is split again along two further tokens sampled by its path, so
unlike nodes that share a common passage part; a bucket that no longer shrinks holds
near copies and is compared in pairs of blocks. Runs repeat until two nodes at the
least similarity miss each other with a probability under 1 - ``recall``.

A pair may meet in many buckets, but counts only in the first that both reach, which
each node's list of buckets tells. There its embedded similarity is looked at first,
with so low a bar that it hardly ever drops a pair, and only nodes with a candidate
send their shingles, for an exact comparison. Tasks return sums of links per node
and one edge per node to the smallest of its group, never a row per pair. Classes
are the connected components, found by passing on the smallest label.

No bucket, group of copies or hot shingle lands in one task: counting is combined
before it is shuffled, joins on a bucket are plain joins that adaptive execution can
split, and blocks bound what is compared in one place. Steps are stored in the
shared folder.

Results for unusual input: null and empty texts, and those of white space alone,
have no shingles and are classes of their own without links; texts of fewer than n
words have one shingle, of all their words; a null id takes no part and comes back
without class; rows of one id are one member of the join, and each comes back; equal
texts are links of each other; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.llm.common import ByteHashes, discard, in_chunks, joined, mixed, starts_of, stored, utf8, whole_groups, words

TOKENS = 32
#: Nodes compared at once; deepest split; a bucket this share of the one it was split from is tight.
LIMIT, DEPTH, TIGHT = 512, 6, 0.6
#: Entries of the arrays in which pairs are compared at once.
PAIRS = 1 << 21
_ODD = mixed(np.arange(64), 21) | np.uint64(1)


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin."""
    data, starts = joined(texts)
    low, high = words(data)
    word = ByteHashes(data).of(low, high)
    doc = np.searchsorted(starts, low, side="right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    sums = np.zeros(max(len(word) - n + 1, 0), np.uint64)
    for k in range(n):
        sums += word[k : k + len(sums)] * _ODD[k]
    same = doc[: len(sums)] == doc[n - 1 :][: len(sums)]
    sums, doc_of = mixed(sums[same], n), doc[: len(same)][same]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.r_[0, np.cumsum(counts)[:-1]]
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            use = counts[short] > k
            whole[use] += word[first[short[use]] + k] * _ODD[k]
        sums = np.r_[sums, mixed(whole + counts[short].astype(np.uint64), n + 1)]
        doc_of = np.r_[doc_of, short]
    order = np.lexsort((sums, doc_of))
    sums, doc_of = sums[order], doc_of[order]
    at = starts_of(doc_of, sums)[:-1]
    sums, doc_of = sums[at], doc_of[at]
    return sums, np.searchsorted(doc_of, np.arange(len(texts) + 1))


def node_names(sums: np.ndarray, edges: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; none for empty sets."""
    names = np.zeros((len(edges) - 1, 2), np.uint64)
    for i in (0, 1):
        total = np.r_[np.uint64(0), np.cumsum(mixed(sums, 31 + i))]
        names[:, i] = total[edges[1:]] - total[edges[:-1]]
    raw = names.tobytes()
    return [raw[16 * i : 16 * i + 16] if edges[i + 1] > edges[i] else None for i in range(len(edges) - 1)]


def _sketch(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", 4 << 20):
            sums, edges = shingles([t or b"" for t in utf8(batch.column("text"))], n)
            size = np.diff(edges)
            tokens = np.zeros((len(size), TOKENS), np.int64)
            full = np.flatnonzero(size)
            if len(full):
                for i in range(TOKENS):
                    hashed = (sums * _ODD[32 + i]) >> np.uint64(32)
                    tokens[full, i] = np.minimum.reduceat(hashed, edges[:-1][full]).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * TOKENS, pa.int32()), pa.array(tokens.ravel()))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(node_names(sums, edges), pa.binary()), pa.array(size, pa.int32()), lists],
                ["doc_id", "node", "size", "tokens"],
            )

    return run


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair at ``similarity`` is missed with at most 1 - recall.

    A run keeps the pair through its first split with that probability, and through
    any number of further ones, which branch in two, with the fixed point of
    f = 1 - (1 - similarity * f)**2.
    """
    further = (2 * similarity - 1) / similarity**2 if similarity > 0.5 else similarity
    return max(1, math.ceil(math.log(max(1 - recall, 1e-12)) / math.log(1 - similarity * further)))


def least_agreeing(similarity: float, miss: float = 2e-6) -> int:
    """Most tokens whose agreement can be asked for without missing more than ``miss``."""
    total = 0.0
    for k in range(TOKENS + 1):
        total += math.comb(TOKENS, k) * similarity**k * (1 - similarity) ** (TOKENS - k)
        if total > miss:
            return k
    return TOKENS


def _buckets(nodes: DataFrame, runs: int) -> DataFrame:
    """Every node's buckets of two or more: ``node, code, key, n``.

    ``code`` names the run and the branches taken, and with ``key`` the bucket. A
    node has at most one bucket for a code.
    """
    first = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    token = F.element_at("tokens", (F.col("run") % TOKENS + 1).cast("int"))
    pending = nodes.select("node", "tokens", first).select(
        "node", F.col("run").cast("long").alias("code"), F.xxhash64("run", token).alias("key"), F.lit(0).cast("long").alias("above")
    )
    found, steps = [], []
    for depth in range(DEPTH + 1):
        sized = stored(pending.groupBy("code", "key", "above").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
        ends = (F.col("n") <= LIMIT) | ((F.col("above") > 0) & (F.col("n") >= TIGHT * F.col("above")))
        if depth == DEPTH:
            ends = F.lit(True)
        steps.append(sized)
        placed = pending.drop("above").join(sized, ["code", "key"])
        found.append(placed.where(ends).select("node", "code", "key", "n"))
        if sized.where(~ends).isEmpty():
            break
        branch = F.explode(F.sequence(F.lit(0), F.lit(1))).alias("branch")
        split = placed.where(~ends).join(nodes.select("node", "tokens"), "node").select("node", "tokens", "code", "key", "n", branch)
        coordinate = F.pmod(F.xxhash64("key", "branch", F.lit(depth)), F.lit(TOKENS)) + 1
        pending = split.select(
            "node",
            (F.lit((depth + 1) << 40) + F.col("code") % (1 << 40) * 2 + F.col("branch")).alias("code"),
            F.xxhash64("key", "branch", F.element_at("tokens", coordinate.cast("int"))).alias("key"),
            F.col("n").alias("above"),
        )
        steps.append(pending := stored(pending, "split"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    leaves = stored(out, "leaves")
    discard(*steps)
    return leaves


def _pairs(blocks: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs to compare in one bucket, or across its two blocks."""
    if lo == hi:
        return np.triu_indices(len(blocks), 1)
    a, b = np.flatnonzero(blocks == lo), np.flatnonzero(blocks == hi)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def _candidates(similarity: float):
    least = least_agreeing(similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches, "code", "key", "lo", "hi"):
            some = some.combine_chunks()
            yield from _chosen(some, similarity, least)

    return run


def _square(owner: np.ndarray, codes: np.ndarray, keys: np.ndarray, n: int, mine: int) -> np.ndarray:
    """The keys of the buckets that each of n nodes reached under codes before ``mine``."""
    use = codes < mine
    names, where = np.unique(codes[use], return_inverse=True)
    square = np.repeat(np.arange(n)[:, None], len(names), 1)  # what was not reached equals nothing
    square[owner[use], where] = keys[use]
    return square


def _chosen(some: pa.Table, similarity: float, least: int) -> Iterator[pa.RecordBatch]:
    """The nodes of each bucket with a candidate that meets them here first."""
    columns = {c: some.column(c).to_numpy() for c in ("code", "key", "lo", "hi", "block", "size")}
    tokens = some.column("tokens").combine_chunks().flatten().to_numpy().astype(np.uint32).reshape(-1, TOKENS)
    reached = some.column("reached").combine_chunks()
    offsets = reached.offsets.to_numpy() - reached.offsets[0].as_py()
    codes, keys = (reached.flatten().field(c).to_numpy() for c in ("code", "key"))
    owner = np.repeat(np.arange(len(some)), np.diff(offsets))
    edges = starts_of(columns["code"], columns["key"], columns["lo"], columns["hi"])
    keep: list[int] = []
    slots: list[int] = []
    mates: list[list[int]] = []
    for start, end in zip(edges[:-1], edges[1:]):
        i, j = _pairs(columns["block"][start:end], columns["lo"][start], columns["hi"][start])
        own = slice(offsets[start], offsets[end])
        before = _square(owner[own] - start, codes[own], keys[own], end - start, columns["code"][start])
        left, right = [], []
        step = max(1, PAIRS // max(TOKENS, before.shape[1]))
        for k in range(0, len(i), step):
            a, b = i[k : k + step], j[k : k + step]
            sizes = columns["size"][start + a], columns["size"][start + b]
            good = np.minimum(*sizes) >= similarity * np.maximum(*sizes) - 1e-9
            a, b = a[good], b[good]
            good = ~(before[a] == before[b]).any(1)  # no bucket before this one has both
            a, b = start + a[good], start + b[good]
            good = (tokens[a] == tokens[b]).sum(1) >= least
            left.append(a[good])
            right.append(b[good])
        if left and len(a := np.concatenate(left)):
            b = np.concatenate(right)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            of = {}
            cuts = starts_of(a)
            for x, y in zip(cuts[:-1], cuts[1:]):
                of[int(a[x])] = (b[x:y] - start).tolist()
            for row in sorted({*of, *b.tolist()}):
                keep.append(row)
                slots.append(row - int(start))
                mates.append(of.get(row, []))
    if keep:
        taken = some.select(["code", "key", "lo", "hi", "node", "rep", "copies"]).take(pa.array(keep))
        taken = taken.append_column("slot", pa.array(slots, pa.int32())).append_column("mates", pa.array(mates, pa.list_(pa.int32())))
        yield from taken.to_batches()


def _sets(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", 4 << 20):
            sums, edges = shingles([t or b"" for t in utf8(batch.column("text"))], n)
            raw = sums.tobytes()
            sets = [raw[8 * a : 8 * b] for a, b in zip(edges[:-1], edges[1:])]
            yield pa.record_batch(
                [pa.array(node_names(sums, edges), pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"]
            )

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets share."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    use = count[token] > 1
    owner, token = owner[use], shared[token[use]]
    out = np.zeros((n, n), np.float32)
    width = max(1, (8 << 20) // max(n, 1))
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    for low in range(0, int(shared[-1]) + 1 if len(shared) else 0, width):
        a, b = np.searchsorted(token, [low, low + width])
        part = np.zeros((n, min(width, int(shared[-1]) + 1 - low)), np.float32)
        part[owner[a:b], token[a:b] - low] = 1
        out += part @ part.T
    return out


def _verify(similarity: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches, "code", "key", "lo", "hi"):
            some = some.combine_chunks()
            keys = [some.column(c).to_numpy() for c in ("code", "key", "lo", "hi")]
            edges = starts_of(*keys)
            nodes, links, reps, roots = [], [], [], []
            for start, end in zip(edges[:-1], edges[1:]):
                rows = {r["slot"]: r for r in some.slice(start, end - start).to_pylist()}  # a repeated id sends its set twice
                rows = list(rows.values())
                linked = _linked(rows, similarity)
                copies = np.array([r["copies"] for r in rows])
                rep = np.array([r["rep"] for r in rows])
                for row, count, own, root in zip(rows, linked @ copies, rep, _smallest(linked, rep)):
                    if count:
                        nodes.append(row["node"])
                        links.append(int(count))
                        reps.append(int(own))
                        roots.append(int(root))
            if nodes:
                yield pa.record_batch(
                    [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(reps, pa.int64()), pa.array(roots, pa.int64())],
                    ["node", "links", "rep", "root"],
                )

    return run


def _linked(rows: list[dict], similarity: float) -> np.ndarray:
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    place = {r["slot"]: i for i, r in enumerate(rows)}
    asked = np.zeros((len(rows), len(rows)), bool)
    for i, row in enumerate(rows):
        asked[i, [place[m] for m in row["mates"] if m in place]] = True
    shared, size = common_counts(sets), np.array([len(s) for s in sets])
    union = size[:, None] + size[None, :] - shared
    asked &= shared >= similarity * union - 1e-6
    return (asked | asked.T).astype(np.int64)


def _smallest(linked: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """The smallest representative in each one's connected group."""
    label = rep.copy()
    near = linked.astype(bool) | np.eye(len(rep), dtype=bool)
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
        if (new == label).all():
            return label
        label = new


def components(edges: DataFrame) -> DataFrame:
    """``vertex, label``: the smallest vertex each is connected to.

    Every round takes the smallest label among neighbours, then the label's label.
    """
    both = edges.select(F.col("rep").alias("a"), F.col("root").alias("b")).where("a <> b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("least"))
    labels = stored(labels.select("vertex", F.least("vertex", "least").alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("vertex", "b"), "b").groupBy(F.col("a").alias("vertex")).agg(F.min("label").alias("near"))
        nearer = labels.join(seen, "vertex").select("vertex", F.least("label", "near").alias("next"), "label")
        of = labels.select(F.col("vertex").alias("next"), F.col("label").alias("beyond"))
        moved = nearer.join(of, "next", "left").select(
            "vertex", F.least("next", F.coalesce("beyond", "next")).alias("next"), "label"
        )
        moved = stored(moved, "labels")
        done = moved.where("next <> label").isEmpty()
        discard(labels)
        labels = moved.select("vertex", F.col("next").alias("label"))
        if done:
            discard(both)
            return labels


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    similarity: float = 0.8,
    recall: float = 0.999999,
) -> DataFrame:
    """Per document its class (the smallest id connected to it), the smallest id of
    its shingle set, its number of links to other documents, and its shingles."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    sketched = stored(rows.mapInArrow(_sketch(n), "doc_id long, node binary, size int, tokens array<long>"), "sketches")
    named = sketched.where("doc_id IS NOT NULL AND node IS NOT NULL")
    least = F.min(F.struct("doc_id", "size", "tokens")).alias("least")
    nodes = named.groupBy("node").agg(least, F.count("*").alias("copies"))
    nodes = stored(nodes.select("node", F.col("least.doc_id").alias("rep"), "copies", "least.size", "least.tokens"), "nodes")

    leaves = _buckets(nodes, runs_for(similarity, recall))
    reached = leaves.groupBy("node").agg(F.collect_list(F.struct("code", "key")).alias("reached"))
    profile = nodes.join(reached, "node")
    blocks = F.ceil(F.col("n") / LIMIT)
    dealt = leaves.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("node", "code", "key", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    bucket = ["code", "key", "lo", "hi"]
    compared = dealt.join(profile, "node").repartition(*bucket).sortWithinPartitions(*bucket)
    chosen = stored(
        compared.mapInArrow(
            _candidates(similarity),
            "code long, key long, lo long, hi long, node binary, rep long, copies long, slot int, mates array<int>",
        ),
        "candidates",
    )
    discard(leaves)
    wanted = chosen.select(F.col("rep").alias("doc_id")).distinct()
    sets = rows.join(wanted, "doc_id").mapInArrow(_sets(n), "node binary, shingles binary")
    sent = chosen.join(sets, "node").repartition(*bucket).sortWithinPartitions(*bucket)
    found = stored(sent.mapInArrow(_verify(similarity), "node binary, links long, rep long, root long"), "links")

    discard(chosen)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select("rep", "root").distinct())
    about = nodes.select("node", "rep", "copies").join(links, "node", "left")
    about = about.join(labels.withColumnRenamed("vertex", "rep"), "rep", "left")
    about = about.select(
        "node",
        "rep",
        F.coalesce("label", "rep").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    out = sketched.select("doc_id", "size", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")).join(about, "node", "left")
    return out.select(
        "doc_id",
        F.coalesce("label", "doc_id").alias("class_id"),
        F.coalesce("rep", "doc_id").alias("rep_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.col("size").alias("n_shingles"),
    )
