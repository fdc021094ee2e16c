"""Hard negatives, periodic runs and repeated lines, against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetide.llm import bloom, common
from pagetide.llm import op11_hard_negatives as op11
from pagetide.llm import op12_periodic_runs as op12
from pagetide.llm import op13_line_dedup as op13
from pagetide.llm import registry

LONG = 2**63 - 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# hard negatives


def brute_negatives(rows, every=50, positives=5, negatives=3, scale=256):
    """By all pairs in whole numbers of any size; ids are distinct."""
    rows = [
        (i, label, [max(-LONG - 1, min(LONG, int(np.floor(float(x) * scale)))) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in rows:
        if i % every:
            continue
        scored = []
        for j, other, w in rows:
            if j != i and len(v) == len(w):
                scored.append((max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(v, w)))), j, other))
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            hits = [s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p][:negatives]
            out += [(i, positive, rank, j, p, s) for rank, (s, j, _) in enumerate(hits, 1)]
    return out


VECTORS = "vec_id long, embedding array<double>, label int, score int, size string, low int, `a.b` int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 2, 3) for r in rows], VECTORS)


def clustered(rng, n, size, labels=4, factor=1.0):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        mix = [c + rng.gauss(0, 0.7) + 1 for c in centres[label]]
        rows.append((i, [round(x, 3) * factor for x in mix], label))
    return rows


@pytest.mark.parametrize("factor", [1.0, 1e6, 1e12, 1e16])
def test_hard_negatives(spark, monkeypatch, factor):
    monkeypatch.setattr(op11, "TREE", 64)
    monkeypatch.setattr(op11, "LEAF", 5)
    monkeypatch.setattr(op11, "FAN", 3)
    rng = random.Random(5)
    rows = clustered(rng, 260, 6, factor=factor)
    rows += [(300 + i, list(rows[7][1]), 9 if i % 2 else rows[7][2]) for i in range(60)]  # ties
    rows += [
        (1000, None, 1),
        (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
        (1100, [float("nan")] * 6, 1),
        (1150, [float("inf")] * 6, 1),
        (1200, [1.0] * 6, None),
        (None, [1.0] * 6, 1),
        (1250, [], 2),
        (1251, [], 2),
        (1252, [], 3),
        (1300, [1.0, 2.0], 1),
        (1301, [1.0, 2.0], 1),
        (1302, [0.5, 1.0], 2),
        (1350, [0.0] * 6, 1),
    ]
    got = [tuple(r) for r in op11.hard_negatives(vectors_of(spark, rows).repartition(3)).collect()]
    assert sorted(got) == sorted(brute_negatives(rows))
    assert len(got) > 10


def test_boxes_leave_rows_out(monkeypatch):
    """Clustered rows are not all read, and what is left out does not count."""
    monkeypatch.setattr(op11, "LEAF", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 300, (20, 4))
    square = np.rint(centres[np.arange(2000) % 20] + rng.normal(0, 4, (2000, 4))).astype(np.int64)
    labels = np.arange(2000) % 20
    order = np.argsort(labels, kind="stable")
    tree = op11.Tree(order, labels[order], square[order])
    read = []
    monkeypatch.setattr(op11.Searches, "_read", lambda self, t, s, leaf, f=op11.Searches._read: (read.append(len(s)), f(self, t, s, leaf)))
    anchors = np.arange(0, 2000, 50)
    ends = np.full(len(anchors), LONG)
    blob = common.packed(anchors, labels[anchors], square[anchors].reshape(-1), np.ones(len(anchors), np.int64), -ends - 1, ends)
    search = op11.Searches(blob, 4, 5, True)
    search.meet(tree)
    assert sum(read) < len(anchors) * (len(tree.starts) - 1) / 4
    for i, a in enumerate(anchors):
        others = np.flatnonzero((labels == labels[a]) & (np.arange(2000) != a))
        scores = square[others] @ square[a]
        best = others[np.lexsort((others, -scores))][:5]
        assert list(search.found[i]) == list(best)


def test_repeated_rows_and_no_rows(spark):
    rows = [(50, [1.0, 1.0], 1), (50, [2.0, 1.0], 1), (50, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (4, [0.5, 0.8], 2), (4, [0.5, 0.8], 2)]
    got = sorted(tuple(r) for r in op11.hard_negatives(vectors_of(spark, rows)).collect())
    # one anchor, the smallest; the repeated negative counts twice
    score = 2 * 256 * 256
    low = 256 * 128 + 256 * 204
    assert got == [(50, 3, 1, 4, score, low), (50, 3, 2, 4, score, low)]
    assert op11.hard_negatives(vectors_of(spark, rows).limit(0)).collect() == []


# periodic runs


def brute_lyndon(word):
    def longest(i):
        return max(n for n in range(1, len(word) - i + 1) if all(word[i : i + n] < word[i + k : i + n] for k in range(1, n)))

    return [longest(i) for i in range(len(word))]


def brute_runs(word, least, periods):
    n, runs, covered = len(word), [], set()
    for period in range(1, n):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and word[end] == word[end + period]:
                end += 1
            stretch = (start, end + period)
            # a stretch of a smaller period has its multiples as periods as well
            if end + period - start >= max(least, periods * period) and stretch not in covered:
                if not any(a <= start and end + period <= b for a, b in covered):
                    runs.append((start, end + period - start, period))
                    covered.add(stretch)
            start = end + 1 if end == start else end + 1
    return sorted(runs)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=24))
@settings(max_examples=400, deadline=None)
def test_lyndon_lengths(word):
    assert op12.lyndon_lengths(np.array(word)).tolist() == brute_lyndon(word)
    assert op12.lyndon_lengths(-np.array(word)).tolist() == brute_lyndon([-w for w in word])


@given(st.lists(st.integers(0, 2), max_size=8), st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 7), st.lists(st.integers(0, 2), max_size=8))
@settings(max_examples=400, deadline=None)
def test_runs(head, root, times, tail):
    word = head + root * times + root[: len(root) // 2] + tail
    for least, periods in ((6, 4), (3, 3)):
        assert op12.runs_of(np.array(word), least, periods) == brute_runs(word, least, periods)


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(op12, "CHUNK", 5000)
    expected = []
    for i, text, *_ in odd_rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute_runs(words, 6, 4) if len(words) < 1000 else None
        expected.append((i, len(words), runs, None if runs is None else collapsed(words, runs)))
    got = [
        (r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]] if r["n_words"] < 1000 else None, r["collapsed"] if r["n_words"] < 1000 else None)
        for r in op12.periodic_runs(odd_docs).collect()
    ]
    assert Counter(map(repr, got)) == Counter(map(repr, expected))
    assert any(r[2] for r in got)


def test_runs_query(spark, tmp_path):
    """The registered query against its contract, word for word."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 90))) + "\n é  x") for i in range(120)]
    rows += [(200, None), (201, ""), (202, "z " * 40 + "\tq q q q q q"), (None, "b b b b b b b")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    expected, planted = [], 0
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            planted += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
        runs = brute_runs(words, 6, 4)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        expected.append((i, len(runs), *best, milli, sha(listed), sha(collapsed(words, runs))))
    got = [tuple(r) for r in registry.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter(expected)
    assert planted > 5 and sum(r[1] > 0 for r in got) > 5


def test_no_documents(no_docs):
    assert op12.periodic_runs(no_docs).collect() == []
    assert op13.line_dedup(no_docs).collect() == []


# repeated lines


def brute_lines(rows, least=40, documents=5):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least:
                holders[k].append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = []
        for line in lines:
            of = holders.get(key(line), [])
            keeper = max((x for x in of if x is not None), default=None)
            gone.append(len(of) >= documents and i != keeper)
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), sha(kept), kept))
    return out


@pytest.fixture(scope="module")
def lined_rows(odd_rows):
    rng = random.Random(4)
    shared = [f"Shared line number {i} that is certainly long enough é" for i in range(12)]
    exact = ["x" * 40, "y" * 39, "é" * 40, "É" * 40, "Z" * 41]
    rows = [(r[0], r[1]) for r in odd_rows]
    for i in range(300, 380):
        lines = [rng.choice(shared + exact) for _ in range(rng.randrange(1, 8))] + [f"a line of document {i} alone, {rng.random()}"]
        lines = [rng.choice(["", "  ", "\t"]) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) + rng.choice(["", "\r", " \x0b"]) for x in lines]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    only_four = "this line stands in four documents, which is too few to go"
    rows += [(400 + i, only_four + "\n" + only_four) for i in range(4)]
    rows += [(410, only_four[:-1]), (None, shared[0]), (None, shared[0]), (379, rows[-1][1]), (420, "\n\n"), (421, "\x00" * 50)]
    rows += [(None, "every document with this line has no id at all, so all keep it")] * 6
    return rows


@pytest.mark.parametrize("bits", [1 << 28, 2048])
def test_line_dedup(spark, lined_rows, monkeypatch, bits):
    """The same rows from wide filters, and from such that suspect nearly all."""
    monkeypatch.setattr(op13, "CHUNK", 3000)
    monkeypatch.setattr(op13, "SEGMENT", 64 if bits > 4096 else 8)
    docs = spark.createDataFrame(lined_rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    got = [tuple(r) for r in op13.line_dedup(docs.repartition(5), bits=bits).collect()]
    assert Counter(got) == Counter(brute_lines(lined_rows))
    assert sum(r[2] for r in got) > 100


def test_filters_know_what_was_put_in():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    filter_ = bloom.Bloom(5000 * bloom.PER_HASH)
    filter_.add(hashes)
    assert filter_.has(hashes).all()
    assert filter_.has(rng.integers(0, 2**64, 5000, dtype=np.uint64)).mean() < 0.01
