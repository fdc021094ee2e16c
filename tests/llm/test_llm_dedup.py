"""Exact dedup, near duplicates and repeated passages against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetide.llm import op3_exact_dedup as op3
from pagetide.llm import op9_suffix_dedup as op9
from pagetide.llm import op10_ngram_join as op10
from pagetide.llm.common import shuffles_freed


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 50)), max_size=60), st.booleans(), st.integers(0, 900))
@settings(max_examples=60, deadline=None)
def test_tries_own_every_string(rows, largest, memory):
    trie = op3.OwnerTrie(largest, memory)
    for key, owner in rows:
        trie.insert(key, owner, 1)
        trie.bound()
    found = sorted(trie.items())
    best = max if largest else min
    groups = defaultdict(list)
    for key, owner in rows:
        groups[key].append(owner)
    assert found == sorted((k, best(v), len(v)) for k, v in groups.items())


@pytest.mark.parametrize("memory", [op3.MEMORY, 2000])
def test_exact_dedup(odd_docs, odd_rows, memory):
    got = [tuple(r) for r in op3.exact_dedup(odd_docs, memory=memory).collect()]
    groups = defaultdict(list)
    for i, text, *_ in odd_rows:
        groups[text or ""].append(i)
    expected = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            expected.append((i, best, len(ids), i == best and first, sha(text)))
            first = first and i != best
    assert Counter(got) == Counter(expected)


def test_exact_dedup_keeps_the_smallest_and_normalises(odd_docs):
    rows = op3.exact_dedup(odd_docs, keep="smallest", normalise=F.lower(F.trim("text"))).collect()
    by = {r.doc_id: r for r in rows}
    assert by[145].keep_id == 144 and not by[145].kept and by[145].text_sha256 == sha("one two")
    with pytest.raises(ValueError):
        op3.exact_dedup(odd_docs, keep="any")


def shingle_set(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def brute_join(rows, similarity=0.8):
    sets = {}
    for i, text, *_ in rows:
        if i is not None:
            sets[i] = shingle_set(text)
    parent, links = {i: i for i in sets}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (root(i), links[i], len(sets[i])) for i in ids}


def found_join(df):
    return {r.doc_id: (r.class_id, r.n_links, r.n_shingles) for r in df.collect() if r.doc_id is not None}


def distinct_ids(odd_rows):
    """The rows but the repeated one, which the join counts as a copy of itself."""
    return [r for i, r in enumerate(odd_rows) if r not in odd_rows[:i]]


def test_ngram_join(spark, odd_docs, odd_rows):
    docs = odd_docs.dropDuplicates(["doc_id", "text"])
    assert found_join(op10.ngram_join(docs)) == brute_join(distinct_ids(odd_rows))
    got = op10.ngram_join(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert [r.class_id for r in got if r.doc_id is None] == [None, None]
    assert {r.class_id for r in got if r.doc_id == 147} == {147}


def test_large_buckets_are_split_and_compared_in_blocks(odd_docs, odd_rows, monkeypatch):
    for name, value in (("LIMIT", 4), ("PAIRS", 64), ("DEPTH", 3)):
        monkeypatch.setattr(op10, name, value)
    docs = odd_docs.dropDuplicates(["doc_id", "text"])
    assert found_join(op10.ngram_join(docs)) == brute_join(distinct_ids(odd_rows))


def test_recall_of_runs():
    assert op10.runs_for(0.8, 0.999999) == 10
    assert op10.runs_for(0.8, 0.9) < op10.runs_for(0.8, 0.99) < op10.runs_for(0.6, 0.99)
    assert op10.least_agreeing(0.8) == 14 and op10.least_agreeing(1.0) == op10.TOKENS


def test_chains_are_one_component(spark):
    edges = [(i, i - 1) for i in range(1, 40)] + [(100, 102), (101, 102)] + [(200, 200)]
    labels = op10.components(spark.createDataFrame(edges, "rep long, root long")).collect()
    assert {r.vertex: r.label for r in labels} == {**{i: 0 for i in range(40)}, 100: 100, 101: 100, 102: 100}


def brute_cut(rows, length=50):
    first = {}
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, text in texts:
        if i is not None:
            for k in range(len(text) - length + 1):
                piece = text[k : k + length]
                first[piece] = min(first.get(piece, i), i)
    out = []
    for i, text in texts:
        gone = np.zeros(len(text) + 2, bool)
        for k in range(len(text) - length + 1) if i is not None else ():
            if first[text[k : k + length]] < i:
                gone[k + 1 : k + 1 + length] = True
        rest = np.frombuffer(text, np.uint8)[~gone[1:-1]].tobytes()
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        out.append((i, len(text), len(text) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize(
    "chunk, hot, hotter",
    [(op9.CHUNK, op9.HOT, op9.HOTTER), (3000, op9.HOT, op9.HOTTER), (op9.CHUNK, 3, op9.HOTTER), (3000, 0, 12), (3000, 0, 0)],
)
def test_suffix_dedup(odd_docs, odd_rows, monkeypatch, chunk, hot, hotter):
    """Also with every gram lengthened, and with every string by itself."""
    monkeypatch.setattr(op9, "HOT", hot)
    monkeypatch.setattr(op9, "HOTTER", hotter)
    monkeypatch.setattr(op9, "CHUNK", chunk)
    monkeypatch.setattr(op9, "HELD", chunk // 20)
    monkeypatch.setattr(op9, "SHARE", 40_000)
    got = [tuple(r) for r in op9.suffix_dedup(odd_docs).collect()]
    assert Counter(got) == Counter(brute_cut(odd_rows))


def test_filters_that_tell_little_lose_nothing(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(op9, "BITS", 2048)
    monkeypatch.setattr(op9, "SEGMENT", 50)
    got = [tuple(r) for r in op9.suffix_dedup(odd_docs).collect()]
    assert Counter(got) == Counter(brute_cut(odd_rows))


def test_what_is_kept_of_a_text(odd_docs, odd_rows):
    for row in op9.suffix_dedup(odd_docs, keep_text=True).collect():
        assert hashlib.sha256(row.kept).hexdigest() == row.kept_sha256


@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=8), st.integers(4, 8))
@settings(max_examples=150, deadline=None)
def test_repeat_groups_in_one_suffix_array(texts, length):
    """All steps in one process, on texts so alike that every interval is diverse."""
    gram = 3
    data = [t.encode() for t in texts]
    rows = [(i, t) for i, t in enumerate(texts)]
    ids, marks = np.arange(len(texts)), np.arange(len(texts))
    found = op9.Anchors(data, length, gram)
    covers = [[] for _ in texts]
    if len(found.at):
        place = found.at - found.starts[found.doc]
        columns = np.arange(-(length - gram), length)
        square = found.data[np.clip(found.at[:, None] + columns, 0, len(found.data) - 1)].copy()
        square[(columns < -found.left[:, None]) | (columns >= found.right[:, None])] = 0
        array = op9.SuffixArray(square, found.left, found.right, length - gram)
        edges = np.append(np.flatnonzero(array.common < gram), len(array.order))
        for a, b in zip(edges[:-1], edges[1:]):
            for before, after, members in op9.maximal_repeats(array, length, a, b - 1):
                pieces = {data[found.doc[m]][place[m] - before : place[m] + after] for m in members}
                assert len(pieces) == 1 and len(pieces.pop()) >= length
                least = ids[found.doc[members]].min()
                for m in members:
                    if found.doc[m] > least:
                        covers[found.doc[m]].append((place[m] - before, place[m] + after))
    got = []
    for i, text in enumerate(data):
        gone = np.zeros(len(text), bool)
        for a, b in covers[i]:
            gone[a:b] = True
        got.append(int(gone.sum()))
    assert got == [r[2] for r in brute_cut(rows, length)]
    assert marks is not None


def test_empty_tables(no_docs):
    assert op3.exact_dedup(no_docs).count() == 0
    assert op9.suffix_dedup(no_docs).count() == 0
    assert op10.ngram_join(no_docs).count() == 0


def shared_at_edges(n: int) -> list[tuple[int, str]]:
    """Texts round one passage, each with words of its own before and after it, some of
    which a few of them share."""
    draw = np.random.default_rng(5)
    passage = "".join(chr(97 + c) for c in draw.integers(0, 26, 70))
    rows = []
    for i in range(n):
        before, after = ("".join(chr(97 + c) for c in draw.integers(0, 26, 60)) for _ in range(2))
        rows.append((i, before[: i % 50] + "edge " * (i % 3) + passage + " more" * (i % 4) + after))
    return rows


@pytest.mark.parametrize("hot, hotter", [(10**9, 10**9), (20, 10**9), (20, 40)])
def test_hot_grams_at_the_edges_of_a_passage(spark, monkeypatch, hot, hotter):
    monkeypatch.setattr(op9, "HOT", hot)
    monkeypatch.setattr(op9, "HOTTER", hotter)
    rows = shared_at_edges(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in op9.suffix_dedup(docs).collect()) == Counter(brute_cut(rows))


@pytest.mark.parametrize("hot", [10**9, 0])
def test_zero_bytes_are_not_the_end_of_a_text(spark, monkeypatch, hot):
    """A text that ends where others go on with zero bytes does not part those in the array."""
    monkeypatch.setattr(op9, "HOT", hot)
    draw = np.random.default_rng(9)
    rows = []
    for group in range(20):
        passage = "".join(chr(97 + c) for c in draw.integers(0, 26, 45))
        for cut in (8, 0, 8, 3, 8):  # zero bytes after it, and before it
            rows.append((len(rows), f"{group:02}{len(rows):03}" * 4 + passage + "\x00" * cut))
            rows.append((len(rows), "\x00" * cut + passage + f"{group:02}{len(rows):03}" * 4))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in op9.suffix_dedup(docs).collect()) == Counter(brute_cut(rows))


def test_grams_in_many_contexts_are_found(spark, monkeypatch):
    """Levels are met by what several rows of a segment add up to, at any size of input."""
    monkeypatch.setattr(op9, "HOT", 20)
    monkeypatch.setattr(op9, "HOTTER", 10**6)
    monkeypatch.setattr(op9, "CHUNK", 2000)
    rows = spark.createDataFrame(shared_at_edges(120), "doc_id long, text string")
    some = rows.selectExpr("doc_id", "CAST(text AS BINARY) AS content", "xxhash64(text) AS doc_hash")
    found = op9.Anchors([t.encode() for _, t in shared_at_edges(120)], op9.LENGTH, op9.GRAM)
    pairs = {(g, c) for g, c in zip(found.gram.tolist(), found.contexts().tolist())}
    contexts = Counter(g for g, _ in pairs)
    many = np.array([g for g, n in contexts.items() if n >= 20], np.uint64)
    few = np.array([g for g, n in contexts.items() if n < 5], np.uint64)
    for total in (20_000, 10**12):
        known, hot, hotter = op9.Known(some, total, op9.LENGTH, op9.GRAM).opened()
        assert len(many) and hot(many).all() and known(many).all()
        assert hot(few).mean() < 0.01 and not hotter(many).any()


def random_texts(n, size):
    draw = np.random.default_rng(11)
    return ["".join(chr(97 + c) for c in draw.integers(0, 26, size)) for _ in range(n)]


def test_segments_get_equal_shares_of_anchors():
    """Anchors are the grams of least hash; that does not send them to the first segments."""
    batch = pa.record_batch([pa.array([t.encode() for t in random_texts(40, 4000)])], ["content"])
    by_segment = Counter()
    for b in op9._seen(op9.LENGTH, op9.GRAM, 16)([batch]):
        by_segment.update(dict(zip(b.column("segment").to_pylist(), b.column("n").to_pylist())))
    assert len(by_segment) == 16 and max(by_segment.values()) < 1.3 * by_segment.total() / 16


def test_anchors_that_no_other_text_has_are_not_sent(spark, monkeypatch):
    """The filters tell nearly all of them, in many segments as in one."""
    monkeypatch.setattr(op9, "SEGMENT", 250)
    texts = random_texts(60, 4000)
    texts += texts[:30]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    some = rows.selectExpr("doc_id", "CAST(text AS BINARY) AS content", "xxhash64(text) AS doc_hash")
    known, _, _ = op9.Known(some, sum(map(len, texts)), op9.LENGTH, op9.GRAM).opened()
    found = op9.Anchors([t.encode() for t in texts], op9.LENGTH, op9.GRAM)
    grams, counts = np.unique(found.gram, return_counts=True)
    assert known(grams[counts > 1]).all()
    assert known(grams[counts == 1]).mean() < 0.02


def test_shuffles_are_freed_within_only(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
        1 / 0
    assert spark.conf.get(name, None) == before


@given(st.lists(st.text("ab", min_size=6, max_size=30), min_size=1, max_size=8), st.integers(4, 8))
@settings(max_examples=150, deadline=None)
def test_pairs_are_found_without_a_scan(texts, length):
    """Intervals of two by one step, larger ones by the stack: the same bytes as all by the stack."""
    gram = 3
    found = op9.Anchors([t.encode() for t in texts], length, gram)
    if not len(found.at):
        return
    columns = np.arange(-(length - gram), length)
    square = found.data[np.clip(found.at[:, None] + columns, 0, len(found.data) - 1)].copy()
    square[(columns < -found.left[:, None]) | (columns >= found.right[:, None])] = 0
    array = op9.SuffixArray(square, found.left, found.right, length - gram)
    edges = np.append(np.flatnonzero(array.common < gram), len(array.order))
    want = set()
    for a, b in zip(edges[:-1], edges[1:]):
        for before, after, members in op9.maximal_repeats(array, length, a, b - 1):
            owner = found.doc[members]
            want |= {(m, i) for m in members[owner > owner.min()].tolist() for i in range(-before, after)}
    row, before, after = op9._later(array, found.doc, length, gram)
    assert {(m, i) for m, b, a in zip(row.tolist(), before.tolist(), after.tolist()) for i in range(-b, a)} == want
