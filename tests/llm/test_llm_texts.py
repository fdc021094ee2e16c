"""Token counts, shards, classifier, source mix and packing."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetide import session
from pagetide.llm import op1_best_fit_packing as op1
from pagetide.llm import op2_token_shards as op2
from pagetide.llm import op6_source_mix as op6
from pagetide.llm import op7_quality_classifier as op7
from pagetide.llm import op8_token_counts as op8

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=public_tokenizers.path(MODEL)), op8.PieceCounter(public_tokenizers.path(MODEL))


@given(st.text(st.one_of(st.sampled_from("ab the▁ \n\tin"), st.characters(codec="utf-8")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_counts_equal_the_library(pieces, text):
    assert pieces[1].count(text) == len(pieces[0].encode(text))


def test_token_counts(odd_docs, odd_rows, pieces, monkeypatch):
    expected = []
    for i, text, *_ in odd_rows:
        n = len(pieces[0].encode(text or ""))
        expected.append((i, len((text or "").encode()), n, n > 4096))
    got = [tuple(r) for r in op8.token_counts(odd_docs).collect()]
    assert Counter(got) == Counter(expected)
    assert any(r[3] for r in got)


def test_words_are_forgotten_without_harm(pieces, monkeypatch):
    monkeypatch.setattr(op8, "REMEMBERED", 3)
    for text in ("one two three four five six", "seven one eight", "one two"):
        assert pieces[1].count(text) == len(pieces[0].encode(text))


def test_feistel_is_a_permutation():
    for size in (1, 2, 5, 64, 1000, 4097):
        for key in (0, 7):
            assert sorted(op2.Feistel(size, key)(np.arange(size))) == list(range(size))
    assert list(op2.Feistel(1000, 1)(np.arange(1000))) != list(op2.Feistel(1000, 2)(np.arange(1000)))


@pytest.mark.parametrize("length", [64, 1024])
def test_token_shards(spark, odd_docs, odd_rows, monkeypatch, length):
    monkeypatch.setattr(op2, "SHARD", 60_000)
    folder = session.run_folder(spark, "shards")
    rows = op2.token_shards(odd_docs, folder, length=length).collect()
    slots = sorted({(r.slot, r.shard) for r in rows})
    assert [s for s, _ in slots] == list(range(len(slots)))
    counts = Counter(shard for _, shard in slots)
    assert len(counts) > 3
    shards, first = [], 0
    for shard in sorted(counts):
        shards.append((shard, counts[shard], first))
        first += counts[shard]
    read = list(op2.read_slots(folder, shards, 0, len(slots), length))
    assert [x.tolist() for x in op2.read_slots(folder, shards, 11, 30, length)] == [x.tolist() for x in read[11:41]]
    by, seen = defaultdict(lambda: defaultdict(list)), defaultdict(int)
    firsts = {shard: first for shard, _, first in shards}
    for r in rows:
        assert r.byte_offset == (r.slot - firsts[r.shard]) * 2 * (length + 1)
        by[r.doc_id][r.seq_no].append(read[r.slot][r.place : r.place + r.n_tokens].tolist())
        seen[r.slot] += r.n_tokens
    assert all(seen[i] == len(x) for i, x in enumerate(read))  # every token is some document's
    assert sum(len(x) < length for x in read) <= 5  # one for each task at most
    encoder = op2.WordEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for i, text, *_ in odd_rows:
        if i is not None and i != 147 and text:
            ids = sum((by[i][k][0] for k in range(len(by[i]))), [])
            assert ids == [*encoder.encoding.encode_ordinary(text), encoder.end]
    assert 140 not in by and 141 not in by
    assert sum(len(p) for k in by[147].values() for p in k) == 2 * (len(encoder.encoding.encode_ordinary("aaaa" * 300)) + 1)
    assert sum(len(p) for k in by[None].values() for p in k) > 20
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.slot)]
    assert order != sorted(order, key=lambda i: (i is None, i or 0))


def test_ids_of_any_size_and_documents_over_many_sequences(spark):
    docs = spark.createDataFrame([(2**63 - 1, "one two " * 3000), (-(2**63), "x"), (None, "y"), (5, "z " * 9)], "doc_id long, text string")
    folder = session.run_folder(spark, "shards")
    rows = op2.token_shards(docs.coalesce(1), folder, length=16).collect()
    encode = op2.WordEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encoding.encode_ordinary
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.n_tokens
    assert tokens == {i: len(encode(t)) + 1 for i, t in docs.collect()}
    assert len({r.slot for r in rows}) == -(-sum(tokens.values()) // 16)


@given(st.lists(st.integers(1, 40), max_size=12), st.integers(1, 9), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_sequences_are_filled(sizes, length, step):
    """Tokens in order, full but for the last, with every piece where it says it is."""
    filler, tokens = op2.Filler(length), [np.full(n, i, "<u2") for i, n in enumerate(sizes)]
    sequences, pieces, done = [], [], 0
    for i in [*range(0, len(tokens), step), None]:
        some = [] if i is None else tokens[i : i + step]
        ids = np.arange(len(some), dtype=np.int64) + (i or 0)
        body, filled, found = filler.fill(some, ids, np.zeros(len(some), bool), last=i is None)
        sequences += [x[:n].tolist() for x, n in zip(body, filled)]
        pieces += [(s + done, *rest) for s, *rest in zip(*(c.tolist() for c in found))]
        done += len(body)
    assert sum(sequences, []) == np.concatenate([*tokens, []]).tolist()
    assert all(len(x) == length for x in sequences[:-1])
    seen = Counter()
    for sequence, doc, _, number, place, n in pieces:
        assert sequences[sequence][place : place + n] == [doc] * n
        assert number == sum(p[1] == doc and p[0] < sequence for p in pieces)
        seen[doc] += n
    assert seen == {i: n for i, n in enumerate(sizes)}


@given(st.text(st.sampled_from("ab 's\n\t é1."), max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_are_encoded_as_whole_texts(text):
    encoder = test_words_are_encoded_as_whole_texts.__dict__.setdefault(
        "encoder", op2.WordEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    )
    assert encoder.encode(text) == encoder.plain(text)


def water(sizes, weights, most=3):
    """Targets by sharing out again and again."""
    total, held = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in held)
        free = [s for s in sizes if s not in held]
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {**{s: most * sizes[s] for s in held}, **share}
        held |= over


def test_source_mix(odd_docs, odd_rows):
    rows = op6.source_mix(odd_docs, block=64).collect()
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes = Counter()
    for _, text, _, source in odd_rows:
        sizes[source] += count(text)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = water(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)})
    assert len(rows) == len(odd_rows)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, count(t)) for i, t, *_ in odd_rows)
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    for s in names:
        got = taken[sizes[s], round(expected[s], 6)]
        assert abs(got - expected[s]) < 1
    again = op6.source_mix(odd_docs.repartition(3), block=64).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_slots_are_spread_evenly(odd_docs):
    sized = odd_docs.select("source", op6.word_count(F.col("text")).alias("size"))
    targeted = op6.targets(sized, (1, 2, 3), 3)
    slots = op6.schedule(targeted, 16).collect()
    share = {r.place: math.ceil(math.floor(r.target + 0.5) / 16) for r in targeted.collect()}
    total = sum(share.values())
    assert sorted(r.slot for r in slots) == list(range(total))
    assert Counter(r.place for r in slots) == Counter({p: n for p, n in share.items() if n})
    seen = Counter()
    for i, r in enumerate(sorted(slots, key=lambda r: r.slot), 1):
        assert r["rank"] == seen[r.place]
        seen[r.place] += 1
        for place, n in seen.items():
            assert abs(n - i * share[place] / total) < 6


def test_small_sources_meet_their_targets(spark):
    """Forty sources of few words beside twenty large ones, and one without words."""
    sizes = {f"s{i:02d}": 100 + 7 * i for i in range(40)} | {f"t{i:02d}": 50_000 for i in range(20)} | {"u": 0}
    rows, i = [], 0
    for source, words in sizes.items():
        for part in range(0, max(words, 1), 5000):
            rows.append((i, "w " * min(5000, words - part), source))
            i += 1
    got = op6.source_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    expected = water(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))})
    of = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        taken[of[r.doc_id]] += r.taken
        assert r.target == pytest.approx(expected[of[r.doc_id]])
        assert r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - expected[s]) < 1 for s in sizes)


def test_packing(odd_docs, odd_rows):
    size, cluster = op6.word_count(F.col("text")), F.xxhash64("text")
    rows = op1.best_fit_packing(odd_docs, size, cluster, capacity=256, per_source=2, group_rows=50).collect()
    by_doc, bins = defaultdict(Counter), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id][r.piece] += r.length
        bins[r.pack_group, r.bin].append(r)
    sizes = Counter()
    for i, text, *_ in odd_rows:
        sizes[i] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert {i: sum(c.values()) for i, c in by_doc.items()} == {i: n for i, n in sizes.items() if n}
    about = {i: (text, source) for i, text, _, source in odd_rows if i is not None}
    for some in bins.values():
        some.sort(key=lambda r: r.place)
        assert [r.offset for r in some] == np.cumsum([0] + [r.length for r in some])[:-1].tolist()
        assert {r.free for r in some} == {256 - sum(r.length for r in some)}
        parts = [about[r.doc_id] for r in some if r.length < 256 and r.doc_id is not None]
        assert max(Counter(t for t, _ in parts).values(), default=0) <= 1
        assert max(Counter(s for _, s in parts).values(), default=0) <= 2
    again = op1.best_fit_packing(odd_docs.repartition(2), size, cluster, capacity=256, per_source=2, group_rows=50)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))
    kept = op1.best_fit_packing(odd_docs, size, cluster, keep_empty=True)
    assert {r.doc_id for r in kept.where("bin IS NULL").collect()} == {140, 141, 142}


@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 3), st.integers(0, 4)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_the_tightest_compatible_bin_is_taken(items):
    bins, held = op1.Bins(20, 2), []
    for size, source, cluster in items:
        fits = [
            (20 - sum(s for s, *_ in b), i)
            for i, b in enumerate(held)
            if sum(s for s, *_ in b) + size <= 20
            and cluster not in [c for *_, c in b]
            and [s for _, s, _ in b].count(source) < 2
        ]
        found = bins.put(size, 1 << source, 1 << cluster)
        if fits:
            assert 20 - sum(s for s, *_ in held[found]) == min(fits)[0] and found in [i for _, i in fits]
        else:
            assert found == len(held)
            held.append([])
        held[found].append((size, source, cluster))


def junk(i):
    return " ".join(f"w{(i * k) % 17}###" if k % 2 else f"W{k}$$$" for k in range(1, 30))


@pytest.fixture(scope="module")
def graded(spark, odd_docs):
    good = odd_docs.select("doc_id", "text").where("doc_id < 140")
    bad = spark.createDataFrame([(1000 + i, junk(i)) for i in range(60)], "doc_id long, text string")
    docs = good.unionByName(bad)
    return docs, docs.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))


def test_classifier_tells_junk_it_has_not_seen(graded):
    docs, labels = graded
    rows = op7.quality_scores(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and all(0 <= r.score <= 1 for r in rows)
    right = sum(r.predicted == (r.doc_id < 1000) for r in held)
    assert right >= 0.9 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    again = op7.quality_scores(docs.repartition(3), labels).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx({r.doc_id: r.score for r in rows}, abs=1e-6)


def test_held_out_labels_and_labels_of_others_change_nothing(graded):
    docs, labels = graded
    before = {r.doc_id: r.score for r in op7.quality_scores(docs, labels).collect()}
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    nulls = turned.unionByName(labels.selectExpr("doc_id + 100000 AS doc_id", "0 AS quality"))
    assert {r.doc_id: r.score for r in op7.quality_scores(docs, nulls).collect()} == pytest.approx(before, abs=1e-9)


def test_long_labelled_texts_do_not_end_the_sample(spark, graded, monkeypatch):
    """Texts of a megabyte at every tenth id, more than the sample may hold at all; and a
    label of few rows, all late in the order, is still learnt."""
    docs, labels = graded
    monkeypatch.setattr(op7, "SAMPLE_BYTES", 400_000)
    monkeypatch.setattr(op7, "LONGEST", 20_000)
    monkeypatch.setattr(op7, "EACH", 20)
    long = spark.range(2000, 2060).selectExpr("id AS doc_id", "repeat('long text ', 100000) AS text")
    more = labels.unionByName(spark.range(2000, 2060).selectExpr("id AS doc_id", "1 AS quality"))
    held = [r for r in op7.quality_scores(docs.unionByName(long), more).collect() if r.held_out and r.doc_id < 2000]
    assert sum(r.predicted == (r.doc_id < 1000) for r in held) >= 0.9 * len(held)
    monkeypatch.setattr(op7, "SAMPLE_BYTES", 60_000)
    few = docs.where("doc_id < 1010")
    scores = {r.doc_id: r.score for r in op7.quality_scores(few, labels).collect()}
    assert len(set(scores.values())) > 10


def test_classifier_on_unusual_input(odd_docs, no_docs, graded, odd_rows):
    _, labels = graded
    rows = op7.quality_scores(odd_docs, labels, keep_row=True)
    assert rows.count() == len(odd_rows)
    assert rows.select("row.*").columns == odd_docs.columns
    found = {r.doc_id: r.score for r in rows.collect()}
    assert found[140] == found[141]
    assert op7.quality_scores(no_docs, labels).count() == 0
    assert {r.score for r in op7.quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    one = labels.where("quality = 1")
    assert {r.score for r in op7.quality_scores(odd_docs, one).collect()} == {1.0}


def test_empty_tables(spark, no_docs):
    assert op8.token_counts(no_docs).count() == 0
    assert op6.source_mix(no_docs).count() == 0
    assert op2.token_shards(no_docs, session.run_folder(spark, "shards")).count() == 0
    assert op1.best_fit_packing(no_docs, op6.word_count(F.col("text")), F.xxhash64("text")).count() == 0
