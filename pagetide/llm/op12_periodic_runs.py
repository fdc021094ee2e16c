"""Runs of repeated word sequences, from Lyndon roots found by grouping suffixes.

A run is a stretch of words with a smallest period that no neighbouring word extends.
Every run holds, for the order of words or for the opposite one, a Lyndon root: a
place whose longest Lyndon word is as long as the period. The first phase of suffix
sorting by groups (Baier) yields just these lengths: suffixes lie in groups by the
Lyndon word they are known to begin with; groups are taken from the highest down, and
each suffix of a group is appended to the nearest place before it in a lower group,
which moves up accordingly. No suffix array is made. A root that is followed by its
own copy is extended to both sides as far as the words agree (longest common
extension), which gives the run.

A run of ``periods`` periods holds each of its words that often, and each pair of
neighbours once less, so texts are cut first where these are rarer, and whatever is
left is grouped. Texts do not depend on each
other: there is no shuffle, and a lost task is repeated alone. The work on a text is
proportional to its words, sorting of words apart.

Results for unusual input: words are runs of bytes that are not ASCII white space; a
null or empty text has no words, no run and an empty collapsed text; very long texts
are read whole; rows are answered one by one, so repeated ids and rows and null ids
stay as they are; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.llm.common import U64, in_chunks, mixed, starts_of, utf8

#: Bytes of text taken together, and rounds of cutting at rare words.
CHUNK, ROUNDS = 2 << 20, 6
_BASE = U64(0xD6E8FEB86659FD93)
_INVERSE = U64(pow(int(_BASE), -1, 2**64))


def lyndon_lengths(codes: np.ndarray) -> np.ndarray:
    """For each place the length of the longest Lyndon word that starts there."""
    n = len(codes)
    by_code = np.argsort(codes, kind="stable")
    edges = starts_of(codes[by_code])
    first = np.empty(n, np.int64)
    first[by_code] = np.repeat(edges[:-1], np.diff(edges))
    # members in group order, the place of each, its group's first index, ends by first index
    members, group = by_code.tolist(), first.tolist()
    place = np.empty(n, np.int64)
    place[by_code] = np.arange(n)
    place = place.tolist()
    end = [0] * (n + 1)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        end[a] = b
    length, before = [1] * n, list(range(-1, n - 1))
    high = n
    while high:
        low = group[members[high - 1]]
        width = length[members[low]]
        if high - low == 1:  # one suffix, as most are: one place moves, alone
            i, high = members[low], low
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                own = group[j]
                last = end[own] - 1
                length[j] += width
                if last > own:
                    other, at = members[last], place[j]
                    members[at], place[other] = other, at
                    members[last], place[j] = j, last
                    end[own], end[last], group[j] = last, last + 1, last
            continue
        appended: dict[int, int] = {}
        for i in sorted(members[low:high]):
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                appended[j] = appended.get(j, 0) + 1
        high = low
        for times in sorted(set(appended.values()), reverse=True):
            moved, ends = [], {}
            for i, n_times in appended.items():
                if n_times != times:
                    continue
                own = group[i]
                last = end[own] - 1
                ends.setdefault(own, last + 1)
                other, at = members[last], place[i]
                members[at], place[other] = other, at
                members[last], place[i] = i, last
                end[own] = last
                length[i] += times * width
                moved.append(i)
            starts = {own: end[own] for own in ends}
            for i in moved:
                group[i] = starts[group[i]]
            for own, old_end in ends.items():
                end[starts[own]] = old_end
    return np.array(length, np.int64)


def _extended(codes: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """Where the stretch around ``start`` that repeats with ``period`` begins and ends."""
    n = len(codes)
    step, right = 64, start
    while right + period < n:
        some = codes[right : right + step]
        ahead = codes[right + period : right + period + step]
        differ = np.flatnonzero(some[: len(ahead)] != ahead)
        if len(differ):
            right += int(differ[0])
            break
        right += len(ahead)
        step *= 2
    step, left = 64, start
    while left > 0:
        low = max(0, left - step)
        differ = np.flatnonzero(codes[low:left] != codes[low + period : left + period])
        if len(differ):
            left = low + int(differ[-1]) + 1
            break
        left = low
        step *= 2
    return left, right + period


def runs_of(codes: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of at least ``least`` words and ``periods`` periods."""
    n = len(codes)
    if n < least:
        return []
    up = np.cumprod(np.r_[U64(1), np.full(n - 1, _BASE)])
    down = np.cumprod(np.r_[U64(1), np.full(n - 1, _INVERSE)])
    sums = np.r_[U64(0), np.cumsum(mixed(codes, 5) * up)]
    found = set()
    for order in (codes, -codes):
        length = lyndon_lengths(order)
        at = np.flatnonzero(np.arange(n) + 2 * length <= n)
        at = at[length[at] * periods <= n]
        q = length[at]
        own, ahead = (sums[at + q] - sums[at]) * down[at], (sums[at + 2 * q] - sums[at + q]) * down[at + q]
        root = np.zeros(n, np.int64)
        agree = own == ahead
        root[at[agree]] = q[agree]
        # of roots that follow each other in one run, the first
        at = np.flatnonzero(root)
        earlier = at - root[at]
        at = at[(earlier < 0) | (root[earlier] != root[at])]
        for i in at.tolist():
            period = int(root[i])
            start, end = _extended(codes, i, period)
            if end - start >= max(least, periods * period):
                found.add((start, end - start, period))
    return sorted((s, n_words, p) for s, n_words, p in found)


def _often(*keys: np.ndarray, least: int) -> np.ndarray:
    """Whether each row's key, one or more numbers, stands in ``least`` rows."""
    key = keys[0]
    for other in keys[1:]:
        key = key * (int(other.max(initial=0)) + 1) + other
    _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    return counts[which] >= least


def _stretches(codes: np.ndarray, owner: np.ndarray, least: int, periods: int) -> list[tuple[int, int]]:
    """Stretches of the texts that runs can lie in: cut at words rarer than ``periods``
    and between neighbours that are rarer by one, again within what is left, and
    without those of under ``least`` words."""
    at, part = np.arange(len(codes)), owner
    for _ in range(ROUNDS):
        before = len(at)
        stays = _often(part, codes[at], least=periods)
        at, part = at[stays], part[stays]
        if not len(at):
            break
        tied = np.zeros(len(at), bool)  # to the word before
        near = np.flatnonzero((np.diff(at) == 1) & (np.diff(part) == 0)) + 1
        tied[near] = _often(part[near], codes[at[near] - 1], codes[at[near]], least=periods - 1)
        sizes = np.diff(np.append(np.flatnonzero(~tied), len(at)))
        part = np.repeat(np.arange(len(sizes)), sizes)
        enough = np.repeat(sizes >= least, sizes)
        at, part = at[enough], part[enough]
        if len(at) == before and tied.sum() + len(sizes) == before:
            break
    edges = starts_of(part)
    return [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(edges[:-1], edges[1:])]


def _search(least: int, periods: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", CHUNK):
            texts = [(t or b"").split() for t in utf8(batch.column("text"))]
            counts = np.array([len(t) for t in texts])
            starts = np.r_[0, np.cumsum(counts)]
            words = np.empty(starts[-1], object)
            words[:] = [w for t in texts for w in t]
            codes = pd.factorize(words)[0].astype(np.int64)
            owner = np.repeat(np.arange(len(texts)), counts)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            drops = np.zeros(starts[-1], bool)
            for low, high in _stretches(codes, owner, least, periods):
                text = int(owner[low])
                part = pd.factorize(codes[low:high])[0].astype(np.int64)
                for start, length, period in runs_of(part, least, periods):
                    runs[text].append((int(low + start - starts[text]), length, period))
                    drops[low + start + period : low + start + length] = True
            kept = []
            for i, t in enumerate(texts):
                if runs[i]:
                    dropped = drops[starts[i] : starts[i + 1]]
                    t = [w for w, gone in zip(t, dropped.tolist()) if not gone]
                kept.append(b" ".join(t))
            flat = [r for some in runs for r in some]
            offsets = np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32)
            columns = [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, ["start", "length", "period"])),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, periods: int = 4
) -> DataFrame:
    """Per row its words, its runs by start and period, and its text without repeats.

    Runs have at least ``least`` words and ``periods`` periods (three or more). The
    collapsed text lacks what runs hold after their first period.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    columns = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(_search(least, periods), columns)
