"""Token counts by byte-pair merging, without making any token.

Every text is cut where no merge can reach across, each distinct stretch is merged
with a heap over a linked list, and the count is what it began with less its
merges. A vocabulary's merges never reach across a cut that no piece spans, which
is read off the vocabulary itself. Words are remembered in a table of bounded size by
each worker, so frequent words are merged once.

Results for unusual input: null and empty texts have 0 tokens; very long texts are
counted whole; rows repeat as they come; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Space as the vocabulary writes it.
MARK = "▁"
#: Distinct words a worker remembers; beyond that it starts afresh.
REMEMBERED = 1_000_000


class PieceCounter:
    """Counts as a byte-fallback BPE piece model does, with a space put in front."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        }
        longer = [p for p in score if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("a piece spans the end of a word; texts cannot be cut at spaces")
        self.joins_lines = any("\n" in p for p in longer)
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        number = {p: i for i, p in enumerate(score)}
        self.single = {p: i for p, i in number.items() if len(p) == 1}
        #: Two neighbours' numbers to the rank of their merge and its number.
        self.pairs = {
            number[p[:k]] << 20 | number[p[k:]]: order[score[p]] << 20 | number[p]
            for p in longer
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        }
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        known = self.known
        words = text.replace(MARK, " ").split(" ")
        if "" in words:  # runs of spaces
            return self._spaced(words)
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            new = set(words).difference(known)
            if len(known) > REMEMBERED:
                known.clear()
                new = set(words)
            for word in new:
                known[word] = self._stretch(MARK + word)
            return sum(map(known.__getitem__, words))

    def _spaced(self, words: list[str]) -> int:
        total, spaces, last = 0, 1, len(words) - 1
        for i, word in enumerate(words):
            if word or i == last:
                total += self._stretch(MARK * spaces + word)
                spaces = 1
            else:
                spaces += 1
        return total

    def _stretch(self, text: str) -> int:
        if self.joins_lines or "\n" not in text:
            return self.merged(text)
        lines = text.split("\n")
        return sum(map(self.merged, lines)) + len(lines) - 1  # a line feed is one symbol or one byte

    def merged(self, text: str) -> int:
        """Tokens left when the lowest-ranked adjacent pair is merged until none is.

        A symbol outside the vocabulary joins no merge and counts its bytes.
        """
        n = len(text)
        pairs, single = self.pairs, self.single
        symbols = [single.get(c, -1) for c in text]
        extra = sum(len(c.encode()) - 1 for c in text if c not in single) if -1 in symbols else 0
        heap = []
        for i in range(n - 1):
            if (merge := pairs.get(symbols[i] << 20 | symbols[i + 1])) is not None:
                heap.append(merge >> 20 << 40 | i)
        if not heap:
            return n + extra
        heapq.heapify(heap)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        count = n
        while heap:
            entry = heappop(heap)
            left = entry & 0xFFFFFFFFFF
            right = after[left]
            if right < 0 or (merge := pairs.get(symbols[left] << 20 | symbols[right])) is None or merge >> 20 != entry >> 40:
                continue  # one of the two has merged since
            count -= 1
            symbols[left] = here = merge & 0xFFFFF
            symbols[right] = -1
            following = after[left] = after[right]
            after[right] = -1
            if following >= 0:
                before[following] = left
                if (merge := pairs.get(here << 20 | symbols[following])) is not None:
                    heappush(heap, merge >> 20 << 40 | left)
            ahead = before[left]
            if ahead >= 0 and (merge := pairs.get(symbols[ahead] << 20 | here)) is not None:
                heappush(heap, merge >> 20 << 40 | ahead)
        return count + extra


@lru_cache(maxsize=1)
def _counter(model: str) -> PieceCounter:
    """One counter for all tasks of a worker, with the words it has seen."""
    return PieceCounter(public_tokenizers.path(model))


def _counts(model: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_tokens = pa.array([counter.count(t) if t else 0 for t in texts], pa.int64())
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = "piece_bpe_32k.model",
    limit: int = 4096,
) -> DataFrame:
    """Per document its bytes, its tokens, and whether these exceed ``limit``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    counted = rows.mapInArrow(_counts(model), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
