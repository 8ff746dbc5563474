"""Token counts of a piece vocabulary by byte-pair merging, without making identifiers.

Spaces become the mark U+2581 and one mark is put before the text. No piece has a mark behind another
character or holds a line break, so merging never crosses the start of a run of marks or a line break, and
the text falls into chunks whose counts add up. A chunk is a linked list of characters and a heap of
adjacent pairs; the best-ranked pair (ties: leftmost) is popped and merged until none is left. The count is
the number of symbols at first less the merges; a character without a piece counts as its UTF-8 bytes.

Defined cases: a null or empty text has no token; control strings in a text are plain characters.
"""

from __future__ import annotations

import heapq

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, functions as F

PIECES = "piece_bpe_32k.model"
MARK = "▁"
# Counts of chunks that a task remembers, and the longest chunk it remembers.
REMEMBERED = 1 << 18
SHORT = 48

_counters: dict[str, PieceCounter] = {}


class _Counts(dict):
    """Chunk counts, computed when missing; emptied when full."""

    def __init__(self, counter: PieceCounter, before: str):
        super().__init__()
        self.counter, self.before = counter, before

    def __missing__(self, word: str) -> int:
        n = self.counter.chunk(self.before + word)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


class PieceCounter:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cost: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if model.is_unused(i):
                raise ValueError("vocabularies with unused pieces need re-segmentation, which is not built")
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                self.cost[model.id_to_piece(i)] = -model.get_score(i)
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.cost):
            raise ValueError("pieces that cross a word or line start cannot be counted by chunk")
        self.marked = _Counts(self, MARK)
        self.bare = _Counts(self, "")

    def chunk(self, text: str) -> int:
        cost = self.cost
        symbols: list[str] = list(text)
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in cost:
                heap.append((cost[pair], i, i + 1, pair))
        merges = 0
        if heap:
            heapq.heapify(heap)
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
            while heap:
                _, left, right, pair = heapq.heappop(heap)
                # A merge of either side since then has changed its length or emptied it.
                if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(pair):
                    continue
                symbols[left], symbols[right] = pair, ""
                merges += 1
                nxt = after[right]
                after[left] = nxt
                if nxt < n:
                    before[nxt] = left
                    joined = pair + symbols[nxt]
                    if joined in cost:
                        heapq.heappush(heap, (cost[joined], left, nxt, joined))
                prv = before[left]
                if prv >= 0:
                    joined = symbols[prv] + pair
                    if joined in cost:
                        heapq.heappush(heap, (cost[joined], prv, left, joined))
        unknown = sum(len(s.encode("utf-8")) - 1 for s in symbols if len(s) == 1 and s not in cost)
        return n - merges + unknown

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        for i, line in enumerate(text.replace(MARK, " ").split("\n")):
            words = line.split(" ")
            if i:
                total += 1
                first, rest = words[0], words[1:]
                total += self.bare[first] if first else 0
            else:
                rest = words
            if "" not in rest:
                total += sum(map(self.marked.__getitem__, rest))
                continue
            marks = 0
            for word in rest:
                marks += 1
                if word:
                    total += self.marked[word] if marks == 1 else self.chunk(MARK * marks + word)
                    marks = 0
            total += self.chunk(MARK * marks) if marks else 0
        return total


def token_count(text: Column, path: str | None = None) -> Column:
    """Number of tokens of a text column under the piece vocabulary at ``path``."""
    path = path or public_tokenizers.path(PIECES)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        if path not in _counters:
            _counters[path] = PieceCounter(path)
        return texts.map(_counters[path].text).astype("int64")

    return count(F.coalesce(text, F.lit("")))
