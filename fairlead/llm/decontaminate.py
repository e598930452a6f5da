"""Benchmark decontamination: a BM25 inverted index of the test items, asked with every passage of every document by block-max WAND.

The index is of the benchmark, which is counted: up to ITEMS items form one index, sent to the executors; a larger benchmark takes
several, one after the other. Impacts are divided by the item's score against itself, so that a score is the share
of an item that the passage covers and one threshold suits all items. Passages are windows that overlap by half and are twice as
long as the longest item, so that every stretch as long as any item lies whole in one of them.

Items are ordered so that like ones (by their commonest word, then length) are neighbours, and postings are cut into blocks by ranges
of BLOCK items. The sum of the passage's terms' largest impacts in a block bounds what any item of it can score; it is computed for
all blocks at once. WAND then runs in the blocks whose bound reaches the threshold, which is nearly nowhere. What is retrieved is verified on the wording: the item's question, and its answer if it has one, must each share at least `overlap` of
their shingles of five words with the passage.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, small_batches, stored

#: Items in one index (each some hundred words at most: some MB), BM25's constants, and postings in a block.
ITEMS, K1, B, BLOCK = 20_000, 1.2, 0.75, 4
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.8, 5
#: Up to so many cells the block bounds are a table; above, they are summed from lists.
CELLS = 4_000_000
_ANSWER = re.compile(r"(?is)^(.+?)\s(?:answer|a)\s*:\s*(\S.*)$")


def words_of(text: str | None) -> list[str]:
    """Lower-case words without ASCII punctuation around them; words of nothing else don't count."""
    return [c for w in (text or "").lower().split() if (c := w.strip(string.punctuation))]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The parts before and after "Answer:" or "A:"; without it all is the question."""
    m = _ANSWER.match(text)
    return (words_of(m[1]), words_of(m[2])) if m else (words_of(text), [])


def shingles(terms: list[int], n: int) -> set[tuple[int, ...]]:
    return {tuple(terms[i : i + n]) for i in range(len(terms) - n + 1)}


class Index:
    """Postings by term (items ascending, with impacts) and the largest impact in each block of items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        parts = [(i, *question_and_answer(t or "")) for i, t in items]
        common = Counter(w for _, q, a in parts for w in {*q, *a})
        parts = sorted((p for p in parts if p[1]), key=lambda p: (max(p[1] + p[2], key=lambda w: (common[w], w)), len(p[1]) + len(p[2]), p[0] is not None, p[0] or 0, p[1:]))
        self.ids = [p[0] for p in parts]
        self.vocabulary: dict[str, int] = {}
        term = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary))
        self.parts = [([term(w) for w in q], [term(w) for w in a]) for _, q, a in parts]
        self.longest = max((len(q) + len(a) for q, a in self.parts), default=0)
        counts = [Counter(q + a) for q, a in self.parts]
        frequency = Counter(t for c in counts for t in c)
        mean, n = (sum(c.total() for c in counts) / len(counts) if counts else 1), len(counts)
        self.items: list[list[int]] = [[] for _ in self.vocabulary]
        self.impacts: list[list[float]] = [[] for _ in self.vocabulary]
        for i, c in enumerate(counts):
            size = c.total()
            raw = {t: math.log(1 + (n - frequency[t] + 0.5) / (frequency[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean)) for t, f in c.items()}
            own = sum(raw.values())
            for t, x in raw.items():
                self.items[t].append(i)
                self.impacts[t].append(x / own)
        self.n_blocks = -(-n // BLOCK)
        self.block_ids, self.block_max = [], []
        for t, at in enumerate(self.items):
            blocks = np.array(at) // BLOCK
            starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
            self.block_ids.append(blocks[starts])
            self.block_max.append(np.maximum.reduceat(np.array(self.impacts[t]), starts))
        self.table = None
        if len(self.vocabulary) * self.n_blocks <= CELLS:
            self.table = np.zeros((len(self.vocabulary), self.n_blocks), np.float32)
            for t, (at, x) in enumerate(zip(self.block_ids, self.block_max)):
                self.table[t, at] = x
        self.wanted = [[(shingles(p, min(SHINGLE, len(p))), min(SHINGLE, len(p))) for p in qa if p] for qa in self.parts]

    def live(self, terms: np.ndarray, threshold: float) -> list[int]:
        """Blocks in which the terms' largest impacts add up to the threshold."""
        if self.table is not None:
            bounds = self.table[terms].sum(axis=0)
        else:
            bounds = np.bincount(np.concatenate([self.block_ids[t] for t in terms]), np.concatenate([self.block_max[t] for t in terms]), self.n_blocks)
        return np.flatnonzero(bounds >= threshold - 1e-5).tolist()

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items whose score reaches the threshold, by block-max WAND (Ding and Suel 2011)."""
        out = []
        for block in self.live(terms, threshold) if len(terms) else ():
            low, high, cursors = block * BLOCK, block * BLOCK + BLOCK, []
            for t in terms.tolist():
                items = self.items[t]
                at = bisect_left(items, low)
                if at < len(items) and items[at] < high:
                    cursors.append([items[at], at, t, float(self.block_max[t][bisect_left(self.block_ids[t], block)])])
            while cursors:
                cursors.sort()
                bound, pivot = 0.0, None
                for c in cursors:
                    bound += c[3]
                    if bound >= threshold - 1e-9:
                        pivot = c[0]
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    score = sum(self.impacts[t][at] for i, at, t, _ in cursors if i == pivot)
                    if score >= threshold - 1e-9:
                        out.append((pivot, score))
                target = pivot + (cursors[0][0] == pivot)
                for c in cursors:
                    if c[0] < target:
                        items = self.items[c[2]]
                        c[1] = bisect_left(items, target, c[1])
                        c[0] = items[c[1]] if c[1] < len(items) else high
                cursors = [c for c in cursors if c[0] < high]
        return out

    def overlaps(self, item: int, passage: list[int]) -> list[float]:
        """For the item's question, and its answer if any, the share of its shingles that are in the passage."""
        by_size = {n: shingles(passage, n) for _, n in self.wanted[item]}
        return [len(s & by_size[n]) / len(s) for s, n in self.wanted[item]]


class Terms(dict):
    """Words as they stand in texts -> term of the index, or -1; -2 for what is no word at all."""

    def __init__(self, vocabulary: dict[str, int], most: int = 250_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most

    def __missing__(self, word: str) -> int:
        core = word.strip(string.punctuation)
        got = self.vocabulary.get(core, -1) if core else -2
        if len(self) < self.most or got >= 0:
            self[word] = got
        return got


def leaks(index: Index, terms: Terms, text: str | None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, float, float, float]]:
    """(item, score, question overlap, answer overlap or 1) of the items that a whole text holds; of each its best passage."""
    words = (text or "").lower().split()
    if not words or not index.ids:
        return []
    found = np.fromiter(map(terms.__getitem__, words), np.int32, len(words))
    found = found[found > -2]
    step = max(32, index.longest)
    best: dict[int, tuple] = {}
    for start in range(0, max(1, len(found) - step), step):
        passage = found[start : start + 2 * step]
        distinct = np.unique(passage)
        for item, score in index.search(distinct[np.searchsorted(distinct, 0) :], threshold):
            shares = index.overlaps(item, passage.tolist())
            if min(shares) >= overlap:
                got = (item, float(score), shares[0], shares[1] if len(shares) > 1 else 1.0)
                best[item] = max(best.get(item, got), got, key=lambda g: g[1])
    return [best[i] for i in sorted(best)]


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The benchmark in indexes of ITEMS items or so, made one after the other; items without words are in none."""
    parts = max(1, math.ceil(benchmark.count() / ITEMS))
    part = F.pmod(F.xxhash64(id_col, text_col), F.lit(parts))
    for p in range(parts):
        yield Index([(r["i"], r["t"] or "") for r in benchmark.filter(part == p).select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): every item that a document holds, once for each row of docs.

    Null and empty texts hold none, whatever their length texts are searched whole, and a null doc_id is reported as null. An item
    with a null item_id is an item like others, reported with a null item_id; items that are null, empty or without words are
    found nowhere. Repeated items are found each, and items with equal scores all. Of an item's several places in a document the
    best-scoring one is told, the first of equals. An empty benchmark finds none, and no documents give no rows. Columns other than
    doc_id and text are not looked at. A benchmark of several indexes is searched with one after the other, each result stored."""
    base, found, last = docs.select("doc_id", "text"), [], None

    def searched(index: Index) -> DataFrame:
        def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            terms = Terms(index.vocabulary)
            for b in batches:
                rows = [(i, index.ids[g[0]], *g[1:]) for i, t in zip(b["doc_id"], b["text"]) for g in leaks(index, terms, t, threshold, overlap)]
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        return mapped(base, f, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")

    for index in indexes(benchmark):
        if last is not None:
            found.append(stored(last, "leaks"))  # the index before isn't needed any more
        last = searched(index)
    return reduce(DataFrame.unionByName, [*found, last])


def _clean(index: Index, threshold: float, overlap: float):
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms(index.vocabulary)
        for texts in batches:
            yield pd.Series([not leaks(index, terms, t, threshold, overlap) for t in texts], dtype=bool)

    return clean


def drop_leaking(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """docs without the rows whose text holds a test item (see find_leaks); all columns and other rows stay as they are. Each row is
    judged by its own text, so null and repeated ids make no difference. With several indexes, what one leaves is stored."""
    small_batches(docs.sparkSession)
    for n, index in enumerate(indexes(benchmark)):
        docs = (stored(docs, "not-leaking") if n else docs).filter(_clean(index, threshold, overlap)("text"))
    return docs
