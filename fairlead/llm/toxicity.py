"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

The kernel of two words sums, over all subsequences of three characters that both hold, with gaps, a decay to the power of the
lengths they span; it is normalised to 1 for equal words. An insult with characters put in, or with a changed ending, keeps most
of its subsequences, so it stays near the plain insult.

Labels are for documents, but an insult is a word in one of their sentences (multiple-instance learning): no word of a clean
document is an insult, some word of a toxic one is. The first witnesses are words holding a character run that occurs in toxic
documents and (nearly) never in clean ones; later rounds add each toxic document's highest-scoring words, and from clean documents
the highest-scoring words as negatives. Landmarks are witnesses far from each other, and ordinary words.

The decision function is a weighted sum of kernels with the landmarks, and so, exactly, a sum over a word's own subsequences of
one weight for each triple of characters. That table is what is sent to the executors; its size depends on the alphabet alone.
A document's score comes from the margins of its most toxic distinct words, over the whole text, and how many distinct words it
has (the more, the likelier a chance likeness), by a logistic model fitted on documents that the machine was not trained on.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import nlargest

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, kept_for, mapped, small_batches

#: Bounds of the training sample: documents of each label, landmarks, negatives in the first round and added in a later one.
PER_LABEL, LANDMARKS, NEGATIVES, HARD = 2000, 96, 12_000, 3_000
DECAY, LONGEST, ALPHABET = 0.5, 24, 64
#: Codes that all characters share which are not among the commonest of the training sample, by a hash of the code point.
SHARED = 12
#: Words that are worked on at once: norms take some 15 kB for each of the longest.
PIECES = 3_000
#: How many of a document's words its score rests on.
TOP = 4
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Three or more single characters in a row, as when an insult is spelled out.
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def trimmed(word: str) -> str:
    return word if word[:1].isalnum() and word[-1:].isalnum() else _EDGE.sub("", word)


def units(text: str | None) -> set[str]:
    """The distinct lower-case words of a whole text, and spelled-out words put together; empty for null or blank texts."""
    if not text:
        return set()
    low = text.lower()
    out = set(low.split())
    out.update("".join(m[0].split()) for m in _SPELLED.finditer(low))
    return out


@lru_cache(maxsize=4)
def _codes(alphabet: str) -> np.ndarray:
    """The code (below ALPHABET) of every code point: one of its own for the alphabet's first characters, else a shared one."""
    own = ("^$" + alphabet.replace("^", "").replace("$", ""))[: ALPHABET - SHARED]
    table = (ALPHABET - SHARED + (np.arange(sys.maxunicode + 1, dtype=np.uint64) * np.uint64(2654435761) >> np.uint64(16)) % np.uint64(SHARED)).astype(np.uint8)
    table[[ord(c) for c in own]] = np.arange(len(own))
    return table


class Kernel:
    """Words as rows of character codes, by length, and sums over their subsequences. Characters of all scripts have a code; words
    are told apart by code points where norms are computed, by codes where weights are summed."""

    def __init__(self, alphabet: str):
        self.table = _codes(alphabet)

    def rows(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(indices of words, code points, codes) of equal length each; words longer than LONGEST come as overlapping pieces."""
        by: dict[int, tuple[list[int], list[str]]] = {}
        for i, w in enumerate(words):
            w = f"^{trimmed(w)}$"  # a word's start and end are characters of their own
            starts = range(0, max(1, len(w) - LONGEST + LONGEST // 2), LONGEST // 2) if len(w) > LONGEST else (0,)
            for s in starts:
                part = w[s : s + LONGEST]
                if len(part) >= 4:
                    at, parts = by.setdefault(len(part), ([], []))
                    at.append(i)
                    parts.append(part)
        for n, (at, parts) in by.items():
            for k in range(0, len(parts), PIECES):
                points = np.array(parts[k : k + PIECES], f"<U{n}").view(np.uint32).reshape(-1, n)
                yield np.array(at[k : k + PIECES]), points, self.table[points].astype(np.int64)

    def sums(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of weights[triple] * DECAY ** span over all subsequences of each row."""
        n, out, flat = codes.shape[1], np.zeros(len(codes)), weights.ravel()
        for i in range(n - 2):
            for j in range(i + 1, n - 1):
                head = (codes[:, i] * ALPHABET + codes[:, j]) * ALPHABET
                for k in range(j + 1, n):
                    out += DECAY ** (k - i + 1) * flat[head + codes[:, k]]
        return out

    def norms(self, points: np.ndarray) -> np.ndarray:
        """The kernel of each row with itself, by the recursion over prefixes (Lodhi et al. 2002), all rows at once."""
        m, n = points.shape
        same = points[:, :, None] == points[:, None, :]
        before = np.ones((m, n + 1, n + 1))
        for _ in range(2):
            now = np.zeros((m, n + 1, n + 1))
            for a in range(1, n + 1):
                run = np.zeros(m)
                for b in range(1, n + 1):
                    run = DECAY * run + DECAY**2 * same[:, a - 1, b - 1] * before[:, a - 1, b - 1]
                    now[:, a, b] = DECAY * now[:, a - 1, b] + run
            before = now
        return DECAY**2 * (same * before[:, :n, :n]).sum(axis=(1, 2))

    def triples(self, word: str) -> np.ndarray:
        """The weights whose sums() are kernels with this word, normalised by its own norm."""
        out = np.zeros((ALPHABET,) * 3)
        for _, points, codes in self.rows([word]):
            c, n = codes[0], codes.shape[1]
            for i in range(n - 2):
                for j in range(i + 1, n - 1):
                    for k in range(j + 1, n):
                        out[c[i], c[j], c[k]] += DECAY ** (k - i + 1)
            return out / np.sqrt(self.norms(points[:1])[0])
        return out

    def with_all(self, words: list[str], landmarks: list[str]) -> np.ndarray:
        """Normalised kernels, words by landmarks; of a long word's pieces the largest."""
        out = np.zeros((len(words), len(landmarks)), np.float32)
        rows = [(at, codes, np.sqrt(self.norms(points))) for at, points, codes in self.rows(words)]
        for z, landmark in enumerate(landmarks):
            table = self.triples(landmark)
            for at, codes, root in rows:
                np.maximum.at(out[:, z], at, self.sums(codes, table) / root)
        return out


class Model:
    """alphabet, weights for triples, bias, and the weights of the logistic model over features()."""

    def __init__(self, alphabet: str, weights: np.ndarray, bias: float, logistic: np.ndarray | None = None):
        self.alphabet, self.weights, self.bias, self.logistic = alphabet, weights.astype(np.float32), bias, logistic

    def margins(self, words: list[str]) -> np.ndarray:
        kernel, out = Kernel(self.alphabet), np.full(len(words), self.bias)
        best = np.full(len(words), -np.inf)
        for at, points, codes in kernel.rows(words):
            np.maximum.at(best, at, kernel.sums(codes, self.weights) / np.sqrt(kernel.norms(points)))
        return np.where(np.isfinite(best), out + best, out)

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.logistic, -40, 40)))


class Scorer:
    """Scores whole texts; remembers words' margins, and forgets them all when they are too many."""

    def __init__(self, model: Model, most: int = 350_000):
        self.model, self.most, self.known = model, most, {}

    def features(self, bags: list[set[str]]) -> np.ndarray:
        """For each bag the TOP largest margins (not below -1), the logarithm of its size, and 1."""
        known, out = self.known, np.full((len(bags), TOP + 2), -1.0)
        new = list({w for bag in bags for w in bag if w not in known})
        if len(known) + len(new) > self.most:
            known.clear()
            new = list(set().union(*bags))
        known.update(zip(new, self.model.margins(new).tolist()))
        for row, bag in zip(out, bags):
            best = nlargest(TOP, map(known.__getitem__, {trimmed(w): w for w in bag if known[w] > -1}.values()))
            row[: len(best)] = best
            row[TOP:] = np.log1p(len(bag)), 1
        return out

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        texts, out = list(texts), []
        for k in range(0, len(texts), 500):
            out.append(self.features([units(t) for t in texts[k : k + 500]]))
        return self.model.probability(np.concatenate(out)) if out else np.empty(0)


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-3, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated gradient descent."""
    a = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    cost = cost / cost.sum()
    step = 1 / (2 * np.linalg.eigvalsh((a * cost[:, None]).T @ a)[-1] + ridge)
    w = v = np.zeros(a.shape[1])
    for n in range(rounds):
        slack = np.maximum(0, 1 - y * (a @ v))
        grad = -2 * a.T @ (cost * y * slack) + ridge * np.append(v[:-1], 0)
        w, old = v - step * grad, w
        v = w + n / (n + 3) * (w - old)
    return w[:-1], float(w[-1])


def _witnesses(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """Words of toxic documents that hold a run of 3 to 6 characters (word ends among them) speaking for toxicity, and that are
    themselves much more frequent there; with the number of documents they come from."""

    def cut(w: str) -> set[str]:
        w = f"^{trimmed(w)[:LONGEST]}$"
        return {w[i : i + n] for n in range(3, 7) for i in range(len(w) - n + 1)} | {w}

    def cuts(bag: set[str]) -> set[str]:
        return set().union(*map(cut, bag))

    # Runs in fewer toxic documents than `least` are ruled out by counts in hashed cells first, which keeps the tables small.
    least = max(3, len(toxic) // 200)
    cells = np.zeros(1 << 22, np.int32)
    for bag in toxic:
        cells[np.unique(np.fromiter(map(hash, cuts(bag)), np.int64) & (len(cells) - 1))] += 1
    t = Counter(r for bag in toxic for r in cuts(bag) if cells[hash(r) & (len(cells) - 1)] >= least)
    t = Counter({r: n for r, n in t.items() if n >= least})
    c = Counter(r for bag in clean for r in cuts(bag) & t.keys())
    whole = Counter(w for bag in clean for w in {trimmed(u)[:LONGEST] for u in bag})
    seen = Counter(w for bag in toxic for w in {trimmed(u)[:LONGEST] for u in bag})
    odds = lambda a, b: np.log((a + 0.5) / len(toxic)) - np.log((b + 0.5) / len(clean))
    value = {r: v + 0.1 * len(r) for r, n in t.items() if (v := odds(n, c[r])) > np.log(8)}
    out: Counter = Counter()
    for bag in toxic:
        best = sorted(((max(map(value.get, cut(w) & value.keys()), default=0), w) for w in {trimmed(u) for u in bag}), reverse=True)[:4]
        out.update(w for v, w in best if v > 0 and odds(seen[w[:LONGEST]], whole[w[:LONGEST]]) > np.log(4))
    return dict(out)


def fit(toxic: list[set[str]], clean: list[set[str]], seed: int = 7, rounds: int = 3) -> Model:
    """A model from bags of words of toxic and clean documents; each fourth of either is kept for the logistic model. With too few
    documents of a label to learn from, one that scores all alike, by the share of toxic ones but below one half: a machine that
    has learnt nothing calls nothing toxic."""
    parts = [([b for i, b in enumerate(x) if i % 4 != 3], x[3::4]) for x in (toxic, clean)]
    (toxic, toxic_cal), (clean, clean_cal) = parts
    good = _witnesses(toxic, clean) if toxic_cal and clean_cal else {}
    if not good:
        p = min(0.45, (len(toxic) + 0.5) / (len(toxic) + len(clean) + 1))
        return Model("a", np.zeros((ALPHABET,) * 3), 0.0, np.append(np.zeros(TOP + 1), np.log(p / (1 - p))))
    rng = np.random.default_rng(seed)
    alphabet = "".join(c for c, _ in sorted(Counter("".join(w for bag in (*toxic, *clean) for w in bag)).items(), key=lambda x: (-x[1], x[0])) if not c.isspace())
    kernel, often = Kernel(alphabet), Counter(w for bag in clean for w in {trimmed(u) for u in bag})
    ordinary = sorted(often)
    bad = {ordinary[i] for i in rng.choice(len(ordinary), min(NEGATIVES, len(ordinary)), replace=False)}

    # Landmarks: the heaviest witness first, then always the one least like those chosen; for the rest ordinary words.
    pool = [w for w, _ in sorted(good.items(), key=lambda x: (-x[1], x[0]))][:400]
    like, chosen = kernel.with_all(pool, pool), []
    near = np.zeros(len(pool))
    for _ in range(min(2 * LANDMARKS // 3, len(pool))):
        chosen.append(at := int(np.argmin(near)))
        near = np.maximum(near, like[:, at])
        near[at] = 2
    marks = [pool[i] for i in chosen]
    marks += [w for w in sorted(bad) if len(w) > 4][:: max(1, len(bad) // (LANDMARKS - len(marks)))][: LANDMARKS - len(marks)]
    marks = sorted(dict.fromkeys(marks))
    values, vectors = np.linalg.eigh(kernel.with_all(marks, marks).astype(np.float64))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T

    seen: dict[str, np.ndarray] = {}
    for n in range(rounds):
        positive, negative = sorted(good), sorted(bad)
        if missing := sorted({*positive, *negative} - seen.keys()):
            seen.update(zip(missing, kernel.with_all(missing, marks)))
        x = np.stack([seen[w] for w in (*positive, *negative)]) @ root
        y = np.repeat([1.0, -1.0], [len(positive), len(negative)])
        cost = np.array([min(good[w], 50.0) for w in positive] + [min(often[w], 50.0) ** 0.5 for w in negative])
        cost[y > 0] *= 0.5 * cost[y < 0].sum() / cost[y > 0].sum()
        w, bias = _svm(x, y, cost)
        model = Model(alphabet, sum(c * kernel.triples(z) for c, z in zip(root @ w, marks)), bias)
        bad |= {ordinary[i] for i in np.argsort(-model.margins(ordinary))[:HARD]}
    scorer = Scorer(model)
    x, y = scorer.features([*toxic_cal, *clean_cal]), np.repeat([1.0, 0.0], [len(toxic_cal), len(clean_cal)])
    model.logistic = _logistic(x, y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights of a logistic model by Newton steps; the last column is the constant, which the ridge leaves alone."""
    w, pull = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        w = w - np.linalg.solve(hess, x.T @ (p - y) + pull * w)
    return w


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, seed: int = 7) -> Model:
    """A model from labelled documents outside the held-out fold, at most per_label of each label, chosen by a hash of the id.

    A document counts as toxic if any of its label rows says so; null labels and labels without a document don't count. Rows with
    a labelled id all count, each with its own text. No labels, or too few of one kind: see fit(). Texts of the sample are cut into
    words where they lie, and the distinct words alone reach the driver."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(seed))
    sample = known.filter("toxic = 1").orderBy(order).limit(per_label).unionByName(known.filter("toxic = 0").orderBy(order).limit(per_label))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"], "words": [sorted(units(t)) for t in b["text"]]})

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    bags: tuple[list, list] = [], []
    for r in mapped(texts, f, "toxic int, words array<string>").toLocalIterator():
        bags[r["toxic"]].append(tuple(map(sys.intern, r["words"])))
    clean, toxic = (list(map(set, sorted(x))) for x in bags)
    return fit(toxic, clean, seed)


def _column(model: Model):
    @F.pandas_udf("double")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept_for("")
        scorer = Scorer(model)
        try:
            for texts in batches:
                yield pd.Series(scorer.scores(texts))
        finally:
            del scorer
            give_back()

    return column


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with `score` (0 to 1) and `predicted` (1 from 0.5): null, empty and blank texts get the score of a text without any
    word, which is low. Other columns stay; such named score or predicted are replaced. Rows are scored one by one, in place, so
    equal texts score alike whatever their ids; no rows in, no rows out."""

    small_batches(docs.sparkSession)
    return docs.withColumn("score", _column(model)(F.col(text_col))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that score() predicts 0 for, unchanged."""
    small_batches(docs.sparkSession)
    return docs.filter(_column(model)(F.col(text_col)) < 0.5)
