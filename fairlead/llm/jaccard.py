"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

Two documents with at least the wanted Jaccard likeness share at least T shingles, so each is found in at least T of the other's
inverted lists. DivideSkip sets the longest lists aside, merges the short ones for documents on at least T less the number set
aside, and looks those up in the long lists by binary search.

One index over all documents would have to be everywhere. Blocks of it are made instead, so that any two documents that may be
linked share a block. Documents with equal shingle sets are first put together. For the rest, in any one order of all shingles, two
linked sets share one of their first |X| - T + 1 (prefix filter, Chaudhuri et al. 2006). The order puts shingles below a hash limit
first, the rarest before the others, as counted over the whole corpus; the rest follow by hash. So only a sample of the shingles is
shuffled and counted, somewhat more than prefixes are long, and a document with enough shingles of its own has nothing but those in
its prefix and is done. Documents that share a shingle in their prefixes are in the block named by the smallest of them. Copies
within a batch are dropped before the shuffle. Blocks too big for a task are cut into chunks, and each pair of chunks is one task.

Before whole sets are sent to a block, small sketches are: numbers of shingles by hash cell, four to a cell. The differences of two
sketches add up to no more than what the sets differ in, so pairs that differ too much can't be linked; a block falls apart into
groups joined by pairs that may be, and documents alone in theirs are done.

In a block, documents already known to be connected are not compared again: the result is components, and links that make them.
"""

from __future__ import annotations

import itertools
import math
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from heapq import merge

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, by_group, mapped, mixed, partitions, shingle_hashes, stored, word_hashes
from .graph import components

#: Shingles in a block, about; a block with more is cut into chunks of half as many.
BLOCK_SHINGLES = 250_000
#: Shingles in more sets than this count as equally frequent.
MOST_COUNTED = 1_000
#: Documents in a block whose sketches are compared at once.
BLOCK_DOCS = 2_000
#: List entries up to which short lists are merged by a heap; more are merged by sorting them at once.
MERGED = 4096


def shingle_sets(texts: Iterable[str | None], n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each whole text, ASCII letters lower-cased. With fewer words (but one at
    least), the whole sequence as one; without words, none."""
    every, ends = word_hashes(texts, lower=True)
    grams = shingle_hashes(every, n)  # of all texts at once; those that go beyond a text's end are left out
    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield np.unique(grams[i : j - n + 1] if j - i >= n else shingle_hashes(every[i:j], j - i) + np.uint64(j - i) if j > i else every[:0])


def _salted(s: np.ndarray, salt: int) -> int:
    with np.errstate(over="ignore"):
        return int(np.add.reduce(mixed(s + np.uint64(salt)))) & (2**64 - 1)


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


class Prefixes:
    """Which shingles of a set come first. Likeness is num / den; shingles below `limit` are counted."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.limit = min(2**64 - 1, 2**64 * 3 * (den - num) // (2 * den))

    def length(self, size: int) -> int:
        return size - -(-self.num * size // self.den) + 1

    def first(self, s: np.ndarray) -> np.ndarray:
        """Of a sorted set, those that are counted, and further ones if that is less than a prefix."""
        return s[: max(self.counted(s), self.length(len(s)))]

    def counted(self, s: np.ndarray) -> int:
        return int(np.searchsorted(s, np.uint64(self.limit)))

    def shared(self, size: int, counted: int, found: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """Places in `found` (shingles of first() that other sets hold too, each in `sets` sets) that are in the set's prefix."""
        low = found < np.uint64(self.limit)
        room = self.length(size) - (counted - int(low.sum()))  # what no other set has comes first
        places = np.flatnonzero(low)
        order = places[np.lexsort((found[places], sets[places]))]
        return np.concatenate([order[: max(0, room)], np.flatnonzero(~low)])


def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows sorted by sign and h1: (h1, sign, sets) of signs in several sets, with their number (MOST_COUNTED at most). State
    between batches is one sign's rows, up to that many."""
    held, hot = None, None  # rows of the last sign so far; a sign that is known to be in more sets
    for b in itertools.chain(batches, [None]):
        last = b is None
        b = held if last else b if held is None else pd.concat([held, b], ignore_index=True)
        held = None
        if b is None or not len(b):
            continue
        b = b[~b.duplicated()]
        x, out = b["sign"].to_numpy(), []
        if hot is not None:
            n = int(np.searchsorted(x, hot, side="right"))
            out.append(b[:n].assign(sets=MOST_COUNTED))
            b, x = b[n:], x[n:]
            hot = None if len(b) or last else hot
        if len(b):
            starts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            size = np.diff(np.append(starts, len(x)))
            if not last:
                if size[-1] > MOST_COUNTED:
                    hot = x[-1]
                else:
                    held = b[starts[-1] :]
                    b, size = b[: starts[-1]], size[:-1]
            each = np.repeat(np.minimum(size, MOST_COUNTED), size)
            out.append(b.assign(sets=each)[each > 1])
        out = pd.concat(out) if out else None
        if out is not None and len(out):
            yield out[["h1", "sign", "sets"]]


def sketch(s: np.ndarray) -> bytes:
    """How many shingles fall into each of a power of two of hash cells (255 at most), about four to a cell. Cells are by leading
    bits, so that neighbouring cells make the cell of a sketch half as long."""
    cells = 1 << max(4, (len(s) // 4).bit_length() - 1)
    at = (mixed(s) >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=cells), 255).astype(np.uint8).tobytes()


def feasible_groups(sizes: np.ndarray, sketches: list[bytes], num: int, den: int) -> np.ndarray:
    """A label for each set: sets joined by pairs that their sizes and sketches allow to be linked have the same one."""
    order = np.argsort(sizes, kind="stable")
    label = np.arange(len(sizes))
    lengths = np.array([len(x) for x in sketches])
    for cells in np.unique(lengths):
        mine = order[(lengths[order] == cells) | (lengths[order] == 2 * cells)]  # linked sets' cells differ by a factor of two at most
        rows = np.stack([np.frombuffer(sketches[i], np.uint8).reshape(cells, -1).sum(axis=1, dtype=np.int16) for i in mine])
        n = sizes[mine]
        low = np.searchsorted(n, -(-num * n // den))
        for k in range(1, len(mine)):
            if low[k] < k:
                differ = np.abs(rows[low[k] : k] - rows[k]).sum(axis=1, dtype=np.int64)
                near = mine[low[k] : k][differ <= (n[low[k] : k] + n[k]) * (den - num) // (den + num)]
                old = np.unique(label[near])
                if len(old) and (len(old) > 1 or old[0] != label[mine[k]]):
                    label[np.isin(label, old) | (label == label[mine[k]])] = old[0]
    return label


def link_block(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links of sets with den * |both| >= num * |either| that connect whatever such links connect, by T-occurrence search."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    lists: dict[int, array] = {}  # shingle -> places in `order` of indexed sets that have it, ascending
    links = []
    for place, i in enumerate(order):
        s = sets[i].tolist()
        n = len(s)
        least = -(-num * n // den)  # a smaller partner shares at least num / den of the larger set
        own = sorted((lists[x] for x in s if x in lists), key=len)
        if n and len(own) >= least:
            # DivideSkip: the longest lists are set aside, as many as its estimate says and more while merging is dear.
            aside = min(least - 1, int(least / (0.05 * math.log2(len(own[-1]) + 1) + 1)))
            volume = sum(map(len, own[: len(own) - aside]))
            while volume > MERGED and aside < least - 1:
                aside += 1
                volume -= len(own[len(own) - aside])
            short, long = own[: len(own) - aside], own[len(own) - aside :]
            need = least - aside
            hits: list[tuple[int, int]] = []
            if volume > MERGED:
                place_, count = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in short]), return_counts=True)
                hits = [(int(p), int(c)) for p, c in zip(place_, count) if c >= need]
            else:
                last, run = -1, 0
                for p in merge(*short):
                    if p != last:
                        if run >= need:
                            hits.append((last, run))
                        last, run = p, 0
                    run += 1
                if run >= need:
                    hits.append((last, run))
            root = find(i)
            for p, run in sorted(hits, key=lambda h: -h[1]):
                j = order[p]
                if find(j) == root:
                    continue
                want = -(-num * (n + len(sets[j])) // (num + den))
                left = len(long)
                for x in long:
                    if run >= want or run + left < want:
                        break
                    at = bisect_left(x, p)
                    run += at < len(x) and x[at] == p
                    left -= 1
                if run >= want:
                    links.append((i, j))
                    parent[find(j)] = root
        for x in s:
            lists.setdefault(x, array("i")).append(place)
    return links


def _in_chunks(rows: DataFrame, most: int) -> DataFrame:
    """rows(h1, total, ...) with the pair of chunks (i, j) that each is in: (0, 0) where its group's total is at most `most`; else
    the group is cut by h1 into chunks of half as much, and each row goes to every pair with its chunk."""
    chunks = F.when(F.col("total") <= most, 1).otherwise(F.ceil(F.col("total") / (most // 2))).cast("int")
    cut = rows.withColumn("chunks", chunks).withColumn("mine", F.pmod(F.xxhash64("h1"), F.col("chunks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j")))
    return cut.withColumn("at", F.explode(pairs)).select("*", "at.i", "at.j").drop("at", "chunks", "mine", "total")


def jaccard_components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) for each document: its set's size and the smallest id that links reach.

    Documents link when den * |both| >= num * |either| for their sets of n-word shingles. Null texts and texts without words have
    size 0 and are their own component. Rows with equal ids are one node. A null id is its own component, null. Equal sets share
    a component whatever the size of the group; no list of partners is cut."""
    prefixes = Prefixes(num, den)

    def pass1(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen, rows = set(), []
            for s, named in zip(shingle_sets(b["text"], n), b["id"].notna()):
                h = signed(_salted(s, 1))
                first = named and len(s) > 0 and h not in seen  # rows without an id link to nothing, so they stand for no copy
                if first:
                    seen.add(h)
                rows.append((len(s), h, signed(_salted(s, 2)), sketch(s) if first else None, prefixes.counted(s), prefixes.first(s).view(np.int64) if first else None))
            yield pd.concat([b[["id"]].astype("Int64"), pd.DataFrame(rows, columns=["n", "h1", "h2", "sketch", "counted", "signs"])], axis=1)

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """From rows sorted by sign and h1: (block, h1) of signs with several sets; block is the smallest of them."""
        sign, first, told = None, None, False  # of the sign at the end of the last batch
        for b in batches:
            x, h = b["sign"].to_numpy(), b["h1"].to_numpy()
            new = np.append(True, x[1:] != x[:-1])
            if sign is not None and len(x) and x[0] == sign:
                new[0] = False
            starts = np.flatnonzero(new)
            group = np.cumsum(new)  # 0: still the last batch's sign
            block = np.concatenate([[first if first is not None else 0], h[starts]])[group]
            other = h != block
            many = np.zeros(len(starts) + 1, bool)
            many[group[other]] = True
            firsts = np.concatenate([[first if first is not None and not told else 0], h[starts]])
            say = many.copy()
            say[0] &= not told
            out = pd.DataFrame({"block": np.concatenate([block[other], firsts[say]]), "h1": np.concatenate([h[other], firsts[say]])})
            if len(x):
                told = bool(many[-1]) or (len(starts) == 0 and told)
                sign, first = x[-1], block[-1]
            if len(out):
                yield out.drop_duplicates()

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = stored(mapped(base, pass1, "id long, n long, h1 long, h2 long, sketch binary, counted long, signs array<long>"), "shingles")
    classes = sets.filter("n > 0 and id is not null").groupBy("h1", "h2").agg(F.min("id").alias("rep"))

    light = stored(sets.filter("id is not null and sketch is not null").select("h1", "n", "counted", "sketch").dropDuplicates(["h1"]), "block-sketches")

    def by_sign(rows: DataFrame) -> DataFrame:
        return rows.select("sign", "h1").repartition(partitions(docs.sparkSession), "sign").sortWithinPartitions("sign", "h1")

    def in_prefix(g: dict[str, np.ndarray]) -> list[tuple]:
        found, at = np.unique(g["sign"].astype(np.int64), return_index=True)  # a batch's end may tell a frequent one twice
        take = prefixes.shared(int(g["n"][0]), int(g["counted"][0]), found.view(np.uint64), g["sets"][at])
        return [(x, int(g["h1"][0])) for x in found[take].tolist()]

    several = mapped(by_sign(sets.filter("id is not null").select(F.explode("signs").alias("sign"), "h1")), counts, "h1 long, sign long, sets long")
    firsts = by_group(several.join(light.select("h1", "n", "counted"), "h1"), ["h1"], in_prefix, "sign long, h1 long")
    members = stored(mapped(by_sign(firsts), shared, "block long, h1 long").distinct(), "block-members")

    # Documents of a block that may be linked at all, by their sketches.
    counted = members.groupBy("block").agg(F.count("*").alias("total"))
    placed = _in_chunks(members.join(counted, "block"), BLOCK_DOCS).join(light.drop("counted"), "h1")

    def sift(g: dict[str, np.ndarray]) -> list[tuple]:
        if len(g["h1"]) < 2:
            return []
        label = feasible_groups(g["n"].astype(np.int64), list(g["sketch"]), num, den)
        many = np.bincount(label)[label] > 1
        # A group is named by its block's chunks and one of its members.
        return [(int(g["block"][0]), int(g["i"][0]) << 32 | int(g["j"][0]), int(g["h1"][x]), int(h), int(m)) for x, h, m in zip(label[many], g["h1"][many], g["n"][many])]

    members = stored(by_group(placed, ["block", "i", "j"], sift, "block long, chunk long, part long, h1 long, size long"), "block-parts")

    # The sets of these documents are made anew from the texts, one document for each set.
    reps = stored(classes.join(members.select("h1").distinct(), "h1").select("rep", "h1"), "block-reps")

    def pass2(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bodies = list(shingle_sets(b["text"], n))
            out = pd.DataFrame({"rep": b["rep"], "h1": b["h1"], "size": [len(s) for s in bodies], "body": [s.astype("<u8").tobytes() for s in bodies]})
            yield out[[signed(_salted(s, 1)) == h for s, h in zip(bodies, b["h1"].tolist())]]

    again = base.join(broadcast_if_small(reps), F.col("id") == F.col("rep")).select("rep", "h1", "text")
    bodies = stored(mapped(again, pass2, "rep long, h1 long, size long, body binary").dropDuplicates(["rep", "h1"]), "block-sets")
    counted = members.groupBy("block", "chunk", "part").agg(F.sum("size").alias("total"))
    work = _in_chunks(members.join(counted, ["block", "chunk", "part"]), BLOCK_SHINGLES).join(bodies.select("h1", "rep", "body"), "h1")

    def search(g: dict[str, np.ndarray]) -> list[tuple]:
        order = np.argsort(g["rep"], kind="stable")
        got = link_block([np.frombuffer(g["body"][k], "<u8") for k in order], num, den)
        return [(int(g["rep"][order[a]]), int(g["rep"][order[b]])) for a, b in got]

    links = stored(by_group(work, ["block", "chunk", "part", "i", "j"], search, "a long, b long"), "jaccard-links")
    found = components(links)
    named = classes.join(found, classes["rep"] == found["node"], "left").select("h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    # Sets (all but one of a group of copies leave no row in `named`) find theirs by their hash.
    out = sets.select("id", "n", "h1", "h2").join(named.withColumnsRenamed({"h1": "g1", "h2": "g2"}), (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("n") > 0), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs less all but one of each component: the one with the smallest id stays. Of rows equal in id and text one stays; rows with
    one id and different texts are one document to the join, and stay or go together. Documents without words and rows with a null
    id all stay. All columns stay as they are; no rows in, no rows out."""
    got = jaccard_components(docs, n, num, den, id_col, text_col)
    drop = stored(got.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__dropped")).distinct(), "jaccard-dropped")
    kept = docs.join(broadcast_if_small(drop), F.col(id_col) == F.col("__dropped"), "left_anti")
    if docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col)).count().filter("count > 1").isEmpty():
        return kept
    counts = F.col(id_col).isNotNull() & F.coalesce(F.rlike(text_col, F.lit(WORD)), F.lit(False))
    copies = kept.filter(counts).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    one = copies.groupBy("id", "hash").agg(F.first("row").alias("row"))
    return kept.filter(~counts).unionByName(one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
