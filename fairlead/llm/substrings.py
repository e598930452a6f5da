"""Substring deduplication with suffix automata over reference shards.

A word goes if a window of `window` words that covers it also starts earlier: in a document with a smaller id, or earlier in its
own. The reference is the corpus itself, so no shard of it can be broadcast to all documents; shards are instead made so that a
window and all its copies meet in one, and each automaton goes just where the documents' pieces for it go.

1. Each window is represented by its anchor, the k-gram in it with the smallest hash (the leftmost of equals). Equal windows have
   equal anchors at equal places. Consecutive windows with the same anchor form a piece. An anchor comes every eight or nine words
   or so for windows of 20, so there are far fewer pieces than windows.
2. Pieces are sorted by anchor and content. A piece with the content of an earlier one is matched whole, without being streamed;
   where both are in one batch of documents that is seen before the shuffle, so a piece in very many documents is no hot group.
   Where an anchor has pieces of different content, windows in them may still be equal.
3. Such pieces, once for each content, go to the shard of their anchor. There they are streamed in document order through the
   suffix automaton of all pieces before them: where the matching statistic reaches the window length, the window starts
   earlier. Then the piece is added to the automaton. Shards hold SHARD_PIECES pieces or so.
4. An anchor with more than HOT_PIECES different pieces (the edge of a passage in a great many documents) would overfill a shard.
   Its windows are matched one by one: a piece of a single window is equal to an earlier one or matches nothing. The smallest
   place of each window is found by sums in every task first, so that no window's copies meet in one task.
5. Spans are united for each document and the text rebuilt without their words.

Hashes of words, k-grams and pieces are of 64 bits; pieces are told apart by anchor and content together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, mapped, mixed, partitions, shingle_hashes, stored, word_hashes

SHARD_PIECES, HOT_PIECES = 3_000, 5_000
#: Rows of places up to which they are broadcast to the texts, instead of shuffling the texts to them.
FEW_PLACES = 100_000


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def pieces(ids: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, content, start, number of windows) of the pieces of several texts: their word ids one after the other, and
    where each text's begin (and the last one's end)."""
    if len(ids) < window:
        return (np.empty(0, np.int64),) + (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    n, text = len(ids) - window + 1, np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    with np.errstate(over="ignore"):
        grams = shingle_hashes(ids, gram)
        # The upper bits of the hash decide, then the place: a batch of Arrow rows holds fewer words than the lower bits can count.
        low = np.uint64((1 << 30) - 1)
        at = (_least(grams & ~low | np.arange(len(grams), dtype=np.uint64), window - gram + 1) & low).astype(np.int64)
        real = text[:n] == text[window - 1 :]  # windows within one text
        new = np.append(True, (at[1:] != at[:-1]) | (text[1:n] != text[: n - 1]))
        whole = window_hashes(ids, grams, window, gram)[real]
        new, places = new[real], np.flatnonzero(real)
        if not len(places):
            return pieces(ids[:0], ends[:1], window, gram)
        first = np.flatnonzero(new)
        starts, counts = places[first], np.diff(np.append(first, len(places)))
        inside = places - np.repeat(starts, counts)
        content = np.add.reduceat(mixed(whole + inside.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first) + counts.astype(np.uint64)
    return text[starts], grams[at[starts]], content, starts - ends[text[starts]], counts


#: Words that are cut into pieces at once: as many as a processor's cache has room for, and the rest of the last text.
AT_ONCE = 1 << 15


def pieces_of_texts(ids: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """pieces(), some texts at a time."""
    got, first = [], 0
    while first < len(ends) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + AT_ONCE)))
        last = min(last, len(ends) - 1)
        text, *rest = pieces(ids[ends[first] : ends[last]], ends[first : last + 1] - ends[first], window, gram)
        got.append((text + first, *rest))
        first = last
    return tuple(map(np.concatenate, zip(*got))) if got else pieces(ids[:0], ends[:1], window, gram)


def window_hashes(ids: np.ndarray, grams: np.ndarray, window: int, gram: int) -> np.ndarray:
    """A hash of each window, from the k-grams that cover it."""
    n = len(ids) - window + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in sorted({*range(0, window - gram + 1, gram), window - gram}):
            out = mixed(out * np.uint64(0xC2B2AE3D27D4EB4F) + grams[i : i + n])
    return out


class Automaton:
    """A suffix automaton of many word sequences, grown one sequence at a time (Blumer et al. 1985, for several strings)."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def matches(self, words: list[int]) -> list[int]:
        """At each place the length of the longest match that ends there: the matching statistics."""
        state, run, out = 0, 0, []
        nxt, link, length = self.next, self.link, self.length
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                run = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                run += 1
            else:
                run = 0
            out.append(run)
        return out

    def _split(self, p: int, w: int, q: int) -> int:
        """The state for the longest match of p's words and w, parted from q if q stands for longer ones too."""
        nxt, link, length = self.next, self.link, self.length
        if length[p] + 1 == length[q]:
            return q
        clone = len(nxt)
        nxt.append(nxt[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def add(self, words: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                last = self._split(last, w, q)
                continue
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p >= 0:
                link[new] = self._split(p, w, nxt[p][w])
            last = new


def stream_shard(segments: list[tuple[tuple[int, int], int, np.ndarray]], window: int) -> list[tuple[int, int, int, int]]:
    """(id, row, start, number of windows) of windows that occur in an earlier segment; segments ((id, row), start, words) in order."""
    automaton, out = Automaton(), []
    for doc, start, words in segments:
        words = words.tolist()
        runs = automaton.matches(words)
        seen = [i - window + 1 for i, r in enumerate(runs) if r >= window]
        for k, s in enumerate(seen):
            if k and s == seen[k - 1] + 1:
                out[-1][3] += 1
            else:
                out.append([*doc, start + s, 1])
        if not runs or runs[-1] < len(words):
            automaton.add(words)
    return [tuple(x) for x in out]


def _sorted_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From pieces sorted by anchor, content, id, row and start: those like an earlier piece (whole), and, of anchors with several
    contents, the first of each content (not whole). State between batches is one piece, however many share an anchor."""
    held = None  # (anchor, content, its row if it is the anchor's first content and not told yet)
    for b in batches:
        if b["whole"].any():
            yield b[b["whole"]][["id", "row", "start", "n", "anchor", "whole"]]
            b = b[~b["whole"]]
        if not len(b):
            continue
        anchor, content = b["anchor"].to_numpy(), b["content"].to_numpy()
        before_a = np.append(held[0] if held else 0, anchor[:-1])
        before_c = np.append(held[1] if held else 0, content[:-1])
        new_anchor = anchor != before_a
        new_content = new_anchor | (content != before_c)
        if held is None:
            new_anchor[0] = new_content[0] = True
        group = np.cumsum(new_anchor)  # 0: the last batch's anchor
        kinds = np.bincount(group[new_content & ~new_anchor], minlength=group[-1] + 1) > 0  # a further content in this batch
        first = new_anchor & kinds[group]
        told = new_content & ~new_anchor
        out = b[first | told | ~new_content][["id", "row", "start", "n", "anchor"]].assign(whole=(~new_content)[first | told | ~new_content])
        if held and held[2] is not None and kinds[0]:
            out = pd.concat([held[2], out])
        at = np.flatnonzero(new_anchor)
        if len(at):  # the last anchor began in this batch
            row = None if kinds[-1] else b.iloc[at[-1] : at[-1] + 1][["id", "row", "start", "n", "anchor"]].assign(whole=False)
        else:
            row = held[2] if not kinds[0] else None
        held = (anchor[-1], content[-1], row)
        if len(out):
            yield out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(id, row, text) of every row, and whether ids repeat. If so, id and row (a hash of the text) together name a document; else
    row is 0, which costs the shuffles nothing."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    repeat = not base.filter("id is not null").groupBy("id").count().filter("count > 1").isEmpty()
    return base.select("id", (F.xxhash64("text") if repeat else F.lit(0).cast("long")).alias("row"), "text"), repeat


def repeated_spans(docs: DataFrame, window: int = 20, gram: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, start, n): runs of n consecutive windows, from word `start` on, that occur earlier, in the document that id and row
    name (see _rows). Stored; ids are never null here."""
    spark = docs.sparkSession
    base, repeat = _rows(docs, id_col, text_col)
    base = base.filter("id is not null and text is not null")
    if repeat:
        base = base.dropDuplicates(["id", "row"])  # rows that are equal in id and text are one document

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, anchor, content, start, n = pieces_of_texts(*word_hashes(b["text"]), window, gram)
            anchor, content, doc, row = anchor.view(np.int64), content.view(np.int64), b["id"].to_numpy()[at], b["row"].to_numpy()[at]
            order = np.lexsort((start, row, doc, content, anchor) if repeat else (start, doc, content, anchor))
            whole = np.zeros(len(order), bool)
            whole[order[1:]] = (anchor[order[1:]] == anchor[order[:-1]]) & (content[order[1:]] == content[order[:-1]])
            yield pd.DataFrame({"route": np.where(whole, doc, anchor), "whole": whole, "anchor": anchor, "content": content, "id": doc, "row": row, "start": start, "n": n})

    cuts = mapped(base, cut, "route long, whole boolean, anchor long, content long, id long, row long, start int, n int")
    cuts = cuts.repartition(partitions(spark), "route").sortWithinPartitions("whole", "anchor", "content", "id", "row", "start").drop("route")
    found = stored(mapped(cuts, _sorted_pieces, "id long, row long, start int, n int, anchor long, whole boolean"), "repeats")

    open_ = found.filter("not whole")
    per_anchor = open_.groupBy("anchor").agg(F.count("*").alias("pieces"))
    hot = stored(per_anchor.filter(F.col("pieces") > HOT_PIECES).select(F.col("anchor").alias("hot_anchor")), "repeats-hot")
    open_ = open_.join(broadcast_if_small(hot), F.col("anchor") == F.col("hot_anchor"), "left").withColumn("hot", F.col("hot_anchor").isNotNull())
    wanted = open_.groupBy("id", "row").agg(F.collect_list(F.struct("start", "n", "anchor", "hot")).alias("places"))
    total = found.filter("not whole").count()
    shards = max(1, math.ceil(total / SHARD_PIECES))
    wanted = F.broadcast(wanted) if total <= FEW_PLACES else wanted.hint("merge")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, (every, ends) = [], word_hashes(b["text"])
            for i, row, first, places in zip(b["id"].tolist(), b["row"].tolist(), ends.tolist(), b["places"]):
                for p in places:
                    s = p["start"]
                    words = every[first + s : first + s + p["n"] + window - 1]
                    if p["hot"]:
                        hashes = window_hashes(words, shingle_hashes(words, gram), window, gram).view(np.int64).tolist()
                        rows.extend((-1, h, p["anchor"], i, row, s + k, b"") for k, h in enumerate(hashes))
                    else:
                        rows.append((int(np.uint64(p["anchor"] & (2**64 - 1)) % np.uint64(shards)), 0, p["anchor"], i, row, s, words.astype("<u8").tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["shard", "hash", "anchor", "id", "row", "start", "body"])

    again = base.join(wanted, ["id", "row"]).select("id", "row", "text", "places")
    segments = stored(mapped(again, take, "shard long, hash long, anchor long, id long, row long, start int, body binary"), "repeats-segments")

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "row", "start"])
        got = stream_shard([((i, r), s, np.frombuffer(x, "<u8")) for i, r, s, x in zip(pdf["id"].tolist(), pdf["row"].tolist(), pdf["start"].tolist(), pdf["body"])], window)
        return pd.DataFrame(got, columns=["id", "row", "start", "n"]).astype("int64")

    streamed = segments.filter("shard >= 0").groupBy("shard").applyInPandas(shard, "id long, row long, start int, n int")
    alone = segments.filter("shard < 0").select("anchor", "hash", "id", "row", "start")
    earliest = alone.groupBy("anchor", "hash").agg(F.min(F.struct("id", "row", "start")).alias("first"))
    single = alone.join(earliest, ["anchor", "hash"]).filter(F.struct("id", "row", "start") != F.col("first")).select("id", "row", "start", F.lit(1).alias("n"))
    return stored(found.filter("whole").select("id", "row", "start", "n").unionByName(streamed).unionByName(single), "repeats-spans")


def remove_repeats(docs: DataFrame, window: int = 20, gram: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_removed, kept (the words that stay, joined by one space) of every row.

    Words are runs of characters other than ASCII white space, unchanged. Null and blank texts have no words and keep the empty
    text; texts shorter than a window stay whole; so do documents with a null id, which take no part. Rows with equal ids and
    different texts are documents of their own, in the order of a hash of their texts; rows equal in both are one document, with
    the same result each. Copies of a document lose every word that a window covers. No rows in, no rows out; other columns are
    not looked at."""
    spans = repeated_spans(docs, window, gram, id_col, text_col)
    by_doc = spans.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, text, spans in zip(b["id"], b["text"], b["spans"]):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if spans is None or not len(spans):
                    rows.append((i, n, 0, b" ".join(words).decode("utf-8", "replace")))
                    continue
                depth = np.zeros(n + 1, np.int64)
                for s in spans:
                    depth[s["start"]] += 1
                    depth[s["start"] + s["n"] + window - 1] -= 1
                gone = np.cumsum(depth)[:n] > 0
                rows.append((i, n, int(gone.sum()), b" ".join([words[k] for k in np.flatnonzero(~gone)]).decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "kept"]).astype({"id": "Int64"})

    base, _ = _rows(docs, id_col, text_col)
    few = spans.limit(FEW_PLACES + 1).count() <= FEW_PLACES
    on = (F.col("id") == F.col("__id")) & (F.col("row") == F.col("__row"))
    joined = base.join(F.broadcast(by_doc) if few else by_doc.hint("merge"), on, "left").select("id", "text", "spans")
    return mapped(joined, f, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
