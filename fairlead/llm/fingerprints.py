"""Document fingerprints: a canonical exact digest.

A text is normalised (NFKC, case folded, NFKC again, white space runs to one space, ends trimmed) and hashed to 128 bits by xxh3.
Documents are then grouped by digest, and within equal digests by the canonical bytes themselves: where two canonical texts share
a digest, each but the smallest gets its ordinal appended. So equal fingerprints mean equal canonical bytes.

Only texts whose digest may recur are compared. A first pass counts 64-bit keys of digests and marks each recurring key's slot in a
bitmap of SLOTS bits, whatever the corpus's size; a second groups the texts in marked slots by (digest, compressed canonical bytes).
Texts in a marked slot by chance are grouped in vain: the more keys recur the more there are, until with some SLOTS of them all texts
are, which takes more shuffling and changes no result. Counts are summed in each task before a shuffle, so a group of copies of any
size sends one row a task, and the bytes are compared in the aggregation's own key comparison.
"""

from __future__ import annotations

import hashlib
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread
from .common import key_bounds, mapped, order_key, partitions


def canonical(text: str | None) -> str:
    """The canonical form; a null text's is that of the empty text."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.casefold().split())


def xxh128(body: bytes) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(body)


def edited(text: str, following: str) -> str:
    """text with its last quarter (rounded down, code points) replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _body(text: str | None) -> bytes:
    return canonical(text).encode("utf-8", "surrogatepass")


#: Bits of the map of recurring digests, a power of two; the map is held by the driver and each worker (8 MB).
SLOTS = 1 << 26


def _keys(digests: Iterable[str]) -> np.ndarray:
    """A 64-bit key of each digest: equal digests have equal keys."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, digests), np.uint64).view(np.int64)


def recurring(texts: DataFrame, hashed: Callable[[bytes], str]) -> np.ndarray | None:
    """A bitmap (64 to a word) with the slot of every key that two or more rows of `text` have; None if there is no such key. At most
    SLOTS / 64 words reach the driver."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": _keys(hashed(_body(t)) for t in b["text"])})

    twice = mapped(texts, f, "key long").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    slot = twice.select(F.col("key").bitwiseAND(F.lit(SLOTS - 1)).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    if not words.num_rows:
        return None
    out = np.zeros(max(1, SLOTS // 64), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def _marked(keys: np.ndarray, bitmap: np.ndarray, slots: int) -> np.ndarray:
    at = keys.view(np.uint64) & np.uint64(slots - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


#: So many clashing canonical texts mean that the digest is broken, not that the corpus is large.
MOST_CLASHES = 10_000


def clashes(docs: DataFrame, text_col: str = "text", hashed: Callable[[bytes], str] = xxh128) -> dict[str, dict[bytes, int]]:
    """Digests that two or more different canonical texts share, with the ordinal of each text: the byte comparison inside equal
    buckets. No texts but such clashes reach the driver, and 128 bits leave none to be expected at any corpus size; bodies are
    shuffled only where a digest may recur."""
    texts, slots = docs.select(F.col(text_col).alias("text")), SLOTS
    bitmap = recurring(texts, hashed)
    if bitmap is None:
        return {}

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c = [_body(t) for t in b["text"]]
            digests = [hashed(x) for x in c]
            at = np.flatnonzero(_marked(_keys(digests), bitmap, slots)).tolist()
            if at:
                yield pd.DataFrame({"digest": [digests[i] for i in at], "body": [zlib.compress(c[i], 1) for i in at]})

    got = mapped(texts, f, "digest string, body binary")
    classes = got.groupBy("digest", "body").agg(F.count("*").alias("n"))
    shared = classes.groupBy("digest").agg(F.count("*").alias("classes")).filter("classes > 1").select("digest")
    found = [r[0] for r in shared.limit(MOST_CLASHES + 1).collect()]
    if len(found) > MOST_CLASHES:
        raise ValueError(f"over {MOST_CLASHES} digests stand for several texts: use a wider hash")
    out: dict[str, dict[bytes, int]] = {}
    if found:
        for r in classes.filter(F.col("digest").isin(found)).collect():
            out.setdefault(r["digest"], {})[zlib.decompress(r["body"])] = 0
        out = {d: {b: n for n, b in enumerate(sorted(bodies))} for d, bodies in out.items()}
    return out


def _named(hashed: Callable[[bytes], str], clashing: dict[str, dict[bytes, int]]) -> Callable[[str], str]:
    def name(text: str) -> str:
        d = hashed(body := _body(text))
        # A text that is not of the corpus can only be told apart from the corpus texts that clash among themselves.
        n = clashing.get(d, {}).get(body, 0) if clashing else 0
        return f"{d}-{n}" if n else d

    return name


def fingerprint(docs: DataFrame, text_col: str = "text", hashed: Callable[[bytes], str] = xxh128) -> DataFrame:
    """docs with a column `fingerprint`: equal exactly where the canonical texts are equal byte for byte.

    Null and blank texts share the fingerprint of the empty text. Every other column stays; one named fingerprint is replaced.
    No rows in, no rows out; repeated rows stay repeated."""
    name = _named(hashed, clashes(docs, text_col, hashed))

    @F.pandas_udf("string")
    def column(text: pd.Series) -> pd.Series:
        return text.map(lambda t: name(t or ""))

    return docs.withColumn("fingerprint", column(F.col(text_col)))


def fingerprint_edits(docs: DataFrame, hashed: Callable[[bytes], str] = xxh128) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of documents and their edited
    texts (last quarter replaced from the next document in doc_id order; equal ids by text; a null id comes first).

    The fingerprint is exact, so likeness is 1 for equal canonical texts and 0 else. Documents are dealt by ranges of doc_id; the
    first of each range also goes, as a closing row, to the range before (the first of all to the last range), so each task sees
    every following text without a global sort. A single document follows itself. Pass a table as it was read: it is spread here,
    and only where texts are hashed before they are dealt."""
    name = _named(hashed, clashes(spread(docs), "text", hashed))
    base = docs.select(order_key(F.col("doc_id")).alias("k"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = key_bounds(docs, "doc_id", 4 * partitions(docs.sparkSession))

    @F.pandas_udf("long")
    def own(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int64))

    # One row for each range: its number and smallest key.
    heads = sorted((r["b"], r["k"]) for r in base.select("k").withColumn("b", own("k")).groupBy("b").agg(F.min("k").alias("k")).collect())
    closes = {k: heads[i - 1][0] for i, (_, k) in enumerate(heads)}

    @F.pandas_udf("array<struct<b:long,closing:boolean>>")
    def places(k: pd.Series) -> pd.Series:
        own_b = np.searchsorted(bounds, k.to_numpy(), side="right")
        return pd.Series([[{"b": int(b), "closing": False}] + ([{"b": closes[x], "closing": True}] if x in closes else []) for x, b in zip(k.tolist(), own_b.tolist())])

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (range, id, text, fingerprint) of the document that waits for the next

        for batch in batches:
            out = []
            for b, closing, i, text in zip(batch["b"].tolist(), batch["closing"].tolist(), batch["doc_id"].tolist(), batch["text"].tolist()):
                if held is None and closing:
                    continue  # a further row with the closing id
                mark = name(text)
                if held is not None:
                    _, i0, text0, mark0 = held
                    e = edited(text0, text)
                    e_mark = name(e)
                    out.append((i0, len(text0), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), mark0, e_mark, float(mark0 == e_mark), float(mark0 == mark)))
                held = None if closing else (b, i, text, mark)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).astype({"doc_id": "Int64"})

    dealt = base.withColumn("place", F.explode(places("k"))).select("place.b", "place.closing", "k", "doc_id", "text")
    dealt = dealt.repartition(partitions(docs.sparkSession), "b").sortWithinPartitions("b", "closing", "k", "text")
    return mapped(dealt, f, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
