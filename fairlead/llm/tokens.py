"""Token ids in a fixed-width, bit-packed file format.

Every id takes the fewest bits that hold the vocabulary (16 for 49,408 ids). A file (Parquet as the container, so that any store
Spark writes to will do) has blocks as its rows: shard, block, first (ids before the block in its shard), n_ids, first_id and
last_id (of its documents), bits, doc_ids (int64 each, little-endian), offsets (where each document starts in the block, and n_ids
at the end; uint32) and payload (the packed ids, least significant bit first). Shards follow doc_id order, as do the blocks of a
shard and the documents of a block. So Parquet's statistics of first_id and last_id lead to a document's block, the offsets to its
place there, and numpy unpacks that alone, or a whole block at once.

A block takes documents until it holds BLOCK_IDS ids, so it is bounded by that and the longest document.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_for, key_bounds, mapped, order_key, partitions, range_of, shared_dir

BLOCK_IDS = 1 << 16
SCHEMA = "shard int, block long, first long, n_ids long, first_id long, last_id long, bits int, doc_ids binary, offsets binary, payload binary"


def width(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, n: int, start: int = 0) -> np.ndarray:
    """n ids from the start-th of a payload, without unpacking what comes before."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, start * bits // 8).astype(np.uint32)
    lo = start * bits // 8
    planes = np.unpackbits(np.frombuffer(payload, np.uint8, (start + n) * bits // 8 + ((start + n) * bits % 8 > 0) - lo, lo), bitorder="little")
    planes = planes[start * bits - 8 * lo :][: n * bits].reshape(n, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _letters(word: str) -> bool:
    """Whether a word is letters alone and stays so when normalised and lower-cased."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class Known:
    """Byte strings with their ids (two bytes each), held in Arrow and numpy arrays: some 30 bytes a word. Empties itself before it
    would hold more than `most`."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.words, self.ids, self.ends = pa.array([], pa.large_binary()), np.empty(0, "<u2"), np.zeros(1, np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each word is held, -1 if nowhere."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()

    def add(self, words: list[bytes], ids: list[bytes]) -> None:
        self.words = pa.concat_arrays([self.words, pa.array(words, pa.large_binary())])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u2")])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 2)])

    def get(self, places: np.ndarray) -> list[bytes]:
        raw = self.ids.tobytes() if len(places) else b""
        return [raw[i:j] for i, j in zip((2 * self.ends[places]).tolist(), (2 * self.ends[places + 1]).tolist())]


class WordEncoder:
    """A tokenizer whose pre-tokenizer cuts texts at ASCII white space, and between letters, digits and other characters; the ids of
    each word (what stands between white space) and of each piece of a word are remembered.

    A batch of texts is cut into words and its distinct words are numbered and looked up by Arrow; the ids of all words are put
    together by numpy. A new word is cut into pieces by the tokenizer's rule, with the bytes above ASCII counted as letters, and
    new pieces are encoded many at a time. Words in which a piece has such bytes and isn't letters alone, or a special token may be,
    are encoded uncut. That this gives what encoding whole texts gives is tried on a probe when the encoder is made, and in tests
    on random texts; tokenizers for which the probe fails, and texts with the parting token, are encoded whole."""

    PROBE = "It's a Test,\n of  2 words.\tand\x0bnumb3rs 12, É. ÜnïCode ΣΑΣ é ́x <|endoftext|> n1. ok... \"end.\"'s I'll 3's z"
    PART = "<|startoftext|>"
    _PIECE = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[a-z\x80-\xff]+|[0-9]+|[^a-z0-9\x80-\xff\s]+")

    def __init__(self, path: str, most: int = 2_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.pieces = Known(most), Known(most)
        self.uncut: set[bytes] = set()  # pieces that aren't to be cut out of their words
        self.part = self.tokenizer.token_to_id(self.PART)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.apart = False
        if self.part is not None and len(self.ends) <= 1 << 16:
            self.apart = all(self._by_words([x])[0].tolist() == self._whole(x).tolist() for x in (self.PROBE, *self.PROBE.split()))

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_pieces(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each piece, but for those that have to stay in their words, which are noted."""
        plain, other, out = [], [], {}
        for w in new:
            if w[0] > 127 or 97 <= w[0] <= 122:  # a letter, or a byte above ASCII
                text = w.decode()
                if _letters(text):
                    plain.append((w, text))
                else:
                    self.uncut.add(w)
            else:
                other.append((w, w.decode()))
        for k in range(0, len(plain), 2000):
            # Each is one unit for the tokenizer, whose last token is marked as ending a word.
            some = plain[k : k + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([t for _, t in some])], add_special_tokens=False)[0].ids, "<u2")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                out |= self._encode_parted(some)
                continue
            raw, start = ids.tobytes(), 0
            for (w, _), end in zip(some, (2 * cuts).tolist()):
                out[w] = raw[start:end]
                start = end
        return out | self._encode_parted(other)

    def _encode_parted(self, words: list[tuple[bytes, str]]) -> dict[bytes, bytes]:
        out = {}
        for k in range(0, len(words), 1000):
            some = words[k : k + 1000]
            got = self.tokenizer.encode_batch_fast([f" {self.PART} ".join([t for _, t in some])], add_special_tokens=False)[0].ids
            ids = np.array([self.part, *got], "<u2")
            cuts = np.append(np.flatnonzero(ids == self.part), len(ids)).tolist()
            if len(cuts) != len(some) + 1:
                raise ValueError("the parting token is not kept apart")
            raw = ids.tobytes()
            out.update((w, raw[2 * i + 2 : 2 * j]) for (w, _), i, j in zip(some, cuts, cuts[1:]))
        return out

    def _learn(self, new: list[bytes]) -> None:
        cut, known = self._PIECE.findall, self.pieces
        parts = [() if b"<|" in w else cut(w.lower()) for w in new]
        distinct = list({p for found in parts for p in found})
        if len(known.ends) + len(distinct) > known.most:
            known.clear()
            self.uncut.clear()
        places = known.places(pa.array(distinct, pa.large_binary()))
        ids = dict(zip([distinct[i] for i in np.flatnonzero(places >= 0).tolist()], known.get(places[places >= 0])))
        made = self._encode_pieces([p for i in np.flatnonzero(places < 0).tolist() if (p := distinct[i]) not in self.uncut])
        known.add(list(made), list(made.values()))
        ids |= made
        whole = self._encode_parted([(w, w.decode()) for w, found in zip(new, parts) if not found or not self.uncut.isdisjoint(found)])
        self.words.add(new, [b"".join([ids[p] for p in found]) if (got := whole.get(w)) is None else got for w, found in zip(new, parts)])

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        cut = pc.ascii_split_whitespace(pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_string()))
        numbered = cut.values.dictionary_encode()
        distinct, known = numbered.dictionary.cast(pa.large_binary()), self.words
        if len(known.ends) + len(distinct) > known.most:
            known.clear()
        places = known.places(distinct).copy()
        new = np.flatnonzero(places < 0)
        if len(new):
            held = len(known.words)
            self._learn(distinct.take(pa.array(new)).to_pylist())
            places[new] = np.arange(held, held + len(new))
        at = numbered.indices.to_numpy()
        each = np.diff(known.ends)[places][at]
        ends = np.append(0, np.cumsum(each))
        out = known.ids[np.repeat(known.ends[places][at] - ends[:-1], each) + np.arange(ends[-1])]
        return np.split(out, ends[cut.offsets.to_numpy()[1:-1]])

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = {i: self._whole(t) for i, t in enumerate(texts) if not self.apart or self.PART in t}
        words = iter(self._by_words([t for i, t in enumerate(texts) if i not in whole]) if len(whole) < len(texts) else ())
        for i in range(len(texts)):
            yield whole[i] if i in whole else next(words)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


def encoder(path: str) -> WordEncoder:
    """One for each process and tokenizer, so that later tasks find words already encoded; gone once the process works for others."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    encoders = kept_for("tokens")
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of every whole text, each document closed by end_id, to files at `path` in ascending id order.

    A null or empty text is end_id alone. A null doc_id comes first and reads back as the smallest long. Equal ids follow each
    other by text. No documents: files without blocks. `vocabulary`: ids are below it. Each range of ids with about equally many
    documents is a shard and a task of its own; however many rows have one id, they are in one shard, in blocks of the usual size."""
    bits, bounds = width(vocabulary), key_bounds(docs, id_col, 2 * partitions(docs.sparkSession))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        now, block, first, size = None, 0, 0, 0
        end = np.array([end_id], np.uint32)
        ids: list[np.ndarray] = []
        held: list[int] = []
        ends: list[int] = [0]

        def flush() -> tuple:
            body = np.concatenate(ids)
            if body.max() >= 1 << bits:
                raise ValueError(f"id {body.max()} does not fit a vocabulary of {vocabulary}")
            return now, block, first, size, held[0], held[-1], bits, np.array(held, "<i8").tobytes(), np.array(ends, "<u4").tobytes(), pack(body, bits)

        for batch in batches:
            out = []
            for s, k, got in zip(batch["shard"].tolist(), batch["k"].tolist(), enc.encode_all(batch["text"].tolist())):
                if held and (s != now or size >= block_ids):
                    out.append(flush())
                    first, block, size = first + size, block + 1, 0
                    ids, held, ends = [], [], [0]
                if s != now:
                    now, block, first = s, 0, 0
                ids += (got, end)
                held.append(k)
                size += len(got) + 1
                ends.append(size)
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])
        if held:
            yield pd.DataFrame([flush()], columns=[x.split()[0] for x in SCHEMA.split(", ")])

    base = docs.select(order_key(F.col(id_col)).alias("k"), F.coalesce(text_col, F.lit("")).alias("text"))
    dealt = base.withColumn("shard", range_of(F.col("k"), bounds)).repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "k", "text")
    mapped(dealt, f, SCHEMA, owner="tokens").write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian uint32) from such files.

    Only the number of ids in each shard reaches the driver: there are as many shards as key ranges, not as documents."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    sizes = sorted((r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    before = dict(zip([s for s, _ in sizes], np.cumsum([0, *[n for _, n in sizes]])[:-1].tolist()))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                ends, raw = np.frombuffer(b.offsets, "<u4").astype(np.int64), memoryview(unpack(b.payload, b.bits, b.n_ids).astype("<u4", copy=False).tobytes())
                crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pd.DataFrame({"doc_id": np.frombuffer(b.doc_ids, "<i8"), "start": before[b.shard] + b.first + ends[:-1], "n_tokens": np.diff(ends), "ids_crc32": crc})

    return mapped(blocks, f, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(spark, path: str, doc_id: int) -> np.ndarray | None:
    """Random access: the ids of one document (the first of that id), unpacking nothing else of its block. Blocks of other ids are
    passed over by the files' statistics."""
    mine = spark.read.schema(SCHEMA).parquet(path).filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    for b in mine.orderBy("shard", "block").limit(1).collect():
        at = np.flatnonzero(np.frombuffer(b["doc_ids"], "<i8") == doc_id)
        ends = np.frombuffer(b["offsets"], "<u4").astype(np.int64)
        if len(at):
            return unpack(b["payload"], b["bits"], int(ends[at[0] + 1] - ends[at[0]]), int(ends[at[0]]))
    return None


def token_files(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int = 1) -> DataFrame:
    """Writes docs to new files in the shared folder and reads them back (see write_tokens and read_tokens). The files stay there."""
    path = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, vocabulary, end_id)
    return read_tokens(docs.sparkSession, path)
