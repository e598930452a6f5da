"""What several operators share: the shared folder, word splitting, checked broadcasts and key ranges."""

from __future__ import annotations

import ctypes
import gc
import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than ASCII white space. Python's bytes.split() cuts at the same places.
WORD = r"[^\x20\x09-\x0D]+"
#: A side with more rows than this is never broadcast.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder of our own, but only if
    driver and executors are one process; on a cluster that is an error, as no other folder is known to be shared."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark.sparkContext, "_fairlead_dir", None)
    if own is None:
        own = spark.sparkContext._fairlead_dir = "file://" + tempfile.mkdtemp(prefix="fairlead-")
    return own


#: Where the tables are that the innermost passing() is about to delete.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back, which cuts its lineage and survives lost executors. The files stay, as the
    caller's frames read them; see passing()."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (made := _passing.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What stored() writes inside is deleted at the end: frames made of it have to be written elsewhere before."""
    made: list[str] = []
    token = _passing.set(made)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in made:
            delete(spark, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to have at most `limit` (narrow) rows; else df, for a shuffled join in which
    adaptive execution splits skewed keys. Count stored frames only: the frame is computed for it."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df.hint("merge")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    """Null ids sort before all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(2**63)))


def key_bounds(docs: DataFrame, column: str, pieces: int) -> np.ndarray:
    """At most pieces - 1 ascending cuts of an integer column into ranges with about equally many rows.

    One number for each piece reaches the driver, however many rows there are."""
    if pieces < 2:
        return np.empty(0, np.int64)
    got = docs.agg(F.percentile_approx(order_key(F.col(column)), [i / pieces for i in range(1, pieces)], 20 * pieces)).first()[0]
    return np.unique(np.array(got or [], np.int64))


def range_of(key: Column, bounds: np.ndarray) -> Column:
    """Which of the ranges that ascending bounds cut a long key is in (from 0; a bound begins its range), by bisection."""
    if not len(bounds):
        return F.lit(0)
    cuts, steps = F.lit([int(b) for b in bounds]), [1 << i for i in reversed(range(len(bounds).bit_length()))]
    step = lambda at, n: F.when(F.get(cuts, at + n - 1) <= key, at + n).otherwise(at)
    return F.aggregate(F.lit(steps), F.lit(0), step)


#: Bytes of rows that go to Python at once.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Texts can be long, so a number of rows alone bounds no batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Returns to the system what this process has freed: Python workers live on between tasks and stages, and allocators keep freed
    memory, which would add up to the most that any stage has needed in each of them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


#: What a worker process keeps between the tasks of one operator, by the operator's name.
_kept: dict[str, dict] = {}


def kept_for(owner: str) -> dict:
    """What this process keeps for the operator; what it kept for others goes, as a worker outlives the stages that it works for."""
    for other in _kept.keys() - {owner}:
        del _kept[other]
    return _kept.setdefault(owner, {})


def giving_back(f: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """f, before which the worker lets go of what it kept for others, and after which it gives freed memory back."""

    def g(batches: Iterator) -> Iterator:
        kept_for(owner)
        try:
            yield from f(batches)
        finally:
            give_back()

    return g


def mapped(df: DataFrame, f: Callable[[Iterator], Iterator], schema: str, owner: str = "") -> DataFrame:
    """mapInPandas over batches of bounded size; `owner`: see kept_for()."""
    small_batches(df.sparkSession)
    return df.mapInPandas(giving_back(f, owner), schema)


def by_group(df: DataFrame, keys: list[str], f: Callable[[dict[str, np.ndarray]], list[tuple]], schema: str) -> DataFrame:
    """f for the rows of each group, as arrays by column. Groups come one after the other in sorted partitions, so small ones cost
    little; a group has to fit a task. Keys are never null."""
    names = [x.split()[0] for x in schema.split(", ")]

    def stream(batches: Iterator) -> Iterator:
        held = None
        for b in itertools.chain(batches, [None]):
            if b is None:
                if held is None:
                    return
                b, ends = held, [len(held)]
            else:
                if not len(b):
                    continue
                b = b if held is None else pd.concat([held, b], ignore_index=True)
                new = np.zeros(len(b), bool)
                for k in keys:
                    x = b[k].to_numpy()
                    new[1:] |= x[1:] != x[:-1]
                ends = np.flatnonzero(new).tolist()
            columns = {c: b[c].to_numpy() for c in b.columns}
            rows, start = [], 0
            for end in ends:
                rows += f({c: x[start:end] for c, x in columns.items()})
                start = end
            held = b.iloc[start:] if start < len(b) else None
            if rows:
                yield pd.DataFrame(rows, columns=names)

    dealt = df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    return mapped(dealt, stream, schema)


def word_hashes(texts: Iterable[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit xxhash of each word, in order of the texts; where each text's begin, and the end of the last). Words are cut and
    their distinct ones numbered by Arrow, so that each is hashed once. `lower`: ASCII letters are lower-cased."""
    import xxhash

    whole = pa.array([(t or "").encode("utf-8", "replace") for t in texts], pa.large_string())
    cut = pc.ascii_split_whitespace(pc.ascii_lower(whole) if lower else whole)
    numbered = cut.values.dictionary_encode()
    distinct = numbered.dictionary.cast(pa.large_binary()).to_pylist()
    at, ends = numbered.indices.to_numpy(), cut.offsets.to_numpy()
    if b"" in distinct:  # what the cutting leaves before leading and after trailing white space
        real = at != distinct.index(b"")
        at, ends = at[real], np.append(0, np.cumsum(real))[ends]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[at], ends


M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word ids, in order."""
    k = len(ids) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mixed(out * M1 + ids[i : i + k])
    return out
