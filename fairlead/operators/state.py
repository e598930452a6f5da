"""State across runs: the event store, the enrichment cache and the sitemap snapshot, as versions of Parquet tables.

A new version is written beside the old one and named last, so a reader or a failed run never sees half of one."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import effective_day
from ..functions.identity import identity_key


class Versions:
    """Versions of a table under a path, through Spark's own file system, so any store will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and self._fs.exists(self._path(f"{self.path}/{n}/_SUCCESS")))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}".rstrip("/"))
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)

    def latest(self) -> DataFrame | None:
        n = self.numbers()
        return self.spark.read.parquet(f"{self.path}/v{n[-1]}") if n else None

    def write(self, df: DataFrame, keep: int = 2) -> DataFrame:
        """[X7, X10]"""
        n = self.numbers()
        new = (n[-1] if n else 0) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{new}")
        for old in n[: max(0, len(n) + 1 - keep)]:
            self._fs.delete(self._path(f"{self.path}/v{old}"), True)
        return self.spark.read.parquet(f"{self.path}/v{new}")


def merge_events(store: DataFrame | None, batch: DataFrame, seen_at: datetime | Column) -> DataFrame:
    """[K1, U1] The store after a batch: rows of known identity are replaced and keep first_seen; of a batch's equals the last
    counts; rows that the batch doesn't have stay. Identity is kept in `identity`."""
    seen = F.lit(seen_at) if isinstance(seen_at, datetime) else seen_at
    fields = batch.columns
    new = batch.withColumn("identity", identity_key()).groupBy("identity").agg(F.max_by(F.struct(*fields), "seq").alias("new")).withColumn("seen", seen.cast("timestamp_ntz"))
    if store is None:
        return new.select("identity", *[f"new.{c}" for c in fields], F.col("seen").alias("first_seen"), F.col("seen").alias("last_seen"))
    old = store.select("identity", F.struct(*fields).alias("old"), F.col("first_seen").alias("first"), F.col("last_seen").alias("last"))
    both = old.join(new, "identity", "full")
    row = F.coalesce("new", "old")
    return both.select("identity", *[row[c].alias(c) for c in fields], F.coalesce("first", "seen").alias("first_seen"), F.coalesce("seen", "last").alias("last_seen"))


def prune_unseen(store: DataFrame, cutoff: datetime | Column) -> DataFrame:
    """[K4] Without rows last seen before the cutoff."""
    return store.filter(F.col("last_seen") >= (F.lit(cutoff) if isinstance(cutoff, datetime) else cutoff))


def prune_past(store: DataFrame, today: date | Column) -> DataFrame:
    """[K5] Without rows whose day is before today; undated ones stay."""
    day = effective_day("start", "end")
    return store.filter(day.isNull() | (day >= (F.lit(today) if isinstance(today, date) else today)))


class EventStore:
    """[K1-K5] Rows lie in buckets by a hash of their identity, each in a folder of its own; the table `map` says which folder holds
    a bucket now. An upsert stages its batch, reads and writes only the buckets that it touches, and then names them in a new version
    of the map, so a run that fails changes nothing. Replaced folders stay until the next change, for readers of the version before.
    Choose the number of buckets by the size of the store; a store keeps the number it was made with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self._buckets = spark, path.rstrip("/"), buckets
        self.map, self._files = Versions(spark, f"{self.path}/map"), Versions(spark, self.path)

    def _places(self) -> tuple[int, dict[int, str], StructType | None]:
        """The number of buckets, the folder of each that has rows, and the columns."""
        got = self.map.latest()
        rows = got.collect() if got is not None else []
        shape = StructType.fromJson(json.loads(rows[0]["columns"])) if rows else None
        return (rows[0]["buckets"] if rows else self._buckets), {r["bucket"]: r["folder"] for r in rows if r["folder"]}, shape

    def _read(self, folders: Iterable[str], shape: StructType) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(shape).parquet(*paths) if paths else self.spark.createDataFrame([], shape)

    def _replace(self, rows: DataFrame, touched: set[int], buckets: int, places: dict[int, str]) -> None:
        """Writes the rows as the touched buckets' new content; adaptive execution splits large buckets into several files."""
        new = f"data{(self.map.numbers() or [0])[-1] + 1}"
        rows.withColumn("bucket", _bucket(buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{new}")
        now = {b: f for b, f in places.items() if b not in touched} | {int(n[7:]): f"{new}/{n}" for n in self._files.names(new) if n.startswith("bucket=")}
        columns = rows.schema.json()
        self.map.write(self.spark.createDataFrame([(b, f, buckets, columns) for b, f in sorted(now.items())] or [(0, "", buckets, columns)], "bucket int, folder string, buckets int, columns string").coalesce(1))
        for data in self._files.names(""):
            if data.startswith("data"):
                for n in self._files.names(data):
                    if n.startswith("bucket=") and f"{data}/{n}" not in {*places.values(), *now.values()}:
                        self._files.delete(f"{data}/{n}")

    def upsert(self, events: DataFrame, seen_at: datetime) -> DataFrame:
        buckets, places, shape = self._places()
        staged = events.withColumn("identity", identity_key()).withColumn("bucket", _bucket(buckets))
        staged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/staged")
        touched = {int(n[7:]) for n in self._files.names("staged") if n.startswith("bucket=")}
        batch = self._read([f"staged/bucket={b}" for b in sorted(touched)], staged.drop("bucket").schema).drop("identity")
        old = self._read([f for b, f in places.items() if b in touched], shape) if shape else None
        self._replace(merge_events(old, batch, seen_at), touched, buckets, places)
        self._files.delete("staged")
        return self.all_events()

    def all_events(self) -> DataFrame | None:
        _, places, shape = self._places()
        return self._read(places.values(), shape) if shape else None

    def count(self) -> int:
        got = self.all_events()
        return got.count() if got is not None else 0

    def prune(self, cutoff: datetime | None = None, today: date | None = None) -> int:
        """How many rows went."""
        got = self.all_events()
        if got is None:
            return 0
        before = got.count()
        got = prune_unseen(got, cutoff) if cutoff is not None else got
        got = prune_past(got, today) if today is not None else got
        buckets, places, _ = self._places()
        self._replace(got, set(places), buckets, places)
        return before - self.count()


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("identity"), F.lit(buckets)).cast("int")


def latest_per(log: DataFrame, *keys: str, order: str = "seq") -> DataFrame:
    """[K9] Of an append-only log the last row of each key. An extension; the reference only plans it."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return log.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
