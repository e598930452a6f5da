"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A document's expected number of copies is r = target / source size: floor(r) whole copies
are certain, and the fraction left over is its inclusion probability p. Documents are ranked by their random odds u / (1 - u)
divided by their inclusion odds p / (1 - p), and the sample of fixed size is what comes first in that order: documents are taken
until the words still wanted are used up, passing over those that no longer fit. As targets are for sources, p is the same for all
documents of a source; it differs between sources, so ranks can be compared across them.

The order is never sorted as a whole. The rank is mapped to (0, 1) and the place where the sample ends is found by radix
selection: word sums by coarse slot of the rank (pre-aggregated in each task, so a hot source costs no more than others), then by
fine slot within the one slot where the sum passes the target, then document by document within that fine slot.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, stored, word_count

#: Documents of a source, about, that are offered the words still wanted at once.
NEXT = 200
#: Slots of the rank at each of two levels: what a source's sums come in.
SLOTS = 256


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size, docs) -> with target: weights repeat over the sources by code point, null last; a target stops at
    cap * source_size and the excess goes to the others by weight until none is above. One row for each source meets in one
    task; documents never do."""
    by_name, n = Window.orderBy(F.col("source").asc_nulls_last()), len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % n + 1)
    s = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    everyone = Window.partitionBy()
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    s = (
        s.withColumn("total", F.sum("source_size").over(everyone))
        .withColumn("limits_before", F.sum("limit").over(by_limit) - F.col("limit"))
        .withColumn("weight_from", F.sum("weight").over(everyone) - F.sum("weight").over(by_limit) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("limits_before")) / F.col("weight_from"))
        .withColumn("capped", F.col("limit") <= F.col("weight") * F.col("level"))
    )
    level = F.min(F.when(~F.col("capped"), F.struct("limits_before", "level"))).over(everyone)["level"]
    return s.withColumn("target", F.when(F.col("capped"), F.col("limit")).otherwise(F.col("weight") * level)).select("source", "source_size", "docs", "target")


def _with(left: DataFrame, right: DataFrame, *also: str, small: bool, how: str = "inner") -> DataFrame:
    """left joined to a frame with a row or none for each source, on source (null equals null) and the columns `also`; the right
    side is broadcast if sources were counted to be few."""
    right = right.withColumnsRenamed({c: f"{c}__r" for c in ("source", *also)})
    on = F.lit(True)
    for c in ("source", *also):
        on = on & F.col(c).eqNullSafe(F.col(f"{c}__r"))
    return left.join(F.broadcast(right) if small else right, on, how).drop(*[f"{c}__r" for c in ("source", *also)])


def _ends(sums: DataFrame, slot: str) -> DataFrame:
    """sums(source, wanted, before, slot, words) -> for each source the first slot at which the running sum of words passes what
    is wanted, and the words before it."""
    run = F.sum("words").over(Window.partitionBy("source").orderBy(slot)) + F.col("before")
    over = sums.withColumn("run", run).filter(F.col("run") > F.col("wanted"))
    first = over.groupBy("source").agg(F.min_by(F.struct(slot, F.col("run") - F.col("words")), slot).alias("end"))
    return first.select("source", F.col("end")[slot].alias(slot), F.col("end.col2").alias("before"))


def _prefix(cand: DataFrame, small: bool) -> DataFrame:
    """cand(source, wanted, x, size) -> for each source the rank x before which all are taken, and their words `before`. Sources
    whose candidates all fit are absent."""
    cand = cand.withColumn("before", F.lit(0).cast("long"))
    for slot, rank in (("coarse", F.floor(F.col("x") * SLOTS)), ("fine", F.floor(F.col("x") * SLOTS * SLOTS)), ("x", F.col("x"))):
        sums = cand.withColumn(slot, rank).groupBy("source", "wanted", "before", slot).agg(F.sum("size").alias("words"))
        ends = _ends(sums, slot)
        if slot == "x":
            return ends
        # What is left is one slot of each source: the rank's next digit is looked at there alone.
        cand = _with(cand.drop("before").withColumn(slot, rank), ends, slot, small=small).select("source", "wanted", "before", "x", "size")


STATE = ("wanted", "left", "low", "at", "few", "stride")
FINISHED = "source string, wanted long, left long, low double, at double, few double, stride double, high double"


def _finish(rows: pd.DataFrame) -> pd.DataFrame:
    """The stretches of the rank (low to high, sizes up to wanted) in which a source's documents are taken, from the next documents
    in order: each is taken if it fits in the words left. The last stretch stays open (no high) unless words are few, or the order
    is at its end. Documents with the same rank are taken together."""
    told = rows[rows["n"] == 0].iloc[0]
    source, (wanted, left, low, at, few, stride) = told["source"], (told[c] for c in STATE)
    out, done = [], False
    for x, g in rows[rows["n"] > 0].groupby("x", sort=True):
        g = g[g["size"] <= wanted]
        words = int((g["size"] * g["n"]).sum())
        if words <= left:
            left -= words
            continue
        out.append((source, wanted, 0, low, 0.0, few, stride, x))
        wanted, low = left, x
        if done := left < few:
            break
    if not done:
        out.append((source, wanted, left, low, at + stride, few, stride, 2.0 if at + stride >= 1 else None))
    return pd.DataFrame(out, columns=[c.split()[0] for c in FINISHED.split(", ")]).astype({"wanted": "int64", "left": "int64"})


def random_number(doc_id: Column, seed: int) -> Column:
    """Between 0 and 1, from a hash of the id."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def _sampler(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], cap: float, seed: int, tolerance: float):
    """A function that adds source_size, target and copies to a frame with id, source, size and u."""
    keyed = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), random_number(F.col(id_col), seed).alias("u")]
    base = stored(docs.select(*keyed), "mix-sizes")
    targets = stored(source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), weights, cap), "mix-targets")
    small = targets.count() <= BROADCAST_ROWS

    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.withColumn("whole", F.floor(ratio + F.lit(1e-9))).withColumn("p", F.greatest(ratio - F.col("whole"), F.lit(0.0)))
    t = t.withColumn("wanted", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    odds = F.col("u") / (1 - F.col("u")) / (F.col("p") / (1 - F.col("p")))

    def ranked(rows: DataFrame) -> DataFrame:
        return _with(rows, t, small=small, how="left").withColumn("x", F.when(F.col("p") > 0, odds / (1 + odds)))

    # How far the rank goes on, at the place where a sample ends (one half, or nearly), until NEXT more documents have come.
    stride = F.lit(float(NEXT)) / F.greatest(F.lit(1.0), 4 * F.col("p") * (1 - F.col("p")) * F.col("docs"))
    few = F.greatest(F.lit(1.0), F.col("target") * F.lit(tolerance))
    start = stored(t.filter("wanted > 0").select("source", "wanted", F.lit(-1.0).alias("low"), few.alias("few"), stride.alias("stride")), "mix-start")
    sized = ranked(base).drop("wanted").filter("x is not null and size > 0")
    ends = _prefix(_with(sized, start, small=small).filter("size <= wanted").select("source", "wanted", "x", "size"), small).withColumnRenamed("x", "high")
    # Up to the document at `high` all that fit are taken; it doesn't, and the rest is offered to those behind it.
    first = stored(_with(start, ends, small=small, how="left"), "mix-first")
    steps = [first.select("source", "wanted", "low", F.coalesce("high", F.lit(2.0)).alias("high"))]
    left = F.col("wanted") - F.col("before")
    state = first.filter("high is not null").select("source", left.alias("wanted"), left.alias("left"), F.col("high").alias("low"), F.col("high").alias("at"), "few", "stride").filter("left >= few")
    while not (state := stored(state, "mix-state")).isEmpty():
        near = _with(sized, state, small=small).filter("size <= wanted and x > at and x <= at + stride").groupBy("source", "x", "size").agg(F.count("*").alias("n"))
        rows = near.select("source", "x", "size", "n").withColumns({c: F.lit(None).cast("double") for c in STATE})
        told = state.withColumns({"x": F.lit(-1.0), "size": F.lit(0).cast("long"), "n": F.lit(0).cast("long")}).withColumns({c: F.col(c).cast("double") for c in STATE})
        done = stored(rows.unionByName(told.select(*rows.columns)).groupBy("source").applyInPandas(_finish, FINISHED), "mix-finish")
        steps.append(done.filter("high is not null").select("source", "wanted", "low", "high"))
        state = done.filter("high is null").select("source", "wanted", "left", "low", "at", "few", (2 * F.col("stride")).alias("stride"))
    takes = reduce(DataFrame.unionByName, steps).groupBy("source").agg(F.collect_list(F.struct("wanted", "low", "high")).alias("takes"))

    def sampled(rows: DataFrame | None = None) -> DataFrame:
        out = ranked(base if rows is None else rows)
        fits = F.exists("takes", lambda t: (F.col("size") <= t["wanted"]) & (F.col("x") > t["low"]) & (F.col("x") < t["high"]))
        copies = F.col("whole") + F.coalesce(fits & (F.col("size") > 0), F.lit(False)).cast("long")
        return _with(out, takes, small=small, how="left").withColumn("copies", copies)

    return keyed, sampled


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    cap: float = 3.0,
    seed: int = 20240229,
    tolerance: float = 0.001,
) -> DataFrame:
    """One row per row of docs: id_col, source, size, source_size, target, copies, taken (= copies * size).

    Random numbers come from a hash of the id, so reruns agree and a recomputed task gives the same rows. Rows with equal ids (or
    null ones) have the same rank; equal ids, sources and sizes share their fate, each row counting. Null or empty texts have size
    0; they get the whole copies alone and take no words. A null source is a source. An empty table gives no rows. The words still
    wanted are offered again to the documents that come after the one that didn't fit, until they are less than `tolerance` of the
    source's target, or nothing fits; so a source falls short by less than that, or than its smallest document passed over.
    """
    _, sampled = _sampler(docs, id_col, text_col, source_col, weights, cap, seed, tolerance)
    out = sampled().select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies")
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    cap: float = 3.0,
    seed: int = 20240229,
    tolerance: float = 0.001,
) -> DataFrame:
    """The mix itself: docs with each row repeated as often as mix() takes it (not at all for 0), with the columns of docs. Each
    row's copies follow from its own id, source and size, so rows with equal ids don't touch each other."""
    keyed, sampled = _sampler(docs, id_col, text_col, source_col, weights, cap, seed, tolerance)
    rows = docs.select(*keyed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = sampled(rows).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("n"))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
