"""Secret scans through a trigram inverted index, with built-in functions only.

From each rule's regular expression follows a Boolean query over trigrams that every match must contain: alternatives (clauses) of
trigrams that must all occur. The index holds, for each block of documents and each trigram that some query names, the ids of the
documents with that trigram. A clause's postings are intersected, the clauses' results united, and only documents found so are
verified with the expression itself. A rule without mandatory trigrams (a bare run of hexadecimal digits) scans every text.

Blocks are by a hash of the id and hold BLOCK_DOCS ids or so, which bounds every posting list and intersection.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stored

BLOCK_DOCS = 50_000


@dataclass(frozen=True)
class Rule:
    """kind; pattern (valid in Java, Python and RE2, ASCII letters only); the group whose length counts, and its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    base: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


#: The base rules, in the order in which they are listed in results.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, any_case=True, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, base=True),
    Rule("hex", r"[0-9a-f]+", 0, 32, base=True),
)
#: Further kinds of secrets, by their public formats.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
#: Sets of strings above this size are not followed further; that only weakens a query.
MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Clauses of lower-case trigrams, one of which must be wholly present in any lower-cased match; None: no such demand."""
    tree = re._parser.parse(pattern)
    demands: list[list[frozenset[str]]] = []

    def demand(strings: set[str]) -> None:
        if strings and min(map(len, strings)) >= 3:
            demands.append([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])

    def chars(items: Sequence) -> set[str] | None:
        out: set[str] = set()
        for op, arg in items:
            if str(op) == "LITERAL":
                out.add(chr(arg).lower())
            elif str(op) == "RANGE" and arg[1] - arg[0] < MOST_STRINGS:
                out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
            else:
                return None
        return out if len(out) <= 5 else None

    def exact(node: Sequence) -> set[str] | None:
        """All strings that a node matches, lower-cased, if they are few."""
        out = {""}
        for op, arg in node:
            name = str(op)
            if name == "LITERAL":
                part = {chr(arg).lower()}
            elif name == "IN":
                part = chars(arg)
            elif name == "SUBPATTERN":
                part = exact(arg[3])
            elif name == "BRANCH":
                parts = [exact(x) for x in arg[1]]
                part = None if None in parts else set().union(*parts)
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 3:
                one, part = exact(arg[2]), set()
                for n in range(arg[0], arg[1] + 1):
                    if one is None or len(one) ** n > MOST_STRINGS:
                        part = None
                        break
                    reps = {""}
                    for _ in range(n):
                        reps = {a + b for a in reps for b in one}
                    part |= reps
            else:
                part = None
            if part is None or len(out) * len(part) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in part}
        return out

    now = {""}
    for item in tree:
        part = exact([item])
        if part is not None and len(now) * len(part) <= MOST_STRINGS:
            now = {a + b for a in now for b in part}
        else:
            demand(now)
            now = part or {""}
    demand(now)
    if not demands:
        return None
    clauses = {frozenset()}
    for d in demands:
        if len(clauses) * len(d) <= MOST_STRINGS:
            clauses = {a | b for a in clauses for b in d}
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def build_index(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, trigram, ids): the inverted index over the trigrams that the rules' queries name, stored in the shared folder."""
    wanted = sorted({t for r in rules for c in trigram_query(r.pattern) or () for t in c})
    blocks = max(1, math.ceil(docs.count() / BLOCK_DOCS))
    low = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    posts = low.select("id", F.explode(has).alias("trigram"))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    # Ids are told apart from a null id by the struct, which collect_set keeps.
    return stored(posts.groupBy(block.alias("block"), "trigram").agg(F.collect_set(F.struct("id")).alias("ids")), "trigrams")


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(id, kinds): documents in which a rule with a trigram query may match, by intersecting postings."""
    spark = index.sparkSession
    rows = [(r.kind, n, t, len(c)) for r in rules for n, c in enumerate(trigram_query(r.pattern) or ()) for t in sorted(c)]
    clauses = spark.createDataFrame(rows, "kind string, clause int, trigram string, need int")
    lists = index.join(F.broadcast(clauses), "trigram").groupBy("block", "kind", "clause", "need").agg(F.collect_list("ids").alias("lists"))
    both = F.aggregate(F.slice("lists", 2, F.greatest(F.size("lists"), F.lit(1))), F.get("lists", F.lit(0)), lambda a, b: F.array_intersect(a, b))
    found = lists.filter(F.size("lists") == F.col("need")).select("kind", F.explode(both).alias("hit"))
    return stored(found.groupBy(F.col("hit.id").alias("id")).agg(F.collect_set("kind").alias("kinds")), "trigram-hits")


#: Matches whose places are added up at once; a sum that carries on over more would copy its list too often.
AT_ONCE = 256


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind_order, kind, end>> of leftmost non-overlapping matches whose group is long enough; code points.

    Positions add up what split() leaves between the matches and the matches themselves: within chunks of AT_ONCE matches, and over
    the chunks' lengths, so that a text with very many matches takes time in proportion."""
    kind = F.struct(F.lit(0).alias("start"), F.lit(order).alias("kind_order"), F.lit(rule.kind).alias("kind"), F.lit(0).alias("end"))
    none = F.filter(F.array(kind), lambda x: F.lit(False))
    p = F.lit(rule.java)
    rows = F.arrays_zip(F.split(text, rule.java, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit"), F.regexp_extract_all(text, p, F.lit(rule.group)).alias("part"))
    rows = F.filter(rows, lambda r: r["hit"].isNotNull())
    rows = F.transform(rows, lambda r: F.struct(F.length(r["gap"]).alias("gap"), F.length(r["hit"]).alias("hit"), (F.length(r["part"]) >= rule.least).alias("counts")))
    # rows is named by a lambda, or it would be computed anew for each chunk.
    chunked = lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.size(x) - 1, F.lit(0)), F.lit(AT_ONCE)), lambda i: F.slice(x, i + 1, AT_ONCE))

    def carry(acc: Column, chunk: Column) -> Column:
        length = F.aggregate(chunk, F.lit(0), lambda n, r: n + r["gap"] + r["hit"])
        return F.struct((acc["at"] + length).alias("at"), F.concat(acc["done"], F.array(F.struct(acc["at"].alias("at"), chunk.alias("chunk")))).alias("done"))

    def add(acc: Column, r: Column) -> Column:
        start = acc["at"] + r["gap"]
        end = start + r["hit"]
        new = F.struct(start.alias("start"), F.lit(order).alias("kind_order"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(r["counts"], F.concat(acc["found"], F.array(new))).otherwise(acc["found"]).alias("found"))

    unplaced = F.expr("cast(array() as array<struct<at:int,chunk:array<struct<gap:int,hit:int,counts:boolean>>>>)")
    placed = lambda x: F.aggregate(chunked(x), F.struct(F.lit(0).alias("at"), unplaced.alias("done")), carry, lambda acc: acc["done"])
    within = lambda c: F.aggregate(c["chunk"], F.struct(c["at"].alias("at"), none.alias("found")), add, lambda acc: acc["found"])
    found = F.flatten(F.flatten(F.transform(F.array(rows), lambda x: F.transform(placed(x), within))))
    return F.when(F.rlike(text, p), found).otherwise(none)


def _scanned(rule: Rule) -> Rule:
    """The same rule with the least length in the expression, where that cannot change what is found: a pattern that is one
    greedy run of a class, perhaps after a literal, matches each maximal run whole."""
    m = re.fullmatch(r"(\w*)(\[[^\]]+\])\+", rule.pattern)
    if m and rule.group == 0 and rule.least > len(m[1]) + 1 and re.fullmatch(f"{m[2]}*", m[1]):
        return Rule(rule.kind, f"{m[1]}{m[2]}{{{rule.least - len(m[1])},}}", 0, rule.least, rule.any_case, rule.base)
    return rule


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with a column `secrets`: array<struct<start, kind_order, kind, end>> by start, then order of the rules.

    A null or empty text has none. Equal or null ids share candidates, which verification sorts out. All other columns stay, but
    for one named secrets, which is replaced."""
    hits = candidates(build_index(docs, rules, id_col, text_col), rules).select(F.col("id").alias("__hit_id"), F.col("kinds").alias("__kinds"))
    joined = docs.drop("secrets").join(broadcast_if_small(hits), F.col(id_col).eqNullSafe(F.col("__hit_id")), "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = []
    for n, r in enumerate(rules):
        spans = _spans(text, _scanned(r), n)
        if trigram_query(r.pattern):
            spans = F.when(F.array_contains("__kinds", r.kind), spans)
        parts.append(F.coalesce(spans, F.expr("cast(array() as array<struct<start:int,kind_order:int,kind:string,end:int>>)")))
    return joined.withColumn("secrets", F.array_sort(F.concat(*parts))).drop("__hit_id", "__kinds")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
