"""Enrichment by an injected client, with a cache and a gate; what the client can't answer falls back to keyword rules."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..functions.identity import content_hash, identity_hash
from ..functions.text import blob
from ..schema import overlaid

#: [E8, M5] Fields of a reply, all of which must be there: recovered ones may be null, classified ones and the verdict may not.
RECOVERED = {"start": "timestamp_ntz", "end": "timestamp_ntz", "all_day": "boolean", "location": "string", "cost": "string", "registration_url": "string"}
CLASSIFIED = {"areas_of_interest": "array<string>", "age_grade_level": "array<string>", "cost_range": "string", "time_of_day": "array<string>"}
REPLY = "struct<" + ",".join([f"`{n}`:{t}" for n, t in (RECOVERED | CLASSIFIED).items()] + ["relevant:boolean", "relevance_reason:string"]) + ">"
#: Fields of an event that the client is told.
ASKED = ("title", "description", "start", "end", "all_day", "location", "cost", "registration_url", "categories", "tags")
MODEL_CONFIDENCE, RULE_CONFIDENCE = 0.7, 0.3


#: [E8] Values that a classified field may take, where they are fixed.
VOCABULARY = {
    "areas_of_interest": [*[label for _, label in taxonomy.AREAS], "General Science"], "age_grade_level": [label for _, label in taxonomy.AGES],
    "cost_range": ["Free", *[label for _, label in taxonomy.COST_CAPS], "Greater than $200"], "time_of_day": ["Morning", "Afternoon", "Evening", "All Day"],
}


def reply_schema() -> dict:
    """[E8, M5] The JSON schema of a reply."""
    text, verdict = {"type": "string"}, {"relevant": {"type": "boolean"}, "relevance_reason": {"type": "string"}}
    fields = {n: {"type": ["boolean" if t == "boolean" else "string", "null"]} for n, t in RECOVERED.items()} | verdict
    for n, t in CLASSIFIED.items():
        fields[n] = {"type": "array", "items": text | {"enum": VOCABULARY[n]}} if t.startswith("array") else text | {"enum": [*VOCABULARY[n], ""]}
    return {"type": "object", "properties": fields, "required": list(fields), "additionalProperties": False}


def instructions(audience: str = "school-age youth", subject: str = "science, technology, engineering or mathematics") -> str:
    """[E8] What a model is told before the records."""
    values = "\n".join(f"- {n}: {'any of' if CLASSIFIED[n].startswith('array') else 'one of, or empty:'} {', '.join(v)}" for n, v in VOCABULARY.items())
    return (
        f"You check records of a directory of chances to learn {subject} for {audience}. Each record is JSON.\n"
        f"Fill in {', '.join(RECOVERED)} where null, if the title or description says it; otherwise leave null. Invent nothing and keep what is given. Times are ISO 8601.\n"
        f"Classify the record:\n{values}\n"
        "Set relevant to whether it belongs in the directory, and relevance_reason to one short sentence that says why. Reply with the JSON object alone."
    )


def question(record: dict) -> str:
    """[E8] What a model is told of one record, as `ask` passes it to the client."""
    return json.dumps(record, indent=1, ensure_ascii=False)


def _is_time(text: str) -> bool:
    try:
        return bool(datetime.fromisoformat(text))
    except ValueError:
        return False


def valid_reply(text: str | None) -> str | None:
    """[M6] The reply if it is an object with every field, of the right types, and readable times; else nothing."""
    try:
        d = json.loads(text or "")
    except ValueError:
        return None
    if not isinstance(d, dict) or not {*RECOVERED, *CLASSIFIED, "relevant", "relevance_reason"} <= d.keys():
        return None
    fits = {
        "string": lambda v: isinstance(v, str),
        "boolean": lambda v: isinstance(v, bool),
        "timestamp_ntz": lambda v: isinstance(v, str) and _is_time(v),
        "array<string>": lambda v: isinstance(v, list) and all(isinstance(x, str) for x in v),
    }
    needed = CLASSIFIED | {"relevant": "boolean", "relevance_reason": "string"}
    return text if all(fits[t](d[n]) for n, t in needed.items()) and all(d[n] is None or fits[t](d[n]) for n, t in RECOVERED.items()) else None


def ask(events: DataFrame, client: Callable[[dict], str]) -> DataFrame:
    """[E1, V5] (identity, content_hash, reply) from the client (a record with ASKED in, null where unknown; JSON text out), many
    rows at once over the cluster; reply is null where it failed or answered badly."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            replies = []
            for record in b["record"]:
                try:
                    replies.append(valid_reply(client(json.loads(record))))
                except Exception:  # noqa: BLE001  a client may fail in any way; the row falls back
                    replies.append(None)
            yield pd.DataFrame({"identity": b["identity"], "content_hash": b["content_hash"], "reply": replies})

    known = [F.nullif(F.col(n), F.lit("")).alias(n) if n in ("location", "cost", "registration_url") else F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss").alias(n) if n in ("start", "end") else F.col(n) for n in ASKED]
    return events.select("identity", "content_hash", F.to_json(F.struct(*known), {"ignoreNullFields": "false"}).alias("record")).mapInPandas(f, "identity string, content_hash string, reply string")


def keyed(events: DataFrame) -> DataFrame:
    """[E4] Keys are of the content before it is enriched."""
    return events.withColumn("identity", identity_hash()).withColumn("content_hash", content_hash())


def misses(events: DataFrame, cache: DataFrame) -> DataFrame:
    """[J3, K6] Keyed events, internships apart, that the cache doesn't have with this content."""
    return events.filter("kind <> 'internship'").join(cache.select("identity", "content_hash"), ["identity", "content_hash"], "left_anti")


def apply_replies(events: DataFrame, replies: DataFrame) -> DataFrame:
    """[E2, E3, J3] Keyed events with what the replies say. Recovered fields only where given; without a reply, keyword rules classify
    and the event counts as relevant. Internships stay as they are."""
    r = replies.filter("reply is not null").dropDuplicates(["identity", "content_hash"]).select("identity", "content_hash", F.from_json("reply", REPLY).alias("r"))
    e = events.join(r, ["identity", "content_hash"], "left")
    job, got = F.col("kind") == "internship", F.col("r").isNotNull()
    text = blob("title", "description", "categories", "tags")
    derived = {"areas_of_interest": taxonomy.areas_of_interest(text), "age_grade_level": taxonomy.age_grade_level(text), "cost_range": taxonomy.cost_range("cost"), "time_of_day": taxonomy.time_of_day("start", "all_day")}
    new = {n: F.when(~job & got, F.coalesce(F.col(f"r.{n}"), F.col(n))).otherwise(F.col(n)) for n in RECOVERED}
    new |= {n: F.when(job, F.col(n)).when(got, F.col(f"r.{n}")).otherwise(d) for n, d in derived.items()}
    new["relevant"] = F.when(job, F.col("relevant")).when(got, F.col("r.relevant")).otherwise(F.lit(True))
    new["relevance_reason"] = F.when(~job & got, F.col("r.relevance_reason")).otherwise(F.col("relevance_reason"))

    def note(n: str, source: str, confidence: float):
        return F.struct(F.lit(n).alias("key"), F.struct(F.lit(source).alias("source"), F.lit(confidence).alias("confidence")).alias("value"))

    told = [F.when(got & F.col(f"r.{n}").isNotNull(), note(n, "llm", MODEL_CONFIDENCE)) for n in RECOVERED]
    told += [F.when(got, note(n, "llm", MODEL_CONFIDENCE)).otherwise(note(n, "taxonomy", RULE_CONFIDENCE)) for n in CLASSIFIED]
    notes = F.map_from_entries(F.array_compact(F.array(*told)))
    new["field_provenance"] = F.when(job, F.col("field_provenance")).otherwise(overlaid("field_provenance", notes))
    return e.withColumns(new).drop("r", "identity", "content_hash")


def gate(events: DataFrame) -> DataFrame:
    """[E5, E6, V7] Without what is known to be irrelevant, unless trusted; an unknown verdict passes."""
    return events.filter(F.col("trusted") | ~F.col("relevant").eqNullSafe(F.lit(False)))


def enrich(events: DataFrame, cache: DataFrame, client: Callable[[dict], str] | None) -> tuple[DataFrame, DataFrame]:
    """[E1-E6] (events that pass, the cache with new replies). Failed replies aren't cached."""
    k = keyed(events)
    fresh = ask(misses(k, cache), client) if client else cache.limit(0)
    replies = cache.select("identity", "content_hash", "reply").unionByName(fresh.filter("reply is not null").select("identity", "content_hash", "reply"))
    return gate(apply_replies(k, replies)), replies


def gate_candidates(candidates: DataFrame, gated: DataFrame) -> DataFrame:
    """[E7, J9] Candidates whose synthetic events passed the gate, by identity."""
    return candidates.join(gated.select("identity").distinct(), "identity", "left_semi")
