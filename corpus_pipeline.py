"""The corpus pipeline: documents in, token files out, in five stages, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents; the last returns what reading its token files back gives (doc_id, start, n_tokens, ids_crc32).

In all stages rows are whole: other columns, whatever their names, go along unchanged, and an empty table gives an empty one. Each
stage's docstring says what becomes of nulls, empty and very long texts, ties and repeated rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fairlead.llm import decontaminate, jaccard, mixing, tokens, toxicity
from fairlead.llm.common import delete, passing, shared_dir
from fairlead.llm.queries import table, tokenizer


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the kernel machine, trained on the labelled ones, doesn't call toxic (a score below one half).

    Null and empty texts stay, as no word speaks against them. Long texts are read whole. Each row is judged by its own text, so
    repeated rows stay or go together and a null doc_id makes no difference. With too few labels to learn from all stay."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by a likeness of 0.8 or more over shingles of five words.

    Null texts and texts without words are linked with nothing and stay. Texts shorter than a shingle are compared as a whole, long
    ones with all their shingles. Of rows equal in id and text one stays; rows with one id and different texts stay or go together;
    rows with a null id stay."""
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none and stay; long texts are searched whole. Each row is judged by its own text, so repeated rows stay
    or go together and a null doc_id makes no difference; so does an item's null id. An empty benchmark lets all stay."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, sources weighing 1, 2 and 3 in turn.

    A null source is a source, the last. Null and empty texts have no words: they get the copies that are certain. A long text that
    no longer fits is passed over. Rows with equal (or null) ids have the same rank, and equal ranks are taken together or not."""
    return mixing.mixed_documents(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the packed token files of all documents hold, a row for each.

    Null and empty texts are the end id alone; long ones are encoded whole. Repeated ids follow each other by text, each with a row
    of its own; a null id comes first and reads back as the smallest long."""
    return tokens.token_files(docs, tokenizer(), 49_408, end_id=1)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token ids", as_tokens),
]

#: SQL can express neither the kernel machine nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage has stored on its way, and what it read, goes once its result is written; the last
    result (and nothing else) stays in the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        with passing(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
