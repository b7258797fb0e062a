"""The corpus pipeline: language ID, line dedup, near dedup, decontamination, BPE round trip, over the table documents.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with the columns of documents; the last
one returns the documents' token counts and digests. Stages are deterministic, so a stage may be run again
from the table that the one before wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.bpe import encode_decode
from plumbline.llm.decontam import without_leaks
from plumbline.llm.langid import identify, learn
from plumbline.llm.simhash import near_components
from plumbline.llm.store import materialize, table
from plumbline.llm.templates import drop_recurring_lines


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no known language: null texts and those without a letter. The prediction replaces a null lang."""
    told = identify(docs, learn(docs)).where("lang_pred <> 'und'")
    lang = F.coalesce("lang", "lang_pred")
    return told.select(*[lang.alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; the first document by id keeps them. n_chars follows the text. Every document stays."""
    out = drop_recurring_lines(docs)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similarity 0.8 or more, by shingles of five words, that of the smallest id stays; of its rows with equal text one. Documents without id all stay."""
    found = near_components(docs.where("doc_id is not null"))
    ids = found.groupBy("doc_id").agg(F.min(F.col("doc_id") - F.col("component_id")).alias("off"), F.count("*").alias("rows")).where("off = 0")
    # Ids of one row, which are nearly all, need no look at other rows; of the rest, rows with equal text become one.
    one = docs.join(ids.where("rows = 1").select("doc_id"), "doc_id", "left_semi")
    several = docs.join(ids.where("rows > 1").select("doc_id"), "doc_id", "left_semi").withColumn("__body", F.xxhash64("text")).dropDuplicates(["doc_id", "__body"])
    return one.unionAll(several.select(docs.columns)).unionAll(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    return encode_decode(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("bpe", bpe)]

#: SQL can't express language ID by cross-parsing, nor byte-level BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
