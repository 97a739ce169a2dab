"""A training-corpus pipeline: each stage works on all that the one before it kept.

A filtering stage decides row by row: rows are told apart by a hash of id and text, so a null id is a document of its own and
a row is not drawn along by another one with its id. Rejected rows are stored, so that the plan knows their size: a small
table goes to every task, a large one is joined by key. Only line dedup and near duplicates, whose decisions are about
documents, go by id there; rows with a null id are no document, and stay. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.llm.bpe import bpe_encode
from cinderspark.llm.decontaminate import ask_index, build_index
from cinderspark.llm.jaccard_join import jaccard_components
from cinderspark.llm.language import fit_languages, predict_languages, rejected
from cinderspark.llm.line_dedup import dedup_texts
from cinderspark.sources.tables import drop, scratch, written

KEY = "row_key"
#: Characters of a block in the last stage, whose workers come after all others' in an executor's memory.
BLOCK_CHARS = 2_000_000


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*docs.columns, F.xxhash64("doc_id", "text").alias(KEY))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` but those with one of the ``keys`` (column ``doc_id``)."""
    gone = written(keys.select(F.col("doc_id").alias(KEY)).distinct(), "rejected")
    return _keyed(docs).join(gone, KEY, "left_anti").select(*docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told from their text: no letter, or no codeword near enough, and a document goes."""
    model = fit_languages(docs)
    found = predict_languages(_keyed(docs), model, id_col=KEY)
    return _without(docs, found.where(rejected(found)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them only; a document that keeps no text goes."""
    kept = dedup_texts(docs).where("n_dropped = 0 or text <> ''")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the smallest id stays."""
    groups = jaccard_components(docs, width=5, num=80, den=100)
    gone = written(groups.where("doc_id <> component_id").select("doc_id").distinct(), "rejected")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any benchmark window go: one of 13 words is enough, however long the document."""
    found = ask_index(build_index(_keyed(docs), id_col=KEY), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where("n_hit > 0"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each remaining text, and the digest of what they decode to: ``doc_id, n_tokens, ids, decoded_sha256``."""
    both = bpe_encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decode=True, most_chars=BLOCK_CHARS)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_passages),
    ("bpe", encode),
]

#: The first stage is a trained classifier, which SQL can't express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; a stage's input and working tables go when its output is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch() as kept:
            after = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            kept.append(after)
        if hasattr(docs, "written_at"):
            drop(docs)
        docs = after
    return docs
