"""The corpus pipeline: stages over documents, each written as Parquet and read by the next.

A stage begins by removing what the stage before it has staged, whose result is written by then.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldkeep.llm import minhash, packing, secrets, suffixes, toxicity
from coldkeep.llm.common import Scratch, settled, table, tuned
from coldkeep.llm.queries import learning

#: What the stages have staged; only this is removed between them.
SCRATCH = Scratch()

#: Columns of documents besides the id and the text, which every stage but the last passes on.
PASSED = ("lang", "source", "n_chars")


def shaped(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents, with a new text and its length."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    with SCRATCH.renewed(spark):
        labels = table(spark, sf_dir, "labels")
        model = toxicity.learnt(learning(docs), learning(labels))
        scored = toxicity.score(docs, model, ("text", *PASSED))
        return scored.where(F.col("score") < toxicity.THRESHOLD).select("doc_id", "text", *PASSED)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each near-duplicate group, and every document in no group.

    Rows that repeat a doc_id are one document if their texts are equal, else all of them stay with
    their id; rows without an id can't be named, and stay.
    """
    with SCRATCH.renewed(spark):
        groups = minhash.near_duplicates(docs.where("doc_id is not null"))
        kept = docs.join(groups.where("kept").select("doc_id").distinct(), "doc_id", "left_semi")
        kept = kept.dropDuplicates(["doc_id", "text"])
        return kept.unionByName(docs.where("doc_id is null")).select("doc_id", "text", *PASSED)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start in a document of a smaller id as well."""
    with SCRATCH.renewed(spark):
        found = suffixes.repeated(docs, PASSED)
        return shaped(suffixes.readable(found), "text")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced."""
    with SCRATCH.renewed(spark):
        return shaped(secrets.find_secrets(docs, PASSED), "redacted")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    with SCRATCH.renewed(spark):
        return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("minhash", near_distinct),
    ("suffixes", without_repeats),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The stages use a trained model and numpy kernels; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tuned(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
