"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept, as a table in the shared
folder, and all but the last return documents with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import decontaminate, doubling, packing, simhash, subwords
from tagloom.llm.queries import REJECT_BELOW, quality_model, table
from tagloom.llm.tokens import vocabulary
from tagloom.sources.sinks import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; the score of an unlabelled document counts as any other."""
    name = "_".join([*docs.columns, "score"])  # longer than any, so that no name of theirs can clash
    scored = subwords.score(docs, quality_model(spark, sf_dir), keep=tuple(docs.columns), name=name)
    return scored.filter(F.col(name) >= REJECT_BELOW).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return simhash.keep_first(docs, shingle=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words in runs of 20 that start earlier elsewhere; a text may become empty."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    rest = F.struct(F.lit(0).alias("_"), *others).alias("rest")  # one column, so that no name of theirs can clash
    found = doubling.remove_repeats(docs.select("doc_id", "text", rest), width=20, keep=("rest",), layout=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*[new.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are in benchmark windows."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=13)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences."""
    return packing.pack_documents(packing.token_counts(docs, vocabulary()))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained classifier is no SQL; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
