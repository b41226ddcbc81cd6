"""A training corpus from raw documents, in five stages.

Every stage works on all documents that the one before kept, and its decisions take
effect: toxic documents go, of near duplicates the first stays, repeated passages
are cut, secrets are replaced, and what is left is packed into training windows.
Stages before the last return the columns of ``documents``; each result is written as
Parquet under ``spark.checkpoint.dir`` and read again.

Of rows that repeat a ``doc_id`` all stay or all go. A row with a NULL ``doc_id`` is judged
by its text alone; it has no duplicates. NULL texts stay NULL until they are packed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.llm import minhash, packing, secrets, suffix_dedup, toxicity
from retail_lake.workspace import stage

#: Score from which a document is toxic.
LEAST_TOXIC = 0.7


def _counted(documents: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the texts, where there is such a column."""
    if "n_chars" not in documents.columns:
        return documents
    kind = documents.schema["n_chars"].dataType
    return documents.withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return docs.where(toxicity.score(F.col("text"), model) < LEAST_TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = minhash.cluster(docs).where("NOT kept").select(F.col("doc_id").alias("copy_id"))
    copies = stage(copies.distinct(), "copies").rows
    return docs.join(copies, docs["doc_id"] == copies["copy_id"], "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole characters of the bytes that are kept."""
    return _counted(suffix_dedup.without_repeats(docs))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(docs, secrets.fit(docs)))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.digests(packing.pack_documents(docs, path, public_tokenizers.PATTERN))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("secrets", replace_secrets),
    ("packing", pack_windows),
]
#: SQL can express neither the learned lexicon nor the tokenizer; tests/llm holds every
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, function in STAGES:
        written = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            before.discard()
        docs, before = written.rows, written
    return docs
