"""One query per operator of this subpackage over the tables in TESTDATA.md."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from retail_lake.llm import (
    bpe,
    fingerprint,
    infill,
    minhash,
    packing,
    pages,
    quality,
    repetitions,
    secrets,
    sharding,
    suffix_dedup,
    toxicity,
    warc,
)
from retail_lake.llm.oracles import ORACLES

__all__ = ["ORACLES", "registered"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def op1_bpe(spark, sf):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(
        bpe.encode(documents(spark, sf), ranks, public_tokenizers.PATTERN, back=True)
    )


def op2_secrets(spark, sf):
    return secrets.digests(secrets.find(documents(spark, sf)))


def op3_toxicity(spark, sf):
    labels = spark.read.parquet(f"{sf.rstrip('/')}/labels.parquet")
    return toxicity.assess(documents(spark, sf), labels)


def op4_suffixes(spark, sf):
    return suffix_dedup.digests(suffix_dedup.find_repeats(documents(spark, sf)))


def op5_packing(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.digests(
        packing.pack_documents(documents(spark, sf), path, public_tokenizers.PATTERN)
    )


def op6_minhash(spark, sf):
    return minhash.cluster(documents(spark, sf))


def op7_pages(spark, sf):
    return pages.main_text(spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet"))


def op8_shards(spark, sf):
    return sharding.assign(documents(spark, sf))


def op9_fingerprints(spark, sf):
    return fingerprint.compare(documents(spark, sf))


def op10_quality(spark, sf):
    return quality.verdicts(quality.assess(documents(spark, sf)))


def op11_infill(spark, sf):
    return infill.digests(infill.restored(infill.transform(documents(spark, sf))))


def op12_warc(spark, sf):
    return warc.packed_and_read(spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet"))


def op13_runs(spark, sf):
    return repetitions.digests(
        repetitions.collapse_runs(documents(spark, sf), edit=repetitions.planted)
    )


def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)


_QUERIES = [
    op1_bpe,
    op2_secrets,
    op3_toxicity,
    op4_suffixes,
    op5_packing,
    op6_minhash,
    op7_pages,
    op8_shards,
    op9_fingerprints,
    op10_quality,
    op11_infill,
    op12_warc,
    op13_runs,
    pipeline,
]


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}
