"""The corpus pipeline: raw documents in, encoded clean documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next one's docs. All stages but the last
return the columns of ``documents``:

1. ``language``: documents without a language go (null text, no letter);
2. ``near_dedup``: one document of each class of near-duplicates stays;
3. ``decontaminate``: documents that contain a benchmark item go;
4. ``private``: personal data becomes pseudonyms, ``n_chars`` follows;
5. ``pieces``: ids, byte spans and decoded text, as digests for each document.

Null or repeated ids, clashing or further columns and empty tables pass
through; see each operator for its defined results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from conflux.llm import containment, fpe_pii, lang_mix, near_dedup, piece_offsets
from conflux.llm.registry import PII_KEY
from conflux.session import new_path, staging


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_mix.with_language(docs, lang_mix.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return containment.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fpe_pii.replace_text(docs, PII_KEY, length_col="n_chars" if "n_chars" in docs.columns else None)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_offsets.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language", language), ("near_dedup", near_duplicates), ("decontaminate", benchmark_free),
          ("private", pseudonyms), ("pieces", pieces)]

#: SQL can't express the language, near-dedup, pseudonym and encoding stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table. What a stage has staged for
    itself goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        with staging(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
