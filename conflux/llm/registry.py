"""The registered queries of the operators: production parameters, whole
tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (collision_ann, containment, fpe_pii, lang_mix, lattice_lm, link_trust, near_dedup,
               phrase_mining, piece_offsets, set_join, token_count, token_store, walsh_codes)

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The rules of the URL filter.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"))


def op2_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op3_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op4_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_rans_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: For checks only: whoever runs this on real data passes a secret of their own.
PII_KEY = b"not a secret: key of the registered checks"


def op6_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fpe_pii.pseudonyms(read(spark, sf_dir, "documents"), PII_KEY)


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_mix.held_out_identification(read(spark, sf_dir, "documents"))


def op8_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_texts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_piece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_offsets.encode_digests(read(spark, sf_dir, "documents"),
                                        public_tokenizers.path("piece_bpe_32k.model"))


def op11_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(read(spark, sf_dir, "documents"))


def op12_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walsh_codes.encode(read(spark, sf_dir, "embeddings"))


def op13_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.joined(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_counts, op2_prob_minhash, op3_link_trust, op4_collision_neighbours, op5_rans_store, op6_feistel_pii,
    op7_language_mixture, op8_contained_items, op9_subword_lattice, op10_piece_offsets,
    op11_toivonen_phrases, op12_walsh_codes, op13_set_relations)}

ORACLES: dict[str, str] = {"op3_link_trust": link_trust.oracle(URL_RULES)}
