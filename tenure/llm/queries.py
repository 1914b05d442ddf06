"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenure.llm import crosstok, langid, mixing, pieces, pitman_yor, quality, repeats, sharding, simhash, toxicity, whitening, winnowing, wrappers
from tenure.llm.common import documents, labels

SHARDS = 24
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir), [1.0] * SHARDS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(documents(spark, sf_dir))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir), PIECE_MODEL)


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_documents(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir), labels(spark, sf_dir))[0]


def op11_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(documents(spark, sf_dir))


def op12_crosstok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align_documents(documents(spark, sf_dir), BYTE_MODEL, PIECE_MODEL)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_language": op3_language,
    "op4_repeats": op4_repeats,
    "op5_pieces": op5_pieces,
    "op6_wrappers": op6_wrappers,
    "op7_winnowing": op7_winnowing,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_pitman_yor": op11_pitman_yor,
    "op12_crosstok": op12_crosstok,
    "op13_whitening": op13_whitening,
}
