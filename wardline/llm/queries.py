"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (codes, decontaminate, htmltext, langid, lmscore, oracles, packing, pii, sharding, simhash,
                          toxicity, trie, vptree, warc)
from wardline.llm.tables import read


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, radius=4)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(read(spark, sf_dir, "pages"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op6_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, factor=1.0)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, sf_dir)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


def op9_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_against(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), shards=40, overhead=16)


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"), block=100, heads=6)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_html": op4_html,
    "op5_langid": op5_langid,
    "op6_vptree": op6_vptree,
    "op7_warc": op7_warc,
    "op8_pii": op8_pii,
    "op9_lmscore": op9_lmscore,
    "op10_decontaminate": op10_decontaminate,
    "op11_sharding": op11_sharding,
    "op12_trie": op12_trie,
    "op13_codes": op13_codes,
}

ORACLES: dict[str, str] = {
    "op6_vptree": oracles.nearest_sql(5, 50),
    "op7_warc": oracles.warc_sql(),
    "op8_pii": oracles.pii_sql(),
    "op12_trie": oracles.trie_sql(),
    "op13_codes": oracles.codes_sql(),
}
