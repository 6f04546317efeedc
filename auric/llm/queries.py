"""The registered queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm import bpe, decontaminate, language, lm_score, near_dup, phrases, pii, quality, resample, sharding, token_count, topk, toxicity


def tokenizer(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=4).drop("text_hash")  # its contract has four words


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_score.score(docs, lm_score.fit(docs))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, machine).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    return language.identify(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", F.col("score"))


#: The key of the registered query; a real run passes its own.
QUERY_KEY = "surrogates of the registered query"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, QUERY_KEY).withColumn("n_entities", F.size("pii_kinds"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_near_dups": op1_near_dups,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_count": op3_token_count,
    "op4_shards": op4_shards,
    "op5_bpe": op5_bpe,
    "op6_topk": op6_topk,
    "op7_lm_score": op7_lm_score,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_pii": op10_pii,
    "op11_phrases": op11_phrases,
    "op12_quality": op12_quality,
    "op13_resample": op13_resample,
}

ORACLE_SQL = {
    "op1_near_dups": near_dup.SQL,
    "op2_decontaminate": decontaminate.SQL,
    "op6_topk": topk.SQL,
    "op11_phrases": phrases.SQL,
    "op13_resample": resample.SQL,
}
