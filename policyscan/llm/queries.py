"""The operators of this subpackage as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policyscan.llm import (
    embedding_dedup,
    line_dedup,
    minhash,
    mixing,
    packing,
    pii,
    quality_rules,
    ranked_search,
    sentencepiece_codec,
    sharding,
    toxicity,
    url_rules,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filtered(table(spark, sf_dir, "pages"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it (the word mark reads as a blank)."""
    model = sentencepiece_codec.Model.load()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.col("decoded").eqNullSafe(F.replace("text", F.lit(sentencepiece_codec.MARK), F.lit(" "))).alias("round_trip"),
        "ids",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_rules": op3_url_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_toxicity": op6_toxicity,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_minhash": op9_minhash,
    "op10_pii": op10_pii,
    "op11_ranked_search": op11_ranked_search,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_embedding_dedup": embedding_dedup.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
}
