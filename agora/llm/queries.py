"""Queries of the operators over the whole given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import (bpe, ctw, decontaminate, fertility, langid, lexical, ngram_join, pii,
                       prefix_trie, quality_mil, sharding, substring_dedup, url_filter)
from agora.llm.common import documents, remainder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.overlaps(documents(spark, sf_dir), benchmark).drop("row")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = bpe.read_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    return bpe.digests(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> quality_mil.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_mil.learn(docs, labels, remainder(F.col("doc_id"), 4) != 2)


def op5_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = quality_mil.score(docs, quality_model(docs, spark, sf_dir))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_passages")


def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    ranks = bpe.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    return fertility.rules(documents(spark, sf_dir), model, ranks, public_tokenizers.PATTERN)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir), words=4, percent=85)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir), shards=24)
    return placed.select("doc_id", (F.col("size") + 8).alias("size"), "text_crc32",
                         F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")


URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.score(documents(spark, sf_dir), remainder(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                        k=50)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"),
                            base=conv - conv % 100, taken=remainder(conv, 6))


def op13_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.learn(docs, remainder(F.col("doc_id"), 3) != 1)
    predicted = langid.predict(docs, model)
    return predicted.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
                            "lang_pred", "score", "rejected")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_decontaminate": op3_decontaminate,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_mil": op5_quality_mil,
    "op6_fertility": op6_fertility,
    "op7_ngram_join": op7_ngram_join,
    "op8_sharding": op8_sharding,
    "op9_url_filter": op9_url_filter,
    "op10_ctw": op10_ctw,
    "op11_lexical": op11_lexical,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_langid": op13_langid,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_decontaminate": decontaminate.SQL,
    "op7_ngram_join": ngram_join.SQL,
    "op9_url_filter": url_filter.sql(URL_RULES),
    "op11_lexical": lexical.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
