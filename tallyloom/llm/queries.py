"""The thin opN queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import importance, jaccard, language, media, mixing, packing, pii, rules, toxicity, urls
from tallyloom.llm.oracle import ORACLE  # noqa: F401  the entry module reads it


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", toxicity.held_out("doc_id", 4, 2))
    model = language.fit(docs.filter("not held_out"))
    return language.identify(docs, model, keep=["doc_id", "held_out"])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", toxicity.held_out("doc_id", 5, 0))
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id", 5, 0))
    out = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's last partial pass ends at a whole document, so taken is below target by less than one."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"), rules.passes().alias("kept"), "failed",
    )


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.media_columns(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.col("length").alias("media_bytes"), F.col("read_sha256").alias("media_sha256"), "feature", "width", "height", "shard", "offset")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs), keep=["doc_id"])


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).withColumnRenamed("component", "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_quality_rules": op4_quality_rules,
    "op5_media": op5_media,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_jaccard": op9_jaccard,
    "op10_url_filter": op10_url_filter,
}
