"""The operators over the whole tables, with the parameters they are used with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.llm import columns, exact, fim, langid, packing, quality, secrets, sharding, simhash, substrings, urls, vectors, winnow

#: Which addresses are known to be wanted, or not to be.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(of: int) -> Column:
    """The part of a document by its id: CRC-32 of the id as text, modulo ``of``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold(4) != 2))
    guessed = langid.predict(docs.select("doc_id", "text"), model)
    return guessed.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "unknown", "shares")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents"), "op3")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(read(spark, sf_dir, "documents"), "op4")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(fold(5) != 0))
    scored = quality.score(docs, model)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", predicted, "weight", "passages")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), "op6", added=packing.added_tokens(packing.TOKENIZER))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(read(spark, sf_dir, "documents"), "op7")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), "op8")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.remove_repeats(read(spark, sf_dir, "documents"), "op9")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), group="op10")


def fim_digests(arranged: DataFrame) -> DataFrame:
    """The outputs' digests, and those of the texts that are read back from them."""
    output, form = F.col("output"), F.col("form")
    digests = [F.sha2(x, 256).alias(name) for x, name in ((output.cast("binary"), "output_sha256"), (fim.restored(output, form), "restored_sha256"))]
    return arranged.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(fim.arrange(read(spark, sf_dir, "documents")))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), RULES, "op12")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.compress(read(spark, sf_dir, "embeddings"), "op13")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_sharding": op10_sharding,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_url_filter": op12_url_filter,
    "op13_vector_codes": op13_vector_codes,
}
