"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialguard.llm import (
    ann,
    decontaminate,
    fill_in_middle,
    filter_audit,
    kneser_ney,
    maxent_lm,
    mixing,
    quality_rules,
    secret_scan,
    simhash,
    token_records,
    url_filter,
    wordpiece,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of each document under a model of trusted text, its thresholds and whether it is kept."""
    return kneser_ney.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark windows, and the items they belong to."""
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of each document."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, and which of them are live or copied examples."""
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of each document."""
    pieces = wordpiece.pieces_of(tokenizer_file("piece_bpe_32k.model"))
    return wordpiece.token_counts(_table(spark, sf_dir, "documents"), pieces)


#: Host and path rules of the URL filter query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict of each page, by its URL or its aliases."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document under a hashed maximum-entropy model of the training documents."""
    return maxent_lm.score(_table(spark, sf_dir, "documents"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id record files of all documents, read back."""
    return token_records.token_records(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document by base rules and certified cutoffs."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts and form of each document, with digests of the output and of the text rebuilt from it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle.fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of each order of the five filters removes, by language."""
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_decontamination": op2_decontamination,
    "op3_source_mixing": op3_source_mixing,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_counts": op5_token_counts,
    "op6_url_filter": op6_url_filter,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_maxent_lm": op9_maxent_lm,
    "op10_token_records": op10_token_records,
    "op11_quality_rules": op11_quality_rules,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": decontaminate.SQL,
    "op4_secret_scan": secret_scan.SQL,
    "op6_url_filter": url_filter.sql(URL_RULES),
    "op11_quality_rules": quality_rules.SQL,
    "op12_fill_in_middle": fill_in_middle.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
