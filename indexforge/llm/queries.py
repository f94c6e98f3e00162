"""The registered queries: thin digests over the operators' general results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexforge.llm import (
    curriculum, decontam, divergence, doubling_dedup, line_dedup, line_rules, parity_join, prefix_trie, quality_cnn, secrets,
    suffix_dedup, toxicity, url_markov,
)
from indexforge.llm.text import fold_bucket, read_table


def _judged(scores: DataFrame, folds: int, held_out: int, least: float) -> DataFrame:
    """A row without an id has no fold: it was not learned from and does not count as held out."""
    fold = F.coalesce(fold_bucket(F.col("doc_id"), folds) == held_out, F.lit(False))
    return scores.select("doc_id", fold.alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = quality_cnn.train(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return _judged(quality_cnn.score_quality(docs, net), 5, 0, 0.3)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_components(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return _judged(toxicity.score_toxicity(docs, model), 3, 1, 0.7)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("base", lambda m: m["k"] == k)).cast("long")
    return s.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                    F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
                    secrets.span_text(F.col("spans")).alias("spans"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = decontam.find_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["e"] - s["s"])
    return h.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.size("spans") > 0).alias("contaminated"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_markov.filter_urls(read_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "positions")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.drop_boilerplate(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("__dropped").alias("n_dropped"),
                    F.sha2("text", 256).alias("kept_sha256"))


def op11_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling_dedup.remove_repeated_windows(read_table(spark, sf_dir, "documents"), n=35).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_mix_sources": op9_mix_sources,
    "op10_line_dedup": op10_line_dedup,
    "op11_doubling_dedup": op11_doubling_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}
