"""Registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import oracle
from riskloom.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _fold(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.quality import quality_scores
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                          held_out=_fold(5) == 0, calibrate=_fold(5) == 4, threshold=0.3)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.tokens import read_token_files, write_token_files
    files = write_token_files(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=2)
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.licenses import license_scan
    return license_scan(table(spark, sf_dir, "documents"))


#: fixed values: the URL rules that the query judges by
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.urls import url_verdicts
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.suffix import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return out.select(
        "row.doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.langid import languages
    return languages(table(spark, sf_dir, "documents"), held_out=_fold(3) == 1).select(
        "doc_id", "held_out", "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.rules import quality_verdicts
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=0,
                          capacity=2048)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, similarity=80)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.decontam import leaks
    out = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("similarity", F.round("similarity", 6))


def _span_list(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.secrets import secret_spans
    base = ["assign", "access", "hex"]

    def of(kinds):
        return F.filter("spans", lambda s: s["kind"].isin(kinds))

    counts = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in base]
    return secret_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(_span_list(of(base)), 256).alias("base_sha256"), _span_list(F.col("spans")).alias("spans"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.spelling import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


def registry() -> dict:
    import corpus_pipeline
    ops = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit() and callable(v)}
    return ops | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return {
        "op3_license_scan": oracle.license_scan(),
        "op4_url_filter": oracle.url_filter(URL_RULES),
        "op5_suffix_array_dedup": oracle.suffix_array_dedup(50),
        "op7_quality_rules": oracle.quality_rules(),
        "op9_minhash_near_dedup": oracle.near_dedup(80),
        "op10_benchmark_decontamination": oracle.benchmark_leaks(),
        "op12_spelling_variants": oracle.spelling_variants(),
        "op13_conversation_trie": oracle.conversation_trie(),
    }
