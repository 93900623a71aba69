"""Queries of the training-data operators: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hiremart.llm import byte_bpe, chosen_path, conversation_repair, exact_dedup, fingerprint, html_text, language, merkle, oracles, packing, quality, secrets, token_counts, toxicity
from hiremart.llm.common import crc_of, documents
from hiremart.sources.scratch import Scratch

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"
TOKEN_LIMIT = 2048


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fingerprint.with_next(docs, {"fingerprint": fingerprint.fingerprint(F.col("text"))}, ["text", "fingerprint"])
    cut = F.floor(F.length("text") / 3).cast("int")
    rows = rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), "fingerprint", "next_fingerprint",
        F.concat(F.substr("text", F.lit(1), F.length("text") - cut), F.substr("next_text", F.lit(1), cut)).alias("_edited"))
    rows = rows.withColumn("edited_fingerprint", fingerprint.fingerprint(F.col("_edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))
    return packing.with_crc(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", *quality.STATS, "base_failed", "kept", "distance")


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(documents(spark, sf_dir), words=4, percent=80).drop("text_sha256", "first")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_of() % 4 == 2
    found = language.predict(docs, language.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(documents(spark, sf_dir), path, pattern)
    return byte_bpe.decode(encoded, path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = html_text.train(html_text.sample_words(pages))
    return html_text.extract(pages, model, ["page_id", "url"]).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    found = secrets.scan_history(documents(spark, sf_dir), scratch.path("ledger"), scratch)
    base = secrets.of_kind(F.col("spans"), "assign", "access", "hex")
    counts = [F.size(secrets.of_kind(F.col("spans"), kind)).cast("bigint").alias(f"n_{kind}")
              for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.written(F.col("spans")).alias("spans"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_of() % 5 == 0
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(documents(spark, sf_dir), Scratch(spark))
    return found.withColumn("digest", F.lower(F.hex("digest"))).withColumnRenamed("digest", "text_sha256")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    broken = conversation_repair.damaged(rows)
    report = scratch.stage(conversation_repair.report(broken, scratch))
    digests = conversation_repair.digests(conversation_repair.repaired(broken, report))
    # Conversations that lost all their rows, or all of them to the repair, still get a row.
    counts = list(conversation_repair.COUNTS)
    pieces = report.withColumn("sha256", F.lit(None).cast("string")).unionByName(digests, allowMissingColumns=True)
    pieces = pieces.unionByName(rows.select("conv_id").distinct(), allowMissingColumns=True)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return pieces.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha256"), nothing).alias("repaired_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    def leaf(text: Column) -> Column:
        return merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0  # rows without id are left alone
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = documents(spark, sf_dir).select(
        "doc_id", "lang", leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(lower)).alias("tampered"))
    proofs = merkle.manifest(leaves, Scratch(spark))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in (
        op1_fingerprint, op2_packing, op3_quality, op4_chosen_path, op5_language, op6_byte_bpe, op7_html_text, op8_secrets, op9_token_counts, op10_toxicity,
        op11_exact_dedup, op12_conversation_repair, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
