"""The document pipeline: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents. All but the last return the columns of documents.

* language: documents whose language cannot be told go (no letter, or a rejected prediction).
* toxicity: documents scored 0.5 or more go.
* near_duplicates: of each class of five-word shingle similarity 0.8 or more, the document with the
  smallest id stays; of rows with equal ids and texts one; rows without id stay.
* secrets: findings are replaced by their kind in brackets; ``n_chars`` follows the text.
* packing: the documents' tokens in windows of 2048, one row per piece.

Null texts go with the first stage. Empty tables pass through all stages. Further columns keep their values up to the
last stage, whatever their names; what a stage writes is deleted once the next one is written.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hiremart.llm import chosen_path, language, packing, secrets, toxicity
from hiremart.llm.common import crc_of, unused
from hiremart.sources.scratch import Scratch

TOKENIZER, WINDOW = "word_bpe_49k.json", 2048


def own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = unused(docs, "lang_pred", "score", "accepted")
    found = language.predict(docs, language.train(docs, crc_of() % 4 != 2), docs.columns, tuple(names))
    return found.where(names[2]).select(*own(docs))


def by_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_of() % 5 != 0)
    name, = unused(docs, "toxic")
    return toxicity.score(docs, model, docs.columns, name).where(F.col(name) < 0.5).select(*own(docs))


def by_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with_digest = docs.withColumn(digest := unused(docs, "digest")[0], chosen_path.digest())
    classes = chosen_path.near_duplicates(docs, words=5, percent=80)
    key, text, row = unused(with_digest, "key", "text", "row")
    copies = classes.where("not first").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(text)).distinct()
    rows = with_digest.where("doc_id is not null").join(
        copies, (F.col("doc_id") == F.col(key)) & (F.col(digest) == F.col(text)), "left_anti")
    # Of rows with the same id and text one stays; row_number = 1 is limited before the shuffle.
    number = F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(digest))
    rows = rows.withColumn(row, number).where(F.col(row) == 1).select(*own(docs))
    return rows.unionByName(docs.where("doc_id is null"))


def by_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    clean = secrets.redact(docs, scratch.path("ledger"), scratch)
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind)).select(*own(docs))


def by_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.with_crc(packing.pack(docs, public_tokenizers.path(TOKENIZER), WINDOW))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", by_language), ("toxicity", by_toxicity), ("near_duplicates", by_near_duplicates),
    ("secrets", by_secrets), ("packing", by_packing)]

#: SQL cannot express the trained stages; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        scratch = Scratch(spark)
        docs = scratch.stage(stage(spark, docs, sf_dir))
        if before:
            before.close()
        before = scratch
    return docs
