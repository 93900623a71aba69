"""Exact duplicates by skew-safe combining, in DataFrame functions only.

Texts are equal when they are identical without their white space. Equal texts meet in three steps, each
of which groups by digest *and* full content, so no step trusts a digest:

1. local: the map side of the first group-by leaves one row of each content in a task;
2. salted: those rows meet by (digest, salt), the salt being the task they come from modulo ``salts``, so
   that a content held by every task is spread over ``salts`` groups;
3. global: the at most ``salts`` winners of a content meet by digest.

What is left is one narrow row for each content. It goes back to all rows by digest; should two contents
share a digest, theirs are told apart by content there too. Adaptive execution splits a hot digest in that
join. Members of a group are never listed.

Of a group the row with the most code points in its original text stays, then the smallest id (null ids
last). Null texts count as empty, empty and blank texts are equal to each other, of wholly equal rows one
stays. Every row is in the result, repeated ones as often as they occur; an empty table gives no rows. Only
the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hiremart.llm.common import SPACE, text_of
from hiremart.sources.scratch import Scratch

SALTS = 32


def normalised(text: Column) -> Column:
    """``text`` without white space."""
    return F.regexp_replace(text, SPACE, "")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each content of ``rows`` (digest, content, first): the least ``first``, ``size``, ``variants``.

    ``content`` stays only where several contents (``variants``) share a digest.
    """
    best = [F.min("first").alias("first"), F.sum("size").alias("size")]
    salted = rows.withColumns({"salt": F.spark_partition_id() % salts, "size": F.lit(1).cast("bigint")})
    per_salt = salted.groupBy("digest", "salt", "content").agg(*best)
    # Dealt by digest alone, contents that share one are neighbours after the last step.
    whole = per_salt.select("digest", "content", "first", "size").repartition("digest").groupBy(
        "digest", "content").agg(*best)
    variants = F.count("*").over(Window.partitionBy("digest"))
    return whole.withColumn("variants", variants).withColumn(
        "content", F.when(F.col("variants") > 1, F.col("content")))


def exact_duplicates(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", salts: int = SALTS,
                     digest=sha256) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of each row of ``docs``."""
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), text_of().alias("text"))
    content = normalised(F.col("text"))
    texts = texts.select("id", F.length("text").alias("n_chars"), content.alias("content")).withColumn(
        "digest", digest(F.col("content")))
    # Ascending: long texts first, then small ids, then none.
    texts = texts.withColumn("first", F.struct((-F.col("n_chars")).alias("less"), F.col("id").isNull().alias("none"), "id"))
    found = scratch.stage(winners(texts.select("digest", "content", "first"), salts))

    def members(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
        """Wholly equal rows travel as one row and a number, so one of them can stay."""
        counted = rows.groupBy("first", *keys).agg(F.count("*").alias("copies"))
        groups = groups.select(*keys, F.col("first").alias("best"), "size")
        joined = counted.join(groups, keys).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        return joined.select(
            F.col("first.id").alias(id_column), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
            ((F.col("first") == F.col("best")) & (F.col("copy") == 1)).alias("kept"), "digest")

    alone, shared = found.where("variants = 1"), found.where("variants > 1")
    result = members(texts, alone, ["digest"])
    if not shared.isEmpty():
        among = shared.select("digest").distinct()
        result = result.unionByName(members(texts.join(among, "digest", "left_semi"), shared, ["digest", "content"]))
    return result
