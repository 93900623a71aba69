"""A posting-shaped raw table derived from the generic order tables, for tests and queries.

Five daily crawls of each job, with blank and differently written links, missing companies, jobs
that disappear, noisy lists and salaries of every wording. The SQL twin used by the oracles is in
``oracles/fixture``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hiremart.config import POSTING_COLUMNS

TASK_ORDERS = 500_000  # their postings take about half a gigabyte where a task sorts them
SALARIES = [
    "10 - 15 triệu", "1,000 - 2,000 USD", "Tới 20 triệu", "Từ 12 triệu", "Trên 30 triệu",
    "Thỏa thuận", None, "500k", "$1,500", "8.5 - 12.5 Triệu", "Thu nhap canh tranh",
    "25 - 18 triệu",
]
EXPERIENCES = ["Dưới 1 năm", "1 năm", "2 năm", "3 năm", "4 năm", "Trên 5 năm", "Không yêu cầu", None]
SIZES = ["1-9 nhân viên", "10-24", "25-99 nhân viên", "100-499", "500-1000", "1000+", "51-99",
         "5000+ nhân viên", None, None, None]
ADDRESSES = ["- Hà Nội: Cầu Giấy; • TP. Hồ  Chí Minh ", None, "Đà Nẵng;  remote;saigon", "  "]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _cycle(values: list[str | None], number: Column) -> Column:
    options = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(options, (number % len(values)).cast("int"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem, part, supplier, nation = (
        read(spark, sf_dir, t) for t in ("orders", "lineitem", "part", "supplier", "nation"))
    # The partitioning the join with the lines needs anyway. The count grows with the files and rows of
    # the table and is fixed, so that the narrow key rows are not packed into a few tasks which then
    # would do all the text work and spill it.
    tasks = max(spark.sparkContext.defaultParallelism, orders.rdd.getNumPartitions(), -(-orders.count() // TASK_ORDERS))
    orders = orders.repartition(tasks, "o_orderkey")
    first_part = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_partkey").alias("p_partkey"))
    suppliers = supplier.agg(F.count("*").alias("n")).scalar()
    key = F.col("o_orderkey")
    job, snap = ((key - key % 5) / 5).cast("bigint"), key % 5
    seen = orders.select("o_orderkey", "o_orderdate").where(~((job % 10 == 9) & (snap >= 3)))
    # What follows from the key is added after the joins that move rows.
    jobs = (
        seen.join(first_part, "o_orderkey", "left")
        .join(part.select("p_partkey", "p_name", "p_type", "p_brand"), "p_partkey", "left")
        .select("*", job.alias("jk"), snap.alias("snap_no"))).select(
        "*", (F.col("jk") % suppliers).alias("s_suppkey"),
        (F.col("jk") % 25).cast("int").alias("n_nationkey"),
        F.explode(F.when(key % 50 == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("variant"))
    base = (
        jobs.join(supplier.select("s_suppkey", "s_name"), "s_suppkey")
        .join(nation.select("n_nationkey", "n_name"), "n_nationkey"))
    jk, sk = F.col("jk").cast("string"), F.col("s_suppkey")
    again = F.col("variant") == 1

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def unless(test: Column, value: Column, other: str | None = None) -> Column:
        return F.when(test, F.lit(other).cast("string")).otherwise(value)

    values = {
        "job_url": F.when(key % 97 == 96, "   ")
        .when(again, text("HTTPS://Jobs.Example/viec-lam/x/", jk, ".html"))
        .otherwise(text(" https://jobs.example/viec-lam/x/", jk, ".html ")),
        "title": unless(again, F.col("p_name")),
        "company_url": unless(
            sk % 7 == 0, text("https://jobs.example/cong-ty/", sk.cast("string"))),
        "salary": _cycle(SALARIES, key),
        "location": unless(key % 10 == 0, F.col("n_name"), ""),
        "experience": _cycle(EXPERIENCES, F.col("jk")),
        "deadline": unless(
            key % 9 == 0,
            text(F.dayofmonth("o_orderdate").cast("string"), "/",
                 F.month("o_orderdate").cast("string"),
                 F.when(key % 31 == 5, "/2023").otherwise("/2024")), "Còn 5 ngày"),
        "tags": unless(
            key % 13 == 0,
            text(F.col("p_type"), "; ", F.col("p_brand"), ";;  Data   Analyst ;", F.col("p_type"))),
        "desc_mota": text("about  ", F.col("p_name")),
        "desc_yeucau": unless(key % 6 == 0, text("needs ", F.col("p_brand")), " "),
        "desc_quyenloi": F.lit(None).cast("string"),
        "working_times": F.lit("08:00 - 17:00"),
        "company_website": unless(
            sk % 3 == 0, text("https://Www.Co", sk.cast("string"), ".example")),
        "company_followers": unless(sk % 4 == 0, (sk * 10).cast("string"), ""),
        "company_industry": text("Industry ", (sk % 6).cast("string")),
        "company_address": text(" ", F.col("n_name"), " "),
        "company_description": F.lit(None).cast("string"),
        "working_addresses": _cycle(ADDRESSES, key),
        "company_name_full": unless(sk % 5 == 0, F.col("s_name")),
        "company_size": _cycle(SIZES, key),
        "crawled_at": text("2024-01-0", (F.col("snap_no") + 1).cast("string"), " 01:00:00")
        .cast("timestamp_ntz"),
    }
    return base.select(*[values[c].alias(c) for c in POSTING_COLUMNS])
