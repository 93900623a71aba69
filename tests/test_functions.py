from __future__ import annotations

from decimal import Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from hiremart.functions import buckets, keys, text
from hiremart.functions.salary import salary_midpoint, with_salary

# salary text: currency, multiplier, min, max, failed
SALARIES = {
    "10 - 15 triệu": ("VND", 1000000, "10000000.00", "15000000.00", False),
    "1,000 - 2,000 USD": ("USD", 1, "26000000.00", "52000000.00", False),
    "Tới 20 triệu": ("VND", 1000000, "0.00", "20000000.00", False),
    "Từ 12 triệu": ("VND", 1000000, "12000000.00", "12000000.00", False),
    "Trên 30 triệu": ("VND", 1000000, "30000000.00", None, False),
    "Thỏa thuận": ("VND", 1, None, None, False),
    None: ("VND", 1, None, None, False),
    "500k": ("VND", 1000, "500000.00", "500000.00", False),
    "$1,500": ("USD", 1, "39000000.00", "39000000.00", False),
    "8.5 - 12.5 Triệu": ("VND", 1000000, "8500000.00", "12500000.00", False),
    "Thu nhap canh tranh": ("VND", 1000000, None, None, False),
    "25 - 18 triệu": ("VND", 1000000, "25000000.00", "18000000.00", False),
    "Trên 1000 USD": ("USD", 1000000, None, None, True),
    "Từ 10 tới 20 triệu": ("VND", 1000000, "1020000000.00", "1020000000.00", False),
    "10.000.000": ("VND", 1, None, None, True),
    "Thoả thuận": ("VND", 1, None, None, False),
    "1.500 - 2.000 USD": ("USD", 1, "39000.00", "52000.00", False),
    "Cạnh tranh": ("VND", 1000000, None, None, False),
    "12 -": ("VND", 1, "12.00", None, False),
    "15 triệu": ("VND", 1000000, "15000000.00", "15000000.00", False),
}


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("v")).first()["v"]


def test_salary_wordings(spark):
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(SALARIES)], "i int, salary string")
    rows = with_salary(df, "salary", 26000).orderBy("i").collect()
    for row, (currency, multiplier, low, high, failed) in zip(rows, SALARIES.values()):
        expected = (currency, multiplier, low and Decimal(low), high and Decimal(high), failed)
        assert tuple(row)[1:] == expected


def test_midpoint_rounds_half_up(spark):
    df = spark.sql("select cast(1.01 as decimal(14,2)) a, cast(1.02 as decimal(14,2)) b, "
                   "cast(null as decimal(14,2)) n")
    row = df.select(salary_midpoint("a", "b"), salary_midpoint("n", "b"), salary_midpoint("a", "n"),
                    salary_midpoint("n", "n")).first()
    assert tuple(row) == (Decimal("1.02"), Decimal("1.02"), Decimal("1.01"), None)


@pytest.mark.parametrize("item, written, intended", [
    ("- Hà Nội: Cầu Giấy", " hà nội: cầu giấy", "hà nội: cầu giấy"),
    ("• TP. Hồ  Chí Minh", " tp. hồ  chí minh", "tp. hồ chí minh"),
    ("saigon", "aigon", "saigon"),
    ("- • Hà Nội", " • hà nội", "hà nội"),
])
def test_place_clean_up_in_both_modes(spark, item, written, intended):
    for mode, expected in (("as_written", written), ("intended", intended)):
        assert one(spark, text.location_items("a", F.lit(None), mode), a=item) == [expected]


@pytest.mark.parametrize("addresses, fallback, expected", [
    ("a; b;a ;;", "x", ["a", "b"]),
    ("  ", "x", ["x"]),
    (None, " X  y ", ["x y"]),
    (" ; ;", "x", []),
    (None, None, []),
    ("- ", "x", []),
])
def test_fallback_place_only_without_addresses(spark, addresses, fallback, expected):
    got = one(spark, text.location_items("a", "b", "intended"), a=addresses, b=fallback)
    assert got == expected


def test_tags(spark):
    raw = "Data   Analyst; SQL;;sql ; "
    assert one(spark, text.tag_items("a", "intended"), a=raw) == ["data analyst", "sql"]
    assert one(spark, text.tag_items("a", "as_written"), a=raw) == ["data   analyst", "sql"]
    assert one(spark, text.tag_items("a", "intended"), a=None) == []


@pytest.mark.parametrize("raw, expected", [
    ("01/02/2024", "2024-02-01"), ("1/2/2024", "2024-02-01"), ("31/02/2024", None),
    ("Còn 5 ngày", None), ("x 01/02/2024", None), (None, None),
])
def test_deadline_dates(spark, raw, expected):
    got = one(spark, text.parse_deadline("a", "intended"), a=raw)
    assert (got and got.isoformat()) == expected
    assert one(spark, text.parse_deadline("a", "as_written"), a=raw) is None


def test_deadline_extract_and_title(spark):
    assert one(spark, text.extract_deadline("a"), a="Hạn: 5/12/2024 nhé") == "5/12/2024"
    assert one(spark, text.extract_deadline("a"), a="Còn 5 ngày") == "Còn 5 ngày"
    assert one(spark, text.extract_deadline("a"), a="") is None
    assert one(spark, text.clean_title("a"), a=" HOT Data  Engineer ✨") == "Data Engineer"
    assert one(spark, text.clean_title("a"), a="HOT ✨") is None


def test_initcap_after_any_separator(spark):
    assert one(spark, text.initcap_words("a"), a="co-op đà NẴNG/x2y (tp.hcm)") == \
        "Co-Op Đà Nẵng/X2y (Tp.Hcm)"


def test_keys(spark):
    assert one(spark, keys.surrogate_key(F.lit(""), F.lit(""), F.lit("")), a="") == \
        "cfab1ba8c67c7c838db98d666f02a132"
    assert one(spark, keys.surrogate_key("a") == F.md5(F.lit(keys.NULL_TOKEN)), a=None)


def test_packed_keys_differ_and_come_back(spark):
    texts = ["", "a", "b", "0b", "0" * 32, "A" * 32, "a" * 32, "f" * 32 + "\n", "ab" * 15, "é" * 8, "0" * 16, "\0" * 16, None]
    packed = spark.createDataFrame([(t,) for t in texts], "k string").select("k", keys.packed_key("k").alias("p"))
    rows = packed.select("k", "p", keys.unpacked_key("p").alias("back")).collect()
    assert all(r["back"] == r["k"] for r in rows)
    assert len({None if r["p"] is None else bytes(r["p"]) for r in rows}) == len(texts)
    assert [r["k"] for r in rows if r["p"] is not None and len(r["p"]) == 16] == ["0" * 32, "a" * 32]


@pytest.mark.parametrize("href, path, job", [
    ("https://h.example/viec-lam/abc/12.html?ta=1#x", "/viec-lam/abc/12.html", True),
    ("/brand/z/tuyen-dung/abc-j77.html", "/brand/z/tuyen-dung/abc-j77.html", True),
    ("/viec-lam/12.html", "/viec-lam/12.html", False),
    ("/viec-lam/abc/x12.html", "/viec-lam/abc/x12.html", False),
    ("https://h.example", "", False),
    ("//h.example/viec-lam/a/1.html", "/viec-lam/a/1.html", True),
])
def test_links(spark, href, path, job):
    assert one(spark, keys.url_path("a"), a=href) == path
    assert one(spark, keys.is_job_url("a"), a=href) is job


def test_absolute_links(spark):
    for href, expected in (("/x", "https://b.example/x"), ("x", "https://b.example/x"),
                           ("//c.example/x", "https://c.example/x"), ("http://d/x", "http://d/x")):
        assert one(spark, keys.absolute_url("a", "https://b.example/"), a=href) == expected
    for href in ("?page=2", "#x", "../a", "./a", "/a/../b?c#d", "/a/./b/", "a/..", "..", "", "/x?u=../y", "a?b=//c"):
        for base in ("https://b.example", "https://b.example/"):
            assert one(spark, keys.absolute_url("a", base), a=href) == urljoin(base, href), href


def test_buckets_keep_substring_quirks(spark):
    assert one(spark, buckets.size_label("a"), a="51-99") == "1-9 nhân viên"
    assert one(spark, buckets.size_label("a"), a=None) == "Unknown"
    assert one(spark, buckets.size_index("a"), a="5000+ nhân viên") == 6
    assert one(spark, buckets.city("a"), a="Phòng thuê") == "Các tỉnh thành khác"
    assert one(spark, buckets.city("a"), a="Cho Thue") == "Thừa Thiên Huế"
    assert one(spark, buckets.experience_index("a"), a="11 năm") == 2
    assert one(spark, buckets.experience_index("a"), a="Dưới 1 năm") == 1
