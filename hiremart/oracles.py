"""Expected results as SQL for another engine, written from the definitions of the models.

They take the plain road the Spark plans avoid (global windows, joins back to exploded rows,
per-day self joins), so agreement says something. Types follow ``queries``: integers as bigint,
decimals as double, dates and times as text.
"""

from __future__ import annotations

# Nothing here comes from the code under test: lists and rules are written out again, so that a change there shows.
POSTING_COLUMNS = """title job_url company_url salary location experience deadline tags desc_mota desc_yeucau desc_quyenloi
    working_addresses working_times company_name_full company_website company_size company_followers company_industry
    company_address crawled_at company_description""".split()
UPDATE_COLUMNS = [c for c in POSTING_COLUMNS if c not in ("job_url", "crawled_at")]

_ATTRS = ["title", "job_url", "experience_raw", "desc_mota", "desc_yeucau", "desc_quyenloi",
          "working_addresses_raw", "working_times"]
_COMPANY = ["company_url", "company_name_full", "company_website", "company_size",
            "company_followers", "company_industry", "company_address", "company_description"]

RAW = """
raw AS (
  WITH li AS (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey),
  k AS (SELECT o_orderkey, o_orderdate, o_orderkey // 5 AS jk, o_orderkey % 5 AS snap_no FROM orders),
  base AS (
    SELECT k.*, p.p_name, p.p_type, p.p_brand, na.n_name, s.s_suppkey, s.s_name
    FROM k
    JOIN supplier s ON s.s_suppkey = k.jk % (SELECT count(*) FROM supplier)
    JOIN nation na ON na.n_nationkey = k.jk % 25
    LEFT JOIN li ON li.l_orderkey = k.o_orderkey
    LEFT JOIN part p ON p.p_partkey = li.pk
    WHERE NOT (k.jk % 10 = 9 AND k.snap_no >= 3)),
  both_forms AS (
    SELECT 0 AS variant, base.* FROM base
    UNION ALL SELECT 1, base.* FROM base WHERE o_orderkey % 50 = 4)
  SELECT
    CASE WHEN o_orderkey % 97 = 96 THEN '   '
         WHEN variant = 1 THEN 'HTTPS://Jobs.Example/viec-lam/x/' || jk || '.html'
         ELSE ' https://jobs.example/viec-lam/x/' || jk || '.html ' END AS job_url,
    CASE WHEN variant = 1 THEN NULL ELSE p_name END AS title,
    CASE WHEN s_suppkey % 7 <> 0 THEN 'https://jobs.example/cong-ty/' || s_suppkey END AS company_url,
    CASE o_orderkey % 12 WHEN 0 THEN '10 - 15 triệu' WHEN 1 THEN '1,000 - 2,000 USD'
      WHEN 2 THEN 'Tới 20 triệu' WHEN 3 THEN 'Từ 12 triệu' WHEN 4 THEN 'Trên 30 triệu'
      WHEN 5 THEN 'Thỏa thuận' WHEN 7 THEN '500k' WHEN 8 THEN '$1,500'
      WHEN 9 THEN '8.5 - 12.5 Triệu' WHEN 10 THEN 'Thu nhap canh tranh'
      WHEN 11 THEN '25 - 18 triệu' END AS salary,
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE n_name END AS location,
    CASE jk % 8 WHEN 0 THEN 'Dưới 1 năm' WHEN 1 THEN '1 năm' WHEN 2 THEN '2 năm' WHEN 3 THEN '3 năm'
      WHEN 4 THEN '4 năm' WHEN 5 THEN 'Trên 5 năm' WHEN 6 THEN 'Không yêu cầu' END AS experience,
    CASE WHEN o_orderkey % 9 = 0 THEN 'Còn 5 ngày'
         ELSE day(o_orderdate) || '/' || month(o_orderdate) ||
           CASE WHEN o_orderkey % 31 = 5 THEN '/2023' ELSE '/2024' END END AS deadline,
    CASE WHEN o_orderkey % 13 <> 0
         THEN p_type || '; ' || p_brand || ';;  Data   Analyst ;' || p_type END AS tags,
    'about  ' || p_name AS desc_mota,
    CASE WHEN o_orderkey % 6 = 0 THEN ' ' ELSE 'needs ' || p_brand END AS desc_yeucau,
    CAST(NULL AS VARCHAR) AS desc_quyenloi,
    '08:00 - 17:00' AS working_times,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'https://Www.Co' || s_suppkey || '.example' END AS company_website,
    CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE CAST(s_suppkey * 10 AS VARCHAR) END AS company_followers,
    'Industry ' || (s_suppkey % 6) AS company_industry,
    ' ' || n_name || ' ' AS company_address,
    CAST(NULL AS VARCHAR) AS company_description,
    CASE o_orderkey % 4 WHEN 0 THEN '- Hà Nội: Cầu Giấy; • TP. Hồ  Chí Minh '
      WHEN 2 THEN 'Đà Nẵng;  remote;saigon' WHEN 3 THEN '  ' END AS working_addresses,
    CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS company_name_full,
    CASE o_orderkey % 11 WHEN 0 THEN '1-9 nhân viên' WHEN 1 THEN '10-24' WHEN 2 THEN '25-99 nhân viên'
      WHEN 3 THEN '100-499' WHEN 4 THEN '500-1000' WHEN 5 THEN '1000+' WHEN 6 THEN '51-99'
      WHEN 7 THEN '5000+ nhân viên' END AS company_size,
    CAST('2024-01-0' || (snap_no + 1) || ' 01:00:00' AS TIMESTAMP) AS crawled_at
  FROM both_forms)"""


def _number(text: str) -> str:
    kept = f"replace(regexp_replace({text}, '[^0-9.,]', '', 'g'), ',', '')"
    return f"TRY_CAST(nullif({kept}, '') AS DECIMAL(24,10))"


def _money(number: str) -> str:
    return (f"TRY_CAST({number} * CAST(multiplier * CASE currency WHEN 'USD' THEN 26000 ELSE 1 END "
            f"AS DECIMAL(12,0)) AS DECIMAL(14,2))")


# Bounds by a rule number per text: which rule fires first decides both.
SALARY = f"""
pay AS (
  WITH lowered AS (SELECT *, lower(coalesce(salary, '')) AS t FROM raw),
  ruled AS (
    SELECT *,
      CASE WHEN t LIKE '%usd%' OR t LIKE '%$%' THEN 'USD' ELSE 'VND' END AS currency,
      CASE WHEN t LIKE '%tr%' THEN 1000000 WHEN t LIKE '%k%' THEN 1000 ELSE 1 END AS multiplier,
      CASE WHEN t = '' OR t LIKE '%thỏa thuận%' OR t LIKE '%thu nhap canh tranh%' THEN 'none'
           WHEN t LIKE '%-%' THEN 'range' ELSE 'single' END AS rule
    FROM lowered),
  numbers AS (
    SELECT *,
      CASE rule WHEN 'none' THEN NULL WHEN 'range' THEN {_number("split_part(t, '-', 1)")}
        ELSE CASE WHEN t LIKE '%tới%' AND t NOT LIKE '%từ%' AND t NOT LIKE '%trên%' THEN 0
                  ELSE {_number("t")} END END AS low,
      CASE rule WHEN 'none' THEN NULL WHEN 'range' THEN {_number("split_part(t, '-', 2)")}
        ELSE CASE WHEN t LIKE '%trên%' AND t NOT LIKE '%tới%' THEN NULL
                  ELSE {_number("t")} END END AS high
    FROM ruled)
  SELECT *, {_money("low")} AS salary_min, {_money("high")} AS salary_max FROM numbers)"""


def _blank(column: str) -> str:
    return f"nullif(trim({column}, ' '), '')"


STG = f"""
stg AS (
  WITH cleaned AS (
    SELECT crawled_at AS snapshot_ts, lower(trim(job_url, ' ')) AS job_url, {_blank("title")} AS title,
      {", ".join(f"lower({_blank(c)}) AS {c}" for c in _COMPANY[:3])},
      {", ".join(f"{_blank(c)} AS {c}" for c in _COMPANY[3:])},
      {_blank("location")} AS location_raw, {_blank("experience")} AS experience_raw,
      {_blank("deadline")} AS deadline_raw, {_blank("tags")} AS tags_raw,
      {", ".join(f"{_blank(c)} AS {c}" for c in ("desc_mota", "desc_yeucau", "desc_quyenloi"))},
      {_blank("working_addresses")} AS working_addresses_raw,
      {_blank("working_times")} AS working_times,
      currency AS salary_currency, salary_min, salary_max
    FROM pay WHERE trim(job_url, ' ') <> ''),
  ranked AS (
    SELECT *, row_number() OVER (
      PARTITION BY job_url, snapshot_ts
      ORDER BY CASE WHEN title IS NULL THEN 1 ELSE 0 END,
               CASE WHEN company_url IS NULL THEN 1 ELSE 0 END) AS pick
    FROM cleaned)
  SELECT md5(job_url) AS job_bk,
    md5(coalesce(company_url, '') || '-' || coalesce(company_name_full, '') || '-'
        || coalesce(company_website, '')) AS company_bk,
    1 AS source_id, * EXCLUDE (pick)
  FROM ranked WHERE pick = 1)"""


def _hash_part(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), '_dbt_utils_surrogate_key_null_')"


def _deadline(written: bool) -> str:
    if written:
        return "CAST(NULL AS DATE)"
    return ("CASE WHEN regexp_full_match(deadline_raw, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') "
            "THEN CAST(try_strptime(deadline_raw, '%d/%m/%Y') AS DATE) END")


def _events(written: bool = False) -> str:
    hashed = " || '-' || ".join(_hash_part(c) for c in (
        "job_bk", "snapshot_ts", "title", "company_bk", "location_raw", "tags_raw", "salary_min",
        "salary_max"))
    return f"""
ev AS (
  SELECT *, CAST(strftime(snapshot_ts, '%Y%m%d') AS BIGINT) AS date_id,
    {_deadline(written)} AS deadline_date,
    CASE WHEN salary_min IS NULL THEN salary_max WHEN salary_max IS NULL THEN salary_min
         ELSE CAST((CAST(salary_min AS DECIMAL(18,3)) + salary_max) * CAST(0.5 AS DECIMAL(2,1))
                   AS DECIMAL(14,2)) END AS salary_avg,
    md5({hashed}) AS snapshot_hash
  FROM stg)"""


def _tags(written: bool = False) -> str:
    name = r"regexp_replace(item, '\\s+', ' ', 'g')" if written else r"regexp_replace(item, '\s+', ' ', 'g')"
    return f"""
tags AS (
  SELECT DISTINCT job_bk, snapshot_ts, lower({name}) AS tag_name_norm
  FROM (SELECT job_bk, snapshot_ts, trim(unnest(string_split(tags_raw, ';')), ' ') AS item FROM ev)
  WHERE item <> '')"""


def _locations(written: bool = False) -> str:
    back = "\\\\" if written else "\\"
    name = (f"regexp_replace(lower(regexp_replace(item, '^[-•{back}s]+', '')), "
            f"'{back}s+', ' ', 'g')")
    return f"""
locs AS (
  WITH items AS (
    SELECT job_bk, snapshot_ts, unnest(string_split(working_addresses_raw, ';')) AS item FROM ev
    UNION ALL
    SELECT job_bk, snapshot_ts, location_raw FROM ev WHERE working_addresses_raw IS NULL)
  SELECT DISTINCT job_bk, snapshot_ts, location_name_norm
  FROM (SELECT job_bk, snapshot_ts, {name} AS location_name_norm
        FROM (SELECT job_bk, snapshot_ts, trim(item, ' ') AS item FROM items) WHERE item <> '')
  WHERE location_name_norm <> '')"""


LATEST = f"""
job_src AS (
  SELECT job_bk, source_id, {", ".join(_ATTRS)}, snapshot_ts AS updated_at
  FROM stg s WHERE NOT EXISTS (
    SELECT 1 FROM stg n WHERE n.job_bk = s.job_bk AND n.snapshot_ts > s.snapshot_ts)),
com_src AS (
  SELECT company_bk, {", ".join(_COMPANY)}, snapshot_ts AS updated_at
  FROM (SELECT *, row_number() OVER (
          PARTITION BY company_bk ORDER BY snapshot_ts DESC, job_bk) AS rn FROM stg)
  WHERE rn = 1)"""


def _initcap(column: str) -> str:
    runs = rf"regexp_extract_all({column}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"
    return (f"array_to_string(list_transform({runs}, "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def _dims(written: bool = False) -> str:
    first, last = "min(CAST(snapshot_ts AS DATE))", "max(CAST(snapshot_ts AS DATE))"
    if not written:
        first, last = f"least({first}, min(deadline_date))", f"greatest({last}, max(deadline_date))"
    return f"""
dim_source AS (SELECT 1 AS source_id, 'job_board' AS source_name),
snap_dim_job AS (
  SELECT * EXCLUDE (updated_at), md5(job_bk || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id,
    updated_at AS dbt_updated_at, updated_at AS dbt_valid_from,
    CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM job_src),
snap_dim_company AS (
  SELECT * EXCLUDE (updated_at), md5(company_bk || '|' || CAST(updated_at AS VARCHAR)) AS dbt_scd_id,
    updated_at AS dbt_updated_at, updated_at AS dbt_valid_from,
    CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM com_src),
dim_job AS (
  SELECT row_number() OVER (ORDER BY job_bk, dbt_valid_from) AS job_sk, dbt_scd_id,
    job_bk AS external_job_id, source_id, title, job_url, experience_raw AS experience, desc_mota,
    desc_yeucau, desc_quyenloi, working_addresses_raw AS working_addresses, working_times,
    dbt_valid_from, dbt_valid_to FROM snap_dim_job),
dim_company AS (
  SELECT row_number() OVER (ORDER BY company_bk, dbt_valid_from) AS company_sk, dbt_scd_id,
    company_bk AS company_id, {", ".join(_COMPANY)}, dbt_valid_from, dbt_valid_to
  FROM snap_dim_company),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, CAST(d AS DATE) AS date_day,
    day(d) AS day_of_month, month(d) AS month_of_year, year(d) AS year_number,
    isodow(d) AS iso_day_of_week, isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(CAST(low AS TIMESTAMP), CAST(high AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d
        FROM (SELECT {first} AS low, {last} AS high FROM ev))),
dim_location AS (
  SELECT row_number() OVER (ORDER BY location_name_norm) AS location_id,
    location_name_norm AS location_code, {_initcap("location_name_norm")} AS location_name
  FROM (SELECT DISTINCT location_name_norm FROM locs)),
dim_tag AS (
  SELECT row_number() OVER (ORDER BY tag_name_norm) AS tag_id, tag_name_norm AS tag_name
  FROM (SELECT DISTINCT tag_name_norm FROM tags)),
bridge_job_tags AS (
  SELECT DISTINCT j.job_sk, g.tag_id
  FROM tags t JOIN dim_tag g ON g.tag_name = t.tag_name_norm
  JOIN dim_job j ON j.external_job_id = t.job_bk AND j.dbt_valid_to IS NULL),
fct_job_snapshot AS (
  SELECT e.job_bk, e.snapshot_ts, j.job_sk, e.date_id, c.company_sk, l.location_id,
    CAST(strftime(e.deadline_date, '%Y%m%d') AS BIGINT) AS deadline_date_id,
    e.salary_min, e.salary_max, e.salary_avg, e.salary_currency, e.snapshot_hash
  FROM ev e
  LEFT JOIN dim_job j ON j.external_job_id = e.job_bk AND j.dbt_valid_to IS NULL
  LEFT JOIN dim_company c ON c.company_id = e.company_bk AND c.dbt_valid_to IS NULL
  LEFT JOIN (SELECT job_bk, snapshot_ts, min(location_name_norm) AS name FROM locs GROUP BY ALL) p
    ON p.job_bk = e.job_bk AND p.snapshot_ts = e.snapshot_ts
  LEFT JOIN dim_location l ON l.location_code = p.name)"""


def _model(select: str, written: bool = False) -> str:
    steps = [RAW, SALARY, STG, _events(written), _tags(written), _locations(written), LATEST,
             _dims(written)]
    return f"WITH {','.join(steps)}\n{select}"


def _raw(select: str) -> str:
    return f"WITH {RAW}\n{select}"


def _ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


def _double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


_FACT = f"""SELECT job_bk, {_ts("snapshot_ts")}, job_sk, date_id, company_sk, location_id,
  deadline_date_id, {_double("salary_min", "salary_max", "salary_avg")}, salary_currency,
  snapshot_hash FROM fct_job_snapshot"""
_VALID = f'{_ts("dbt_valid_from")}, {_ts("dbt_valid_to")}'
_NOW = "f.date_id = (SELECT max(date_id) FROM fct_job_snapshot)"


def _half_up(numerator: str, denominator: str) -> str:
    """Two decimals, rounded half up in whole numbers."""
    return (f"CAST((200 * CAST({numerator} AS HUGEINT) + ({denominator})) // (2 * ({denominator})) "
            f"AS DOUBLE) / 100")


def _share(count: str, total: str) -> str:
    return _half_up(f"100 * {count}", f"CAST({total} AS HUGEINT)")


def _mean_million(cents: str, count: str) -> str:
    return f"CASE WHEN {count} > 0 THEN {_half_up(cents, f'{count} * 100000000')} END"


def _cents(*columns: str) -> str:
    return f"sum(CAST(({' + '.join(columns)}) * 100 AS HUGEINT))"


def _case(column: str, rules: list[tuple], default) -> str:
    def lit(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    arms = "".join(
        " WHEN " + " OR ".join(f"lower({column}) LIKE '%{n}%'" for n in needles)
        + f" THEN {lit(value)}" for value, needles in rules)
    return f"CASE{arms} ELSE {lit(default)} END"


_CITY = _case("l.location_name", [
    ("TP. Hồ Chí Minh", ["hồ chí minh", "ho chi minh"]), ("Hà Nội", ["hà nội", "ha noi"]), ("Đà Nẵng", ["đà nẵng", "da nang"]),
    ("Cần Thơ", ["cần thơ", "can tho"]), ("Bình Dương", ["bình dương", "binh duong"]), ("Đồng Nai", ["đồng nai", "dong nai"]),
    ("Hải Phòng", ["hải phòng", "hai phong"]), ("Bắc Ninh", ["bắc ninh", "bac ninh"]), ("Bà Rịa - Vũng Tàu", ["vũng tàu", "vung tau"]),
    ("Thái Nguyên", ["thái nguyên", "thai nguyen"]), ("Thừa Thiên Huế", ["huế", "hue"]),
    ("Remote (Làm việc từ xa)", ["remote", "từ xa"])], "Các tỉnh thành khác")
_SIZES = [("1-9 nhân viên", 1, ["1-9"]), ("10-24 nhân viên", 2, ["10-24"]), ("25-99 nhân viên", 3, ["25-99"]),
          ("100-499 nhân viên", 4, ["100-499"]), ("500-1000 nhân viên", 5, ["500-1000"]),
          ("1000+ nhân viên", 6, ["1000+", "3000+", "5000+", "10000+"])]
_SIZE = _case("c.company_size", [(a, n) for a, _, n in _SIZES], "Unknown")
_SIZE_NO = _case("c.company_size", [(i, n) for _, i, n in _SIZES], 99)
_EXP_NO = _case("experience", [(1, ["dưới 1 năm"]), (2, ["1 năm"]), (3, ["2 năm"]), (4, ["3 năm"]), (5, ["4 năm"]), (6, ["5 năm"])], 99)
_EXCLUDED = "'thỏa thuận', 'negotiable', 'không yêu cầu'"
#: The declared checks: columns not null; unique; unique together; parents; expression.
_CHECKS = {
    "raw": ("job_url crawled_at", "", "", {}, None),
    "stg_postings": ("job_bk company_bk job_url snapshot_ts source_id", "", "job_bk snapshot_ts", {}, None),
    "int_job_snapshot_events": ("job_bk snapshot_ts snapshot_date_id", "", "job_bk snapshot_ts", {}, None),
    "int_job_tags": ("tag_name_norm", "", "job_bk snapshot_ts tag_name_norm", {}, None),
    "int_job_locations": ("location_name_norm", "", "job_bk snapshot_ts location_name_norm", {}, None),
    "int_company_snapshot_source": ("company_bk updated_at", "company_bk", "", {}, None),
    "int_job_snapshot_source": ("job_bk updated_at", "job_bk", "", {}, None),
    "snap_dim_company": ("company_bk dbt_scd_id dbt_valid_from", "dbt_scd_id", "", {}, None),
    "snap_dim_job": ("job_bk dbt_scd_id dbt_valid_from", "dbt_scd_id", "", {}, None),
    "dim_source": ("source_id source_name", "source_id", "", {}, None),
    "dim_company": ("company_sk dbt_scd_id company_id", "company_sk dbt_scd_id", "", {}, None),
    "dim_job": ("job_sk dbt_scd_id external_job_id source_id", "job_sk dbt_scd_id", "", {"source_id": "dim_source.source_id"}, None),
    "dim_date": ("date_id date_day", "date_id", "", {}, None),
    "dim_location": ("location_id location_code", "location_id location_code", "", {}, None),
    "dim_tag": ("tag_id tag_name", "tag_id tag_name", "", {}, None),
    "bridge_job_tags": ("job_sk tag_id", "", "job_sk tag_id", {"job_sk": "dim_job.job_sk", "tag_id": "dim_tag.tag_id"}, None),
    "fct_job_snapshot": ("job_bk snapshot_ts job_sk date_id", "", "job_bk snapshot_ts", {
        "job_sk": "dim_job.job_sk", "company_sk": "dim_company.company_sk", "location_id": "dim_location.location_id",
        "date_id": "dim_date.date_id", "deadline_date_id": "dim_date.date_id"},
        "salary_min is null or salary_max is null or salary_min <= salary_max"),
}


def _history(key: str, source: str, columns: list[str], last: int) -> str:
    """Versions of a key: one per day it was seen, ending when next seen or when found missing."""
    return f"""SELECT {key}, {", ".join(columns)},
  md5({key} || '|' || CAST(ts AS VARCHAR)) AS dbt_scd_id, {_ts("ts", "dbt_updated_at")},
  {_ts("ts", "dbt_valid_from")}, {_ts("ended", "dbt_valid_to")}
FROM (
  SELECT *, CASE
      WHEN day_no = {last} THEN NULL
      WHEN lead(day_no) OVER w = day_no + 1 THEN lead(ts) OVER w
      ELSE CAST('2024-01-0' || (day_no + 1) || ' 03:00:00' AS TIMESTAMP) END AS ended
  FROM (SELECT *, snapshot_ts AS ts, day(snapshot_ts) AS day_no FROM {source}
        WHERE day(snapshot_ts) <= {last})
  WINDOW w AS (PARTITION BY {key} ORDER BY day_no))"""


_JOB_HISTORY_COLUMNS = ["CAST(source_id AS BIGINT) AS source_id", *_ATTRS]
_COMPANY_DAY = """(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY company_bk, snapshot_ts ORDER BY job_bk) AS rn FROM stg) WHERE rn = 1)"""


def _suite(damaged: bool = False) -> str:
    """All declared checks, one SELECT each; ``damaged``: over tables with bad rows added."""
    source = {
        "stg_postings": "stg", "int_job_snapshot_events":
        "(SELECT *, date_id AS snapshot_date_id FROM ev)", "int_job_tags": "tags",
        "int_job_locations": "locs", "int_company_snapshot_source": "com_src",
        "int_job_snapshot_source": "job_src"}
    out, sound = [], lambda table: source.get(table, table)

    def relation(table: str) -> str:
        if not damaged:
            return sound(table)
        (not_null, _, _, parents, _), rel = _CHECKS[table], sound(table)
        rows = lambda digit: f"FROM {rel} WHERE CAST({not_null.split()[0]} AS VARCHAR) LIKE '%{digit}%'"
        parts = [f"SELECT * FROM {rel}", f"SELECT * {rows(1)}",
                 f"SELECT * REPLACE ({', '.join(f'NULL AS {c}' for c in not_null.split())}) {rows(2)}"]
        if parents:
            parts.append(f"SELECT * REPLACE ({', '.join(f'-1 - {c} AS {c}' for c in parents)}) {rows(3)}")
        return f"({' UNION ALL '.join(parts)})"

    def add(table: str, check: str, column: str, count: str) -> None:
        out.append(f"SELECT '{table}' AS table_name, '{check}' AS check, '{column}' AS column_name, "
                   f"CAST(({count}) AS BIGINT) AS n_violations")

    for table, (not_null, unique, together, parents, expression) in _CHECKS.items():
        rel = relation(table)
        for c in not_null.split():
            add(table, "not_null", c, f"SELECT count(*) FROM {rel} WHERE {c} IS NULL")
        for c in unique.split():
            add(table, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {rel} WHERE {c} IS NOT "
                f"NULL GROUP BY {c} HAVING count(*) > 1)")
        if together:
            cols = ", ".join(together.split())
            add(table, "unique_combination", "+".join(together.split()),
                f"SELECT count(*) FROM (SELECT {cols} FROM {rel} GROUP BY {cols} HAVING count(*) > 1)")
        for c, (parent, field) in ((c, p.split(".")) for c, p in parents.items()):
            add(table, "relationships", c, f"SELECT count(*) FROM {rel} x LEFT JOIN {relation(parent)} y "
                f"ON x.{c} = y.{field} WHERE x.{c} IS NOT NULL AND y.{field} IS NULL")
        if expression:
            add(table, "expression_is_true", expression,
                f"SELECT count(*) FROM {rel} WHERE NOT ({expression}) OR ({expression}) IS NULL")
    return "\nUNION ALL ".join(out)


_UPSERT_COLUMNS = ", ".join(f"b.{c}" for c in UPDATE_COLUMNS)
_FLAT = r"trim(regexp_replace({0}, '\s+', ' ', 'g'), ' ')"
_SUPPLIER_URL = "'https://jobs.example/cong-ty/' || s_suppkey"
_INTRO = "'Nhà cung cấp ' || s_name"
_COMPANY_PAGE = f"""company_page AS (
  SELECT {_SUPPLIER_URL} AS company_url, s_name AS company_name_full,
    CASE WHEN s_suppkey % 2 = 0 THEN 'https://www.co' || s_suppkey || '.example' END
      AS company_website,
    s_suppkey || '-99' AS company_size, CAST(NULL AS VARCHAR) AS company_followers,
    'Industry ' || (s_suppkey % 6) AS company_industry, 'nation ' || s_nationkey AS company_address,
    CASE WHEN s_suppkey % 4 <> 0 THEN CASE WHEN s_suppkey % 3 = 0
      THEN 'Giới thiệu ' || {_INTRO} ELSE {_INTRO} END END AS company_description
  FROM supplier)"""


def _filled(column: str) -> str:
    return f"CASE WHEN trim({column}, ' ') <> '' THEN {column} END"


_CARD = f"""cards AS (
  SELECT trim(job_url, ' ') || '#' || strftime(crawled_at, '%Y-%m-%d %H:%M:%S') AS page_id,
    CAST(0 AS BIGINT) AS position, {_FLAT.format("title")} AS title, trim(job_url, ' ') AS job_url,
    CASE WHEN location <> '' AND company_url IS NOT NULL THEN company_name_full END AS company,
    CASE WHEN location <> '' THEN company_url END AS company_url,
    CASE WHEN location <> '' THEN {_FLAT.format("salary")} END AS salary,
    nullif(location, '') AS address_list,
    CASE WHEN location <> '' THEN experience END AS exp_list, location <> '' AS has_next
  FROM raw
  WHERE trim(job_url, ' ') <> '' AND salary IS NOT NULL AND title IS NOT NULL)"""


def _unescape(column: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"),
                         ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "),
                         ("&amp;", "&")):
        column = f"replace({column}, '{entity}', '{char}')"
    return column


def _or(column: str, fallback: str) -> str:
    return f"coalesce(nullif({_FLAT.format(column)}, ''), {fallback})"


_DETAIL = f"""
            SELECT trim(job_url, ' ') || '#' || strftime(crawled_at, '%Y-%m-%d %H:%M:%S') AS job_url,
              {_FLAT.format("title")} AS title, {_or("salary", "'Mức lương'")} AS salary,
              {_or("location", "'Địa điểm :'")} AS location,
              {_or("experience", "'Kinh nghiệm'")} AS experience,
              CASE WHEN deadline LIKE '%/%' THEN deadline ELSE 'Hạn nộp hồ sơ: ' || deadline END
                AS deadline,
              (SELECT string_agg(item, '; ' ORDER BY first_at) FROM (
                 SELECT item, min(i) AS first_at FROM (
                   SELECT {_FLAT.format("x")} AS item, i FROM (
                     SELECT unnest(string_split(tags, ';')) AS x,
                       generate_subscripts(string_split(tags, ';'), 1) AS i))
                 WHERE item <> '' GROUP BY item)) AS tags,
              company_url AS company_url_from_job, company_name_full,
              CAST(NULL AS VARCHAR) AS company_website, company_size,
              nullif(company_followers, '') AS company_followers,
              CAST(NULL AS VARCHAR) AS company_industry, CAST(NULL AS VARCHAR) AS company_address,
              {_or("desc_mota", "'Mô tả công việc'")} AS desc_mota,
              {_or("desc_yeucau", "'Yêu cầu ứng viên'")} AS desc_yeucau,
              CAST(NULL AS VARCHAR) AS desc_quyenloi,
              {_or("working_addresses", "'Địa điểm làm việc'")} AS working_addresses, working_times
            FROM raw WHERE trim(job_url, ' ') <> ''"""


_ORDERS_LATEST = """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS ts FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
    FROM orders{0}) WHERE rn = 1"""


def oracle_sql() -> dict[str, str]:
    stg_text = ["job_bk", "company_bk", "job_url", "title", *_COMPANY, "location_raw",
                "experience_raw", "deadline_raw", "tags_raw", "desc_mota", "desc_yeucau",
                "desc_quyenloi", "working_addresses_raw", "working_times", "salary_currency"]
    posting = ", ".join(c for c in POSTING_COLUMNS if c != "crawled_at")
    locations = f"SELECT job_bk, {_ts('snapshot_ts')}, location_name_norm FROM locs"
    tags = f"SELECT job_bk, {_ts('snapshot_ts')}, tag_name_norm FROM tags"
    dates = ("SELECT date_id, CAST(date_day AS VARCHAR) AS date_day, day_of_month, month_of_year, "
             "year_number, iso_day_of_week, is_weekend FROM dim_date")
    return {
        "stg_postings_model": _model(
            f"SELECT {', '.join(stg_text)}, CAST(source_id AS BIGINT) AS source_id, "
            f"{_ts('snapshot_ts')}, {_double('salary_min', 'salary_max')} FROM stg"),
        "salary_parse": _model(
            f"SELECT job_url, {_ts('crawled_at')}, salary, currency AS salary_currency, "
            f"CAST(multiplier AS BIGINT) AS multiplier, {_double('salary_min', 'salary_max')} FROM pay"),
        "salary_failed": _model(
            "SELECT 'salary_parse_failed' AS check, 'salary' AS column_name, count(*) AS n_violations "
            "FROM pay WHERE trim(job_url, ' ') <> '' AND rule <> 'none' AND t SIMILAR TO '.*[0-9].*' "
            "AND salary_min IS NULL AND salary_max IS NULL"),
        "event_shape": _model(
            f"SELECT job_bk, {_ts('snapshot_ts')}, company_bk, date_id AS snapshot_date_id, "
            f"CAST(deadline_date AS VARCHAR) AS deadline_date, {_double('salary_avg')}, "
            "snapshot_hash FROM ev"),
        "explode_tags": _model(tags),
        "explode_locations": _model(locations),
        "explode_tags_as_written": _model(tags, written=True),
        "explode_locations_as_written": _model(locations, written=True),
        "latest_job": _model(
            f"SELECT job_bk, {', '.join(_JOB_HISTORY_COLUMNS)}, {_ts('updated_at')} FROM job_src"),
        "latest_company": _model(
            f"SELECT company_bk, {', '.join(_COMPANY)}, {_ts('updated_at')} FROM com_src"),
        "upsert_raw": _raw(f"""
            , keyed AS (SELECT * REPLACE (trim(job_url, ' ') AS job_url) FROM raw
                        WHERE trim(job_url, ' ') <> ''),
            spans AS (SELECT job_url, min(crawled_at) AS born, max(crawled_at) AS seen
                      FROM keyed GROUP BY job_url)
            SELECT b.job_url, {_UPSERT_COLUMNS}, {_ts('b.crawled_at', 'crawled_at')},
              CASE day(born) WHEN 1 THEN '2024-01-01 02:00:00' WHEN 5 THEN '2024-01-05 02:00:00'
                ELSE '2024-01-04 02:00:00' END AS created_at,
              CASE WHEN day(born) = 5 THEN 'insert' WHEN day(seen) = 5 THEN 'update'
                ELSE 'keep' END AS action
            FROM keyed b JOIN spans s ON s.job_url = b.job_url AND s.seen = b.crawled_at"""),
        "purge_duplicate_rows": _raw(
            f"SELECT {posting}, {_ts('crawled_at')} FROM raw r WHERE trim(job_url, ' ') <> '' AND "
            "crawled_at = (SELECT max(crawled_at) FROM raw n WHERE n.job_url = r.job_url)"),
        "csv_round_trip": _raw(
            f"SELECT {', '.join(f'''nullif({c}, '') AS {c}''' for c in POSTING_COLUMNS if c != 'crawled_at')}, "
            f"{_ts('crawled_at')} FROM raw WHERE trim(job_url, ' ') <> ''"),
        "dq_raw_gate": _raw(
            "SELECT '' AS missing_columns, count(*) AS row_count, "
            "count(*) FILTER (trim(job_url, ' ') = '') AS blank_keys, "
            "count(*) FILTER (trim(job_url, ' ') <> '') - count(DISTINCT nullif(trim(job_url, ' '), '')) "
            "AS duplicate_keys FROM raw"),
        "scd2_first": _model(_history("job_bk", "stg", _JOB_HISTORY_COLUMNS, 1)),
        "scd2_second": _model(_history("job_bk", "stg", _JOB_HISTORY_COLUMNS, 2)),
        "scd2_hard_delete": _model(_history("job_bk", "stg", _JOB_HISTORY_COLUMNS, 5)),
        "scd2_company": _model(_history("company_bk", _COMPANY_DAY, _COMPANY, 5)),
        "scd2_orders": f"""
            WITH early AS ({_ORDERS_LATEST.format(" WHERE o_orderdate < DATE '1996-01-01'")}),
            late AS ({_ORDERS_LATEST.format("")}),
            versions AS (
              SELECT e.*, CASE WHEN l.ts > e.ts THEN l.ts END AS ended FROM early e
              JOIN late l USING (o_custkey)
              UNION ALL
              SELECT l.*, NULL FROM late l LEFT JOIN early e USING (o_custkey)
              WHERE e.ts IS NULL OR l.ts > e.ts)
            SELECT o_custkey, o_orderkey, o_orderstatus,
              md5(o_custkey || '|' || CAST(ts AS VARCHAR)) AS dbt_scd_id,
              {_ts("ts", "dbt_updated_at")}, {_ts("ts", "dbt_valid_from")},
              {_ts("ended", "dbt_valid_to")} FROM versions""",
        "dim_job": _model(
            "SELECT job_sk, dbt_scd_id, external_job_id, CAST(source_id AS BIGINT) AS source_id, "
            "title, job_url, experience, desc_mota, desc_yeucau, desc_quyenloi, working_addresses, "
            f"working_times, {_VALID} FROM dim_job"),
        "dim_company": _model(
            f"SELECT company_sk, dbt_scd_id, company_id, {', '.join(_COMPANY)}, {_VALID} "
            "FROM dim_company"),
        "dim_date": _model(dates),
        "dim_date_as_written": _model(dates, written=True),
        "dim_location": _model("SELECT * FROM dim_location"),
        "dim_tag": _model("SELECT * FROM dim_tag"),
        "dim_source": _model(
            "SELECT CAST(1 AS BIGINT) AS source_id, 'job_board' AS source_name, count(*) AS n_postings "
            "FROM stg"),
        "bridge_job_tags": _model("SELECT * FROM bridge_job_tags"),
        "fct_full": _model(_FACT),
        "fct_incremental": _model(_FACT),
        "fct_incremental_stale": _model(f"""
            SELECT job_bk, {_ts("snapshot_ts")}, date_id,
              CAST(CASE WHEN job_bk LIKE 'a%' AND day(snapshot_ts) < 4 THEN 1 ELSE salary_avg END AS DOUBLE) AS salary_avg FROM ev"""),
        "stored_days": _model(f"""
            , two AS (SELECT * FROM ev WHERE day(snapshot_ts) <= 2),
            seen AS (SELECT job_bk, max(snapshot_ts) AS last, count(*) AS n FROM two GROUP BY job_bk),
            place AS (SELECT job_bk, snapshot_ts, min(location_name_norm) AS code FROM locs GROUP BY ALL)
            SELECT e.job_bk, {_ts("e.snapshot_ts", "snapshot_ts")}, e.date_id, CAST(e.salary_avg AS DOUBLE) AS salary_avg,
              e.snapshot_hash, e.job_bk AS external_job_id, n.title, {_ts("s.last", "dbt_valid_from")},
              s.n AS n_versions, s.n - 1 AS n_closed, p.code AS location_code
            FROM two e JOIN seen s USING (job_bk) JOIN two n ON n.job_bk = s.job_bk AND n.snapshot_ts = s.last
            LEFT JOIN place p ON p.job_bk = e.job_bk AND p.snapshot_ts = e.snapshot_ts"""),
        "stored_checks": _model(f"""
            , bad AS (SELECT count(*) AS n FROM ev WHERE day(snapshot_ts) = 3 AND salary_min > salary_max)
            SELECT 'error' AS finding UNION ALL SELECT 'late 0' UNION ALL SELECT 'salary 0'
            UNION ALL SELECT 'fct_job_snapshot expression_is_true salary_min is null or salary_max is null or salary_min <= salary_max ' || n
            FROM bad WHERE n > 0"""),
        "published_marts": _model(f"""
            , one AS (SELECT * FROM ev WHERE day(snapshot_ts) = 1),
            place AS (SELECT job_bk, snapshot_ts, min(location_name_norm) AS code FROM locs GROUP BY ALL)
            SELECT strftime(snapshot_ts, '%Y-%m-%d') AS date_day, {_initcap("p.code")} AS location_name, t.tag_name_norm AS tag_name,
              count(*) AS n_facts, count(DISTINCT e.company_bk) AS n_companies
            FROM one e JOIN place p USING (job_bk, snapshot_ts) JOIN tags t USING (job_bk, snapshot_ts) GROUP BY ALL"""),
        "upsert_new_columns": _raw(f"""
            , keyed AS (SELECT * REPLACE (trim(job_url, ' ') AS job_url) FROM raw WHERE trim(job_url, ' ') <> ''),
            spans AS (SELECT job_url, min(crawled_at) AS born, max(crawled_at) AS seen FROM keyed GROUP BY job_url)
            SELECT b.job_url, b.title, CASE WHEN day(seen) = 5 THEN b.tags END AS tags,
              CASE WHEN day(seen) = 5 THEN b.company_size END AS company_size, {_ts('b.crawled_at', 'crawled_at')},
              CASE WHEN day(born) = 5 THEN '2024-01-05 02:00:00' ELSE '2024-01-04 02:00:00' END AS created_at
            FROM keyed b JOIN spans s ON s.job_url = b.job_url AND s.seen = b.crawled_at"""),
        "stored_load": _raw(f"""
            , two AS (SELECT *, trim(job_url, ' ') AS link FROM raw WHERE trim(job_url, ' ') <> '' AND day(crawled_at) <= 2)
            SELECT link AS job_url, title, salary, tags, {_ts("crawled_at")},
              CASE WHEN min(crawled_at) OVER (PARTITION BY link) < DATE '2024-01-02' THEN '2024-01-01 02:00:00'
                ELSE '2024-01-02 02:00:00' END AS created_at
            FROM two QUALIFY row_number() OVER (PARTITION BY link ORDER BY crawled_at DESC) = 1"""),
        "salary_failed_texts": _raw("""
            SELECT 'salary_parse_failed' AS "check", 'salary' AS column_name, count(*) AS n_violations FROM raw
            WHERE job_url LIKE '%3.html%' OR job_url LIKE '%5.html%'"""),
        "dq_suite_damaged": _model(_suite(damaged=True)),
        "report_hotspots_cities": _model("""
            , place AS (SELECT job_bk, list_extract(
                ['TP. Hồ Chí Minh', 'Hà Nội', 'Đà Nẵng', 'Cần Thơ', 'Bình Dương', 'Đồng Nai', 'Hải Phòng', 'Bắc Ninh', 'Bà Rịa - Vũng Tàu',
                 'Thái Nguyên', 'Thừa Thiên Huế', 'Remote (Làm việc từ xa)', 'Remote (Làm việc từ xa)', 'Các tỉnh thành khác'],
                CAST(regexp_extract(job_url, '/x/([0-9]+)', 1) AS BIGINT) % 14 + 1) AS city
              FROM ev WHERE date_id = (SELECT max(date_id) FROM ev)),
            g AS (SELECT city, count(DISTINCT job_bk) AS n FROM place GROUP BY city)
            SELECT city, n AS job_count, """ + _share("n", "(SELECT sum(n) FROM g)") + """ AS market_share_percent FROM g"""),
        "late_rows": _model(
            "SELECT date_id, count(*) AS n_late FROM ev WHERE day(snapshot_ts) < 3 GROUP BY date_id"),
        "report_keywords": _model(f"""
            , g AS (SELECT t.tag_name, count(DISTINCT f.job_sk) AS n FROM fct_job_snapshot f
                    JOIN bridge_job_tags b ON b.job_sk = f.job_sk
                    JOIN dim_tag t ON t.tag_id = b.tag_id WHERE {_NOW} GROUP BY t.tag_name)
            SELECT tag_name AS keyword_name, n AS job_count,
              {_share("n", "(SELECT sum(n) FROM g)")} AS appearance_percentage
            FROM g ORDER BY n DESC, tag_name LIMIT 20"""),
        "report_salary": _model(f"""
            SELECT experience AS experience_level, CAST({_EXP_NO} AS BIGINT) AS sort_index,
              count(*) AS job_count,
              {_mean_million(_cents("salary_min", "salary_max"), "2 * count(salary_max)")}
                AS avg_salary_million_vnd,
              {_mean_million(_cents("salary_min"), "count(*)")} AS min_salary_million_vnd,
              {_mean_million(_cents("salary_max"), "count(salary_max)")} AS max_salary_million_vnd
            FROM fct_job_snapshot f JOIN dim_job j ON j.job_sk = f.job_sk
            WHERE {_NOW} AND salary_min > 0 AND experience IS NOT NULL
              AND lower(experience) NOT IN ({_EXCLUDED}) GROUP BY experience"""),
        "report_hotspots": _model(f"""
            , g AS (SELECT {_CITY} AS city, count(DISTINCT f.job_sk) AS n FROM fct_job_snapshot f
                    JOIN dim_location l ON l.location_id = f.location_id WHERE {_NOW} GROUP BY 1)
            SELECT city, n AS job_count, {_share("n", "(SELECT sum(n) FROM g)")}
              AS market_share_percent FROM g"""),
        "report_company_size": _model(f"""
            , g AS (SELECT {_SIZE} AS size, {_SIZE_NO} AS no, count(DISTINCT f.job_sk) AS n
                    FROM fct_job_snapshot f JOIN dim_company c ON c.company_sk = f.company_sk
                    WHERE {_NOW} GROUP BY 1, 2)
            SELECT size AS company_size, n AS job_count, CAST(no AS BIGINT) AS sort_index,
              {_share("n", "(SELECT sum(n) FROM g)")} AS hiring_share_percent FROM g"""),
        "report_top_companies": _model(f"""
            , g AS (SELECT c.company_name_full AS name, coalesce(c.company_size, 'Unknown') AS size,
                      count(DISTINCT f.job_sk) AS n
                    FROM fct_job_snapshot f JOIN dim_company c ON c.company_sk = f.company_sk
                    WHERE {_NOW} GROUP BY 1, 2 ORDER BY n DESC, name NULLS LAST, size LIMIT 15)
            SELECT {_initcap("name")} AS company_name, size AS company_size, n AS total_active_jobs
            FROM g"""),
        **dict.fromkeys(("report_trend", "stored_trend"), _model(f"""
            SELECT CAST(d.date_day AS VARCHAR) AS snapshot_date,
              count(DISTINCT f.job_sk) AS total_active_jobs,
              {_mean_million(_cents("salary_min", "salary_max"), "2 * count(salary_max)")}
                AS avg_market_salary_mil
            FROM fct_job_snapshot f JOIN dim_date d ON d.date_id = f.date_id
            WHERE d.date_day >= DATE '2024-01-06' - INTERVAL 30 DAY AND salary_min > 0
            GROUP BY d.date_day""")),
        "dq_not_null": _raw(" UNION ALL ".join(
            f"SELECT 'not_null' AS check, '{c}' AS column_name, count(*) - count({c}) AS n_violations "
            "FROM raw" for c in POSTING_COLUMNS)),
        "dq_unique": _raw(" UNION ALL ".join(
            f"SELECT 'unique' AS check, '{c}' AS column_name, (SELECT count(*) FROM (SELECT {c} FROM "
            f"raw WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS n_violations"
            for c in ("job_url", "company_url", "title"))),
        "dq_unique_combo": _raw(
            "SELECT 'unique_combination' AS check, 'key+crawled_at' AS column_name, count(*) AS "
            "n_violations FROM (SELECT 1 FROM raw GROUP BY lower(trim(job_url, ' ')), crawled_at "
            "HAVING count(*) > 1)"),
        "dq_relationships":
            "SELECT 'relationships' AS check, 'l_partkey' AS column_name, count(*) AS n_violations "
            "FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#1')",
        "dq_expression": _model(
            "SELECT 'expression_is_true' AS check, 'salary_range' AS column_name, count(*) AS "
            "n_violations FROM stg WHERE salary_min > salary_max"),
        "dq_freshness": _raw(
            f"SELECT {_ts('max(crawled_at)', 'max_loaded_at')}, '2024-01-06 03:00:00' AS as_of, "
            "date_diff('second', max(crawled_at), TIMESTAMP '2024-01-06 03:00:00') AS age_seconds, "
            "CASE WHEN max(crawled_at) < TIMESTAMP '2024-01-06 03:00:00' - INTERVAL 48 HOUR THEN "
            "'error' WHEN max(crawled_at) < TIMESTAMP '2024-01-06 03:00:00' - INTERVAL 25 HOUR THEN "
            "'warn' ELSE 'pass' END AS status FROM raw"),
        "dq_suite": _model(_suite()),
        "url_class": _raw(r"""
            , urls AS (
              SELECT trim(job_url, ' ') AS url FROM raw
              UNION ALL SELECT '/brand/b' || (o_orderkey % 7) || '/tuyen-dung/role-j' || o_custkey
                || '.html?from=list' FROM orders
              UNION ALL SELECT url FROM pages),
            parts AS (SELECT url, regexp_extract(url,
                '^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)', 3) AS path FROM urls)
            SELECT url, path, regexp_matches(path, '^/viec-lam/.+/[0-9]+\.html$')
              OR regexp_matches(path, '^/brand/.+/tuyen-dung/.+-j[0-9]+\.html$') AS is_job FROM parts"""),
        "title_clean":
            r"SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN regexp_replace(p_name, '\s+', ' ', "
            r"'g') || '  ' || p_brand END AS title FROM part",
        "deadline_extract": _raw(
            f"SELECT job_url, {_ts('crawled_at')}, CASE WHEN deadline LIKE '%/%' THEN deadline "
            "ELSE 'Hạn nộp: ' || deadline || ' (24h)' END AS deadline FROM raw"),
        "initcap_text": _raw(
            f"SELECT job_url, {_ts('crawled_at')}, {_initcap('working_addresses')} AS place, "
            f"{_initcap('''concat_ws('-', company_website, tags)''')} AS label FROM raw"),
        "explode_document_lines": rf"""
            SELECT DISTINCT doc_id, line FROM (
              SELECT doc_id, {_FLAT.format("l")} AS line
              FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents))
            WHERE line <> ''""",
        "share_of_total": f"""
            WITH g AS (SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS n
                       FROM lineitem GROUP BY ALL)
            SELECT l_returnflag, l_linestatus, n AS order_count,
              {_share("n", "(SELECT sum(n) FROM g)")} AS share_percent FROM g""",
        "latest_event": """
            SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
              FROM events) WHERE rn = 1""",
        "extract_pages": rf"""
            WITH parts AS (
              SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title,
                regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS h1,
                regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's') AS ads,
                array_to_string(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'),
                  'href="([^"]*)"', 1), ' ') AS links
              FROM pages)
            SELECT page_id, {", ".join(
                f"nullif({_FLAT.format(_unescape(c))}, '') AS {c}" for c in ("title", "h1", "ads"))},
              {_unescape("links")} AS links FROM parts""",
        "extract_listing": _raw(f", {_CARD} SELECT * FROM cards"),
        "load_batch": _raw(f"""
            SELECT trim(job_url, ' ') AS job_url, {", ".join(
                f"nullif({c}, '') AS {c}" for c in POSTING_COLUMNS if c not in ("job_url", "crawled_at"))},
              {_ts("crawled_at")}
            FROM (SELECT *, row_number() OVER (PARTITION BY trim(job_url, ' ') ORDER BY crawled_at DESC) AS rn
                  FROM raw WHERE trim(job_url, ' ') <> '') WHERE rn = 1"""),
        "newest_drop": _raw(
            "SELECT strftime(crawled_at, '%Y-%m-%d') AS day, count(*) AS n_rows FROM raw "
            "WHERE day(crawled_at) IN (3, 4) GROUP BY 1"),
        "load_gates": _raw("""
            SELECT 'salary,tags' AS missing_columns, count(*) AS row_count,
              count(*) FILTER (trim(job_url, ' ') = '') AS blank_keys,
              count(*) FILTER (trim(job_url, ' ') <> '')
                - count(DISTINCT trim(job_url, ' ')) FILTER (trim(job_url, ' ') <> '') AS duplicate_keys,
              count(*) FILTER (job_url LIKE '%7.html%') AS bad_crawl_times FROM raw"""),
        "schema_sync": _model("""
            SELECT date_id, CASE WHEN day(snapshot_ts) < 4 THEN 'stale' ELSE salary_currency END
                AS salary_currency, count(*) AS n_rows,
              count(CASE WHEN day(snapshot_ts) >= 4 THEN salary_avg END) AS n_averages
            FROM ev GROUP BY ALL"""),
        "listing_dedup": _raw(f"""
            , {_CARD}
            SELECT page_id, job_url, title, salary FROM (
              SELECT *, row_number() OVER (
                PARTITION BY regexp_replace(job_url, '^[A-Za-z]+://[^/]*', '') ORDER BY page_id) AS rn
              FROM cards) WHERE rn = 1"""),
        "extract_detail": _raw(_DETAIL),
        "extract_all_days": _raw(f"""
            , {_CARD}, {_COMPANY_PAGE}, detail AS ({_DETAIL}),
            d AS (SELECT * REPLACE (split_part(job_url, '#', 1) AS job_url) FROM detail
                  QUALIFY row_number() OVER (PARTITION BY split_part(job_url, '#', 1)
                                             ORDER BY split_part(job_url, '#', 2) DESC) = 1),
            b AS (SELECT * FROM cards QUALIFY row_number() OVER (
                    PARTITION BY regexp_replace(job_url, '^[A-Za-z]+://[^/]*', '') ORDER BY page_id) = 1),
            j AS (SELECT b.* EXCLUDE (company_url), coalesce({_filled("b.company_url")},
                    {_filled("d.company_url_from_job")}) AS link FROM b LEFT JOIN d USING (job_url))
            SELECT coalesce({_filled("d.title")}, {_filled("j.title")}, '') AS title, j.job_url,
              coalesce(j.link, '') AS company_url, coalesce({_filled("d.salary")}, {_filled("j.salary")}, '') AS salary,
              coalesce({_filled("d.location")}, {_filled("j.address_list")}, '') AS location,
              coalesce({_filled("d.experience")}, {_filled("j.exp_list")}, '') AS experience,
              {", ".join(f"coalesce(d.{c}, '') AS {c}" for c in (
                  "deadline", "tags", "desc_mota", "desc_yeucau", "desc_quyenloi", "working_addresses",
                  "working_times"))},
              coalesce({_filled("d.company_name_full")}, {_filled("c.company_name_full")}, {_filled("j.company")}, '')
                AS company_name_full,
              coalesce({_filled("d.company_website")}, {_filled("c.company_website")}, {_filled("j.link")}, '')
                AS company_website,
              {", ".join(f"coalesce({_filled(f'c.{c}')}, {_filled(f'd.{c}')}, '') AS {c}" for c in (
                  "company_size", "company_followers", "company_industry", "company_address"))},
              coalesce({_filled("c.company_description")}, '') AS company_description,
              '2024-01-06 00:00:00' AS crawled_at
            FROM j LEFT JOIN d ON d.job_url = j.job_url LEFT JOIN company_page c ON c.company_url = j.link"""),
        "extract_company": f"WITH {_COMPANY_PAGE} SELECT * FROM company_page",
        "merge_record": _raw(f"""
            , {_COMPANY_PAGE},
            keyed AS (SELECT * REPLACE (trim(job_url, ' ') AS job_url) FROM raw
                      WHERE trim(job_url, ' ') <> ''),
            d AS (SELECT * FROM keyed WHERE day(crawled_at) = 4 AND title IS NOT NULL),
            b AS (SELECT k.*, coalesce(company_url, CASE WHEN EXISTS (
                    SELECT 1 FROM d WHERE d.job_url = k.job_url) THEN 'https://other.example/c' END)
                    AS link FROM keyed k WHERE day(crawled_at) = 5)
            SELECT coalesce(d.title, b.title, '') AS title, b.job_url,
              coalesce(b.link, '') AS company_url, coalesce(d.salary, b.salary, '') AS salary,
              coalesce({_filled("d.location")}, {_filled("b.location")}, '') AS location,
              coalesce(b.experience, '') AS experience, coalesce(d.deadline, '') AS deadline,
              coalesce(d.tags, '') AS tags, coalesce(d.desc_mota, '') AS desc_mota,
              coalesce(d.desc_yeucau, '') AS desc_yeucau, '' AS desc_quyenloi,
              coalesce(d.working_addresses, '') AS working_addresses,
              coalesce(d.working_times, '') AS working_times,
              coalesce(c.company_name_full, 'card co') AS company_name_full,
              coalesce(d.company_website, c.company_website, b.link, '') AS company_website,
              coalesce(c.company_size, d.company_size, '') AS company_size,
              coalesce({_filled("d.company_followers")}, '') AS company_followers,
              coalesce(c.company_industry, d.company_industry, '') AS company_industry,
              coalesce(c.company_address, {_filled("d.company_address")}, '') AS company_address,
              coalesce(c.company_description, '') AS company_description,
              '2024-01-06 00:00:00' AS crawled_at
            FROM b LEFT JOIN d ON d.job_url = b.job_url
            LEFT JOIN company_page c ON c.company_url = b.link"""),
    }
