"""Run configuration and the fixed values the models and reports depend on."""

from __future__ import annotations

from dataclasses import dataclass

# The posting record, in file order. Every column is text on disk.
POSTING_COLUMNS = [
    "title", "job_url", "company_url", "salary", "location", "experience", "deadline", "tags",
    "desc_mota", "desc_yeucau", "desc_quyenloi", "working_addresses", "working_times",
    "company_name_full", "company_website", "company_size", "company_followers",
    "company_industry", "company_address", "crawled_at", "company_description",
]

# A drop must carry all of these; crawled_at is judged by the load gate instead.
REQUIRED_COLUMNS = [c for c in POSTING_COLUMNS if c != "crawled_at"]

# Attributes an upsert compares and overwrites.
UPDATE_COLUMNS = [c for c in POSTING_COLUMNS if c not in ("job_url", "crawled_at")]

# Fixed values: (label, substrings) in match order; the first hit names the city.
CITY_LABELS = [
    ("TP. Hồ Chí Minh", ("hồ chí minh", "ho chi minh")),
    ("Hà Nội", ("hà nội", "ha noi")),
    ("Đà Nẵng", ("đà nẵng", "da nang")),
    ("Cần Thơ", ("cần thơ", "can tho")),
    ("Bình Dương", ("bình dương", "binh duong")),
    ("Đồng Nai", ("đồng nai", "dong nai")),
    ("Hải Phòng", ("hải phòng", "hai phong")),
    ("Bắc Ninh", ("bắc ninh", "bac ninh")),
    ("Bà Rịa - Vũng Tàu", ("vũng tàu", "vung tau")),
    ("Thái Nguyên", ("thái nguyên", "thai nguyen")),
    ("Thừa Thiên Huế", ("huế", "hue")),
    ("Remote (Làm việc từ xa)", ("remote", "từ xa")),
]
CITY_OTHER = "Các tỉnh thành khác"

# Fixed values: (label, sort index, substrings) in match order.
SIZE_BUCKETS = [
    ("1-9 nhân viên", 1, ("1-9",)),
    ("10-24 nhân viên", 2, ("10-24",)),
    ("25-99 nhân viên", 3, ("25-99",)),
    ("100-499 nhân viên", 4, ("100-499",)),
    ("500-1000 nhân viên", 5, ("500-1000",)),
    ("1000+ nhân viên", 6, ("1000+", "3000+", "5000+", "10000+")),
]
SIZE_OTHER = ("Unknown", 99)

# Fixed values: (sort index, substring) in match order.
EXPERIENCE_ORDER = [
    (1, "dưới 1 năm"), (2, "1 năm"), (3, "2 năm"), (4, "3 năm"), (5, "4 năm"), (6, "5 năm"),
]
EXPERIENCE_OTHER = 99
EXPERIENCE_EXCLUDED = ["thỏa thuận", "negotiable", "không yêu cầu"]

REGEX_MODES = ("intended", "as_written")


@dataclass(frozen=True)
class Config:
    """Parameters of one deployment.

    ``regex_mode`` picks how the text-cleaning patterns read: ``intended`` collapses whitespace
    and parses deadlines; ``as_written`` treats their doubled backslashes literally, which leaves
    whitespace alone, strips a leading letter ``s`` from locations and never parses a deadline.
    ``buckets`` is the number of key buckets of the raw table and of open history; it belongs to a
    store and should give buckets of about a gigabyte.
    """

    source_id: int = 1
    source_name: str = "job_board"
    base_url: str = "https://jobs.example"
    file_prefix: str = "postings"
    usd_rate: int = 26000
    regex_mode: str = "intended"
    warn_hours: int = 25
    error_hours: int = 48
    trend_days: int = 30
    buckets: int = 16

    def __post_init__(self) -> None:
        if self.regex_mode not in REGEX_MODES:
            raise ValueError(f"regex_mode must be one of {REGEX_MODES}: {self.regex_mode!r}")
