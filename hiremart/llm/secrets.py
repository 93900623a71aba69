"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds, for each
blob, the rule versions it was scanned with and what they found. A run scans only the pairs of blob
and rule version that the ledger lacks, each blob once however many paths hold it, appends the
findings, and joins the ledger back to all paths. Changing a rule means raising its version: then
only that rule runs again over the known blobs.

Spans are code points, end exclusive, leftmost and non-overlapping within a rule; overlapping spans
of different rules are all kept. Null texts count as empty, null ids are paths like any other,
repeated rows give repeated rows, an empty table gives no rows and an empty addition to the ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hiremart.llm.common import let, text_of, unused
from hiremart.sources import files
from hiremart.sources.scratch import Scratch


@dataclass(frozen=True)
class Rule:
    """A match counts if its group ``group`` has ``least`` characters; ``hints``: one must be in the text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules of the contract, then public token formats; spans sort in this order.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # a run of [0-9a-f]+ shorter than that would be dropped anyway
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, ("xox",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*", 0, 1, ("eyj",)),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,30}PRIVATE KEY-----)?",
         0, 1, ("private key-----",)),
)
_BLOCK = 512
_SPAN = "struct<start:int,rank:int,end:int,kind:string>"
_LEDGER = f"blob binary, scanned array<string>, spans array<{_SPAN}>"


def _appended(values: Column, first: Column, value: Callable[[Column, Column], Column]) -> Column:
    """Running state: element i is the state before ``values[i]``; for short arrays."""
    start = F.struct(first.alias("now"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, start, lambda s, v: F.struct(
        value(s["now"], v).alias("now"), F.concat(s["out"], F.array(s["now"])).alias("out")))["out"]


def sums_before(lengths: Column) -> Column:
    """Sum of the elements before each one, in blocks so that long arrays stay linear."""
    def blocks(values: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
                           lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, v: a + v)

    def joined(parts: Column) -> Column:
        starts = _appended(F.transform(parts, total), F.lit(0), lambda a, v: a + v)
        return F.flatten(F.zip_with(parts, starts, lambda p, s: _appended(p, s, lambda a, v: a + v)))

    return F.when(F.size(lengths) > 0, let(lengths, lambda n: let(blocks(n), joined))).otherwise(
        F.array().cast("array<int>"))


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule: the pieces between the matches give the places of the matches."""
    pattern = F.lit(rule.pattern)

    def build(found: Column) -> Column:
        between = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
        length = F.transform(found, lambda m: F.length(m))
        steps = F.zip_with(length, F.slice(between, 2, F.size(length)), lambda a, b: a + b)
        starts = F.transform(sums_before(steps), lambda s: s + F.element_at(between, 1))
        groups = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
        spans = F.zip_with(F.arrays_zip(starts.alias("s"), length.alias("n")), groups, lambda m, g: F.when(
            F.length(g) >= rule.least, F.struct(m["s"].alias("start"), F.lit(rank).alias("rank"),
                                                (m["s"] + m["n"]).alias("end"), F.lit(rule.kind).alias("kind"))))
        return F.filter(spans, lambda s: s.isNotNull())

    maybe = text.rlike(rule.pattern)
    if rule.hints:
        hinted = F.lit(False)
        for hint in rule.hints:
            hinted = hinted | F.contains(F.lower(text), F.lit(hint))
        maybe = hinted & maybe
    return F.when(maybe, let(F.regexp_extract_all(text, pattern, F.lit(0)), build)).otherwise(
        F.array().cast(f"array<{_SPAN}>"))


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``spans`` to rows of (text, pending): those of the pending rules."""
    parts = []
    for rank, rule in enumerate(rules):
        found = F.when(F.array_contains("pending", rule.key), spans_of(F.col("text"), rule, rank)).otherwise(
            F.array().cast(f"array<{_SPAN}>"))
        texts = texts.withColumn(f"_spans{rank}", found)
        parts.append(f"_spans{rank}")
    return texts.withColumn("spans", F.sort_array(F.concat(*parts))).drop(*parts)


def read_ledger(docs: DataFrame, ledger: str) -> DataFrame:
    spark, schema = docs.sparkSession, T._parse_datatype_string(_LEDGER)
    if not files.exists(spark, ledger):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    return spark.read.schema(schema).parquet(ledger)


def blob_of(column: str = "text") -> Column:
    return F.unhex(F.sha2(text_of(column).cast("binary"), 256))


def addressed(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(_id, blob) of each path."""
    return docs.select(F.col(id_column).alias("_id"), blob_of().alias("blob"))


def scan_blobs(docs: DataFrame, paths: DataFrame, ledger: str, scratch: Scratch, rules: tuple[Rule, ...] = RULES,
               id_column: str = "doc_id") -> DataFrame:
    """(blob, spans) of each blob in ``docs`` (id, text) that has findings under ``rules``, written.

    ``paths`` are their addresses. ``docs`` may hold several versions of a path. ``ledger`` is a folder on shared
    storage; what this run scans is appended to it. Of the ledger only rows of the run's blobs are grouped.
    """
    every = F.array(*[F.lit(r.key) for r in rules])
    firsts = scratch.stage(paths.groupBy("blob").agg(F.min("_id").alias("_first")))

    def of_run(rows: DataFrame) -> DataFrame:
        return rows.join(firsts.select("blob"), "blob", "left_semi")

    known = of_run(read_ledger(docs, ledger).select("blob", "scanned")).groupBy("blob").agg(
        F.flatten(F.collect_set("scanned")).alias("_done"))
    pending = firsts.join(known, "blob", "left").select(
        F.col("blob").alias("_blob"), "_first",
        F.array_except(every, F.coalesce("_done", F.array().cast("array<string>"))).alias("pending"),
    ).where(F.size("pending") > 0)
    texts = docs.select(F.col(id_column).alias("_id"), text_of().alias("text"), blob_of().alias("blob"))
    unseen = texts.join(pending, texts["_id"].eqNullSafe(pending["_first"]) & (texts["blob"] == pending["_blob"]))
    found = scan(unseen.select("blob", "text", "pending"), rules)
    found.select("blob", F.col("pending").alias("scanned"), "spans").dropDuplicates(["blob"]).write.mode(
        "append").parquet(ledger)
    kinds = {r.kind for r in rules}
    # A raised version supersedes the findings of the older one: of a kind, those of the scans with its present version.
    current = F.filter("spans", lambda s: s["kind"].isin(*kinds) & F.array_contains(
        "scanned", F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.key)]), s["kind"])))
    results = read_ledger(docs, ledger).where(F.size("spans") > 0).select("blob", current.alias("spans"))
    return scratch.stage(of_run(results.where(F.size("spans") > 0)).groupBy("blob").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")))


def scan_history(docs: DataFrame, ledger: str, scratch: Scratch, rules: tuple[Rule, ...] = RULES,
                 id_column: str = "doc_id") -> DataFrame:
    """(id, spans) of each row of ``docs`` (id, text): the findings of its blob.

    Findings are written before they meet their paths, so that both sides of the join come straight out of a
    shuffle and a content held by very many paths is split over tasks.
    """
    paths = scratch.stage(addressed(docs, id_column))
    found = scan_blobs(docs, paths, ledger, scratch, rules, id_column)
    return paths.join(found, "blob", "left").select(
        F.col("_id").alias(id_column), F.coalesce("spans", F.array().cast(f"array<{_SPAN}>")).alias("spans"))


def redact(docs: DataFrame, ledger: str, scratch: Scratch, rules: tuple[Rule, ...] = RULES,
           id_column: str = "doc_id") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by its kind in brackets."""
    blob, spans = unused(docs, "blob", "spans")
    found = scan_blobs(docs, addressed(docs, id_column), ledger, scratch, rules, id_column)
    found = found.select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    columns = [F.when(F.col(spans).isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col(spans))).alias("text")
               if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return docs.join(found, blob_of() == F.col(blob), "left").select(*columns)


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each stretch covered by spans (sorted by start) replaced by its first kind in brackets."""
    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], F.array(F.concat(
            F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), s["kind"], F.lit("]")))))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substr(text, s["at"] + 1, F.length(text))))).otherwise(text)
