"""Token counts of whole texts by a map-side two-tier look-up.

The lengths of the most frequent white-space pre-tokens, counted in a bounded sample of whole texts drawn by a hash
over all documents, are broadcast as a compact table; everything else is encoded once per worker and kept in the worker's bounded cache.
No pre-token is ever shuffled, and the counts do not depend on what the table holds.

Null texts count as empty (0 tokens), null ids are passed on, repeated rows are counted each, columns
other than those used are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from hiremart.llm.common import bounded_share, made_in_task, map_rows, text_of
from hiremart.llm.word_tokens import worker_ids

#: Bounds: texts that the table is counted from, pre-tokens counted at once, entries broadcast, longest entry.
WARM_ROWS, COUNTED, TABLE, ENTRY_CHARS = 4_000, 1_000_000, 50_000, 40

_LENGTHS: dict[tuple[str, int], dict[str, int]] = {}


def frequent_lengths(docs: DataFrame, path: str) -> tuple[str, bytes]:
    """Frequent pre-tokens, one a line, and a byte with the token count of each: at most 2 MB."""
    def count(blocks: Iterator[dict[str, list]]) -> tuple[str, bytes]:
        tokens, seen = worker_ids(path), Counter()
        for block in blocks:
            for text in block["text"]:
                seen.update(tokens.split(text))
                if len(seen) > COUNTED:  # the rare half goes
                    seen = Counter(dict(seen.most_common(COUNTED // 2)))
        chunks = [c for c, n in seen.most_common(TABLE) if n > 1 and len(c) <= ENTRY_CHARS and c.isprintable()]
        return "\n".join(chunks), bytes(min(255, len(tokens.encode(c)) // 4) for c in chunks)

    texts = docs.select("text").where("text is not null")
    return made_in_task(bounded_share(texts, ["text"], WARM_ROWS), [F.xxhash64("text")], count)


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_tokens) for each row of ``docs`` (id, text)."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path))
    key = table._jbroadcast.id()

    def count(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        tokens = worker_ids(path)
        if (path, key) not in _LENGTHS:
            chunks, lengths = table.value
            _LENGTHS.clear()
            _LENGTHS[path, key] = {c: n for c, n in zip(chunks.split("\n"), lengths) if c and n < 255}
        frequent = _LENGTHS[path, key]
        misses: dict[str, int] = {}
        for block in blocks:
            counts = []
            for text in block["text"]:
                chunks = tokens.split(text)
                found = list(map(frequent.get, chunks))
                if None in found:
                    for at, n in enumerate(found):
                        if n is None:
                            n = misses.get(chunks[at])
                            if n is None:
                                if len(misses) >= tokens.limit:
                                    misses.clear()
                                n = misses[chunks[at]] = len(tokens.encode(chunks[at])) // 4
                            found[at] = n
                counts.append(sum(found))
            yield {"_id": block["_id"], "n_bytes": block["n_bytes"], "n_tokens": counts}

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), text_of().alias("text"),
                       F.octet_length(text_of()).cast("bigint").alias("n_bytes"))
    return map_rows(rows, count, f"_id {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("_id", id_column)
