"""SQL twins of the operators that SQL can express over the whole tables."""

from __future__ import annotations

from hiremart.llm import secrets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates(words: int = 4, percent: int = 80) -> str:
    """Exact classes: all pairs that share a shingle, then everything reachable."""
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""
    WITH RECURSIVE cut AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) >= {words}
          THEN list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: {run}))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM cut),
    one AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
    edges AS (
      SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY ALL HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
    reach(x, y) AS (
      SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edges e ON e.x = r.y),
    class AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
    FROM sets JOIN class ON x = doc_id"""


def _spans(rule: secrets.Rule, rank: int) -> str:
    """Spans of one rule: the pieces between the matches give the places of the matches."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
      SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, unnest(list_transform(range(1, len(m) + 1), lambda i:
          {{'a': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(
             m[1:i - 1], lambda x: length(x))), 0), 'n': length(m[i]), 'g': length(g[i])}})) AS s
      FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
              string_split_regex(t, '{pattern}') AS p FROM texts)"""


def secret_scan() -> str:
    found = " UNION ALL ".join(
        f"SELECT doc_id, kind, rank, CAST(s.a AS BIGINT) AS a, CAST(s.a + s.n AS BIGINT) AS b "
        f"FROM ({_spans(rule, rank)}) WHERE s.g >= {rule.least}" for rank, rule in enumerate(secrets.RULES))
    item = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank)"
    base = "kind IN ('assign', 'access', 'hex')"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({found})
    SELECT doc_id, {counts}, sha256(coalesce({item} FILTER ({base}), '')) AS base_sha256,
      coalesce({item}, '') AS spans
    FROM texts LEFT JOIN found USING (doc_id) GROUP BY doc_id"""


def exact_dedup() -> str:
    return """
    WITH texts AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[ \\x09-\\x0D]', '', 'g') AS c
      FROM documents)
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY c) AS group_size,
      row_number() OVER best = 1 AS kept, sha256(c) AS text_sha256
    FROM texts WINDOW best AS (PARTITION BY c ORDER BY length(t) DESC, doc_id)"""


def _crc32(digits: str) -> str:
    """CRC-32 of an ASCII text, eight bit steps a character."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({digits}, ''), lambda d: ascii(d)::BIGINT)), "
            f"lambda c, b: {bits}), 4294967295)")


def merkle(fan: int = 8, levels: int = 9, top_levels: int = 3) -> str:
    """Proofs level by level: a finished tree goes up unchanged. Room for fan ** levels rows of a language."""
    value = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def climb(name: str, tree: str, steps: int) -> str:
        run = f"PARTITION BY {tree}, i // {fan} ORDER BY i ROWS BETWEEN"
        parts = []
        for k in range(steps):
            parts.append(f"""{name}{k}s AS (SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            parts.append(f"""{name}{k + 1} AS (SELECT {tree}, i // {fan} AS i, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
              (n + {fan - 1}) // {fan} AS n FROM {name}{k} GROUP BY {tree}, i // {fan}, n)""")
        return ", ".join(parts)

    def walk(name: str, source: str, into: str, place: str, on: str, steps: int) -> str:
        parts, before = [], source
        for k in range(steps):
            parts.append(f"""{into}{k} AS (SELECT w.* EXCLUDE ({place}, f, p), w.{place} // {fan} AS {place}, CASE WHEN s.n = 1 THEN f ELSE sha256(l || f || r) END AS f,
              CASE WHEN s.n = 1 THEN p ELSE p || l || r END AS p FROM {before} w JOIN {name}{k}s s ON {on} w.{place} = s.i)""")
            before = f"{into}{k}"
        return ", ".join(parts)

    return f"""
    WITH leaves AS (
      SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {leaf('text')} AS leaf,
        CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed FROM documents),
    a0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h,
      count(*) OVER (PARTITION BY tree) AS n, doc_id, changed FROM leaves),
    {climb('a', 'tree', levels)},
    b0 AS (SELECT 0 AS one, tree AS i, h, count(*) OVER () AS n FROM a{levels}),
    {climb('b', 'one', top_levels)},
    w AS (SELECT doc_id, tree, i AS place, h AS leaf, coalesce(changed, h) AS f, '' AS p FROM a0),
    {walk('a', 'w', 'u', 'place', 'w.tree = s.tree AND', levels)},
    {walk('b', f'u{levels - 1}', 'v', 'tree', '', top_levels)}
    SELECT doc_id, leaf, t.h AS subroot, b.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b.h AS verified
    FROM v{top_levels - 1} v JOIN (SELECT doc_id, tree AS home FROM w) USING (doc_id) JOIN a{levels} t ON t.tree = home CROSS JOIN b{top_levels} b"""


def oracle_sql() -> dict[str, str]:
    return {"op4_chosen_path": near_duplicates(), "op8_secrets": secret_scan(), "op11_exact_dedup": exact_dedup(),
            "op13_merkle": merkle()}
