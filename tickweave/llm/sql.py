"""SQL of the queries of this folder, where SQL can express them."""

from __future__ import annotations


def _spans(kinds: list[tuple[str, str, int, str]], n_base: int) -> str:
    """kinds: name, pattern, group that the check sees as ``inside``, check."""
    found = " UNION ALL ".join(
        f"""SELECT rid, rank, kind, v, first FROM (SELECT rid, {rank} AS rank, '{kind}' AS kind, v, inside, text,
                   list_sum(list_transform(gaps[1:n], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(hits[1:n - 1], lambda x: length(x))), 0) AS first
            FROM (SELECT rid, text, gaps, hits, unnest(range(1, len(hits) + 1)) AS n, unnest(hits) AS v, unnest(ins) AS inside
                  FROM (SELECT rid, text, regexp_split_to_array(text, '{pattern}') AS gaps,
                               regexp_extract_all(text, '{pattern}') AS hits,
                               regexp_extract_all(text, '{pattern}', {group}) AS ins
                        FROM t WHERE regexp_matches(text, '{pattern}'))))
            WHERE {check}"""
        for rank, (kind, pattern, group, check) in enumerate(kinds)
    )
    item = "kind || ':' || first::BIGINT || ':' || (first + length(v))::BIGINT"
    counts = ", ".join(
        f"count(rank) FILTER (rank = {rank})::BIGINT AS n_{kinds[rank][0]}" for rank in range(n_base)
    )
    return f"""
        WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        s AS ({found})
        SELECT doc_id, {counts},
               sha256(coalesce(string_agg({item}, ',' ORDER BY first, rank) FILTER (rank < {n_base}), '')) AS base_sha256,
               coalesce(string_agg({item}, ',' ORDER BY first, rank), '') AS spans
        FROM t LEFT JOIN s USING (rid) GROUP BY rid, doc_id"""


SECRETS = _spans(
    [
        (
            "assign",
            """((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
            2,
            "length(inside) >= 6",
        ),
        ("access", "AKIA[A-Z0-9]+", 0, "length(v) >= 20"),
        ("hex", "[0-9a-f]+", 0, "length(v) >= 24"),
        ("pem", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, "true"),
        ("forge", "gh[pousr]_[A-Za-z0-9]{36}", 0, "true"),
    ],
    3,
)

_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(string_split(reverse({_DIGITS}), ''),
    lambda d, i: CASE WHEN i % 2 = 1 THEN d::INT ELSE (d::INT * 2) % 10 + d::INT // 5 END)) % 10 = 0"""
_ACCOUNT = "replace(v, ' ', '')"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_ACCOUNT}[5:] || {_ACCOUNT}[:4], ''),
    lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ord(c) - 48 ELSE ord(c) - 55 END)),
    lambda r, x: (r * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1"""

PII = _spans(
    [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, "true"),
        (
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            0,
            "list_max(list_transform(string_split(v, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 256))) <= 255",
        ),
        ("card", r"[0-9]([\x20-]?[0-9])+", 0, f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0, f"length({_DIGITS}) BETWEEN 10 AND 15"),
        (
            "iban",
            r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
            0,
            f"length({_ACCOUNT}) BETWEEN 15 AND 34 AND {_MOD97}",
        ),
        (
            "ssn",
            "[0-9]{3}-[0-9]{2}-[0-9]{4}",
            0,
            "regexp_matches(lower(text[greatest(first - 40, 0)::BIGINT + 1:first::BIGINT]), '(?:^|[^a-z])(?:ssn|social security|tax id)')",
        ),
    ],
    4,
)

WARC = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
    f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
    SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
           CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM f"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, least(len(w), 10) AS n
                FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    grams AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
              FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
                    FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    m AS (SELECT rid, i, grams.n, item_id FROM grams JOIN windows USING (gram)),
    hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
    items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
              FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM m WHERE item_id IS NOT NULL) GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)"""
