"""The results of the queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from logscore.llm import quality

# Separators of the two kinds of words.
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Base32 of a SHA-1 in hex: five hex digits are a 20-bit number, four letters.
_BASE32 = """
    array_to_string(list_transform(range(0, 32), lambda k: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST(('0x' || substr(sha, 1 + 5 * (k // 4), 5))::INT // (32 ** (3 - k % 4))::INT
            % 32 AS INT), 1)), '')
"""

WARC = f"""
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS sha
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY sha, n) AS first FROM payloads
)
SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to, 1 AS n_requests
FROM firsts
"""

COUNTED = rf"""
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM (
        SELECT doc_id, lang, source, text, 0 AS text_key, len(w) AS n_words,
            length(array_to_string(w, '')) AS word_chars,
            length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
            coalesce(repeated, 0) AS n_repeat_words
        FROM (
            SELECT *, regexp_extract_all(text, '{_SPACED}') AS w,
                list_filter(string_split(text, chr(10)),
                    lambda x: regexp_matches(x, '{_SPACED}')) AS l
            FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)
        ) LEFT JOIN (
            SELECT doc_id, count(DISTINCT k) AS repeated
            FROM (
                SELECT doc_id, unnest(range(i, i + 3)) AS k
                FROM (
                    SELECT *, count(*) OVER (PARTITION BY doc_id, a) AS times
                    FROM (
                        SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS a
                        FROM (
                            SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM (
                                SELECT doc_id,
                                    regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w
                                FROM documents)
                        )
                    )
                ) WHERE times > 1
            ) GROUP BY doc_id
        ) USING (doc_id)
    )
"""


def _quality() -> str:
    """The statements of the operator one after the other, over counts of this engine's own."""
    names = {"counted": "counted", "groups": "groups", "rows": "stats", "centres": "centres"}
    parts = [
        ("counted", COUNTED),
        ("groups", quality.GROUPS.format(**names)),
        ("stats", quality.ROWS.format(**names)),
        ("centres", quality.CENTRES.format(**names)),
        ("estimates0", quality.STARTS.format(**names)),
    ]
    for step in range(quality.STEPS):
        distance = quality.DISTANCE if step else quality.FIRST_DISTANCE
        names |= {"estimates": f"estimates{step}", "cuts": f"cuts{step}"}
        parts.append((f"cuts{step}", quality.cuts(distance).format(**names)))
        parts.append((f"estimates{step + 1}", quality.estimates(distance).format(**names)))
    names |= {"estimates": f"estimates{quality.STEPS}", "best": "best"}
    parts.append(("best", quality.BEST.format(**names)))
    parts.append(("outliers", quality.OUTLIERS.format(**names)))
    tables = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in parts)
    return f"""
WITH {tables}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outliers) AS kept
FROM counted
"""


NEAR_DUPLICATES = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN
            list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END) AS shingle
    FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y USING (shingle)
    WHERE x.doc_id <> y.doc_id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT doc_id, b FROM reached JOIN links ON a = other
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


DECONTAMINATE = rf"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark
), windows AS (
    SELECT item_id, least(len(w), 13) AS size,
        unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
            lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS words
    FROM items WHERE len(w) > 0
), places AS (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w
    FROM worded, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), hits AS (
    SELECT doc_id, item_id, i, size
    FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words FROM places)
    JOIN windows USING (size, words)
), covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM worded LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


REPEATS = """
WITH hexed AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM hexed)
), gone AS (
    SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS first FROM windows)
    WHERE doc_id > first
), runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b
    FROM (
        SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (
            SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50
                THEN 0 ELSE 1 END AS new
            FROM gone
        )
    ) GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_,
    FROM runs
), kept AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
        string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS k
    FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM hexed LEFT JOIN kept USING (doc_id)
"""


#: CRC-32 of a number in decimal, bit by bit; 3988292384 is its fixed polynomial.
_CRC32 = """
    xor(list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
            lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295::BIGINT)
"""

TRIE = rf"""
WITH turns AS (
    SELECT conv_id, digest, n_words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS i
    FROM (
        SELECT conv_id, turn, len(regexp_extract_all(text, '{_SPACED}')) AS n_words,
            sha256(strlen(role) || ':' || role || text) AS digest
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL)
    )
), convs AS (
    SELECT *, {_CRC32} % 4 AS h, conv_id - conv_id % 20 AS base
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)
), taken AS (
    SELECT c.conv_id, c.h, c.n, least(c.h, coalesce(b.n, 0)) AS n_taken, c.base
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
    SELECT conv_id, n_taken + i - h AS depth, digest, n_words
    FROM turns JOIN taken USING (conv_id) WHERE i > h
    UNION ALL
    SELECT c.conv_id, i, digest, n_words
    FROM taken c JOIN turns t ON t.conv_id = c.base WHERE i <= h
), prefixes AS (
    SELECT conv_id AS member, 0 AS depth, [] AS prefix, 0 AS n_words FROM convs
    UNION ALL
    SELECT conv_id, depth, list(digest) OVER (PARTITION BY conv_id ORDER BY depth), n_words
    FROM rebuilt
), paths AS (
    SELECT *, min(member) OVER (PARTITION BY depth, prefix) AS conv_id,
        depth = max(depth) OVER (PARTITION BY member) AS last
    FROM prefixes
), nodes AS (
    SELECT conv_id, depth, count(*) AS n_convs, count(*) FILTER (last) AS n_ends,
        min(n_words) AS n_words,
        sha256(coalesce(string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (last), '')) AS ends
    FROM paths GROUP BY conv_id, depth
), totals AS (
    SELECT p.conv_id, p.depth, sum(CASE WHEN x.n_ends = x.n_convs THEN 1 ELSE 0 END) AS n_leaves,
        sum((x.n_convs - 1) * x.n_words) AS saved
    FROM nodes x JOIN paths p ON p.member = x.conv_id AND p.depth <= x.depth
    GROUP BY p.conv_id, p.depth
), parents AS (
    SELECT x.conv_id, x.depth, p.conv_id AS parent
    FROM nodes x JOIN paths p ON p.member = x.conv_id AND p.depth = x.depth - 1
), children AS (
    SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n FROM parents GROUP BY ALL
)
SELECT conv_id, depth, parent AS parent_conv_id, n_convs, coalesce(n, 0) AS n_children,
    n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM nodes JOIN totals USING (conv_id, depth) LEFT JOIN parents USING (conv_id, depth)
    LEFT JOIN children USING (conv_id, depth)
"""


NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score
    FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other AS negative_id, positive_score,
    score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": WARC,
        "op3_quality": _quality(),
        "op6_near_duplicates": NEAR_DUPLICATES,
        "op7_decontaminate": DECONTAMINATE,
        "op11_repeats": REPEATS,
        "op12_trie": TRIE,
        "op13_negatives": NEGATIVES,
    }
