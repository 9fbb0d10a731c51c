"""The results of the text operators in SQL, where SQL can express them."""

from __future__ import annotations

from obstar.llm.licenses import TEMPLATES
from obstar.llm.shards import PRIMES, ROUNDS, round_keys

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lines_without_repeats(documents: str) -> str:
    """Common table expressions up to `deduped`: doc_id, n_lines, n_dropped, kept."""
    return f"""
split_lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {documents})
),
keyed AS (
    SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS key FROM split_lines
),
repeats AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND r.last <> k.doc_id AS gone
    FROM keyed k LEFT JOIN repeats r USING (key)
),
deduped AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
    FROM marked GROUP BY doc_id
)"""


def words_sql(text: str) -> str:
    split = f"regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+')"
    return f"list_filter({split}, lambda x: x <> '')"


def shingles_sql(table: str, key: str) -> str:
    """Distinct five-word shingles s of each row of a table of (key, w)."""
    return f"""
    SELECT DISTINCT {key}, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM {table})"""


def canonical_sql(url: str) -> str:
    bare = f"regexp_replace(regexp_replace({url}, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    place = f"regexp_replace({bare}, '\\?.*$', '')"
    host = f"regexp_replace(lower(regexp_extract({place}, '^[^/]*')), '^www\\.|:(80|443)$', '', 'g')"
    path = f"regexp_replace(regexp_extract({place}, '/.*$'), '/+$', '')"
    given = f"string_split(regexp_extract({bare}, '\\?(.*)$', 1), '&')"
    kept = (
        f"list_sort(list_filter({given}, lambda p: p <> '' "
        "AND NOT regexp_matches(p, '^(utm_[a-z]*|gclid|fbclid|ref)(=.*)?$')))"
    )
    query = f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"
    return f"{host} || {path} || {query}"


def crc32_sql(hexed: str) -> str:
    """The unsigned CRC-32 of bytes given as hexadecimal text; `crc_table` must be in scope."""
    byte = f"('0x' || ({hexed})[2 * i - 1 : 2 * i])::BIGINT"
    steps = f"list_prepend(4294967295, list_transform(range(1, length({hexed}) // 2 + 1), lambda i: {byte}))"
    entry = "('0x' || digits[8 * xor(a & 255, x) + 1 : 8 * xor(a & 255, x) + 8])::BIGINT"
    return f"xor(list_reduce({steps}, lambda a, x: xor(a >> 8, {entry})), 4294967295)"


CRC_TABLE = """
crc_table AS (
    SELECT string_agg(printf('%08x', list_reduce(list_prepend(i, range(8)),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), '' ORDER BY i) AS digits
    FROM range(256) t(i)
)"""


def mixed_sql(x: str) -> str:
    a, b, c = PRIMES
    low = 4294967295
    return f"""(SELECT xor(z, z >> 16) FROM (SELECT (xor(y, y >> 13) * {c}) & {low} AS z FROM (
        SELECT (xor(x, x >> 15) * {b}) & {low} AS y FROM (
        SELECT (({x}) * {a} + key) & {low} AS x))))"""


NOTICE_ROWS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES.items())

ORACLE: dict[str, str] = {
    "op1_lines": f"""
WITH {lines_without_repeats("documents")}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM deduped""",
    "op2_licenses": f"""
WITH notices(license, text) AS (VALUES {NOTICE_ROWS}),
notice_words AS (SELECT license, {words_sql("text")} AS w FROM notices),
notice_shingles AS ({shingles_sql("notice_words", "license")}),
doc_words AS (SELECT doc_id, {words_sql("text")} AS w FROM documents),
doc_shingles AS ({shingles_sql("doc_words", "doc_id")}),
sizes AS (SELECT license, count(*) AS shingles FROM notice_shingles GROUP BY license),
met AS (
    SELECT doc_id, license, count(*) AS found
    FROM doc_shingles JOIN notice_shingles USING (s) GROUP BY doc_id, license
)
SELECT doc_id, license, found, shingles, round(found / shingles, 4) AS containment
FROM met JOIN sizes USING (license) WHERE found >= 0.8 * shingles""",
    "op7_warc": f"""
WITH held AS (
    SELECT page_id, url, md5(html) AS digest, page_id * 60 AS time, left(md5(html), 1) AS d FROM pages
),
visited AS (
    SELECT page_id * 8 + 2 + visit AS id, time + 30 + visit * 1800 AS time, page_id // 1000 AS now,
           regexp_extract(url, '^[a-z]+://(www\\.)?([^/?#]*)', 2) AS host,
           digest[visit + 2] BETWEEN '0' AND '7' AS brings, digest[visit + 12] AS told
    FROM held CROSS JOIN (SELECT unnest(range(5)) AS visit)
),
records AS (
    SELECT page_id * 8 AS id, {canonical_sql("url")} AS url_key, time, 1 AS kind,
           '"' || digest || '"' AS tag, time AS modified
    FROM held
    UNION ALL
    SELECT page_id * 8 + 1, {canonical_sql("url")}, time + 3600, 0,
           CASE WHEN d IN ('0', '1', '2', '3') THEN '"changed"'
                WHEN d NOT IN ('4', '5') THEN '"' || digest || '"' END, time
    FROM held
    UNION ALL
    SELECT id, lower(host), time, brings::INTEGER,
           CASE WHEN brings OR told BETWEEN '6' AND '9' OR told > '9' THEN '"front-' || now || '"'
                WHEN told BETWEEN '0' AND '3' THEN '"front-' || (now - 1) || '"' END, now
    FROM visited
),
joined AS (
    SELECT *, last_value(CASE WHEN kind = 1 THEN {{'id': id, 'tag': tag, 'modified': modified}} END IGNORE NULLS)
        OVER (PARTITION BY url_key ORDER BY time, kind, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
    FROM records
)
SELECT id AS revisit_id, url_key, r.id AS response_id,
       CASE WHEN r IS NULL THEN 'no_earlier_response'
            WHEN coalesce(tag = r.tag, modified = r.modified, false) THEN 'resolved'
            ELSE 'validator_mismatch' END AS resolution,
       CASE WHEN r IS NOT NULL AND coalesce(tag = r.tag, modified = r.modified, false) THEN
            'cache-control: max-age=60' || chr(10) || 'content-length: 1000' || chr(10) ||
            'content-type: text/html' || chr(10) || 'date: ' || time || chr(10) || 'etag: ' || r.tag || chr(10) ||
            'expires: ' || time || chr(10) || 'vary: accept' END AS headers
FROM joined WHERE kind = 0""",
    "op12_shards": f"""
WITH RECURSIVE {CRC_TABLE},
numbered AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
           row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS r, count(*) OVER () AS n
    FROM documents
),
wide AS (SELECT r, n, greatest(2, length(to_base(n - 1, 2))) AS bits FROM numbered),
halves AS (SELECT r, n, bits - bits // 2 AS low, (1 << (bits // 2)) - 1 AS lmask, (1 << (bits - bits // 2)) - 1 AS rmask FROM wide),
walk AS (
    SELECT r, n, low, lmask, rmask, 0 AS k, (r >> low)::HUGEINT AS l, (r & rmask)::HUGEINT AS q FROM halves
    UNION ALL
    SELECT r, n, low, lmask, rmask, k % {ROUNDS} + 1,
           CASE WHEN k % 2 = 0 THEN xor(l, {mixed_sql("q")} & lmask) ELSE l END,
           CASE WHEN k % 2 = 1 THEN xor(q, {mixed_sql("l")} & rmask) ELSE q END
    FROM (SELECT *, ({round_keys(0)})[k % {ROUNDS} + 1] AS key FROM walk)
    WHERE k < {ROUNDS} OR l * (rmask + 1) + q >= n
),
placed AS (SELECT r, (l * (rmask + 1) + q)::BIGINT AS place FROM walk WHERE k = {ROUNDS} AND l * (rmask + 1) + q < n)
SELECT doc_id, length(h) // 2 + 8 AS size, {crc32_sql("h")} AS text_crc32, 'rows' AS law,
       (place % 24)::INTEGER AS shard, place // 24 AS slot, NULL::INTEGER AS grown_shard
FROM numbered JOIN placed USING (r) CROSS JOIN crc_table""",
    "op13_trie": f"""
WITH {CRC_TABLE},
given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
known AS (SELECT *, md5(octet_length(encode(role)) || ':' || role || text) AS token FROM given),
own AS (
    SELECT conv_id, token, octet_length(encode(text)) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, token) - 1 AS pos
    FROM known
),
counted AS (SELECT conv_id, count(*) AS n, hex(encode(conv_id::VARCHAR)) AS digits_of FROM own GROUP BY conv_id),
convs AS (
    SELECT c.conv_id, c.conv_id - c.conv_id % 5 AS source, {crc32_sql("digits_of")} % 9 AS h
    FROM counted c CROSS JOIN crc_table
),
sized AS (
    SELECT c.*, least(c.h, coalesce(s.n, 0)) AS taken FROM convs c LEFT JOIN counted s ON s.conv_id = c.source
),
rebuilt AS (
    SELECT c.conv_id, o.pos, o.token, o.size FROM sized c JOIN own o ON o.conv_id = c.source WHERE o.pos < c.taken
    UNION ALL
    SELECT c.conv_id, o.pos - c.h + c.taken, o.token, o.size FROM sized c JOIN own o ON o.conv_id = c.conv_id WHERE o.pos >= c.h
),
paths AS (
    SELECT conv_id, pos + 1 AS depth, size,
           md5(string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS node
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, 'root' FROM convs
),
trie AS (
    SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(size) AS size, count(*) AS n
    FROM paths GROUP BY node
),
hung AS (
    SELECT t.*, up.node AS parent, up_node.conv_id AS parent_conv_id
    FROM trie t LEFT JOIN paths up ON up.conv_id = t.conv_id AND up.depth = t.depth - 1
    LEFT JOIN trie up_node ON up_node.node = up.node
),
kids AS (SELECT parent AS node, count(*) AS n_children FROM hung WHERE parent IS NOT NULL GROUP BY parent),
totals AS (
    SELECT p.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((t.n - 1) * t.size)::BIGINT AS saved_tokens
    FROM trie t JOIN paths p ON p.conv_id = t.conv_id AND p.depth <= t.depth
    LEFT JOIN kids k ON k.node = t.node
    GROUP BY p.node
),
lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ended AS (
    SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
    FROM lengths l JOIN paths p USING (conv_id, depth) GROUP BY p.node
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n AS n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM hung JOIN totals USING (node) LEFT JOIN kids USING (node) LEFT JOIN ended USING (node)""",
}
