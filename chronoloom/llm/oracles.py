"""SQL, as DuckDB runs it, of the corpus queries that SQL can express."""

from __future__ import annotations

#: crc32 in SQL: the table of its 256 remainders by their rule, and a fold over the bytes of a text.
CRC_TABLE = """crc_steps AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS remainders FROM crc_steps WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """Of a text, where crc_table is at hand."""
    of = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {of}), lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)"


OP12 = f"""
WITH RECURSIVE {CRC_TABLE},
o AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL
),
h AS (SELECT c, {crc32_sql("c::VARCHAR")} % 9 AS h, c - c % 5 AS b FROM (SELECT DISTINCT c FROM o), crc_table),
heads AS (SELECT h.c, o.p AS d, r, x FROM h JOIN o ON o.c = h.b AND o.p <= h.h),
taken AS (SELECT h.c, h.h, count(heads.d) AS k FROM h LEFT JOIN heads ON heads.c = h.c GROUP BY ALL),
turns AS (SELECT * FROM heads UNION ALL SELECT o.c, k + p - h, r, x FROM o JOIN taken USING (c) WHERE p > h),
lengths AS (SELECT taken.c, count(turns.d) AS n FROM taken LEFT JOIN turns ON turns.c = taken.c GROUP BY ALL),
paths AS (
  SELECT c, d, list({{'r': r, 'x': x}}) OVER (PARTITION BY c ORDER BY d) AS k, octet_length(encode(x)) AS bytes FROM turns
  UNION ALL SELECT c, 0, [], 0 FROM lengths
),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n), '') AS ended
  FROM paths JOIN lengths USING (c) GROUP BY k, d
),
children AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sub AS (
  SELECT list_slice(v.k, 1, i) AS k, count(*) FILTER (children.n IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT v.*, unnest(range(0, d + 1)) AS i FROM nodes v) v LEFT JOIN children ON children.k = v.k GROUP BY 1
)
SELECT v.conv_id::BIGINT AS conv_id, v.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, v.n_convs::BIGINT AS n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
  sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, sha256(v.ended) AS ends_sha256
FROM nodes v JOIN sub ON sub.k = v.k LEFT JOIN children ON children.k = v.k LEFT JOIN nodes up ON v.d > 0 AND up.k = list_slice(v.k, 1, v.d - 1)
"""

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE},
said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
wanted AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
),
own AS (SELECT doc_id, unnest(words) AS word FROM said),
bucket AS (SELECT word, {crc32_sql("word")} % 10000 AS b FROM (SELECT word FROM own UNION SELECT word FROM wanted), crc_table),
s AS (SELECT b, count(*) AS s FROM own JOIN bucket USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM wanted JOIN bucket USING (word) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM own) + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000))))::BIGINT AS gain
  FROM range(10000) r(b) LEFT JOIN s USING (b) LEFT JOIN t USING (b)
),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM own JOIN bucket USING (word) JOIN gain USING (b) GROUP BY doc_id),
scores AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
  FROM said LEFT JOIN weights USING (doc_id)
),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= (SELECT count(*) FROM ranked) * 10 // 100 THEN r END AS rank
FROM scores LEFT JOIN ranked USING (doc_id)
"""

#: Bare base32 of a SHA-1 in hexadecimal digits h: five digits make four letters.
_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '')"

OP4 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(encode(body)) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM p
"""


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '{pattern}'))"


_UPPER, _LETTER, _LETTERED, _SYMBOL = r"\p{Lu}", r"\p{L}", r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*", "[#*$%&|<>]"
_UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}]"

OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
c AS (
  SELECT doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {_count(_SYMBOL)} AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (rid)
),
b AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars - CASE WHEN word_chars > 12 * n_words THEN {_count(_UNSPACED)} ELSE 0 END <= 12 * n_words AND 10 * n_symbols <= n_words AND 2 * n_dup_lines <= len(lines)
    AND 2 * {_count(_UPPER)} <= {_count(_LETTER)} AND 2 * {_count(_LETTERED)} >= n_words AS kept
FROM b
"""
