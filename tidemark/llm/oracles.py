"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality_rules import STOP_WORDS

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP3 = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM u),
p AS (SELECT page_id, translate(host, {_UPPER}) AS host,
    regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path FROM h),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (SELECT page_id, host, path, max(length(rh || rp)) AS n FROM p JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT p.page_id, p.host, p.path, rh || rp AS rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN fits USING (page_id, host, path)
LEFT JOIN rules ON length(rh || rp) = n AND (p.host = rh OR ends_with(p.host, '.' || rh)) AND starts_with(p.path, rp)
"""

OP7 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM docs),
keyed AS (SELECT *, translate(trim(line, {_BLANK}), {_UPPER}) AS k FROM lines),
many AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3),
judged AS (SELECT keyed.*, many.k IS NOT NULL AND doc_id < top AS gone FROM keyed LEFT JOIN many USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""

OP8 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
spots AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
hits AS (SELECT r, item_id, i, n FROM spots JOIN wins USING (n, g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

OP10 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: trim(l, {_BLANK}) <> '') AS ls
  FROM documents),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop, len(ls) AS n_text_lines
  FROM docs LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 10 * n_words
    AND 100 * n_stop >= 4 * n_words AND 100 * n_dup_lines <= 50 * n_text_lines AS kept
FROM m
"""

_TERMS = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_TERMS}) AS t FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_TERMS}) AS t FROM benchmark),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) GROUP BY ALL),
total AS (SELECT count(*) AS big_n, sum(len(t))::BIGINT AS big_l FROM docs WHERE len(t) > 0),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, big_n),
m AS (SELECT r, doc_id, 75 + (25 * len(t) * big_n) // big_l AS m FROM docs, total WHERE len(t) > 0),
q AS (SELECT i, item_id, term, count(*) AS c FROM (SELECT i, item_id, unnest(t) AS term FROM items) GROUP BY ALL),
scores AS (SELECT i, item_id, r, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

# a CRC-32 bit by bit, as DuckDB has no built-in one: over the ids' decimal digits, taken from the right by shifts
OP12 = """
WITH RECURSIVE rows AS (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'id': id, 'size': size} ORDER BY turn NULLS FIRST, id, size) AS t FROM rows GROUP BY conv_id),
crc(conv_id, c, i) AS (
  SELECT conv_id, 4294967295::BIGINT, 0 FROM own
  UNION ALL
  SELECT conv_id, list_reduce(range(8), lambda x, b: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
      xor(c, ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)), i + 1
  FROM crc WHERE i < length(conv_id::VARCHAR)),
heads AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h FROM crc WHERE i = length(conv_id::VARCHAR)),
built AS (SELECT o.conv_id, coalesce(b.t[1 : h], []) || o.t[h + 1 :] AS t
  FROM own o JOIN heads USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
steps AS (SELECT conv_id, d, len(t) AS n, array_to_string(list_transform(t[1 : d], lambda x: x.id), '') AS k,
    CASE WHEN d > 0 THEN t[d].size ELSE 0 END AS size
  FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM built)),
nodes AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = d AS leaf, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM steps GROUP BY d, k),
above AS (SELECT unnest(range(d + 1)) AS d, k, leaf, saved FROM nodes),
trees AS (SELECT d, substr(k, 1, 32 * d) AS k, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY 1, 2),
children AS (SELECT d - 1 AS d, substr(k, 1, 32 * (d - 1)) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved_tokens, n.ends_sha256
FROM nodes n JOIN trees USING (d, k) LEFT JOIN children USING (d, k)
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = substr(n.k, 1, 32 * (n.d - 1))
"""

OP13 = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
wins AS (SELECT r, doc_id, i, array_to_string(w[i : i + 19], ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)),
later AS (SELECT r, i FROM wins QUALIFY rank() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, i) > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 20)) AS p FROM later)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

ORACLES: dict[str, str] = {
    "op3_url_filter": OP3,
    "op7_line_dedup": OP7,
    "op8_decontamination": OP8,
    "op10_quality_rules": OP10,
    "op11_ranked_search": OP11,
    "op12_conversation_trie": OP12,
    "op13_substring_dedup": OP13,
}
