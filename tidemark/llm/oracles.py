"""The results of queries as SQL, where SQL can express them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words
), classes AS (
  SELECT doc_id, s, len(s) AS n,
    CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS class_id
  FROM sets
), shingles AS (
  SELECT doc_id, n, unnest(s) AS g FROM classes WHERE doc_id = class_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT DISTINCT a, a AS b FROM both_ways
  UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), least_of AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles,
  coalesce(l.component_id, c.class_id) AS component_id, c.class_id
FROM classes c LEFT JOIN least_of l ON c.class_id = l.a
"""

URL_RULES = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
    ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, row_number() OVER () AS k,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (k)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), groups AS (
  SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || substr(h, 5 * k + 1, 5) AS BIGINT)) AS g,
    max(page_id) OVER (PARTITION BY h, payload_bytes) AS kept
  FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((g[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < kept THEN kept END AS refers_to
FROM groups
"""

CASCADE = r"""
WITH words AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3
), repeated AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i+1], w[i+2]) AS n FROM windows
), covered AS (
  SELECT k, count(DISTINCT p) AS n FROM (
    SELECT k, unnest([i, i + 1, i + 2]) AS p FROM repeated WHERE n > 1) GROUP BY k
), counted AS (
  SELECT doc_id, text, lines, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN covered USING (k)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols * 2 > n_words OR word_chars > 20 * n_words
    OR (len(lines) >= 4 AND len(list_distinct(lines)) * 2 < len(lines))
    OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 2 > length(text)
    OR length(regexp_replace(text, '[^\pL]', '', 'g')) * 2 < length(text) AS rejected
  FROM counted
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM judged
"""

_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
    regexp_extract_all({_lower('text')}, {_ALNUM}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, unnest(list_transform(
    range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i+9], ' '))) AS g
  FROM items WHERE len(w) > 0
), docs AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all({_lower('text')}, {_ALNUM}) AS w FROM documents
), places AS (
  SELECT k, size, i, array_to_string(w[i:i+size-1], ' ') AS g FROM (
    SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT p.k, p.i, p.size, item FROM places p JOIN windows USING (size, g)
), hits AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (
    SELECT k, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT k, i, size FROM found))
  GROUP BY k
), named AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT k, item FROM found) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (k) LEFT JOIN named USING (k)
"""

_HASHED = " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    for c in ("doc_id", "source", "lang", "{n_chars}", "text")
)

MERKLE = f"""
WITH RECURSIVE codes AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    list_reduce(list_concat([4294967295], list_transform(
        range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i]))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc
  FROM documents
), leaves AS (
  SELECT *, sha256({_HASHED.format(n_chars='n_chars')}) AS leaf,
    sha256({_HASHED.format(n_chars='(n_chars + CAST(xor(crc, 4294967295) % 7 = 0 AS BIGINT))')})
      AS tampered FROM codes
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
    row_number() OVER () AS k FROM leaves
), levels AS (
  SELECT g, 0 AS level, list(leaf ORDER BY p) AS nodes FROM placed GROUP BY g
  UNION ALL
  SELECT g, level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM levels WHERE len(nodes) > 1
), tops AS (
  SELECT 0 AS level, list(nodes[1] ORDER BY g) AS nodes FROM levels WHERE len(nodes) = 1
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM tops WHERE len(nodes) > 1
), walk AS (
  SELECT k, g, 0 AS level, p, '' AS proof, tampered AS node FROM placed
  UNION ALL
  SELECT k, g, level + 1, p // 2, proof || coalesce(s, ''), CASE WHEN s IS NULL THEN sha256(node)
    WHEN p % 2 = 0 THEN sha256(node || s) ELSE sha256(s || node) END
  FROM (SELECT w.*, l.nodes[xor(p, 1) + 1] AS s FROM walk w JOIN levels l USING (g, level)
    WHERE len(l.nodes) > 1)
), climb AS (
  SELECT k, 0 AS level, g AS p, proof, node
  FROM walk w JOIN levels l USING (g, level) WHERE len(l.nodes) = 1
  UNION ALL
  SELECT k, level + 1, p // 2, proof || coalesce(s, ''), CASE WHEN s IS NULL THEN sha256(node)
    WHEN p % 2 = 0 THEN sha256(node || s) ELSE sha256(s || node) END
  FROM (SELECT c.*, t.nodes[xor(p, 1) + 1] AS s FROM climb c JOIN tops t USING (level)
    WHERE len(t.nodes) > 1)
)
SELECT doc_id, leaf, l.nodes[1] AS subroot, t.nodes[1] AS root, sha256(proof) AS proof_sha256,
  node AS folded_root, node = t.nodes[1] AS verified
FROM placed d JOIN climb c USING (k) JOIN tops t ON c.level = t.level AND len(t.nodes) = 1
  JOIN levels l ON d.g = l.g AND len(l.nodes) = 1
"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_lower('text')}, '{_TERMS}') AS w
  FROM documents
), totals AS (
  SELECT count(*) FILTER (len(w) > 0) AS nn, sum(len(w)) AS ll FROM docs
), occurring AS (
  SELECT k, doc_id, len(w) AS n, unnest(w) AS term FROM docs
), held AS (
  SELECT k, doc_id, term, CAST(count(*) AS BIGINT) AS tf,
    CAST(25 + (75 * n * nn) // ll AS BIGINT) AS m
  FROM occurring, totals GROUP BY k, doc_id, n, term, nn, ll
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, nn
), items AS (
  SELECT item_id, unnest(regexp_extract_all({_lower('text')}, '{_TERMS}')) AS term FROM benchmark
), wanted AS (
  SELECT item_id, term, count(*) AS often FROM items GROUP BY ALL
), scores AS (
  SELECT item_id, k, doc_id,
    CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) GROUP BY item_id, k, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
  AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

CURRICULUM = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
    AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k,
    k % 3 + 1 AS w FROM sized GROUP BY source
), filled AS (
  SELECT *, row_number() OVER by_ratio AS rn,
    coalesce(sum(3 * source_size) OVER before_it, 0) AS held, sum(source_size) OVER () AS total,
    sum(w) OVER () - coalesce(sum(w) OVER before_it, 0) AS w_left FROM sources
  WINDOW by_ratio AS (ORDER BY source_size * 6 // w, k),
    before_it AS (ORDER BY source_size * 6 // w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rn, total - held AS rest, w_left FROM filled
  WHERE NOT 3 * source_size * w_left < (total - held) * w ORDER BY rn LIMIT 1
), targets AS (
  SELECT f.source, f.source_size, f.k, CASE WHEN f.rn < l.rn THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(l.rest AS DOUBLE) * f.w / CAST(l.w_left AS DOUBLE) END AS target,
    CAST(floor(target + 0.5) AS BIGINT) AS demand FROM filled f, level l
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM sized
), shares AS (
  SELECT p.doc_id, p.size, t.*, p.b, CAST(p.b AS DOUBLE) / t.demand AS share,
    list_sum([greatest(0, least(p.size, t.demand - e * t.source_size - p.b)) for e in [0, 1, 2]])
      AS taken
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(taken AS BIGINT) AS taken, round(CASE WHEN taken = 0 THEN NULL
    WHEN k % 3 = 0 AND share * 1.5 < 1.0
      THEN 2.0 * (share * 1.5) / (3.0 + sqrt(9.0 - 8.0 * (share * 1.5)))
    WHEN k % 3 = 0 THEN 0.5 + (share * 1.5 - 1.0)
    WHEN k % 3 = 1 THEN share
    WHEN share * 1.5 < 0.5 THEN share * 1.5
    ELSE 0.5 + 2.0 * (share * 1.5 - 0.5) / (1.0 + sqrt(1.0 + 8.0 * (share * 1.5 - 0.5))) END, 6)
    AS first_position
FROM shares
"""

ORACLES = {
    "op1_ngram_jaccard_join": NGRAM_JOIN,
    "op6_url_rules": URL_RULES,
    "op7_warc_archives": WARC,
    "op8_quality_cascade": CASCADE,
    "op9_benchmark_decontamination": DECONTAMINATION,
    "op11_bitslice_search": SEARCH,
    "op12_curriculum_mix": CURRICULUM,
    "op13_merkle_manifest": MERKLE,
}
