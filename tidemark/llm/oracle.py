"""DuckDB SQL for the training-data queries that SQL can express over whole tables."""

from __future__ import annotations

_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_decontaminate"] = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, w, least(10, len(w)) AS n
  FROM (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM_WORDS} AS w FROM documents),
found AS (
  SELECT r, i, d.n AS n, item
  FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))) d
  JOIN windows USING (n, win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

ORACLE_SQL["op3_substring_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_SPACE_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY win) AS n
  FROM (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win
        FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs))),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows WHERE n > 1),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs) ANTI JOIN gone USING (r, p)
         GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

ORACLE_SQL["op5_quality_rules"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_SPACE_WORDS} AS w
              FROM documents),
grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n
  FROM (SELECT r, i, w[i:i + 4] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM docs))),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM grams WHERE n > 1) GROUP BY r),
base AS (
  SELECT doc_id, source, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         coalesce(n, 0) AS n_repeat_words
  FROM docs LEFT JOIN again USING (r)),
judged AS (
  SELECT doc_id, source, n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM base),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM judged GROUP BY source),
moments AS (
  SELECT sum(n) AS total, sum(f) / sum(n) AS mean, greatest(sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2, 0) AS spread,
         sum(f) / sum(n) * (1 - sum(f) / sum(n)) AS within, count(*) AS k FROM hosts),
prior AS (
  SELECT mean, CASE WHEN spread - within * k / total > 0
                    THEN least(greatest(within / (spread - within * k / total) - 1, 0), total) ELSE total END AS strength
  FROM moments),
verdicts AS (SELECT source, (f + mean * strength) / NULLIF(n + strength, 0) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_kept AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source"""

ORACLE_SQL["op6_warc"] = """
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       if(target IS DISTINCT FROM page_id, 'revisit', 'response') AS record_type,
       CASE WHEN target IS DISTINCT FROM page_id THEN target END AS refers_to
FROM (SELECT page_id, payload, CASE WHEN strlen(payload) < 1000 THEN page_id
             ELSE coalesce(max(page_id) OVER (PARTITION BY payload), page_id) END AS target
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"""

_GAP = "(({p} - {q}) * ({p} - {q})) // {q}"
_AUDIT_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL["op13_source_divergence"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     {_AUDIT_WORDS} AS w FROM documents),
uses AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
size AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS n_all FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
own AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM uses SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, coalesce(sum(n), 0) AS n_group FROM grp LEFT JOIN own USING (lang, source) GROUP BY ALL),
grid AS (
  SELECT t.lang, t.source, k.term, coalesce(o.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(o.n, 0) + 1)) // CAST(t.n_group + s.v AS HUGEINT) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // CAST(s.n_all + s.v AS HUGEINT) AS q
  FROM total t JOIN size s USING (lang) JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum({_GAP.format(p='a.p', q='b.p')}) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, {_GAP.format(p='p', q='q')} FROM grid WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200"""

ORACLE_SQL["op4_line_dedup"] = r"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
cut AS (SELECT doc_id, l, list_filter(range(len(l)), lambda i: i = len(l) - 1 OR md5(l[i + 1]) < 'e') AS ends FROM docs),
ended AS (SELECT doc_id, l, ends, unnest(ends) AS e, unnest(range(1, len(ends) + 1)) AS k FROM cut),
placed AS (SELECT doc_id, l, k, e, greatest(0, least(coalesce(ends[k - 1], -1) + 1, e - 1)) AS s, ends[k + 1] AS next_end FROM ended),
chunked AS (SELECT doc_id, l, e, s, next_end, lag(s) OVER (PARTITION BY doc_id ORDER BY k) AS since FROM placed),
chunks AS (
  SELECT doc_id, l, s, e, l[s + 1:e + 1] AS own, list_reverse(coalesce(l[since + 1:s], [])) AS bef,
         coalesce(l[e + 2:next_end + 1], []) AS aft
  FROM chunked WHERE e > s AND len(list_filter(l[s + 1:e + 1], lambda x: trim(x, ' ') <> '')) > 0),
paired AS (
  SELECT c.doc_id, s, e, list_reverse(c.l[1:s]) AS bef, c.l[e + 2:] AS aft, f.bef AS f_bef, f.aft AS f_aft
  FROM (SELECT *, row_number() OVER (PARTITION BY own ORDER BY doc_id, s) AS rn FROM chunks) c
  JOIN (SELECT own, bef, aft FROM chunks QUALIFY row_number() OVER (PARTITION BY own ORDER BY doc_id, s) = 1) f USING (own)
  WHERE rn > 1),
spans AS (
  SELECT doc_id, s - coalesce(list_min(list_filter(range(len(f_bef)), lambda i: bef[i + 1] IS DISTINCT FROM f_bef[i + 1])), len(f_bef)) AS a,
         e + coalesce(list_min(list_filter(range(len(f_aft)), lambda i: aft[i + 1] IS DISTINCT FROM f_aft[i + 1])), len(f_aft)) AS b
  FROM paired),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM spans),
lost AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
       coalesce(len(g), 0) AS n_removed, sha256(coalesce(CASE WHEN g IS NULL THEN text ELSE array_to_string(list_transform(
         list_filter(range(len(string_split(text, chr(10)))), lambda i: NOT list_contains(g, i)),
         lambda i: string_split(text, chr(10))[i + 1]), chr(10)) END, '')) AS kept_sha256
FROM documents d LEFT JOIN lost USING (doc_id)"""
