"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from quarry.llm import quality_rules as Q


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_W = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op1_quality_rules"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs
), judged AS (
  SELECT rid, line, pos, regexp_extract_all(line, '{_W}') AS ws FROM lines
), ruled AS (
  SELECT rid, line, pos, len(ws) AS n,
    100 * len(list_filter(ws, lambda w: w IN ({', '.join(map(_quoted, Q.SEPARATORS))}))) >= 20 * len(ws)
    OR 100 * len(regexp_extract_all(line, {_quoted(Q.NOISY_RE)})) >= 30 * len(ws)
    OR (len(ws) <= 7 AND NOT regexp_matches(line, {_quoted(Q.TERMINAL_RE)}))
    OR (len(ws) <= 30 AND regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        {_quoted('|'.join(Q.BOILERPLATE))})) AS failed
  FROM judged WHERE len(ws) > 0
), dups AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
    coalesce(sum(n) FILTER (failed), 0)::BIGINT AS n_removed_words,
    coalesce(count(*) FILTER (failed), 0) AS n_removed_lines
  FROM ruled GROUP BY rid
), words AS (
  SELECT rid, unnest(regexp_extract_all(text, '{_W}')) AS w,
    generate_subscripts(regexp_extract_all(text, '{_W}'), 1) AS p FROM docs
), windows AS (
  SELECT rid, p, w, lead(w) OVER t AS w2, lead(w, 2) OVER t AS w3 FROM words WINDOW t AS (PARTITION BY rid ORDER BY p)
), often AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, w, w2, w3) > 1 AND w3 IS NOT NULL AS again FROM windows
), covered AS (
  SELECT rid, count(DISTINCT p + k.i) AS n_repeat_words FROM often, (VALUES (0), (1), (2)) k(i) WHERE again GROUP BY rid
), counted AS (
  SELECT rid, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM words GROUP BY rid
), joined AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_words, 0) AS n_removed_words,
    coalesce(n_removed_lines, 0) AS n_removed_lines
  FROM docs LEFT JOIN counted USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN covered USING (rid)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_removed_words <= 30 * n_words AS kept
FROM joined
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_B = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op4_decontamination"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_B}') AS ws FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_B}') AS ws FROM benchmark
), starts AS (
  SELECT item_id, ws, least(10, len(ws)) AS k, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS a
  FROM items WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[a:a + k - 1], ' ') AS w FROM starts
), places AS (
  SELECT rid, k, unnest(generate_series(1, len(ws) - k + 1)) AS a, ws
  FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(ws) >= k
), pieces AS (
  SELECT rid, k, a, array_to_string(ws[a:a + k - 1], ' ') AS w FROM places
), hits AS (
  SELECT rid, a, item_id, k FROM pieces JOIN windows USING (k, w)
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(a, a + k - 1)) AS p FROM hits) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM hits) GROUP BY rid
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

ORACLES["op5_mixing"] = f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_W}')), 0) AS size FROM documents
), per AS (
  SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), named AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim,
    sum(source_size) OVER () * 1.5::DOUBLE AS all_words FROM named
), levels AS (
  SELECT *, (all_words - (sum(lim) OVER f - lim)) / sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW f AS (ORDER BY lim / weight, place ROWS UNBOUNDED PRECEDING)
), targets AS (
  SELECT source, source_size, least(lim, max(level) OVER () * weight) AS target,
    ('0x' || substr(md5('mix:' || coalesce('=' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM levels
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS k FROM sizes s
), rated AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, u, k,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (floor(u + rate * (k + 1)) - floor(u + rate * k))::BIGINT AS copies,
  (floor(u + rate * (k + 1)) - floor(u + rate * k))::BIGINT * size AS taken
FROM rated
"""

ORACLES["op2_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length('<s>[INST]  [/INST] </s>') + length(role) + length(text)
    + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]')) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES["op8_url_filters"] = r"""
WITH RECURSIVE rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), pages_ AS (
  SELECT row_number() OVER () AS rid, page_id, url, html, contains(coalesce(url, ''), '://') AS ok FROM pages
), tags AS (
  SELECT url, regexp_extract(unnest(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS t FROM pages_
  UNION ALL
  SELECT url, regexp_extract(unnest(regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')), '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM pages_
), resolved AS (
  SELECT url AS a, CASE WHEN contains(t, '://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t
    WHEN length(regexp_extract(url, '(?s)^(.*?://[^?#]*/)', 1)) > length(regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1))
      THEN regexp_extract(url, '(?s)^(.*?://[^?#]*/)', 1) || t
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || '/' || t END AS b
  FROM (SELECT url, replace(t, '&amp;', '&') AS t FROM tags) WHERE t <> '' AND contains(url, '://')
), edges AS (
  SELECT DISTINCT norm(a) AS a, norm(b) AS b FROM resolved WHERE contains(b, '://')
), sym AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach(a, b) AS (
  SELECT a, b FROM sym UNION SELECT r.a, e.b FROM reach r JOIN sym e ON r.b = e.a
), urls AS (
  SELECT DISTINCT url FROM pages_ WHERE ok UNION SELECT a FROM sym
), parts AS (
  SELECT url, lower_(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)) AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM urls
), ruled AS (
  SELECT url, host, path, max({'n': length(h || p), 'v': v, 'rule': h || p}) AS best
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
), inherited AS (
  SELECT r.a, min(best.v) AS v FROM reach r JOIN ruled u ON u.url = r.b WHERE best.v IS NOT NULL GROUP BY r.a
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, best.rule AS rule, coalesce(best.v, i.v, 'allow') AS verdict
FROM pages_ p LEFT JOIN ruled u ON p.ok AND u.url = p.url LEFT JOIN inherited i ON p.ok AND i.a = norm(p.url)
"""
_norm = (r"(" + _LOWER.format(r"regexp_extract({0}, '(?s)^(.*?://[^/?#]*)', 1)") + r" || regexp_extract({0}, '(?s)^.*?://[^/?#]*([^#]*)', 1))")
for _x in ("p.url", "a", "b"):
    ORACLES["op8_url_filters"] = ORACLES["op8_url_filters"].replace(f"norm({_x})", _norm.format(_x))
ORACLES["op8_url_filters"] = ORACLES["op8_url_filters"].replace(
    "lower_(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1))", _LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)"))

ORACLES["op10_warc"] = """
WITH bodies AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), sums AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS original,
    list_transform(range(0, 8), lambda g: ('0x' || substr(hex, (g * 5 + 1)::INT, 5))::BIGINT) AS parts FROM bodies
)
SELECT page_id, payload_bytes,
  array_to_string(flatten(list_transform(parts, lambda x: list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((x >> s::INT) & 31) + 1)::INT, 1)))), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM original THEN NULL ELSE original END AS refers_to
FROM sums
"""

ORACLES["op7_ngram_join"] = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_W}') AS ws FROM documents
), places AS (
  SELECT rid, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS a FROM docs WHERE len(ws) > 0
), shingles AS (
  SELECT DISTINCT rid, array_to_string(ws[a:a + 4], ' ') AS s FROM places
), sizes AS (
  SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), shared AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS m FROM shingles x JOIN shingles y ON x.s = y.s AND x.rid < y.rid GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.rid = a JOIN sizes q ON q.rid = b WHERE 100 * m >= 80 * (p.n + q.n - m)
), sym AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT a, b FROM sym UNION SELECT r.a, e.b FROM reach r JOIN sym e ON r.b = e.a
), least_ AS (
  SELECT a AS rid, min(doc_id) AS c FROM reach JOIN docs ON docs.rid = reach.b GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(doc_id, c), doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (rid) LEFT JOIN least_ USING (rid)
"""

_T = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES["op11_source_divergence"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_T}') AS ts FROM documents
), uses AS (
  SELECT rid, lang, source, unnest(ts) AS t FROM docs
), kept AS (
  SELECT lang, t FROM uses GROUP BY ALL HAVING count(DISTINCT rid) >= 10
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, t, count(*) AS c FROM uses JOIN kept USING (lang, t) GROUP BY ALL
), every AS (
  SELECT g.lang, g.source, k.t, coalesce(c, 0)::HUGEINT AS c
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts o ON o.lang = g.lang AND o.source = g.source AND o.t = k.t
), summed AS (
  SELECT *, sum(c) OVER (PARTITION BY lang, source)::HUGEINT AS n, sum(c) OVER (PARTITION BY lang, t)::HUGEINT AS lc,
    sum(c) OVER (PARTITION BY lang)::HUGEINT AS ln FROM every
), shares AS (
  SELECT lang, source, t, c, 1 + 1000000000::HUGEINT * (c + 2) // (n + 2 * v) AS p, 1 + 1000000000::HUGEINT * (lc + 2) // (ln + 2 * v) AS q
  FROM summed JOIN sizes USING (lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', t, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# States: 0 nothing put out, 1 the system turn, 2 a user turn, 3 an assistant turn. Each round takes one row of every
# conversation: none to two inserts, then the row's own edit; the last round's edits are inserts alone.
ORACLES["op12_conversation_repair"] = r"""
WITH RECURSIVE source_ AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: list_reduce(list_concat([xor(a, c)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS k
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM source_ WHERE k <> 0
), placed AS (
  SELECT *, row_number() OVER o AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, role, text, copy) AS again,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending, left(role, 1) AS r, lag(left(role, 1)) OVER o AS before
  FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), rows_ AS (
  SELECT *, CASE WHEN ending = '' THEN 'b' WHEN again > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows_ GROUP BY conv_id
), inserts(s, s2, ins, said) AS (
  SELECT s, s, '', []::VARCHAR[] FROM (VALUES (0), (1), (2), (3)) t(s)
  UNION ALL VALUES (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']),
    (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:']), (2, 2, 'II', ['assistant:', 'user:']), (3, 3, 'II', ['user:', 'assistant:'])
), best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]} AS b FROM counts
  UNION ALL
  SELECT conv_id, i, s, min(b) AS b FROM (
    SELECT w.conv_id, w.i + 1 AS i, e.s3 AS s,
      {'cost': b.cost + 3 * length(ins) + e.price + CASE WHEN e.edit <> 'D' AND fault = 't' THEN 3 ELSE 0 END, 'audit': b.audit || ins || e.edit,
       'said': list_concat(b.said, x.said, CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
         ELSE [CASE WHEN e.s3 = 2 THEN 'user:' ELSE 'assistant:' END || text] END)} AS b
    FROM best w JOIN inserts x ON x.s = w.s JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN (VALUES (0, 'D', 4, '', 0), (1, 'D', 4, '', 1), (2, 'D', 4, '', 2), (3, 'D', 4, '', 3), (0, 'K', 0, 's', 1), (0, 'K', 0, 'u', 2),
      (1, 'K', 0, 'u', 2), (2, 'K', 0, 'a', 3), (3, 'K', 0, 'u', 2), (0, 'R', 3, '', 2), (1, 'R', 3, '', 2), (2, 'R', 3, '', 3), (3, 'R', 3, '', 2)
    ) e(s2, edit, price, wants, s3) ON e.s2 = x.s2 AND (e.wants = '' OR e.wants = r.r) AND (e.edit = 'D' OR r.fault NOT IN ('b', 'd'))
  ) GROUP BY conv_id, i, s
), ends AS (
  SELECT w.conv_id, min({'cost': b.cost + 3 * length(ins), 'audit': b.audit || ins, 'said': list_concat(b.said, x.said)}) AS b
  FROM best w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts x ON x.s = w.s WHERE x.s2 IN (0, 3) GROUP BY w.conv_id
)
SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
  sha256(coalesce(array_to_string(b.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM v.conv_id
"""
