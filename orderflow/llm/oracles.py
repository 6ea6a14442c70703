"""DuckDB SQL for the results of the corpus operators that SQL can express,
written from the rules of the results, not from the operators (the licence
templates are the shared fixed values)."""

from orderflow.llm.license_scan import TEMPLATES

HOST_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents
), w AS (
  SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), word AS (
  SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w
), three AS (
  SELECT rid, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)
), found AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM three WHERE c IS NOT NULL
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM found WHERE n > 1) GROUP BY rid
), line AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid
), chars AS (
  SELECT rid, sum(length(a)) AS word_chars FROM word GROUP BY rid
), s AS (
  SELECT d.doc_id, d.host, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM d JOIN w USING (rid) LEFT JOIN chars USING (rid) LEFT JOIN line USING (rid) LEFT JOIN rep USING (rid)
), r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS soft_failed
  FROM s
), h AS (
  SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed OR soft_failed) AS f FROM r GROUP BY host
), m AS (
  SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n))
         - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * count(*) / sum(n) AS spread
  FROM h
), prior AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(1e6, greatest(1.0, mean * (1 - mean) / spread - 1)) ELSE 1e6 END AS k
  FROM m
), rate AS (
  SELECT host, n, mean, k, (f + mean * k) / (n + k) AS r FROM h, prior
), bad AS (
  SELECT host, r - 1.645::DOUBLE * sqrt(r * (1 - r) / (n + k + 1)) > mean + 0.15::DOUBLE AS rejected FROM rate
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR soft_failed) AND NOT rejected AS kept
FROM r JOIN bad USING (host)
"""

# base32 (RFC 4648): each 5 hex digits are 20 bits, four characters
ARCHIVE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS INT) >> CAST(5 * (3 - k % 4) AS INT)) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM f
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), item AS (
  SELECT item_id, ws, least(10, len(ws)) AS size FROM b WHERE len(ws) > 0
), win AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS g
  FROM (SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM item)
), place AS (
  SELECT rid, size, i, array_to_string(ws[i:i + size - 1], ' ') AS g
  FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT size FROM item) WHERE len(ws) >= size)
), hit AS (
  SELECT rid, i, size, item_id FROM place JOIN win USING (size, g)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hit) GROUP BY rid
), ids AS (
  SELECT rid, count(*) AS n, string_agg(k, ',' ORDER BY k) AS list
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS k FROM hit WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)
"""



def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]::VARCHAR[]"


def _template(n, t) -> str:
    body, key = t.text.split(), t.phrases[0].split()
    shift = next((i for i in range(len(body)) if body[i:i + len(key)] == key), 0)
    return f"({n}, '{t.label}', {t.base}, {shift}, {_list(key)}, {_list(body)}, {_list(t.phrases[1:])})"


LICENSES = rf"""
WITH tpl AS (
  SELECT * FROM (VALUES {", ".join(_template(n, t) for n, t in enumerate(TEMPLATES))})
    AS v(t, label, base, shift, ph, body, more)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), word AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d
), voc AS (
  SELECT DISTINCT unnest(body) AS w FROM tpl
), df AS (
  SELECT w, count(DISTINCT rid) AS c FROM word WHERE w IN (SELECT w FROM voc) GROUP BY w
), idf AS (
  SELECT voc.w, ln(((SELECT count(*) FROM d) + 1.0) / (coalesce(df.c, 0) + 1)) + 1e-9 AS v FROM voc LEFT JOIN df USING (w)
), place AS (
  SELECT d.rid, d.ws, word.i - 1 AS start, tpl.* FROM word JOIN tpl ON tpl.ph[1] = word.w JOIN d ON d.rid = word.rid
  WHERE d.ws[word.i:word.i + len(tpl.ph) - 1] = tpl.ph
), near AS (
  SELECT *, ' ' || array_to_string(ws[greatest(0, start - shift - len(body)) + 1:start - shift + 2 * len(body)], ' ')
    || ' ' AS text FROM place
), ok AS (
  SELECT * FROM near WHERE len(list_filter(more, lambda p: NOT contains(text, ' ' || p || ' '))) = 0
), body AS (
  SELECT rid, t, start, label, base, ws, unnest(body) AS bw, start - shift + generate_subscripts(body, 1) AS pos FROM ok
), hit AS (
  SELECT rid, t, start, any_value(label) AS label, any_value(base) AS base,
         least(1.0, sum(CASE WHEN pos >= 1 AND pos <= len(ws) AND ws[greatest(pos, 1)] = bw THEN v ELSE 0 END) / sum(v)) AS cover
  FROM body JOIN idf ON idf.w = bw GROUP BY rid, t, start
), r AS (
  SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
         max(start) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, round(max(cover), 6) AS score
  FROM hit GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN r USING (rid)
"""

# a window's first place is the smallest (doc_id, word)
SUBSTRINGS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT rid, doc_id, i, sha256(array_to_string(ws[i:i + 19], ' ')) AS g
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)
), first AS (
  SELECT g, min((doc_id, i)) AS place FROM win GROUP BY g HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM win JOIN first USING (g) WHERE (doc_id, i) > place
), per AS (
  SELECT rid, list(p) AS ps FROM gone GROUP BY rid
), kept AS (
  SELECT d.rid, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d) d LEFT JOIN gone USING (rid, p)
  WHERE gone.rid IS NULL GROUP BY d.rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

RANKING = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), total AS (
  SELECT count(*) AS n, CAST(sum(len(ws)) AS BIGINT) AS l FROM d WHERE len(ws) > 0
), q AS (
  SELECT item, w, count(*) AS c FROM (SELECT item, unnest(ws) AS w FROM b) GROUP BY item, w
), tf AS (
  SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY rid, w
), weight AS (
  SELECT w, CAST(floor(1000 * ln((2.0::DOUBLE * n + 2) / (2 * df + 1))) AS BIGINT) AS wt
  FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), total
), part AS (
  SELECT tf.rid, tf.w, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ws) * n) // l)) AS impact
  FROM tf JOIN d USING (rid), total
), s AS (
  SELECT item, rid, CAST(sum(c * wt * impact) AS BIGINT) AS score
  FROM q JOIN weight USING (w) JOIN part USING (w) GROUP BY item, rid
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s JOIN d USING (rid) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r JOIN b USING (item) WHERE rank <= 10
"""

# The damage's CRC-32 is its shift register over the key's bits; the cheapest
# edits are the least (cost, initials) that reach each role state row by row.
REPAIR = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), key AS (
  SELECT k, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(k) + 1),
      lambda i: [ascii(substr(k, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384::BIGINT * (xor(c, x) & 1)))) % 20 AS fault
  FROM (SELECT DISTINCT k FROM src)
), rows AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM src JOIN key USING (k), range(CASE fault WHEN 3 THEN 2 ELSE 1 END) WHERE fault <> 0
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, row_number() OVER o AS i,
    lag(role) OVER o AS before
  FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE 'n' END AS fault,
    before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal,
    max(i) OVER (PARTITION BY conv_id) AS n
  FROM placed
), chain(state, ins, s2, price, add) AS (
  VALUES (0, '', 0, 0, ''), (0, 'I', 2, 2, 'user:' || chr(10)), (0, 'II', 3, 4, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (1, '', 1, 0, ''), (1, 'I', 2, 2, 'user:' || chr(10)), (1, 'II', 3, 4, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (2, '', 2, 0, ''), (2, 'I', 3, 2, 'assistant:' || chr(10)), (3, '', 3, 0, ''), (3, 'I', 2, 2, 'user:' || chr(10))
), edit(s2, op, role, s3, price) AS (
  VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
         (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (2, 'R', NULL, 3, 2), (3, 'R', NULL, 2, 2),
         (0, 'D', NULL, 0, 3), (1, 'D', NULL, 1, 3), (2, 'D', NULL, 2, 3), (3, 'D', NULL, 3, 3)
), walk(c, i, state, best) AS (
  SELECT DISTINCT c, 0::BIGINT, 0, {'cost': 0, 'audit': '', 't': ''} FROM judged
  UNION ALL
  SELECT w.c, w.i + 1, e.s3, min({'cost': w.best.cost + h.price + e.price + CASE WHEN e.op <> 'D' AND j.fault = 't' THEN 1 ELSE 0 END,
    'audit': w.best.audit || h.ins || e.op,
    't': w.best.t || h.add || CASE e.op WHEN 'D' THEN '' WHEN 'K' THEN j.role || ':' || j.text || chr(10)
         ELSE CASE e.s3 WHEN 2 THEN 'user:' ELSE 'assistant:' END || j.text || chr(10) END})
  FROM walk w JOIN judged j ON j.c = w.c AND j.i = w.i + 1 JOIN chain h ON h.state = w.state
  JOIN edit e ON e.s2 = h.s2 AND (e.role IS NULL OR e.role = left(j.role, 1)) AND (e.op = 'D' OR j.fault IN ('n', 't'))
  GROUP BY w.c, w.i, e.s3
), done AS (
  SELECT w.c, min({'cost': best.cost + h.price, 'audit': best.audit || h.ins, 't': best.t || h.add}) AS best
  FROM walk w JOIN (SELECT DISTINCT c, n FROM judged) j ON j.c = w.c AND j.n = w.i JOIN chain h ON h.state = w.state
  WHERE h.s2 IN (0, 3) GROUP BY w.c
), counted AS (
  SELECT conv_id, any_value(c) AS c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(left(best.t, length(best.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN done USING (c)
"""

ORACLES = {
    "op1_license_scan": LICENSES.strip(),
    "op3_host_rules": HOST_RULES.strip(),
    "op7_warc_dictionary": ARCHIVE.strip(),
    "op10_suffix_decontamination": DECONTAMINATION.strip(),
    "op11_relative_lempel_ziv": SUBSTRINGS.strip(),
    "op12_dense_ranking": RANKING.strip(),
    "op13_conversation_repair": REPAIR.strip(),
}
