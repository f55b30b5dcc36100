"""DuckDB SQL of the operators that SQL can express, written on its own."""

# Entropy 0.95, budget 1, blocks of 1000 documents, 48 halvings.
MIXING = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce(source, '') AS source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM documents),
found AS (SELECT source, count(*) AS docs, sum(n_tokens) AS tokens FROM counted GROUP BY source),
shares AS (SELECT *, tokens / (SELECT greatest(sum(tokens), 1) FROM found) AS share FROM found),
logs AS (SELECT list(ln(share)) AS ls FROM shares WHERE tokens > 0),
halvings AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
  UNION ALL
  SELECT i + 1, CASE WHEN entropy > target THEN mid ELSE low END,
         CASE WHEN entropy > target THEN high ELSE mid END
  FROM (
    SELECT i, low, high, mid, 0.95 * ln(len(ls)) AS target,
           ln(list_sum(list_transform(ls, lambda x: exp(x * mid))))
             - list_sum(list_transform(ls, lambda x: exp(x * mid) * x * mid))
             / list_sum(list_transform(ls, lambda x: exp(x * mid))) AS entropy
    FROM (SELECT *, (low + high) / 2 AS mid FROM halvings CROSS JOIN logs WHERE i < 48))),
exponent AS (SELECT (low + high) / 2 AS a FROM halvings WHERE i = 48),
powers AS (
  SELECT *, CASE WHEN tokens > 0 THEN exp(ln(share) * a) ELSE 0 END AS power
  FROM shares CROSS JOIN exponent),
passes AS (
  SELECT source, CAST(ceil(docs / 1000) AS BIGINT) AS blocks,
         CASE WHEN tokens > 0 THEN round(power / sum(power) OVER () / share, 9) ELSE 1 END AS passes
  FROM powers),
dealt AS (
  SELECT c.*, p.passes,
         CAST('0x' || substr(md5(concat_ws(':', 'block', source, doc_id::VARCHAR)), 1, 13) AS BIGINT)
           % p.blocks AS block,
         CAST('0x' || substr(md5(concat_ws(':', 'turn', source, doc_id::VARCHAR)), 1, 13) AS BIGINT) AS turn
  FROM counted c JOIN passes p USING (source)),
placed AS (
  SELECT *, CAST(row_number() OVER o AS INTEGER) AS place,
         sum(n_tokens) OVER (o ROWS UNBOUNDED PRECEDING) AS spent,
         sum(n_tokens) OVER (PARTITION BY source, block) AS held
  FROM dealt WINDOW o AS (PARTITION BY source, block ORDER BY turn, doc_id, n_tokens))
SELECT doc_id, source, n_tokens, block, place,
       CAST(floor(passes) + CASE WHEN passes > floor(passes) AND 2 * spent - n_tokens <= 2 * ((passes - floor(passes)) * held)
                                 THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed
"""

# The term pattern, 1000, 100, 25, 12 and 20 of the score.
RANKED = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS doc,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM words WHERE len(ts) > 0),
norms AS (
  SELECT doc_id, doc, ts, 100 - 25 + ((25 * len(ts) * n_docs) // n_terms) AS m
  FROM words CROSS JOIN totals WHERE len(ts) > 0),
asked AS (
  SELECT item_id, item, term, count(*) AS times
  FROM (SELECT item_id, item, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT *, row_number() OVER () AS item FROM benchmark))
  GROUP BY ALL),
postings AS (
  SELECT doc_id, doc, m, term, count(*) AS tf
  FROM (SELECT doc_id, doc, m, unnest(ts) AS term FROM norms)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) CROSS JOIN totals),
scored AS (
  SELECT item_id, item, doc_id, doc,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 20
"""

# The word pattern and windows of 50.
REPEATS = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS doc, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
starts AS (
  SELECT doc_id, doc, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT *, unnest(generate_series(1, len(ws) - 49)) AS i FROM words
        WHERE len(ws) >= 50 AND doc_id IS NOT NULL)),
hits AS (
  SELECT doc, i FROM starts JOIN (SELECT w, min(doc_id) AS least FROM starts GROUP BY w) USING (w)
  WHERE least < doc_id),
placed AS (SELECT doc, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM words WHERE len(ws) > 0),
judged AS (
  SELECT p.doc, p.i, word,
         max(h.i IS NOT NULL) OVER (PARTITION BY p.doc ORDER BY p.i ROWS 49 PRECEDING) AS covered
  FROM placed p LEFT JOIN hits h ON p.doc = h.doc AND p.i = h.i),
kept AS (
  SELECT doc, CAST(count(*) FILTER (covered) AS BIGINT) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT covered) AS kept
  FROM judged GROUP BY doc)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc)
"""

# The reversed CRC polynomial, damages 0 to 4 of 20, the patterns, costs 3, 2, 2, 1.
REPAIR = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_concat([4294967295], list_transform(string_split(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)) AS bytes
  FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(bytes, lambda crc, byte: list_reduce(
           list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 20 AS kind
  FROM hashed),
rows AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, (SELECT unnest([1, 2]) AS copy) WHERE kind != 0 AND (copy = 1 OR kind = 3)),
faults AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM rows)),
parse AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 'r': ''} AS e0, {'c': 1000000000::BIGINT, 'a': '', 'r': ''} AS e1,
         {'c': 1000000000::BIGINT, 'a': '', 'r': ''} AS e2, {'c': 1000000000::BIGINT, 'a': '', 'r': ''} AS e3
  FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, here,
    {'c': e0.c + 3, 'a': e0.a || 'D', 'r': e0.r},
    list_min([{'c': e1.c + 3, 'a': e1.a || 'D', 'r': e1.r},
              {'c': e0.c + CASE WHEN stays AND ini = 's' THEN more ELSE 1000000000 END, 'a': e0.a || 'K', 'r': e0.r || own}]),
    list_min([{'c': t2.c + 3, 'a': t2.a || 'D', 'r': t2.r},
              {'c': f.c + CASE WHEN stays AND ini = 'u' THEN more ELSE 1000000000 END, 'a': f.a || 'K', 'r': f.r || own},
              {'c': f.c + CASE WHEN stays THEN 2 + more ELSE 1000000000 END, 'a': f.a || 'R', 'r': f.r || chr(10) || 'user:' || text}]),
    list_min([{'c': t3.c + 3, 'a': t3.a || 'D', 'r': t3.r},
              {'c': t2.c + CASE WHEN stays AND ini = 'a' THEN more ELSE 1000000000 END, 'a': t2.a || 'K', 'r': t2.r || own},
              {'c': t2.c + CASE WHEN stays THEN 2 + more ELSE 1000000000 END, 'a': t2.a || 'R', 'r': t2.r || chr(10) || 'assistant:' || text}])
  FROM (
    SELECT *, list_min([e0, e1, t3]) AS f
    FROM (
      SELECT *, list_min([e3, {'c': t2.c + 2, 'a': t2.a || 'I', 'r': t2.r || chr(10) || 'assistant:'}]) AS t3
      FROM (
        SELECT p.*, w.i AS here, ini, text, chr(10) || role || ':' || text AS own, fault IN (0, 3) AS stays,
               CASE fault WHEN 3 THEN 1 ELSE 0 END AS more,
               list_min([e2, {'c': g.c + 2, 'a': g.a || 'I', 'r': g.r || chr(10) || 'user:'}]) AS t2
        FROM (SELECT *, list_min([e0, e1, e3]) AS g FROM parse) p
        JOIN faults w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.i = p.i + 1)))),
ends AS (
  SELECT conv_id, list_min([e0, e3, {'c': t2.c + 2, 'a': t2.a || 'I', 'r': t2.r || chr(10) || 'assistant:'}]) AS best
  FROM (
    SELECT *, list_min([e2, {'c': g.c + 2, 'a': g.a || 'I', 'r': g.r || chr(10) || 'user:'}]) AS t2
    FROM (SELECT *, list_min([e0, e1, e3]) AS g FROM parse)
    WHERE (conv_id, i) IN (SELECT (conv_id, max(i)) FROM faults GROUP BY conv_id))),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faults) GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLES = {"op11_conversation_repair": REPAIR, "op12_substring_dedup": REPEATS, "op9_mixing": MIXING, "op13_ranked_search": RANKED}
