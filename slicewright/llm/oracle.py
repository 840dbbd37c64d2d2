"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_OP7 = """
WITH cut AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
numbered AS (SELECT *, row_number() OVER () AS row_no FROM parts),
hits AS (
  SELECT row_no, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM numbered JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT n.page_id, n.host, n.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM numbered n LEFT JOIN hits h ON h.row_no = n.row_no AND h.place = 1
"""

_OP2 = """
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
windows AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 12], ' ') AS seen
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS pos FROM split WHERE len(w) >= 13)),
owned AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY seen) < doc_id AS again FROM windows),
marked AS (
  SELECT word.doc_id, word.pos, word.word,
         max(CASE WHEN owned.again THEN 1 ELSE 0 END)
           OVER (PARTITION BY word.doc_id ORDER BY word.pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM word LEFT JOIN owned ON owned.doc_id = word.doc_id AND owned.pos = word.pos),
told AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_words, 0) AS n_words, coalesce(t.n_removed, 0) AS n_removed,
       sha256(coalesce(t.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id
"""

_OP3 = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT conv_id, count(*) AS n, max(place) FILTER (WHERE role = 'assistant') AS reply_place,
         arg_max(text, place) FILTER (WHERE role = 'assistant') AS reply
  FROM turns GROUP BY conv_id),
pairs AS (
  SELECT c.*, d.conv_id AS donor_id, coalesce(d.reply, '') AS other FROM conv c LEFT JOIN conv d ON d.conv_id = xor(c.conv_id, 1)),
sized AS (
  SELECT *, CAST(CASE WHEN reply_place IS NULL OR reply = other THEN n ELSE reply_place - 1 END AS INTEGER) AS prefix_turns FROM pairs),
sides AS (
  SELECT conv_id, true AS chosen, place, role, text FROM turns
  UNION ALL
  SELECT t.conv_id, false, t.place, t.role, CASE WHEN t.place = s.reply_place THEN s.other ELSE t.text END
  FROM turns t JOIN sized s ON s.conv_id = t.conv_id
  UNION ALL
  SELECT conv_id, false, n + 1, 'assistant', other FROM sized WHERE reply_place IS NULL),
told AS (
  SELECT conv_id, chosen, string_agg(head || body, '' ORDER BY place) FILTER (WHERE place <= prefix_turns) AS before,
         string_agg(head || body, '' ORDER BY place) FILTER (WHERE place > prefix_turns) AS after,
         string_agg('0*' || length(head) || CASE WHEN role = 'assistant' THEN ',1*' ELSE ',0*' END || length(body), ',' ORDER BY place)
           FILTER (WHERE place > prefix_turns) AS mask
  FROM (SELECT sides.*, s.prefix_turns, '<|' || role || '|>\n' AS head, text || '<|end|>\n' AS body
        FROM sides JOIN sized s ON s.conv_id = sides.conv_id)
  GROUP BY conv_id, chosen)
SELECT s.conv_id AS pair_id, s.conv_id AS chosen_id, s.donor_id AS rejected_id, s.prefix_turns, coalesce(c.before, '') AS prompt,
       coalesce(c.after, '') AS chosen, coalesce(r.after, '') AS rejected,
       coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
FROM sized s JOIN told c ON c.conv_id = s.conv_id AND c.chosen
JOIN told r ON r.conv_id = s.conv_id AND NOT r.chosen
"""

_OP9 = """
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
word AS (SELECT row_no, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
triples AS (
  SELECT row_no, pos, word || ' ' || lead(word) OVER along || ' ' || lead(word, 2) OVER along AS seen
  FROM word WINDOW along AS (PARTITION BY row_no ORDER BY pos)),
windows AS (
  SELECT row_no, pos, count(*) OVER (PARTITION BY row_no, seen) AS times FROM triples WHERE seen IS NOT NULL),
repeated AS (
  SELECT row_no, count(DISTINCT pos + step) AS n
  FROM windows, (VALUES (0), (1), (2)) AS steps(step) WHERE times > 1 GROUP BY row_no),
counts AS (
  SELECT s.row_no, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM split s LEFT JOIN repeated r ON r.row_no = s.row_no),
based AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
measures AS (
  SELECT row_no, lang, source, unnest([
    {'measure': 'symbol_rate', 'v': (n_symbols + 1) / (word_chars + 1)},
    {'measure': 'repeat_rate', 'v': (n_repeat_words + 1) / (n_words + 1)},
    {'measure': 'dup_line_share', 'v': n_dup_lines / greatest(n_lines, 1)},
    {'measure': 'n_words', 'v': n_words / 1},
    {'measure': 'word_length', 'v': word_chars / greatest(n_words, 1)},
    {'measure': 'words_per_line', 'v': n_words / greatest(n_lines, 1)}], recursive := true)
  FROM based WHERE NOT base_failed),
fine AS (
  SELECT lang, source, measure, CASE WHEN v > 1e-9 THEN CAST(ceil(ln(v) / ln(1.01::DOUBLE / 0.99::DOUBLE)) AS INTEGER) ELSE -10000 END AS bin,
         count(*)::HUGEINT AS n
  FROM measures GROUP BY ALL),
by_lang AS (SELECT lang, measure, bin, sum(n)::HUGEINT AS n FROM fine GROUP BY ALL),
whole AS (SELECT measure, bin, sum(n)::HUGEINT AS n FROM by_lang GROUP BY ALL),
sizes AS (
  SELECT l.lang, l.measure, l.n AS of_lang, w.n AS of_whole
  FROM (SELECT lang, measure, sum(n)::HUGEINT AS n FROM by_lang GROUP BY ALL) l
  JOIN (SELECT measure, sum(n)::HUGEINT AS n FROM whole GROUP BY ALL) w ON w.measure = l.measure),
groups AS (SELECT DISTINCT lang, source, measure FROM fine),
mixed AS (
  SELECT lang, source, measure, bin, sum(n)::HUGEINT AS n FROM (
    SELECT f.lang, f.source, f.measure, f.bin, f.n * (z.of_lang + 200) * z.of_whole AS n
    FROM fine f JOIN sizes z ON z.lang IS NOT DISTINCT FROM f.lang AND z.measure = f.measure
    UNION ALL
    SELECT g.lang, g.source, g.measure, b.bin, b.n * 200 * z.of_whole
    FROM groups g JOIN by_lang b ON b.lang IS NOT DISTINCT FROM g.lang AND b.measure = g.measure
    JOIN sizes z ON z.lang IS NOT DISTINCT FROM g.lang AND z.measure = g.measure
    UNION ALL
    SELECT g.lang, g.source, g.measure, w.bin, w.n * 200 * 200 FROM groups g JOIN whole w ON w.measure = g.measure)
  GROUP BY ALL),
walked AS (
  SELECT lang, source, measure, bin, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bin) AS seen,
         sum(n) OVER (PARTITION BY lang, source, measure) AS total
  FROM mixed),
bins AS (
  SELECT lang, source, measure, min(bin) FILTER (WHERE seen * 100 >= total * 25) AS low,
         min(bin) FILTER (WHERE seen * 100 >= total * 50) AS median, min(bin) FILTER (WHERE seen * 100 >= total * 75) AS high,
         min(bin) FILTER (WHERE seen * 100 >= total * 99) AS tail
  FROM walked GROUP BY ALL),
quartiles AS (
  SELECT lang, source, measure, tail, 2 * pow(1.01::DOUBLE / 0.99::DOUBLE, low) / (1.01::DOUBLE / 0.99::DOUBLE + 1) AS low,
         2 * pow(1.01::DOUBLE / 0.99::DOUBLE, median) / (1.01::DOUBLE / 0.99::DOUBLE + 1) AS median,
         2 * pow(1.01::DOUBLE / 0.99::DOUBLE, high) / (1.01::DOUBLE / 0.99::DOUBLE + 1) AS high,
         CASE measure WHEN 'word_length' THEN 1.1 WHEN 'n_words' THEN 2 WHEN 'words_per_line' THEN 2 ELSE 4 END AS at_least
  FROM bins),
limits AS (
  SELECT lang, source, measure,
         CASE WHEN measure IN ('n_words', 'word_length', 'words_per_line') THEN low / greatest(pow(high / low, 3), at_least) ELSE -1 END AS lower,
         CASE WHEN measure = 'dup_line_share' THEN CASE WHEN tail > -10000 THEN pow(1.01::DOUBLE / 0.99::DOUBLE, tail) ELSE 0 END
              WHEN measure IN ('symbol_rate', 'repeat_rate')
              THEN least(high * greatest(pow(high / low, 3), at_least), median * greatest(pow(median / low, 7), at_least))
              ELSE high * greatest(pow(high / low, 3), at_least) END AS upper
  FROM quartiles),
beyond AS (
  SELECT DISTINCT row_no FROM measures m JOIN limits l
    ON l.lang IS NOT DISTINCT FROM m.lang AND l.source IS NOT DISTINCT FROM m.source AND l.measure = m.measure
  WHERE m.v > l.upper OR m.v < l.lower)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT base_failed AND b.row_no IS NULL AS kept, lang, source
FROM based LEFT JOIN beyond b ON b.row_no = based.row_no
"""

_OP11 = """
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first_id,
         xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
             lambda crc, c: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, c)),
             CAST(4294967295 AS BIGINT)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
rebuilt AS (
  SELECT c.conv_id, p.place, p.role, p.text FROM conv c JOIN placed p ON p.conv_id = c.first_id AND p.place <= c.h
  UNION ALL
  SELECT c.conv_id, p.place, p.role, p.text FROM conv c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h),
whole AS (
  SELECT c.conv_id, coalesce(t.turns, []) AS turns, coalesce(t.sizes, []) AS sizes
  FROM conv c LEFT JOIN (
    SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY place) AS turns, list(length(text) ORDER BY place) AS sizes
    FROM rebuilt GROUP BY conv_id) t ON t.conv_id = c.conv_id),
member AS (
  SELECT conv_id, depth, turns[1:depth] AS node, CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size, len(turns) = depth AS ends
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM whole)),
node AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM member GROUP BY node, depth),
child AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM node n LEFT JOIN child c ON c.node = n.node),
subtree AS (
  SELECT node[1:top] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM counted) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtree s ON s.node = n.node LEFT JOIN node p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""

_OP12 = """
WITH word_list AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
item_window AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[pos:pos + 9], ' ') AS seen
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
  SELECT row_no, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS seen
  FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM word_list, sizes WHERE len(w) >= size)),
met AS (
  SELECT d.row_no, d.pos, d.size, i.item FROM doc_window d JOIN item_window i ON i.seen = d.seen AND i.size = d.size),
hit AS (
  SELECT row_no, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT row_no, unnest(range(pos, pos + size)) AS place FROM met) GROUP BY row_no),
listed AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, item FROM met WHERE item IS NOT NULL) GROUP BY row_no)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
       sha256(coalesce(l.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM word_list d LEFT JOIN hit h USING (row_no) LEFT JOIN listed l USING (row_no)
"""

_OP13 = """
WITH whole AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
least_id AS (SELECT text, min(doc_id) AS least FROM whole GROUP BY text),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         len(v) < 200 AS a, 100 * len(list_distinct(v)) < 50 * len(v) AS b,
         100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 3 * length(w.text) AS c,
         regexp_matches(w.text, '[#$%&*|]') AS d, coalesce(w.doc_id > l.least, false) AS e
  FROM (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS v FROM whole) w
  JOIN least_id l ON l.text = w.text LEFT JOIN marks m ON m.doc_id = w.doc_id),
cell AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, a, b, c, d, e),
letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
filter_orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS o
  FROM letter p, letter q, letter r, letter s, letter t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x),
ranked AS (
  SELECT o, cell.*, least(CASE WHEN a THEN strpos(o, 'A') ELSE 9 END, CASE WHEN b THEN strpos(o, 'B') ELSE 9 END,
                          CASE WHEN c THEN strpos(o, 'C') ELSE 9 END, CASE WHEN d THEN strpos(o, 'D') ELSE 9 END,
                          CASE WHEN e THEN strpos(o, 'E') ELSE 9 END) AS gone,
         (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed
  FROM cell, filter_orders),
told AS (
  SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, substr(o, step, 1) AS letter,
         sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone < step AND contains(failed, substr(o, step, 1)) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = substr(o, step, 1) THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM ranked, (SELECT unnest(range(1, 6)) AS step) GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM told
"""

ORACLE: dict[str, str] = {
    "op11_prefix_trie": _OP11,
    "op12_decontaminate": _OP12,
    "op13_filter_audit": _OP13,
    "op2_substring_dedup": _OP2,
    "op3_preference_format": _OP3,
    "op7_url_filter": _OP7,
    "op9_quality_rules": _OP9,
}
