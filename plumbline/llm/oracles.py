"""The same results in DuckDB's SQL, written from the rules and not from the operators."""

DECONTAMINATION_SQL = r"""
WITH words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
grams AS (
  SELECT DISTINCT item_id, CASE WHEN len(w) < 10 THEN w ELSE w[i:i + 9] END AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
sizes AS (SELECT DISTINCT len(g) AS n FROM grams),
spans AS (
  SELECT r, i, n, w[i:i + n - 1] AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
found AS (SELECT r, i, n, item_id FROM spans JOIN grams USING (g)),
hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

# The bits of `failed`, in order: few_words, repeated_words, symbols, repeated_lines, long_words, few_letters, huge_word, long_word_share.
RULES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '[\p{L}\p{N}]'))) AS n_marked, coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest,
         len(list_filter(w, lambda x: length(x) > 40 AND NOT contains(x, '://') AND NOT regexp_matches(x,
           '[\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}]'))) AS n_long
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 10 * n_marked < 8 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN longest > 1000 THEN 64 ELSE 0 END) + (CASE WHEN 10 * n_long > n_words THEN 128 ELSE 0 END) AS BIGINT) AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed & 175 = 0 AS kept, failed
FROM judged
"""

# A window has 1024 tokens (four bytes each and four per turn). The system turn takes up to 256 of them and the turns repeated from before it
# 256; at multiples of the rest a conversation is cut.
CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, CAST(ceil(strlen(text) / 4.0) AS BIGINT) + 4 AS tokens, md5(text) AS d,
         length('<|im_start|>' || replace(replace(replace(replace(role, '\', '\s'), '<', '\l'), '[', '\b'), chr(10), '\n') || chr(10) || '<|im_end|>' || chr(10)) AS frame
  FROM rows),
marked AS (
  SELECT *, frame + length(replace(replace(replace(text, '\', '\s'), '<', '\l'), '[', '\b')) AS chars,
         frame + length(replace(replace(replace(CASE WHEN tokens > 256 THEN left(text, 252) ELSE text END, '\', '\s'), '<', '\l'), '[', '\b')) AS short
  FROM sized),
system AS (
  SELECT conv_id, turn AS s_turn, d AS s_d, least(tokens, 256) AS s_tokens FROM marked WHERE role = 'system'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) = 1),
placed AS (
  SELECT m.*, 768 - coalesce(s_tokens, 0) AS room, coalesce(role = 'system' AND turn IS NOT DISTINCT FROM s_turn AND d = s_d, false) AS is_system,
         coalesce(sum(tokens) OVER (PARTITION BY m.conv_id ORDER BY turn NULLS FIRST, role, d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM marked m LEFT JOIN system y ON m.conv_id IS NOT DISTINCT FROM y.conv_id),
turns AS (
  SELECT *, s + tokens AS e, 2 * (s // room) + CASE WHEN s // room < (s + tokens - 1) // room THEN 1 ELSE 0 END AS w FROM placed),
wins AS (SELECT conv_id, w, min(s) AS p FROM turns GROUP BY conv_id, w),
first AS (SELECT conv_id, min(w) AS own, any_value(short) AS short FROM turns WHERE is_system GROUP BY conv_id),
old AS (
  SELECT conv_id, sum(chars) AS chars FROM (
    SELECT b.conv_id, chars FROM turns a JOIN wins b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND NOT a.is_system AND a.e <= b.p AND a.s >= b.p - 256
    UNION ALL SELECT b.conv_id, short FROM first f JOIN wins b ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND b.w > f.own)
  GROUP BY conv_id),
each AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY s)) AS turns_sha256,
         CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
         sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY s), '')) AS loss_sha256, sum(chars) AS chars
  FROM turns GROUP BY conv_id)
SELECT each.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, CAST(each.chars + coalesce(old.chars, 0) AS BIGINT) AS formatted_chars
FROM each LEFT JOIN old ON each.conv_id IS NOT DISTINCT FROM old.conv_id
"""

# crc32 of the decimal conv_id, bit by bit; a node is named by its list of turns.
TRIE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, md5(len(role) || ':' || role || text) AS t,
         strlen(text) AS bytes
  FROM rows),
ids AS (SELECT conv_id, count(*) AS n, CAST(conv_id AS VARCHAR) AS s FROM own GROUP BY conv_id),
hashed AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) % 9 AS h
  FROM ids),
turns AS (
  SELECT h.conv_id, o.pos AS p, o.t, o.bytes FROM hashed h JOIN own o ON o.conv_id = h.base AND o.pos < h.h
  UNION ALL SELECT h.conv_id, 1000000000 + o.pos, o.t, o.bytes FROM hashed h JOIN own o ON o.conv_id = h.conv_id AND o.pos >= h.h),
paths AS (
  SELECT conv_id, list(t) OVER w AS node, count(*) OVER w AS depth, bytes FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, [], 0, 0 FROM ids),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM paths GROUP BY node, depth),
lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM paths JOIN lengths USING (conv_id, depth) GROUP BY node),
children AS (SELECT node[:-2] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
flat AS (SELECT node, depth, saved, NOT EXISTS (FROM children c WHERE c.node = nodes.node) AS leaf FROM nodes),
above AS (
  SELECT node[1:d] AS node, count_if(leaf) AS n_leaves, sum(saved) AS saved
  FROM (SELECT node, saved, leaf, unnest(range(0, depth + 1)) AS d FROM flat) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens,
       coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[:-2] LEFT JOIN children c ON c.node = n.node JOIN above a ON a.node = n.node
LEFT JOIN ends e ON e.node = n.node
"""

SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
docs AS (SELECT r, doc_id, len(w) AS n, w FROM words WHERE len(w) > 0),
sizes AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM benchmark),
postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM docs) SEMI JOIN items USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, sizes GROUP BY term, n_docs),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term), sizes GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
