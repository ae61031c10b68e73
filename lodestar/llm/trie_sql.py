"""SQL of the prefix trie and of the Merkle manifest."""

# The checksum of a number's decimal digits, a byte at a time by a table that is computed here.
CRC = """
crc_table AS (SELECT list(c ORDER BY b) AS t FROM (
  SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) r(b))),
crcs AS (SELECT id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS crc FROM (SELECT DISTINCT {id} AS id FROM {table} WHERE {id} IS NOT NULL), crc_table)
"""

PREFIX_TRIE_SQL = f"""
WITH {CRC.format(id='conv_id', table='conversations')},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM turns),
lengths AS (SELECT conv_id, count(*) AS n FROM own GROUP BY 1),
ids AS (SELECT id AS conv_id, id - id % 20 AS head, crc % 4 AS h FROM crcs),
rebuilt AS (
  SELECT i.conv_id, o.pos, o.digest, o.words FROM ids i JOIN own o ON o.conv_id = i.head WHERE o.pos <= i.h
  UNION ALL
  SELECT i.conv_id, o.pos - i.h + least(i.h, coalesce(l.n, 0)), o.digest, o.words
  FROM ids i JOIN own o ON o.conv_id = i.conv_id LEFT JOIN lengths l ON l.conv_id = i.head WHERE o.pos > i.h),
sequences AS (SELECT i.conv_id, coalesce(list(digest ORDER BY pos) FILTER (WHERE digest IS NOT NULL), []) AS s, coalesce(list(words ORDER BY pos) FILTER (WHERE digest IS NOT NULL), []) AS w
  FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY 1),
prefixes AS (SELECT conv_id, d, len(s) AS n, array_to_string(s[1:d], '') AS node, CASE WHEN d > 0 THEN array_to_string(s[1:d - 1], '') END AS parent,
    CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words FROM (SELECT conv_id, s, w, unnest(range(0, len(s) + 1)) AS d FROM sequences)),
nodes AS (SELECT node, min(conv_id) AS conv_id, min(d) AS depth, min(parent) AS parent, min(words) AS words, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n), '') AS ends FROM prefixes GROUP BY 1),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
below AS (SELECT p.node, sum((u.n_convs - 1) * u.words) AS saved, count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
  FROM nodes u JOIN prefixes p ON p.conv_id = u.conv_id AND p.d <= u.depth LEFT JOIN children c ON c.node = u.node GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved::BIGINT AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN children c USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE {CRC.format(id='doc_id', table='documents')},
rows AS (SELECT doc_id, coalesce('v' || lang, '') AS tree, {_leaf('n_chars')} AS leaf, CASE WHEN crc % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS changed
  FROM documents LEFT JOIN crcs ON id = doc_id),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM rows),
up AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, level, pos // 2, n),
roots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM roots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
low_steps AS (SELECT l.tree, l.pos, list(CASE WHEN s.digest IS NULL THEN '' WHEN s.pos < u.pos THEN 'L' || s.digest ELSE 'R' || s.digest END ORDER BY u.level) AS steps
  FROM leaves l JOIN up u ON u.tree = l.tree AND u.n > 1 AND u.pos = l.pos >> u.level LEFT JOIN up s ON s.tree = u.tree AND s.level = u.level AND s.pos = xor(u.pos, 1)
  GROUP BY 1, 2),
high_steps AS (SELECT r.tree, list(CASE WHEN s.digest IS NULL THEN '' WHEN s.pos < u.pos THEN 'L' || s.digest ELSE 'R' || s.digest END ORDER BY u.level) AS steps
  FROM roots r JOIN top u ON u.n > 1 AND u.pos = r.pos >> u.level LEFT JOIN top s ON s.level = u.level AND s.pos = xor(u.pos, 1) GROUP BY 1),
paths AS (SELECT l.*, r.subroot, list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
  FROM leaves l JOIN roots r USING (tree) LEFT JOIN low_steps a ON a.tree = l.tree AND a.pos = l.pos LEFT JOIN high_steps b ON b.tree = l.tree),
done AS (SELECT doc_id, leaf, subroot, (SELECT digest FROM top WHERE n = 1) AS root,
  sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
  list_reduce(list_prepend(coalesce(changed, leaf), steps), lambda d, s: CASE WHEN s = '' THEN sha256(d) WHEN s[1] = 'L' THEN sha256(s[2:] || d) ELSE sha256(d || s[2:]) END) AS folded_root
  FROM paths)
SELECT *, folded_root = root AS verified FROM done
"""
