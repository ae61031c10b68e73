"""The SQL of the divergence rules, written from their definition."""

from . import divergence as D

_SPACE = r"[\x20\x09-\x0D]"


def _count(pattern: str) -> str:
    """Characters left when everything matched by ``pattern`` is taken out."""
    return f"length(regexp_replace(text, '{pattern}', '', 'g'))"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_SPACE}+'), lambda w: w <> '')"


def _js(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of shares of equal length."""
    def half(x, y):
        return f"list_sum(list_transform(range(1, len({p}) + 1), lambda i: CASE WHEN {x}[i] > 0 THEN {x}[i] * log2(2 * {x}[i] / ({x}[i] + {y}[i])) ELSE 0 END))"
    return f"sqrt(greatest(0, ({half(p, q)} + {half(q, p)}) / 2))"


_CLASSES = ", ".join(f"{_count(pattern)} AS {name}" for name, pattern in D.CLASSES.items())

DIVERGENCE_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents),
measured AS (SELECT doc_id, lang, text, {_words('text')} AS w, {_words('lower(text)')} AS lw, {_CLASSES}, {_count('[^' + _SPACE[1:] + '+')} AS white,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs),
hist AS (SELECT *, [upper, digit, symbol, mark - symbol, white, greatest(0, length(text) - upper - digit - mark - white)] AS c FROM measured),
class_totals AS (SELECT lang, [sum(c[1]), sum(c[2]), sum(c[3]), sum(c[4]), sum(c[5]), sum(c[6])]::DOUBLE[] AS t FROM hist GROUP BY lang),
class_ref AS (SELECT lang, list_transform(t, lambda x: CASE WHEN list_sum(t) > 0 THEN x / list_sum(t) ELSE 0 END) AS class_ref FROM class_totals),
counted AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(lw) AS word FROM hist) GROUP BY 1, 2),
common AS (SELECT lang, word, share FROM (SELECT lang, word, n / sum(n) OVER (PARTITION BY lang) AS share,
  row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM counted) WHERE share >= {D.LEAST_SHARE} AND place <= {D.COMMON_WORDS}),
word_ref AS (SELECT lang, list(word ORDER BY word) AS words, list(share ORDER BY word) AS s FROM common GROUP BY lang),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM hist)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT i + j) AS covered FROM twice, range(5) r(j) GROUP BY doc_id),
joined AS (SELECT h.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, symbol AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered, 0) AS n_repeat_words, c::DOUBLE[] AS c, class_ref,
  list_transform(coalesce(words, []), lambda x: len(list_filter(lw, lambda y: y = x)))::DOUBLE[] AS known, coalesce(s, []) AS s
  FROM hist h LEFT JOIN cover USING (doc_id) JOIN class_ref r ON r.lang = h.lang LEFT JOIN word_ref v ON v.lang = h.lang),
shares AS (SELECT *, list_transform(c, lambda x: CASE WHEN list_sum(c) > 0 THEN x / list_sum(c) ELSE 0 END) AS p,
  list_transform(list_append(known, n_words - coalesce(list_sum(known), 0)), lambda x: CASE WHEN n_words > 0 THEN x / n_words ELSE 0 END) AS wp,
  list_append(s, greatest(0, 1 - coalesce(list_sum(s), 0))) AS wq FROM joined),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {_js('p', 'class_ref')} AS cd, {_js('wp', 'wq')} AS wd FROM shares)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (word_chars >= {D.LEAST_CHARS} AND cd > {D.MOST_CLASS_DISTANCE}) AND NOT (n_words >= {D.LEAST_WORDS} AND wd > {D.MOST_WORD_DISTANCE}) AS kept
FROM judged"""
