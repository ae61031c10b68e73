"""Text cleaning, review curation, prompts, replies and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.fixed_values import STOP_WORDS, TOKEN_PATTERN
from ..functions.scalars import half_even
from ..operators import dictionary, features as Fe, plugin, ratings as R, reviews as V, similarity as S, tables as T
from ..session import scratch_path
from ..sources import writers
from .registry import query, sql_of
from .shared_sql import BASE

BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


def strip(e: str) -> str:
    return f"trim({e}, {BLANKS})"


def stop(e: str) -> str:
    return f"array_to_string(list_filter(string_split({e}, ' '), lambda w: NOT list_contains({STOP_SQL}, lower(w))), ' ')"


def drop(e: str, pattern: str) -> str:
    return f"regexp_replace({e}, '{pattern}', '', 'g')"


WORD = r"\p{L}\p{N}_"
TOKENS = f"len(regexp_extract_all({{e}}, '{TOKEN_PATTERN}'))"
CLEAN_REVIEW = f"replace({stop(drop('lower(' + drop('{e}', '[^A-Za-z0-9 ]+') + ')', '^$'))}, '  ', ' ')"


def clean_review(e: str) -> str:
    return CLEAN_REVIEW.replace("{e}", e)


def table_text(e: str) -> str:
    """Every script and mark kept."""
    return f"replace({stop(drop(f'lower({e})', '^$'))}, '  ', ' ')"


def sample_text(e: str) -> str:
    """ASCII letters, digits and spaces; spaces as they fall."""
    return stop(drop("lower(" + drop(e, "[^A-Za-z0-9 ]+") + ")", "^$"))


def tokens(e: str) -> str:
    return TOKENS.replace("{e}", e)


@query("remove_stopwords", f"SELECT doc_id, {stop('text')} AS kept FROM documents")
def remove_stopwords(x):
    return x.documents().select("doc_id", X.remove_stop_words(F.col("text")).alias("kept"))


@query("quality_reviews", f"SELECT doc_id, CAST({tokens('text')} AS INTEGER) AS tokens FROM documents WHERE {tokens('text')} > 10")
def quality_reviews(x):
    kept = x.documents().filter(X.is_quality(F.col("text"), 10))
    return kept.select("doc_id", X.token_count(F.col("text")).alias("tokens"))


@query("normalise_text", f"SELECT doc_id, lower({strip(drop('text', f'[^{WORD}\\s.]'))}) AS plain FROM documents")
def normalise_text(x):
    return x.documents().select("doc_id", X.normalise(F.col("text")).alias("plain"))


RULES = {"the ": "this ", "ing": "PLACEHOLDER", "and": "&", "un ": "", "this is": "here"}


@query("dict_replace", "SELECT doc_id, replace(replace(replace(replace(text, 'the ', 'this '), 'and', '&'), 'un ', ''), 'this is', 'here') AS replaced FROM documents")
def dict_replace(x):
    return x.documents().select("doc_id", X.replace_all(F.col("text"), RULES).alias("replaced"))


def components_of(e: str) -> str:
    flat = f"regexp_replace({e}, '[\\n\\r\\t]', '', 'g')"
    split = f"regexp_replace({flat}, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')"
    return strip(drop(f"lower({split})", f"[^{WORD}\\s.,:]"))


@query("component_normalise", f"SELECT doc_id, {components_of('text')} AS plain FROM documents")
def component_normalise(x):
    return x.documents().select("doc_id", X.normalise_components(F.col("text")).alias("plain"))


PREFIXES = {"red": "crimson", "hot": "PLACEHOLDER", "small": "tiny"}
STRIP_TO = ["crimson", "old r", "large"]


def simplified(e: str) -> str:
    once = f"CASE WHEN starts_with({e}, 'red') THEN replace({e}, 'red', 'crimson') ELSE {e} END"
    twice = f"CASE WHEN starts_with({once}, 'small') THEN replace({once}, 'small', 'tiny') ELSE {once} END"
    return f"CASE WHEN starts_with({twice}, 'crimson') THEN 'crimson' WHEN starts_with({twice}, 'old r') THEN 'old r' WHEN starts_with({twice}, 'large') THEN 'large' ELSE {twice} END"


@query("simplify_category", f"SELECT p_partkey AS item_id, {simplified('p_name')} AS category FROM part")
def simplify_category(x):
    return x.items().select("item_id", X.simplify_category(F.col("name"), PREFIXES, STRIP_TO).alias("category"))


# A "heading: reason." text per part, built from names, types and brands.
HEADED = """headed AS (SELECT p_partkey AS item_id, p_name || ': the Reason is ' || p_brand || '.5 and more. GoodFun of ' || p_type || ' in a very long heading here: because it''s '
|| p_size || '! ' || p_name || ': again, not once. : empty' AS t FROM part)"""


def _headed(x):
    return x.items().select("item_id", F.concat(
        F.col("name"), F.lit(": the Reason is "), F.col("brand"), F.lit(".5 and more. GoodFun of "), F.col("type"),
        F.lit(" in a very long heading here: because it's "), F.col("size").cast("string"), F.lit("! "), F.col("name"),
        F.lit(": again, not once. : empty")).alias("t"))


def plain(e: str) -> str:
    return strip(f"replace({drop(e, f'[^{WORD}\\s]')}, '  ', ' ')")


HEADS = f"""{HEADED}, n AS (SELECT item_id, {components_of('t')} AS row_text FROM headed),
h AS (SELECT item_id, row_text, list_transform(list_filter(list_transform(string_split(row_text, ':')[:-2], lambda p: string_split(p, '. ')[-1]),
  lambda p: {strip('p')} <> ''), lambda p: array_to_string(string_split({plain('p')}, ' ')[:5], ' ')) AS heads FROM n)"""


@query("split_components", f"WITH {HEADS} SELECT item_id, array_to_string(heads, '|') AS components FROM h")
def split_components(x):
    return _headed(x).select("item_id", F.array_join(X.split_components(F.col("t")), "|").alias("components"))


def _sentence() -> str:
    reason = "string_split(string_split(row_text, k || ':')[-1], '.')[1]"
    return f"replace({simplified('k')} || ' ' || {stop(plain(reason))}, '  ', ' ')"


@query("sentiment_elements", f"""WITH {HEADS}, d AS (SELECT item_id, row_text, heads, list_filter(heads, lambda k, i: list_position(heads, k) = i) AS uniq FROM h)
SELECT item_id, array_to_string(list_transform(list_filter(heads, lambda k: k <> ''), lambda k: {simplified('k')}), '|') AS components,
array_to_string(list_transform(uniq, lambda k: {_sentence()}), '|') AS sentences FROM d""")
def sentiment_elements(x):
    made = X.add_sentiment(_headed(x), "t", PREFIXES, STRIP_TO, out="s")
    return made.select("item_id", F.array_join("s.components", "|").alias("components"), F.array_join("s.sentences", "|").alias("sentences"))


@query("clean_reviews", f"SELECT doc_id, {clean_review('text')} AS cleaned FROM documents")
def clean_reviews(x):
    return x.documents().select("doc_id", X.clean_review(F.col("text")).alias("cleaned"))


@query("clean_description", f"SELECT doc_id, {strip('lower(' + drop(drop(chr(114) + 'eplace(text, ' + repr('&amp') + ', ' + repr('') + ')', '[0-9]+'), f'[^{WORD}\\s.]') + ')')} AS cleaned FROM documents")
def clean_description(x):
    return x.documents().select("doc_id", X.clean_description(F.col("text")).alias("cleaned"))


WORDS = f"regexp_extract_all(lower(text), '[{WORD}]+')"


@query("drop_title_tokens", f"""SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: NOT list_contains(string_split(lower(source || ' ' || lang || ' the un'), ' '), w)), ' ') AS kept FROM documents""")
def drop_title_tokens(x):
    title = F.split(F.lower(F.concat_ws(" ", "source", "lang", F.lit("the un"))), " ")
    titled = x.documents().select("doc_id", X.words(F.col("text")).alias("tokens"), title.alias("title"))
    return titled.select("doc_id", F.array_join(X.drop_words(F.col("tokens"), F.col("title")), " ").alias("kept"))


@query("synonym_hits", "SELECT doc_id FROM documents WHERE contains(text, 'email') OR contains(text, 'http') OR contains(text, 'License')")
def synonym_hits(x):
    return x.documents().filter(X.any_contains(F.col("text"), ["email", "http", "License"])).select("doc_id")


PHRASE = "p_name || ' ' || p_partkey"
# Texts of orders: their parts in order, each by name and number; a part's phrase may begin another's.
LINES = f"""lines AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS item_id, {PHRASE} AS phrase
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def order_texts(x):
    part = x.table("part").select("p_partkey", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("phrase"))
    lines = x.table("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "p_partkey", "phrase")))
    return lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.array_join(ordered["phrase"], "; ").alias("text"))


def phrases(x, condition: str = "true"):
    """Every part's phrase, found as a number in brackets."""
    rows = x.table("part").where(condition).select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("phrase"), F.concat(F.lit("["), "p_partkey", F.lit("]")).alias("mark"))
    return dictionary.Dictionary(rows, "phrase", "mark")


@query("dictionary_replace", f"""WITH {LINES}
SELECT order_id, string_agg('[' || item_id || ']', '; ' ORDER BY line, item_id, phrase) AS replaced FROM lines GROUP BY 1""")
def dictionary_replace(x):
    """As many rules as there are parts, replaced in one pass; of phrases that begin alike the longest counts."""
    return order_texts(x).select("order_id", phrases(x).replace(F.col("text")).alias("replaced"))


@query("dictionary_matches", f"""WITH {LINES}
SELECT order_id, CAST(coalesce(sum(length(phrase) + 2) OVER (PARTITION BY order_id ORDER BY line, item_id, phrase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start,
  CAST(length(phrase) AS INTEGER) AS length, '[' || item_id || ']' AS value FROM lines""")
def dictionary_matches(x):
    """Places of all phrases in the texts of orders."""
    return order_texts(x).select("order_id", F.inline(phrases(x).matches(F.col("text"))))


@query("dictionary_hits", f"""WITH {LINES}, needles AS (SELECT {PHRASE} AS needle FROM part WHERE p_size <= 5),
parts AS (SELECT DISTINCT item_id, phrase, EXISTS (SELECT 1 FROM needles WHERE contains(phrase, needle)) AS hit FROM lines)
SELECT DISTINCT order_id FROM lines JOIN parts USING (item_id, phrase) WHERE hit""")
def dictionary_hits(x):
    """Orders whose text holds the phrase of a small part, if only as the beginning of another."""
    return order_texts(x).where(phrases(x, "p_size <= 5").contains(F.col("text"))).select("order_id")


@query("word_frequency", f"SELECT word, count(*) AS n FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word")
def word_frequency(x):
    return Fe.word_frequency(x.documents(), X.words(F.col("text")))


@query("component_vocabulary", f"""WITH {HEADS} SELECT component, CAST(len(string_split(component, ' ')) AS INTEGER) AS words FROM
(SELECT DISTINCT unnest(heads) AS component FROM h) ORDER BY words DESC, component""")
def component_vocabulary(x):
    vocabulary = _headed(x).select(F.explode(X.split_components(F.col("t"))).alias("component")).distinct()
    return vocabulary.withColumn("words", F.size(F.split("component", " "))).orderBy(F.col("words").desc(), "component")


@query("longest_component", f"""WITH {HEADS}, e AS (SELECT item_id, unnest(heads) AS component FROM h)
SELECT item_id, component FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY len(string_split(component, ' ')) DESC, component DESC) AS rn FROM e) WHERE rn = 1""")
def longest_component(x):
    rows = _headed(x).select("item_id", F.explode(X.split_components(F.col("t"))).alias("component"))
    return rows.groupBy("item_id").agg(F.max_by("component", F.struct(F.size(F.split("component", " ")), "component")).alias("component"))


@query("longest_prefix_join", """
WITH texts AS (SELECT p_partkey AS id, p_name || ' ' || p_type || ' ' || p_brand AS text FROM part),
keys AS (SELECT DISTINCT p_name AS key FROM part WHERE p_size > 30 UNION SELECT DISTINCT string_split(p_name, ' ')[1] FROM part UNION SELECT DISTINCT p_name || ' ' || p_type FROM part WHERE p_size > 45)
SELECT id, key FROM (SELECT id, key, row_number() OVER (PARTITION BY id ORDER BY len(string_split(key, ' ')) DESC, length(key) DESC) AS rn
  FROM texts LEFT JOIN keys ON text = key OR starts_with(text, key || ' ')) WHERE rn = 1""")
def longest_prefix_join(x):
    items = x.items()
    texts = items.select(F.col("item_id").alias("id"), F.concat_ws(" ", "name", "type", "brand").alias("text"))
    keys = T.union_tables([
        items.filter("size > 30").select(F.col("name").alias("key")), items.select(F.split("name", " ")[0].alias("key")),
        items.filter("size > 45").select(F.concat_ws(" ", "name", "type").alias("key"))], distinct=True)
    return S.longest_prefix(texts, keys).select("id", "key")


@query("longest_prefix_join_characters", """
WITH texts AS (SELECT p_partkey AS id, p_name || ' ' || p_type AS text FROM part),
keys AS (SELECT DISTINCT substr(p_name, 1, 3 + p_size % 4) AS key FROM part)
SELECT id, key FROM (SELECT id, key, row_number() OVER (PARTITION BY id ORDER BY len(string_split(key, ' ')) DESC, length(key) DESC) AS rn
  FROM texts LEFT JOIN keys ON starts_with(text, key)) WHERE rn = 1""")
def longest_prefix_join_characters(x):
    """Keys may end inside a word."""
    items = x.items()
    texts = items.select(F.col("item_id").alias("id"), F.concat_ws(" ", "name", "type").alias("text"))
    keys = items.select(F.substring("name", F.lit(1), F.col("size") % 4 + 3).alias("key")).distinct()
    return S.longest_prefix(texts, keys, characters=True).select("id", "key")


_TFIDF = f"""
tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[{WORD}][{WORD}]+') AS w FROM documents),
terms AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM tok),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM documents),
voc AS (SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term), n
        WHERE df >= n * 0.01 AND df <= n * 0.1 ORDER BY cf DESC, term LIMIT 1000),
w AS (SELECT doc_id, term, (ln(tf) + 1) * idf AS w FROM tf JOIN voc USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)"""


@query("tfidf_vectors", f"WITH {_TFIDF} SELECT doc_id, term, round_even(w / norm, 4) AS weight FROM w JOIN norm USING (doc_id)")
def tfidf_vectors(x):
    tokens = X.words(F.col("text"), r"[\p{L}\p{N}_][\p{L}\p{N}_]+")
    return Fe.tfidf(x.documents(), tokens).withColumn("weight", half_even("weight", 4))


# --- reviews -------------------------------------------------------------------------------------

REVIEWS = """reviews AS (SELECT CAST(substr(source, 4) AS BIGINT) AS item_id, doc_id AS user_id, CAST(doc_id * 7 % 91 + 10 AS INTEGER) AS rating_x10, text AS value FROM documents)"""


@query("quality_review_table", f"""WITH {REVIEWS}, c AS (SELECT item_id, user_id, rating_x10, {table_text('value')} AS value FROM reviews WHERE value IS NOT NULL)
SELECT * FROM c WHERE {tokens('value')} > 10""")
def quality_review_table(x):
    return V.quality_table(x.reviews())


@query("review_counters", f"""WITH {REVIEWS}, kept AS ({sql_of("quality_review_table")})
SELECT (SELECT count(*) FROM reviews) AS reviews_in, (SELECT count(*) FROM reviews WHERE value IS NULL) AS without_text,
  (SELECT count(*) FROM reviews) - count(*) AS removed, count(*) AS kept, sum(rating_x10) AS kept_x10 FROM kept""")
def review_counters(x):
    """Reviews that come in, that cleaning removes, and that are kept: counted by the one job that writes the table."""
    seen, reviews = writers.counted(x.reviews(), {"reviews_in": F.count(F.lit(1)), "without_text": F.count_if(F.col("value").isNull())})
    kept = writers.write_counted(V.quality_table(reviews), scratch_path(x.spark, "reviews"), {"kept": F.count(F.lit(1)), "kept_x10": F.sum("rating_x10")})
    counters = seen.get
    return writers.counter_row(x.spark, counters | {"removed": counters["reviews_in"] - kept["kept"]} | kept)


_PLAN = f"""{REVIEWS}, st AS (SELECT *, CAST(round_even(rating_x10 / 10.0, 0) AS INTEGER) AS stratum FROM reviews),
plan AS (SELECT item_id, stratum, total, wanted, CAST(round_even(n / total * wanted, 0) AS BIGINT) AS quota FROM (
  SELECT item_id, stratum, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY item_id) AS BIGINT) AS total,
         CAST(floor(sum(count(*)) OVER (PARTITION BY item_id) * 0.5) AS BIGINT) AS wanted FROM st GROUP BY 1, 2))"""


@query("stratified_plan", f"WITH {_PLAN} SELECT * FROM plan")
def stratified_plan(x):
    strata = x.reviews().withColumn("stratum", F.bround(F.col("rating_x10") / F.lit(10.0), 0).cast("int"))
    return V.sample_plan(strata, 0.5)


def _sampled(x):
    """Share .5 from 5 reviews on, not the defaults .1 and 250: items have 50 reviews at sf0.01, so by the defaults every item would keep all and no stratum be sampled."""
    return V.stratified_reviews(x.reviews(), share=0.5, minimum=5)


_CHOSEN = f"""{_PLAN}, q AS (SELECT *, {sample_text('value')} AS cleaned FROM st),
ok AS (SELECT item_id, stratum, user_id, rating_x10, cleaned, count(*) OVER (PARTITION BY item_id) AS quality_n,
  row_number() OVER (PARTITION BY item_id, stratum ORDER BY substr(md5(user_id || ':42'), 1, 10), user_id) AS rn FROM q WHERE {tokens('cleaned')} > 5),
chosen AS (SELECT item_id, user_id, stratum, printf('%.1f', rating_x10 / 10.0) || ' ' || cleaned AS combined_review
  FROM ok JOIN plan USING (item_id, stratum) WHERE wanted < 5 OR quality_n <= wanted OR rn <= quota)"""


@query("stratified_reviews", f"WITH {_CHOSEN} SELECT * FROM chosen")
def stratified_reviews(x):
    return _sampled(x)


@query("stratified_sample", f"""WITH {_PLAN}, q AS (SELECT item_id, stratum, user_id FROM st WHERE {tokens(sample_text('value'))} > 5),
left_ AS (SELECT item_id, count(*) AS quality_n FROM q GROUP BY 1), per AS (SELECT item_id, stratum, count(*) AS available FROM q GROUP BY 1, 2)
SELECT per.item_id, per.stratum, CASE WHEN wanted < 5 OR quality_n <= wanted THEN available ELSE least(available, quota) END AS sampled
FROM per JOIN left_ USING (item_id) JOIN plan USING (item_id, stratum)
WHERE CASE WHEN wanted < 5 OR quality_n <= wanted THEN available ELSE least(available, quota) END > 0""")
def stratified_sample(x):
    """Rows drawn per item and stratum; which rows is decided by a hash, how many is not."""
    return _sampled(x).groupBy("item_id", "stratum").agg(F.count(F.lit(1)).alias("sampled"))


@query("grouped_context", f"""WITH {_CHOSEN}, placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY substr(md5(user_id || ':42'), 1, 10), user_id) AS rn FROM chosen)
SELECT item_id, CAST(floor((rn - 1) / 10) AS BIGINT) AS part, string_agg(combined_review, chr(10) ORDER BY rn) AS review_text, CAST(count(*) AS INTEGER) AS reviews
FROM placed GROUP BY 1, 2""")
def grouped_context(x):
    return V.grouped_context(_sampled(x), 10)


TEMPLATE = ("Reviews of '{GAME_NAME_HERE}' with average_score {GAME_AVERAGE_HERE}; overall {OVERALL_MEAN}. Below {TWO_UNDER} strongly disliked, "
            "below {ONE_UNDER} disliked, above {HALF_OVER} very liked, above {ONE_OVER} loved. Do not say {GAME_NAME_HERE}.")


def _prompt_sql() -> str:
    e = "'" + TEMPLATE.replace("'", "''") + "'"
    for key, value in (("{GAME_NAME_HERE}", "s_name"), ("{GAME_AVERAGE_HERE}", "printf('%.2f', item_mean)"),
                       ("{TWO_UNDER}", "printf('%.2f', round_even(m - s * 2, 2))"), ("{ONE_UNDER}", "printf('%.2f', round_even(m - s, 2))"),
                       ("{ONE_OVER}", "printf('%.2f', round_even(m + s, 2))"), ("{HALF_OVER}", "printf('%.2f', round_even(m + s * 0.5, 2))"),
                       ("{OVERALL_MEAN}", "printf('%.2f', round_even(m, 2))")):
        e = f"replace({e}, '{key}', {value})"
    return e


@query("build_prompts", BASE + f"""
, o AS (SELECT avg(rating_x10 / 10.0) AS m, stddev_samp(rating_x10 / 10.0) AS s FROM ratings),
i AS (SELECT item_id, round_even(avg(rating_x10 / 10.0), 2) AS item_mean FROM ratings GROUP BY item_id)
SELECT item_id, {_prompt_sql()} AS prompt FROM i JOIN supplier ON s_suppkey = item_id, o""")
def build_prompts(x):
    ratings = x.ratings()
    names = x.table("supplier").select(F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("name"))
    items = R.item_bands(ratings).select("item_id", F.col("overall_mean").alias("item_mean")).join(names, "item_id")
    return V.build_prompts(TEMPLATE, items, R.overall_bands(ratings))


_REPLIES = """replies AS (SELECT doc_id, '### What is this game about?' || chr(10) || '**' || source || '** ' || text || chr(10) || chr(10) || '### Pros' || chr(10) || '- **fun**: ' || lang ||
  CASE WHEN doc_id % 5 > 0 THEN chr(10) || chr(10) || '### Cons' || chr(10) || '- long: ' || n_chars || chr(10) ELSE '' END AS reply FROM documents),
r AS (SELECT doc_id, replace(reply, '**', '') AS t FROM replies),
p AS (SELECT doc_id, string_split(t, chr(10) || chr(10) || '### Pros' || chr(10)) AS a, string_split(t, chr(10) || chr(10) || '### Cons' || chr(10)) AS b FROM r)"""


@query("parse_summaries", f"""WITH {_REPLIES}
SELECT doc_id, replace(a[1], '### What is this game about?' || chr(10), '') AS generated_description,
  {strip("replace(replace(string_split(a[2], chr(10) || chr(10) || '### Cons' || chr(10))[1], chr(10), ''), '-', '')")} AS generated_pros,
  {strip("replace(replace(b[2], chr(10), ''), '-', '')")} AS generated_cons FROM p""")
def parse_summaries(x):
    cons = F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("\n\n### Cons\n- long: "), F.col("n_chars").cast("string"), F.lit("\n"))).otherwise("")
    reply = F.concat(F.lit("### What is this game about?\n**"), "source", F.lit("** "), "text", F.lit("\n\n### Pros\n- **fun**: "), "lang", cons)
    parsed = V.parse_summary(F.col("reply"))
    return x.documents().withColumn("reply", reply).select("doc_id", *[c.alias(n) for n, c in parsed.items()])


@query("attach_generated_text", "SELECT s_suppkey AS item_id, s_name AS name, text AS generated FROM supplier LEFT JOIN benchmark ON CAST(s_suppkey AS VARCHAR) = CAST(item_id AS VARCHAR)")
def attach_generated_text(x):
    texts = x.table("benchmark").select(F.col("item_id").cast("string").alias("key"), F.col("text").alias("generated"))
    items = x.table("supplier").select(F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("name"))
    return T.attach(items.withColumn("key", F.col("item_id").cast("string")), texts, ["key"]).drop("key")


_STAMPS = """stamps AS (SELECT o_custkey AS item_id, strftime(max(o_orderdate), '%Y%m%d') AS date_updated FROM orders GROUP BY 1)"""
AS_OF = "2001-08-01"


def _stamps(x):
    return x.table("orders").groupBy(F.col("o_custkey").alias("item_id")).agg(F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("date_updated"))


@query("freshness_filter", f"WITH {_STAMPS} SELECT * FROM stamps WHERE date_diff('day', strptime(date_updated, '%Y%m%d'), TIMESTAMP '{AS_OF}') < 30")
def freshness_filter(x):
    return _stamps(x).filter(V.is_fresh(F.col("date_updated"), F.lit(AS_OF).cast("date")))


@query("summary_worklist", f"""WITH {_STAMPS} SELECT c_custkey AS item_id, block FROM
(SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1) / 166) AS BIGINT) AS block FROM customer)
WHERE c_custkey NOT IN (SELECT item_id FROM stamps WHERE date_diff('day', strptime(date_updated, '%Y%m%d'), TIMESTAMP '{AS_OF}') < 30)""")
def summary_worklist(x):
    from ..operators.frontier import rank_blocks

    ranked = rank_blocks(x.table("customer").select(F.col("c_custkey").alias("item_id"), "c_acctbal"), "c_acctbal")
    return V.worklist(ranked.select("item_id", "block"), _stamps(x), F.lit(AS_OF).cast("date"))


# --- objects ---------------------------------------------------------------------------------------

_UUID_SQL = """obj AS (SELECT doc_id, lang, source, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('{"source":"' || source || '","doc_id":' || doc_id || '}')) AS h FROM documents),
objects AS (SELECT doc_id, lang, source, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  substr('89ab', CAST(strpos('0123456789abcdef', substr(h, 17, 1)) - 1 AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM obj)"""


def _objects(x):
    return V.with_uuid(x.documents().select("doc_id", "lang", "source"), ["source", "doc_id"])


@query("object_uuid5", f"WITH {_UUID_SQL} SELECT * FROM objects")
def object_uuid5(x):
    return _objects(x)


@query("idempotent_upsert", f"WITH {_UUID_SQL} SELECT * FROM objects")
def idempotent_upsert(x):
    objects = _objects(x)
    return V.upsert(objects.filter("lang in ('en', 'de')"), objects.filter("lang <> 'en'"))


@query("delete_by_uuid", f"WITH {_UUID_SQL} SELECT * FROM objects WHERE lang <> 'en'")
def delete_by_uuid(x):
    objects = _objects(x)
    return V.delete(objects, objects.filter("lang = 'en'"))


_VOWELS = "aeiou"


def _vowel_counts():
    """Stands for a user's model: counts of five letters; raises on texts that have none of them."""

    def embed(texts):
        made = [[t.count(v) for v in _VOWELS] for t in texts]
        if not all(map(any, made)):
            raise ValueError("no letters")
        return made

    return embed


@query("model_map", f"""
WITH v AS (SELECT doc_id, text, {", ".join(f"length(text) - length(replace(text, '{c}', '')) AS {c}" for c in _VOWELS)} FROM documents)
SELECT doc_id, CASE WHEN a + e + i + o + u > 0 THEN concat_ws(',', a, e, i, o, u) END AS vec, CASE WHEN a + e + i + o + u = 0 THEN 'ValueError: no letters' END AS error FROM v""")
def model_map(x):
    """Every text through a user's function in batches; rows at fault are rejected one by one, not with their batch."""
    mapped = plugin.map_batches(x.documents().select("doc_id", "text"), "text", "vec", "array<int>", _vowel_counts, tries=1)
    return mapped.select("doc_id", F.when(F.col("vec").isNotNull(), F.array_join(F.col("vec").cast("array<string>"), ",")).alias("vec"), F.col(plugin.ERROR).alias("error"))
