"""Catalog: cleaning, routing, reshaping, frontiers, content features and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S, text
from ..functions.fixed_values import FEATURE_GROUP_WEIGHTS
from ..functions.scalars import half_even
from ..operators import conform as C, features as Fe, frontier, ordering, similarity, tables as T
from ..session import scratch_path
from ..sources import readers, writers
from .registry import query

# Rule lists over the words and types of the given tables.
DROP = ["old"]
MECHANICS = {"ring": "Ring Rolling", "rod": "Rod Drafting", "bolt": "Bolt Placement"}
THEMES = ["red", "blue", "hot"]
MAJORS = {"small": "Cat:Small", "large": "Cat:Large"}
BASE_URL = "https://catalog.example.org/xmlapi2"


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


WORDS = "words AS (SELECT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS value FROM part)"
EDITIONS = "editions AS (SELECT p_partkey AS item_id, p_name || ' ' || p_size AS value FROM part)"
FEATURES = """
features AS (
  SELECT p_partkey AS item_id, 'designers' AS grp, 'd:' || p_brand AS feature, 1.0::DOUBLE AS weight FROM part
  UNION SELECT p_partkey, 'categories', 'c:' || p_type, 1.0 FROM part
  UNION SELECT p_partkey, 'mechanics', 'm:' || unnest(string_split(p_name, ' ')), 0.75 FROM part
  UNION SELECT p_partkey, 'themes', 't:' || p_size, 0.5 FROM part)
"""


@query("drop_columns", "SELECT p_partkey AS item_id, p_name AS name, p_brand AS brand FROM part")
def drop_columns(x):
    return T.drop_columns(x.items(), ["type", "size", "price", "no_such_column"])


@query("row_filters", f"WITH {WORDS} SELECT item_id, value, size FROM words JOIN (SELECT p_partkey, p_size AS size FROM part) ON p_partkey = item_id "
       f"WHERE value <> '(Uncredited)' AND value NOT IN {_list(DROP)} AND 1980 + size <= 2024")
def row_filters(x):
    kept = C.drop_rows(x.words(), DROP)
    years = x.items().select("item_id", "size", (F.col("size") + 1980).alias("year"))
    return kept.join(C.released(years, 2024), "item_id").select("item_id", "value", "size")


_ROUTE = f"""CASE WHEN value IN {_list(DROP)} THEN 'drop' WHEN value IN {_list(MECHANICS)} THEN 'mechanic'
WHEN value IN {_list(THEMES)} THEN 'theme' WHEN value IN {_list(MAJORS)} THEN 'major' ELSE 'rest' END"""
_REMAP = "CASE " + " ".join(f"WHEN value = '{k}' THEN '{v}'" for k, v in MECHANICS.items()) + " ELSE value END"


@query("category_routing", f"WITH {WORDS} SELECT * FROM (SELECT item_id, {_REMAP} AS value, {_ROUTE} AS bucket FROM words) WHERE bucket <> 'drop'")
def category_routing(x):
    return C.route_categories(x.words(), DROP, MECHANICS, THEMES, MAJORS)


@query("value_remap", f"WITH {WORDS} SELECT item_id, {_REMAP} AS mechanic FROM words WHERE value IN {_list(MECHANICS)}")
def value_remap(x):
    kept = x.words().filter(F.col("value").isin(list(MECHANICS)))
    return kept.select("item_id", T.remap(F.col("value"), MECHANICS).alias("mechanic"))


@query("prefix_select", """
SELECT p_partkey AS item_id, p_size AS positive_size, p_retailprice AS positive_price FROM part""")
def prefix_select(x):
    wide = x.items().select("item_id", F.col("size").alias("positive_size"), F.col("price").alias("positive_price"),
                            F.col("brand").alias("negative_brand"))
    return T.prefix_columns(wide, ["item_id"], ("positive_",))


@query("name_contains", "SELECT p_partkey AS item_id, p_name AS name FROM part WHERE lower(p_name) LIKE '%ring%'")
def name_contains(x):
    return x.items().filter(F.contains(F.lower("name"), F.lower(F.lit("RING")))).select("item_id", "name")


@query("left_attach", """
SELECT p_partkey AS item_id, p_name AS name, coalesce(n, 0) AS n FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey""")
def left_attach(x):
    counts = x.table("lineitem").filter("l_returnflag = 'R' and l_quantity > 45").groupBy(F.col("l_partkey").alias("item_id")).agg(
        F.count(F.lit(1)).alias("n"))
    return T.attach(x.items().select("item_id", "name"), counts, ["item_id"], {"n": 0})


@query("semi_join_ids", "SELECT p_partkey AS item_id, p_name AS name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09)")
def semi_join_ids(x):
    ids = x.table("lineitem").filter("l_discount > 0.09").select(F.col("l_partkey").alias("item_id"))
    return T.matching(x.items().select("item_id", "name"), ids, ["item_id"])


@query("id_name_lookup", "SELECT l_orderkey, l_linenumber, l_partkey AS item_id, p_name AS name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey")
def id_name_lookup(x):
    lines = x.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item_id"))
    return T.attach(lines, x.items().select("item_id", "name"), ["item_id"])


@query("same_family_items", """
SELECT s_nationkey AS family, s_suppkey AS item_id, n - 1 AS others
FROM supplier JOIN (SELECT s_nationkey AS f, count(*) AS n FROM supplier GROUP BY 1) ON f = s_nationkey WHERE n > 1""")
def same_family_items(x):
    items = x.table("supplier").select(F.col("s_suppkey").alias("item_id"), F.col("s_nationkey").alias("family"))
    return T.group_members(items, "item_id", "family")


# --- rare values, counts, pivots -------------------------------------------------------

@query("rare_value_prune", f"WITH {EDITIONS} SELECT * FROM editions WHERE value IN (SELECT value FROM editions GROUP BY value HAVING count(*) > 2)")
def rare_value_prune(x):
    return C.prune_rare(x.editions(), 2)


@query("low_entry_flag", f"""WITH {EDITIONS}, n AS (SELECT value, count(*) AS n FROM editions GROUP BY value)
SELECT item_id, max(CASE WHEN n <= 2 THEN 1 ELSE 0 END) AS low_entry FROM editions JOIN n USING (value) GROUP BY item_id""")
def low_entry_flag(x):
    return C.low_entry_flag(x.editions(), 2)


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("crosstab_counts", "SELECT p_brand AS brand, " + ", ".join(f"count(*) FILTER (p_type = '{t}') AS \"{t}\"" for t in _TYPES) + " FROM part GROUP BY p_brand")
def crosstab_counts(x):
    return T.one_hot(x.items(), "brand", "type", _TYPES, counts=True)


@query("one_hot_pivot", "SELECT p_name AS name, " + ", ".join(
    f"CAST(count(*) FILTER (p_type = '{t}') > 0 AS INTEGER) AS \"{t}\"" for t in _TYPES) + " FROM part GROUP BY p_name")
def one_hot_pivot(x):
    return T.one_hot(x.items(), "name", "type", _TYPES)


@query("unpivot_long", """
SELECT p_partkey AS item_id, 'size' AS attribute, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size IS NOT NULL
UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part WHERE p_retailprice > 950""")
def unpivot_long(x):
    wide = x.items().select("item_id", F.col("size").cast("double").alias("size"), F.when(F.col("price") > 950, F.col("price")).alias("price"))
    return T.unpivot_long(wide, ["item_id"], ["size", "price"], "attribute", "value")


_MECH = """
mech AS (SELECT p_partkey AS item_id, CASE p_size % 6 WHEN 0 THEN 'Turn Order: Auction' WHEN 1 THEN 'Turn Order: ' || noun
  WHEN 2 THEN 'Card Drafting' WHEN 3 THEN 'Worker ' || noun WHEN 4 THEN noun ELSE 'Tableau ' || noun || ' Legacy' END AS value
  FROM (SELECT *, string_split(p_name, ' ')[2] AS noun FROM part))"""


@query("mechanic_compaction", f"""WITH {_MECH}, merged AS (
  SELECT item_id, 'Auction or Bidding' AS value FROM mech WHERE lower(value) LIKE '%auction%'
  UNION ALL SELECT item_id, 'Drafting' FROM mech WHERE lower(value) LIKE '%drafting%'
  UNION ALL SELECT item_id, 'Worker Placement' FROM mech WHERE lower(value) LIKE '%worker%'
  UNION ALL SELECT item_id, 'Tableau Building' FROM mech WHERE lower(value) LIKE '%tableau%'
  UNION ALL SELECT item_id, 'Legacy Game' FROM mech WHERE lower(value) LIKE '%legacy%'
  UNION ALL SELECT item_id, value FROM mech WHERE NOT regexp_matches(lower(value), 'auction|drafting|worker|tableau|legacy'))
SELECT DISTINCT item_id, value FROM merged WHERE lower(value) NOT LIKE '%turn order%'""")
def mechanic_compaction(x):
    return C.compact_mechanics(x.mechanics())


@query("category_flags", f"""WITH {WORDS}
SELECT p_partkey AS item_id, greatest(CAST(p_size > 45 AS INTEGER), coalesce(s, 0)) AS "Cat:Small", coalesce(l, 0) AS "Cat:Large"
FROM part LEFT JOIN (SELECT item_id, max(CAST(value = 'small' AS INTEGER)) AS s, max(CAST(value = 'large' AS INTEGER)) AS l
  FROM words WHERE value IN ('small', 'large') GROUP BY item_id) ON item_id = p_partkey""")
def category_flags(x):
    items = x.items().select("item_id", (F.col("size") > 45).cast("int").alias("Cat:Small"))
    return C.category_flags(items, x.words(), MAJORS)


_RANKS = """ranks AS (SELECT p_partkey AS item_id, CASE WHEN p_size % 3 = 0 THEN 'Not Ranked' WHEN p_size % 5 > 0 THEN 'no. ' || p_size END AS r FROM part)"""


def _ranks(x):
    size = F.col("size")
    rank = F.when(size % 3 == 0, F.lit("Not Ranked")).when(size % 5 > 0, F.concat(F.lit("no. "), size.cast("string")))
    return x.items().select("item_id", rank.alias("Rank:wargames"))


@query("not_null_flag", f"""WITH {_RANKS} SELECT item_id, CASE WHEN regexp_replace(r, '[^0-9]', '', 'g') <> '' THEN 1 ELSE 0 END AS "Cat:War" FROM ranks""")
def not_null_flag(x):
    return C.rank_flags(_ranks(x), {"Rank:wargames": "Cat:War"}).select("item_id", "Cat:War")


@query("integer_reduce", f"""WITH {_RANKS} SELECT item_id, CAST(coalesce(TRY_CAST(regexp_replace(r, '[^0-9]', '', 'g') AS INTEGER),
(SELECT count(*) + 1 FROM part)) AS INTEGER) AS "Rank:wargames" FROM ranks""")
def integer_reduce(x):
    return C.fill_ranks(_ranks(x), ["Rank:wargames"])


@query("clean_best_players", f"""WITH {_RANKS} SELECT item_id, CAST(coalesce(TRY_CAST(regexp_replace(r, '[^0-9]', '', 'g') AS INTEGER), 0) AS INTEGER) AS best_players,
CASE WHEN p_size % 5 = 0 THEN 2 ELSE p_size % 5 END AS min_players FROM ranks JOIN part ON p_partkey = item_id""")
def clean_best_players(x):
    cleaned = _ranks(x).select("item_id", S.integer_reduce(F.col("`Rank:wargames`")).alias("best_players"))
    players = x.items().select("item_id", C.min_players(F.col("size") % 5).alias("min_players"))
    return cleaned.join(players, "item_id")


@query("sanitise_columns", "SELECT p_partkey AS item_id, p_size AS rank_wargames, p_name AS the_name FROM part")
def sanitise_columns(x):
    return T.sanitise_columns(x.items().select("item_id", F.col("size").alias("Rank:wargames"), F.col("name").alias("The Name")))


@query("name_key", "SELECT p_partkey AS item_id, lower(regexp_replace(p_brand || ' - ' || p_name, '[^A-Za-z0-9\\s]+', '', 'g')) AS name_key FROM part")
def name_key(x):
    return x.items().select("item_id", text.name_key(F.concat_ws(" - ", "brand", "name")).alias("name_key"))


@query("fix_numbers", "SELECT p_partkey AS item_id, CASE WHEN p_size % 2 = 0 THEN p_size * 1000.0::DOUBLE ELSE p_size + 0.5::DOUBLE END AS number FROM part")
def fix_numbers(x):
    size = F.col("size").cast("string")
    written = F.when(F.col("size") % 2 == 0, F.concat(size, F.lit("k"))).otherwise(F.concat(size, F.lit(".5")))
    return x.items().select("item_id", S.magnitude(written).alias("number"))


# --- sets and stages ---------------------------------------------------------------------

@query("union_bridges", f"WITH {WORDS} SELECT item_id, value FROM words UNION SELECT p_partkey, lower(p_type) FROM part")
def union_bridges(x):
    return T.union_tables([x.words(), x.items().select("item_id", F.lower("type").alias("value"))], distinct=True)


@query("union_blocks", "SELECT DISTINCT l_partkey AS item_id, l_quantity AS value FROM lineitem")
def union_blocks(x):
    """Rating blocks written as separate folders, read back as one table without duplicates."""
    path = scratch_path(x.spark, "blocks")
    lines = x.table("lineitem").select(F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("value"), "l_returnflag")
    lines.write.partitionBy("l_returnflag").parquet(path)
    return x.spark.read.parquet(path).select("item_id", "value").distinct()


@query("stage_counters", """
SELECT p_brand AS brand, count(*) AS rows_in, count(*) FILTER (p_size > 10) AS sized, count(*) FILTER (p_size > 10 AND p_retailprice > 1000) AS priced
FROM part GROUP BY p_brand""")
def stage_counters(x):
    sized = F.col("size") > 10
    return T.stage_counts(x.items(), "brand", {"sized": sized, "priced": sized & (F.col("price") > 1000)})


@query("epsilon_fill", """
SELECT p_partkey AS item_id, CASE WHEN coalesce(n, 0) = 0 THEN 0.01 ELSE CAST(n AS DOUBLE) END AS weight FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey""")
def epsilon_fill(x):
    filled = left_attach(x)
    return filled.select("item_id", F.when(F.col("n") == 0, F.lit(0.01)).otherwise(F.col("n").cast("double")).alias("weight"))


# --- ranks and frontiers -------------------------------------------------------------------

@query("rank_fallback", """
SELECT p_partkey AS item_id, coalesce(CASE WHEN p_size % 4 > 0 THEN p_size END, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1) AS rank_value FROM part""")
def rank_fallback(x):
    items = x.items().select("item_id", "price", F.when(F.col("size") % 4 > 0, F.col("size")).alias("given"))
    ranked = ordering.global_rank(items, "price", "item_id")
    return ranked.select("item_id", F.coalesce(F.col("given").cast("long"), F.col("rank") - 1).alias("rank_value"))


@query("rank_blocks", """
SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank,
       CAST(floor((row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1) / 166) AS BIGINT) AS block FROM part""")
def rank_blocks(x):
    return frontier.rank_blocks(x.items().select("item_id", "price"), "price").select("item_id", "rank", "block")


_CHUNKS = """chunks AS (SELECT CAST(floor((rn - 1) / 20) AS BIGINT) AS chunk, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS ids
FROM (SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_partkey) AS rn FROM part) GROUP BY 1)"""


@query("id_chunks", f"WITH {_CHUNKS} SELECT * FROM chunks")
def id_chunks(x):
    return frontier.id_chunks(x.items())


@query("user_groups", "SELECT c_custkey AS user_id, CAST(ntile(29) OVER (ORDER BY c_custkey) AS INTEGER) AS grp FROM customer")
def user_groups(x):
    return frontier.user_groups(x.table("customer").select(F.col("c_custkey").alias("user_id")))


@query("rating_pages", "SELECT l_suppkey AS item_id, count(*) AS n, CAST(ceil(count(*) / 100) AS INTEGER) AS pages FROM lineitem GROUP BY 1")
def rating_pages(x):
    counts = x.table("lineitem").groupBy(F.col("l_suppkey").alias("item_id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pages", S.pages_for(F.col("n")))


@query("page_packing", """
WITH RECURSIVE p AS (SELECT l_suppkey AS item_id, CAST(ceil(count(*) / 100) AS INTEGER) AS pages FROM lineitem GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY pages DESC, item_id) AS rn FROM p),
t AS (SELECT CAST(ceil(sum(pages) / 29) AS BIGINT) AS target FROM p),
f AS (SELECT rn, item_id, pages, CAST(pages AS BIGINT) AS fill, CAST(1 AS BIGINT) AS grp FROM o WHERE rn = 1
  UNION ALL SELECT o.rn, o.item_id, o.pages, CASE WHEN f.fill >= target THEN o.pages ELSE f.fill + o.pages END,
    CASE WHEN f.fill >= target THEN f.grp + 1 ELSE f.grp END FROM f JOIN o ON o.rn = f.rn + 1, t)
SELECT item_id, pages, grp FROM f""")
def page_packing(x):
    return frontier.pack_pages(rating_pages(x).select("item_id", "pages"))


@query("frontier_urls", f"""
WITH {_CHUNKS}, p AS (SELECT l_suppkey AS item_id, CAST(ceil(count(*) / 100) AS INTEGER) AS pages FROM lineitem GROUP BY 1)
SELECT 'batch' AS kind, '{BASE_URL}/thing?id=' || ids || '&stats=1' AS url FROM chunks
UNION ALL SELECT 'ratings', '{BASE_URL}/thing?id=' || item_id || '&ratingcomments=1&page=' || page || '&pagesize=100'
  FROM (SELECT item_id, unnest(range(1, pages + 1)) AS page FROM p)
UNION ALL SELECT 'user', '{BASE_URL}/collection?username=' || c_custkey || '&rated=1&stats=1' FROM customer""")
def frontier_urls(x):
    users = x.table("customer").select(F.col("c_custkey").alias("user_id"))
    return T.union_tables([
        frontier.batch_urls(frontier.id_chunks(x.items()), BASE_URL).select(F.lit("batch").alias("kind"), "url"),
        frontier.page_urls(rating_pages(x), BASE_URL).select(F.lit("ratings").alias("kind"), "url"),
        frontier.user_urls(users, BASE_URL).select(F.lit("user").alias("kind"), "url"),
    ])


@query("url_param", "SELECT c_custkey AS user_id, CAST(c_custkey AS VARCHAR) AS username FROM customer")
def url_param(x):
    urls = frontier.user_urls(x.table("customer").select(F.col("c_custkey").alias("user_id")), BASE_URL)
    return urls.select("user_id", frontier.url_username(F.col("url")).alias("username"))


@query("confidence_cut", """
SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS rank FROM events)
WHERE rank > 10 AND rank <= 30""")
def confidence_cut(x):
    """Positions 11 to 30 of each user's rows in order of confidence."""
    best = ordering.top_per_group(x.table("events").select("user_id", "event_id", "value"), ["user_id"],
                                  [F.col("value").desc_nulls_last(), F.col("event_id")], 30)
    return best.filter("rank > 10").select("user_id", "event_id", F.col("rank").cast("long").alias("rank"))


# --- features --------------------------------------------------------------------------------

_FLOORED = FEATURES + """,
kept AS (SELECT grp, feature FROM features GROUP BY grp, feature HAVING count(DISTINCT item_id) >= round_even((SELECT count(*) FROM part) * 0.02, 0))"""


def _floored(x):
    count = x.items().agg(F.count(F.lit(1)).alias("n")).scalar()
    return Fe.feature_floor(x.features(), count, 0.02)


@query("feature_floor", f"WITH {_FLOORED} SELECT DISTINCT item_id, f.grp, f.feature FROM features f JOIN kept k ON f.grp = k.grp AND f.feature = k.feature")
def feature_floor(x):
    return _floored(x).select("item_id", "grp", "feature").distinct()


@query("weighted_features", f"WITH {_FLOORED} SELECT item_id, f.grp, f.feature, weight FROM features f JOIN kept k ON f.grp = k.grp AND f.feature = k.feature")
def weighted_features(x):
    return Fe.weight_features(_floored(x), FEATURE_GROUP_WEIGHTS).select("item_id", "grp", "feature", "weight")


_SCALED = """scaled AS (SELECT p_partkey AS item_id,
  (CAST(p_size AS DOUBLE) - (SELECT min(p_size) FROM part)) / (SELECT max(p_size) - min(p_size) FROM part) * 2.0 + -1.0 AS size,
  (p_retailprice - (SELECT min(p_retailprice) FROM part)) / (SELECT max(p_retailprice) - min(p_retailprice) FROM part) * 1.0 + -0.5 AS price FROM part)"""
_RANGES = {"size": (-1.0, 1.0), "price": (-0.5, 0.5)}


@query("min_max_scale", f"WITH {_SCALED} SELECT item_id, round_even(size, 4) AS size, round_even(price, 4) AS price FROM scaled")
def min_max_scale(x):
    scaled = S.scale_columns(x.items().select("item_id", "size", "price"), _RANGES)
    return scaled.select("item_id", half_even("size", 4).alias("size"), half_even("price", 4).alias("price"))


_NUMERIC = f"""{_SCALED}, numeric_features AS (SELECT item_id, 'size' AS feature, size AS weight FROM scaled UNION ALL SELECT item_id, 'price', price FROM scaled)"""


def numeric_block(x):
    return Fe.numeric_features(x.items(), _RANGES)


NUMERIC_SQL, FLOORED_SQL = _NUMERIC, _FLOORED
floored_features = _floored


@query("numeric_features", f"WITH {_NUMERIC} SELECT item_id, 'numeric' AS grp, feature, round_even(weight, 4) AS weight FROM numeric_features")
def numeric_features(x):
    return Fe.numeric_features(x.items(), _RANGES).withColumn("weight", half_even("weight", 4))


@query("feature_assemble", f"""WITH {FEATURES}, {_NUMERIC}
SELECT item_id, count(*) AS features, round_even(sum(weight * weight), 4) AS sq FROM
(SELECT item_id, weight FROM features UNION ALL SELECT item_id, weight FROM numeric_features) GROUP BY item_id""")
def feature_assemble(x):
    """Every block of features in one long table, keyed by item."""
    weighted = Fe.weight_features(x.features(), FEATURE_GROUP_WEIGHTS).select("item_id", "grp", "feature", "weight")
    both = T.union_tables([weighted, Fe.numeric_features(x.items(), _RANGES)])
    return both.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("features"), half_even(F.sum(F.col("weight") * F.col("weight")), 4).alias("sq"))


@query("content_cosine", f"""WITH {FEATURES},
vec AS (SELECT item_id, list((feature, weight) ORDER BY feature) AS v, sum(weight * weight) AS sq FROM features GROUP BY item_id),
prof AS (SELECT min(item_id) AS profile, count(*) AS held, v, min(sq) AS sq FROM vec GROUP BY v),
pf AS (SELECT profile, feature, weight FROM prof JOIN features ON item_id = profile),
dots AS (SELECT p.profile AS a, q.profile AS b, sum(p.weight * q.weight) AS dot FROM pf p JOIN pf q ON p.feature = q.feature AND p.profile < q.profile GROUP BY 1, 2),
sims AS (SELECT a, b, pa.held AS held_a, pb.held AS held_b, round_even(dot / sqrt(pa.sq * pb.sq), 2) AS sim
  FROM dots JOIN prof pa ON pa.profile = a JOIN prof pb ON pb.profile = b)
SELECT * FROM sims WHERE sim >= 0.7 AND sim < 1.0""")
def content_cosine(x):
    weighted = Fe.weight_features(x.features(), FEATURE_GROUP_WEIGHTS).select("item_id", "feature", "weight")
    return similarity.profile_cosine(weighted, 0.7)


@query("group_cosine_distance", f"""WITH {FEATURES},
vec AS (SELECT grp, item_id, list((feature, weight) ORDER BY feature) AS v, sum(weight * weight) AS sq FROM features GROUP BY grp, item_id),
prof AS (SELECT grp, min(item_id) AS profile, count(*) AS held, v, min(sq) AS sq FROM vec GROUP BY grp, v),
pf AS (SELECT p.grp, profile, feature, weight FROM prof p JOIN features f ON item_id = profile AND f.grp = p.grp),
dots AS (SELECT p.grp, p.profile AS a, q.profile AS b, sum(p.weight * q.weight) AS dot FROM pf p JOIN pf q ON p.grp = q.grp AND p.feature = q.feature AND p.profile < q.profile GROUP BY 1, 2, 3)
SELECT d.grp, a, b, pa.held AS held_a, pb.held AS held_b, round_even(1 - dot / sqrt(pa.sq * pb.sq), 3) AS distance
FROM dots d JOIN prof pa ON pa.profile = a AND pa.grp = d.grp JOIN prof pb ON pb.profile = b AND pb.grp = d.grp""")
def group_cosine_distance(x):
    return similarity.group_distances(Fe.weight_features(x.features(), FEATURE_GROUP_WEIGHTS))


@query("abs_diff_pairs", """
WITH v AS (SELECT CAST(p_size AS DOUBLE) / 10 AS x, count(*) AS held FROM part GROUP BY 1)
SELECT a.x AS x_a, b.x AS x_b, a.held AS held_a, b.held AS held_b, round_even(abs(a.x - b.x), 4) AS difference
FROM v a JOIN v b ON a.x < b.x WHERE round_even(abs(a.x - b.x), 4) <= 0.75""")
def abs_diff_pairs(x):
    return similarity.abs_diff_pairs(x.items().withColumn("w", F.col("size") / 10), "w", 0.75)


# --- files --------------------------------------------------------------------------------------

PART_SCHEMA = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"


@query("tsv_scan", "SELECT * FROM part")
def tsv_scan(x):
    """A tab-separated export with one broken line per file, read back without the broken lines."""
    path = scratch_path(x.spark, "tsv") + ".tsv"
    writers.write(x.table("part"), path)
    broken = x.table("region").select(F.lit("not a number\tx").alias("value"))
    broken.write.mode("append").text(path)
    return readers.read(x.spark, path, PART_SCHEMA)


@query("csv_to_tsv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_to_tsv(x):
    source, target = scratch_path(x.spark, "csv") + ".csv", scratch_path(x.spark, "tsv") + ".tsv"
    writers.write(x.table("part"), source)
    writers.csv_to_tsv(x.spark, source, target)
    return readers.read(x.spark, target, PART_SCHEMA)


@query("jsonl_scan", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def jsonl_scan(x):
    path = scratch_path(x.spark, "events") + ".jsonl"
    writers.write(x.table("events").select("event_id", "event_type", "props"), path)
    rows = readers.read(x.spark, path, "event_id BIGINT, event_type STRING, props STRING")
    return rows.select("event_id", "event_type", F.from_json("props", "k INT")["k"].alias("k"))


@query("table_roundtrip", "SELECT * FROM supplier")
def table_roundtrip(x):
    path = scratch_path(x.spark, "supplier") + ".parquet"
    writers.write(x.table("supplier"), path)
    return readers.read(x.spark, path)


@query("catalog_sink", "SELECT p_partkey AS item_id, p_name AS the_name, p_size AS rank_overall FROM part")
def catalog_sink(x):
    frame = x.items().select("item_id", F.col("name").alias("The Name"), F.col("size").alias("Rank:overall"))
    path = scratch_path(x.spark, "catalog")
    return writers.save_table(frame, "lodestar_items_" + path[-12:], path)


@query("json_matches", "SELECT event_id, '{\"user\":' || user_id || ',\"kind\":\"' || event_type || '\"}' AS doc, user_id AS parsed FROM events")
def json_matches(x):
    doc = F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")))
    rows = x.table("events").select("event_id", doc.alias("doc"))
    return rows.withColumn("parsed", F.from_json("doc", "user BIGINT, kind STRING")["user"])
