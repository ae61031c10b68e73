"""Ratings: dedup, activity, statistics, centring, key-value rows, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import cap, half_even
from ..operators import models, ordering, quantiles, ratings as R, sketches, tables as T
from ..sources import kv_table, writers
from .registry import query, sql_of
from .shared_sql import BASE

STAMP = "20240101"


@query("distinct_rows", """
SELECT DISTINCT o_custkey AS user_id, l_suppkey AS item_id, CAST(l_quantity * 2 AS INTEGER) AS rating_x10
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def distinct_rows(x):
    return x.raw_ratings().select("user_id", "item_id", "rating_x10").distinct()


@query("dedup_keep_first", BASE + "SELECT * FROM ratings")
def dedup_keep_first(x):
    return x.first_ratings()


@query("active_users", BASE + """
SELECT * FROM ratings WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= 30)""")
def active_users(x):
    return R.active_users(x.ratings(), 30)


@query("unique_user_ids", "SELECT DISTINCT o_custkey AS user_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def unique_user_ids(x):
    return x.raw_ratings().select("user_id").distinct().orderBy("user_id")


@query("clean_rating_block", BASE + """
, known AS (SELECT * FROM ratings WHERE item_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))
SELECT * FROM known WHERE user_id IN (SELECT user_id FROM known GROUP BY user_id HAVING count(*) >= 5)""")
def clean_rating_block(x):
    known = x.table("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("item_id"))
    return R.clean_block(x.ratings(), known)


_BANDS = """round_even(m, 2) AS overall_mean, round_even(s, 2) AS overall_std, round_even(m - s * 2, 2) AS two_under,
round_even(m - s, 2) AS one_under, round_even(m + s * 0.5, 2) AS half_over, round_even(m + s, 2) AS one_over"""


@query("global_rating_bands", BASE + f"""
SELECT {_BANDS} FROM (SELECT avg(rating_x10 / 10.0) AS m, stddev_samp(rating_x10 / 10.0) AS s FROM ratings)""")
def global_rating_bands(x):
    return R.overall_bands(x.ratings())


@query("item_rating_bands", BASE + f"""
SELECT item_id, {_BANDS}
FROM (SELECT item_id, avg(rating_x10 / 10.0) AS m, stddev_samp(rating_x10 / 10.0) AS s FROM ratings GROUP BY item_id)""")
def item_rating_bands(x):
    items = x.table("supplier").select(F.col("s_suppkey").alias("item_id"))
    return R.item_bands(x.ratings(), items)


@query("kv_stats_rows", BASE + f"""
, b AS (SELECT CAST(item_id AS VARCHAR) AS game_id, avg(rating_x10 / 10.0) AS m, stddev_samp(rating_x10 / 10.0) AS s
        FROM ratings GROUP BY item_id
        UNION ALL SELECT 'all_stats', avg(rating_x10 / 10.0), stddev_samp(rating_x10 / 10.0) FROM ratings),
v AS (SELECT game_id, {_BANDS} FROM b)
SELECT game_id, printf('%.2f', overall_mean) AS overall_mean, printf('%.2f', overall_std) AS overall_std,
       printf('%.2f', two_under) AS two_under, printf('%.2f', one_under) AS one_under,
       printf('%.2f', half_over) AS half_over, printf('%.2f', one_over) AS one_over, '{STAMP}' AS updated_at FROM v""")
def kv_stats_rows(x):
    return R.stats_rows(x.ratings(), STAMP)


@query("kv_rating_rows", BASE + f"""
SELECT CAST(item_id AS VARCHAR) AS game_id, CAST(user_id AS VARCHAR) AS username,
       printf('%.1f', rating_x10 / 10.0) AS rating, CAST(NULL AS VARCHAR) AS value, '{STAMP}' AS updated_at FROM ratings""")
def kv_rating_rows(x):
    return R.rating_rows(x.ratings().withColumn("value", F.lit(None).cast("string")), STAMP)


_KV = "game_id string, username string, rating string, value string, updated_at string"


def _kv_table(x) -> str:
    """Rating rows put by three jobs: older values, the newest ones, and the newest once more under the same name."""

    def write(path):
        rows = R.rating_rows(x.ratings().withColumn("value", F.lit(None).cast("string")), STAMP)
        kv_table.put(rows.withColumns({"rating": F.lit("0.0"), "updated_at": F.lit("20230101")}), path, "older", key=["game_id"])
        for _ in range(2):
            kv_table.put(rows, path, "newest", key=["game_id"])

    return x.written("kv-table", write)


@query("kv_table_rows", sql_of("kv_rating_rows"))
def kv_table_rows(x):
    """What is read back of a key-value table after rows were put over older ones, some jobs twice."""
    return kv_table.newest(x.spark, _kv_table(x), _KV, ["game_id", "username"]).select("game_id", "username", "rating", "value", "updated_at")


@query("kv_table_lookup", BASE + """
SELECT CAST(item_id AS VARCHAR) AS game_id, CAST(user_id AS VARCHAR) AS username, printf('%.1f', rating_x10 / 10.0) AS rating
FROM ratings WHERE item_id IN (SELECT s_suppkey FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 3)""")
def kv_table_lookup(x):
    """All rows of three keys, from a table clustered by key: the filter reaches the scan, which skips row groups."""
    keys = x.table("supplier").orderBy("s_acctbal", "s_suppkey").limit(3).select(F.col("s_suppkey").cast("string").alias("k"))
    wanted = [r.k for r in keys.collect()]
    found = kv_table.newest(x.spark, _kv_table(x), _KV, ["game_id", "username"])
    return found.where(F.col("game_id").isin(wanted)).select("game_id", "username", "rating")


@query("kv_lookup_join", BASE + """
SELECT CAST(item_id AS VARCHAR) AS game_id, CAST(user_id AS VARCHAR) AS username
FROM ratings WHERE item_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""")
def kv_lookup_join(x):
    rows = x.ratings().select(
        F.col("item_id").cast("string").alias("game_id"), F.col("user_id").cast("string").alias("username"))
    wanted = x.table("supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").cast("string").alias("game_id"))
    return T.matching(rows, wanted, ["game_id"])


@query("user_item_means", BASE + """
SELECT 'user' AS side, user_id AS id, n, round_even(mean_rating, 4) AS mean_rating FROM user_means
UNION ALL SELECT 'item', item_id, n, round_even(mean_rating, 4) FROM item_means""")
def user_item_means(x):
    ratings = x.ratings()
    sides = [
        R.means(ratings, f"{side}_id").select(
            F.lit(side).alias("side"), F.col(f"{side}_id").alias("id"), "n", half_even("mean_rating", 4).alias("mean_rating"))
        for side in ("user", "item")
    ]
    return T.union_tables(sides)


@query("rating_summary", BASE + """
SELECT count(*) AS n, min(rating_x10) AS lowest, max(rating_x10) AS highest,
       quantile_cont(CAST(rating_x10 AS DOUBLE), 0.25) AS q1, median(rating_x10) AS q2,
       quantile_cont(CAST(rating_x10 AS DOUBLE), 0.75) AS q3 FROM ratings""")
def rating_summary(x):
    return x.ratings().agg(
        F.count(F.lit(1)).alias("n"), F.min("rating_x10").alias("lowest"), F.max("rating_x10").alias("highest"),
        F.percentile("rating_x10", F.lit(0.25)).alias("q1"), F.percentile("rating_x10", F.lit(0.5)).alias("q2"),
        F.percentile("rating_x10", F.lit(0.75)).alias("q3"))


@query("activity_histogram", BASE + """
SELECT CAST(floor(n / 5) * 5 AS BIGINT) AS bucket, count(*) AS users,
       (SELECT median(n) FROM user_means) AS median_ratings,
       (SELECT round_even(count(*) FILTER (n <= 30) / count(*), 4) FROM user_means) AS share_under_cut
FROM user_means GROUP BY 1""")
def activity_histogram(x):
    return R.activity_histogram(x.ratings(), 5, 30)


@query("rating_distribution", BASE + """
SELECT item_id, rating_x10, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY item_id) AS BIGINT) AS total
FROM ratings GROUP BY item_id, rating_x10""")
def rating_distribution(x):
    return R.distribution(x.ratings())


@query("distinct_counts", """
SELECT count(DISTINCT l_suppkey) AS items, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_quantity) AS levels,
       (SELECT count(DISTINCT string_split(p_name, ' ')[1]) FROM part) AS first_words FROM lineitem""")
def distinct_counts(x):
    first = x.table("part").agg(F.count_distinct(F.split("p_name", " ")[0]).alias("w")).scalar()
    return x.table("lineitem").agg(
        F.count_distinct("l_suppkey").alias("items"), F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_quantity").alias("levels"),
    ).withColumn("first_words", first)


@query("center_ratings", BASE + """
SELECT user_id, cx.item_id, cx.c AS item_c, cu.c AS user_c FROM cx JOIN cu USING (user_id, item_id)""")
def center_ratings(x):
    ratings = x.ratings()
    a = R.center(ratings, "item_id").withColumnRenamed("c", "item_c")
    return a.join(R.center(ratings, "user_id", 100).withColumnRenamed("c", "user_c"), ["user_id", "item_id"])


@query("long_ratings", """
SELECT user_id, event_type AS item, round_even(CAST(sum(round_even(value * 100, 0)) AS DOUBLE) / count(*), 0) / 100 AS rating FROM events
WHERE value IS NOT NULL GROUP BY user_id, event_type""")
def long_ratings(x):
    """Per-user maps of item to rating, exploded back to long rows.

    The map of a user has one entry per event type, a small fixed domain.
    """
    per = x.table("events").groupBy("user_id", "event_type").agg(
        (F.rint(F.sum(F.rint(F.col("value") * 100)) / F.count(F.lit(1))) / 100).alias("r"))
    maps = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "r"))).alias("m"))
    return maps.select("user_id", F.explode("m").alias("item", "rating")).filter("rating is not null")


@query("ratings_date_join", BASE + """
, dated AS (SELECT o_custkey AS user_id, l_suppkey AS item_id, strftime(max(o_orderdate), '%Y-%m-%d') AS lastmodified
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT user_id, item_id, rating_x10, lastmodified FROM ratings JOIN dated USING (user_id, item_id)""")
def ratings_date_join(x):
    dated = x.raw_ratings().filter("o_orderstatus = 'F'").groupBy("user_id", "item_id").agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("lastmodified"))
    return R.with_dates(x.ratings(), dated)


@query("iqr_filter", BASE + """
, q AS (SELECT quantile_cont(CAST(n AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(n AS DOUBLE), 0.75) AS q3 FROM user_means)
SELECT user_id, n FROM user_means, q WHERE n >= q1 - (q3 - q1) * 0.75 AND n <= q3 + (q3 - q1) * 0.75""")
def iqr_filter(x):
    counts = x.ratings().groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return R.iqr_filter(counts, "n", 0.75)


_PRICES = "l_extendedprice AS price, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge"


def _prices(x):
    return x.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"))


@query("wide_quantiles", " UNION ALL ".join(f"""
SELECT '{c}' AS name, CAST({p} AS DOUBLE) AS probability, round_even(quantile_cont({c}, {p}), 4) AS quantile FROM (SELECT {_PRICES} FROM lineitem)""" for c in ("price", "charge") for p in (0.05, 0.25, 0.5, 0.75, 0.95)))
def wide_quantiles(x):
    """Exact quantiles of columns in which hardly a value comes twice, from ranges of at most 1,000 values."""
    probabilities = [0.05, 0.25, 0.5, 0.75, 0.95]
    found = quantiles.exact_quantiles(_prices(x), ["price", "charge"], probabilities, few=1_000)
    rows = [(name, p, q) for name, values in found.items() for p, q in zip(probabilities, values)]
    return x.spark.createDataFrame(rows, "name string, probability double, quantile double").withColumn("quantile", half_even(F.col("quantile"), 4))


@query("iqr_filter_wide", f"""
WITH v AS (SELECT l_orderkey, l_linenumber, {_PRICES} FROM lineitem), q AS (SELECT quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3, quantile_cont(charge, 0.25) AS c1, quantile_cont(charge, 0.75) AS c3 FROM v)
SELECT l_orderkey, l_linenumber, price FROM v, q WHERE price >= p1 - (p3 - p1) * 0.25 AND price <= p3 + (p3 - p1) * 0.25 AND charge >= c1 - (c3 - c1) * 0.25 AND charge <= c3 + (c3 - c1) * 0.25""")
def iqr_filter_wide(x):
    return quantiles.inside_fences(_prices(x), ["price", "charge"], 0.25, few=1_000).select("l_orderkey", "l_linenumber", "price")


@query("all_outside_users", """
SELECT user_id, bool_and(k > 80) AS above, bool_and(k < 20) AS below
FROM (SELECT l_orderkey AS user_id, CAST(l_quantity * 2 AS INTEGER) AS k FROM lineitem)
GROUP BY user_id HAVING bool_and(k > 80) OR bool_and(k < 20)""")
def all_outside_users(x):
    rows = x.table("lineitem").select(
        F.col("l_orderkey").alias("user_id"), (F.col("l_quantity") * 2).cast("int").alias("rating_x10"))
    return R.outside_users(rows, 20, 80)


@query("scalar_broadcast", BASE + """
SELECT item_id, n, round_even(mean_rating - (SELECT avg(rating_x10 / 10.0) FROM ratings), 4) AS above_average FROM item_means""")
def scalar_broadcast(x):
    ratings = x.ratings()
    overall = ratings.agg(F.avg(F.col("rating_x10") / F.lit(10.0)).alias("m")).scalar()
    return R.means(ratings, "item_id").withColumn("_m", overall).select(
        "item_id", "n", half_even(F.col("mean_rating") - F.col("_m"), 4).alias("above_average"))


@query("cap_values", """
SELECT p_partkey AS item_id, CASE WHEN p_size * 15 > 480 THEN 480 ELSE p_size * 15 END AS playtime,
       (p_size * 5 + p_size * 15) / 2.0 AS mean_playtime FROM part""")
def cap_values(x):
    return x.items().select(
        "item_id", cap(F.col("size") * 15, 480).alias("playtime"),
        ((F.col("size") * 5 + F.col("size") * 15) / 2.0).cast("double").alias("mean_playtime"))


@query("known_item_intersect", BASE + """
SELECT user_id, count(*) AS known_items FROM ratings WHERE item_id IN (SELECT p_size FROM part) GROUP BY user_id""")
def known_item_intersect(x):
    """How many of each user's items are in a catalog that lacks many: ids up to the largest part size."""
    known = T.matching(x.ratings(), x.items().select(F.col("size").cast("long").alias("item_id")).distinct(), ["item_id"])
    return known.groupBy("user_id").agg(F.count(F.lit(1)).alias("known_items"))


@query("x10_matrix", """
SELECT user_id,
  CAST(coalesce(round_even(avg(value) FILTER (event_type = 'click') * 10, 0), 0) AS BIGINT) AS click,
  CAST(coalesce(round_even(avg(value) FILTER (event_type = 'error') * 10, 0), 0) AS BIGINT) AS error,
  CAST(coalesce(round_even(avg(value) FILTER (event_type = 'purchase') * 10, 0), 0) AS BIGINT) AS purchase,
  CAST(coalesce(round_even(avg(value) FILTER (event_type = 'signup') * 10, 0), 0) AS BIGINT) AS signup,
  CAST(coalesce(round_even(avg(value) FILTER (event_type = 'view') * 10, 0), 0) AS BIGINT) AS "view"
FROM events GROUP BY user_id""")
def x10_matrix(x):
    """Users by a short fixed list of items, value times ten, missing 0."""
    known = ["click", "error", "purchase", "signup", "view"]
    return x.table("events").groupBy("user_id").pivot("event_type", known).agg(
        F.rint(F.avg("value") * 10).cast("long")).na.fill(0)


@query("unrated_fill", BASE + """
, wanted AS (SELECT user_id FROM (SELECT c_custkey AS user_id, CAST('0x' || substr(md5(c_custkey || ':42'), 1, 10) AS BIGINT) AS h FROM customer) WHERE h % 10000 < 125),
catalog AS (SELECT s_suppkey AS item_id FROM supplier)
SELECT w.user_id, c.item_id, 0 AS rating_x10 FROM wanted w, catalog c
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = w.user_id AND r.item_id = c.item_id)""")
def unrated_fill(x):
    """For the users of the test part alone."""
    ratings = x.ratings()
    users = models.split_users(x.table("customer").select(F.col("c_custkey").alias("user_id"))).where("part = 'test'")
    catalog = x.table("supplier").select(F.col("s_suppkey").alias("item_id"))
    return R.fill_unrated(users, catalog, ratings)


@query("last_wins_merge", """
SELECT coalesce(b.item_id, a.item_id) AS item_id, coalesce(b.label, a.label) AS label FROM
(SELECT p_partkey AS item_id, p_name AS label FROM part) a FULL JOIN
(SELECT p_partkey AS item_id, p_type AS label FROM part WHERE p_size > 25) b ON a.item_id = b.item_id""")
def last_wins_merge(x):
    items = x.items()
    return T.last_wins(
        [items.select("item_id", F.col("name").alias("label")),
         items.filter("size > 25").select("item_id", F.col("type").alias("label"))], ["item_id"])


@query("dataset_consistency", BASE + """
SELECT u.user_id, u.n AS deduped, r.n AS raw FROM user_means u
JOIN (SELECT o_custkey AS user_id, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) r USING (user_id)
WHERE u.n <> r.n""")
def dataset_consistency(x):
    sets = T.union_tables([
        T.value_counts(x.ratings(), ["user_id"]).withColumn("data", F.lit("deduped")),
        T.value_counts(x.raw_ratings(), ["user_id"]).withColumn("data", F.lit("raw")),
    ])
    wide = sets.groupBy("user_id").pivot("data", ["deduped", "raw"]).agg(F.max("n"))
    return wide.filter("deduped <> raw")


@query("surrogate_ids", """
SELECT user_id, rn - 1 AS surrogate, CAST(floor((rn - 1) / 400) AS BIGINT) AS block
FROM (SELECT c_custkey AS user_id, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer)""")
def surrogate_ids(x):
    return R.surrogate_blocks(x.table("customer").select(F.col("c_custkey").alias("user_id")), 400)


@query("array_position_join", """
SELECT l_suppkey AS item_a, l_linenumber AS item_b, round_even(avg(l_discount), 4) AS sim FROM lineitem GROUP BY 1, 2""")
def array_position_join(x):
    """Similarity lists aligned with a column-order table, back to pairs.

    A list has one entry per line number, so gathering it is bounded.
    """
    cells = x.table("lineitem").groupBy("l_suppkey", "l_linenumber").agg(half_even(F.avg("l_discount"), 4).alias("s"))
    order = x.table("lineitem").select("l_linenumber").distinct().withColumn("pos", F.col("l_linenumber").cast("int"))
    lists = cells.groupBy("l_suppkey").agg(
        F.map_from_entries(F.collect_list(F.struct("l_linenumber", "s"))).alias("m")
    ).select("l_suppkey", F.transform(F.sequence(F.lit(1), F.array_max(F.map_keys("m"))),
                                      lambda i: F.try_element_at("m", i)).alias("sims"))
    cells = lists.select(F.col("l_suppkey").alias("item_a"), F.posexplode("sims").alias("p", "sim"))
    return cells.join(order, F.col("p") + 1 == F.col("pos")).filter("sim is not null").select(
        "item_a", F.col("l_linenumber").alias("item_b"), "sim")


@query("lookup_map", """
SELECT CAST(p_partkey AS VARCHAR) AS key, '{"id":' || p_partkey || ',"name":"' || p_name || '"}' AS entry FROM part""")
def lookup_map(x):
    return writers.lookup_rows(x.items(), "item_id", "name")


@query("top_n_items", "SELECT p_partkey AS item_id, p_name AS name, p_retailprice AS price FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1000")
def top_n_items(x):
    return x.items().select("item_id", "name", "price").orderBy(F.col("price").desc(), "item_id").limit(1000)


@query("avg_rating_ranking", BASE + "SELECT item_id, round_even(mean_rating, 4) AS mean_rating FROM item_means ORDER BY mean_rating DESC, item_id")
def avg_rating_ranking(x):
    return R.means(x.ratings(), "item_id").orderBy(F.col("mean_rating").desc(), "item_id").select(
        "item_id", half_even("mean_rating", 4).alias("mean_rating"))


@query("sorted_export", BASE + "SELECT * FROM ratings ORDER BY item_id, user_id")
def sorted_export(x):
    return x.ratings().orderBy("item_id", "user_id")


@query("best_score_per_key", """
SELECT l_suppkey AS item_id, l_linenumber AS k, max(l_extendedprice) AS best, arg_max(l_orderkey, (l_extendedprice, l_orderkey)) AS best_order
FROM lineitem GROUP BY 1, 2""")
def best_score_per_key(x):
    return x.table("lineitem").groupBy(F.col("l_suppkey").alias("item_id"), F.col("l_linenumber").alias("k")).agg(
        F.max("l_extendedprice").alias("best"), F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("best_order"))


@query("coverage_merged", """
WITH v AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, l_partkey AS item_id FROM lineitem), k AS (SELECT p_partkey AS item_id FROM part WHERE p_size > 10)
SELECT month, count(DISTINCT v.item_id) AS seen, count(DISTINCT k.item_id) AS covered, round_even(count(DISTINCT k.item_id) / (SELECT count(*) FROM k), 4) AS share
FROM v LEFT JOIN k USING (item_id) GROUP BY 1""")
def coverage_merged(x):
    """Catalog coverage by month from sketches of months and flags, written once; exact up to 65,536 items a month."""
    lines = x.table("lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_returnflag", F.col("l_partkey").alias("item_id"))
    path = x.written("month-sketches", lambda p: sketches.part_sketches(lines, ["month", "l_returnflag"], "item_id", 16).write.parquet(p))
    known = x.table("part").where("p_size > 10").select(F.col("p_partkey").alias("item_id"))
    found = sketches.coverage(x.spark.read.parquet(path), ["month"], known, "item_id", 16)
    return found.withColumn("share", half_even(F.col("share"), 4))
