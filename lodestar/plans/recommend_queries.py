"""Similarity from co-rating, predictions, evaluation and model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import half_even
from ..operators import evaluation as E, factorisation, models, ordering, pairs as P, prediction, ratings as R, synthetic
from ..session import materialise, sent
from .registry import query, sql_of
from .shared_sql import BASE, ITEM_PAIRS, K, MACRO, N, PREDICTIONS, STORE, USER_NEIGHBOURS, V, pairs, scores, synthetic as synthetic_sql, user_pairs


def item_pairs(x):
    """Item-item cosine over shared users on plain ratings, more than 10 in common."""
    return P.support_cosine(x.ratings(), "item_id", "user_id", "rating_x10", 11)


def store(x):
    return P.mirror(P.in_band(item_pairs(x)))


def centered(x):
    """Ratings minus the user's mean, in hundredths."""
    return R.center(x.ratings(), "user_id", 100)


def similar_users(x, v=V):
    """The user pairs above a support, written once per session: many queries start from them."""
    path = x.written(f"user-pairs-{v}", lambda p: P.centered_user_similarity(x.ratings(), v).write.parquet(p))
    return x.spark.read.schema("a BIGINT, b BIGINT, common BIGINT, sim DOUBLE").parquet(path)


def chosen(x):
    return prediction.neighbours(similar_users(x), K)


def predictions(x):
    """The neighbours' estimates, written once per session."""
    def make(path):
        prediction.neighbour_predictions(chosen(x), centered(x), R.means(x.ratings(), "user_id"), N).write.parquet(path)

    return x.spark.read.parquet(x.written("neighbour-predictions", make))


def actual(x):
    return x.ratings().select("user_id", "item_id", (F.col("rating_x10") / F.lit(10.0)).alias("rating"))


def catalog(x):
    return x.table("supplier").select(F.col("s_suppkey").alias("item_id"))


def user_scores_of(x):
    return E.user_scores(predictions(x), actual(x), R.means(x.ratings(), "user_id"))


@query("co_rating_pairs", BASE + "," + ITEM_PAIRS + "SELECT a, b, common, dot FROM item_pairs_sums")
def co_rating_pairs(x):
    return P.shared_sums(x.ratings(), "item_id", "user_id", "rating_x10", 11).select("a", "b", "common", "dot")


@query("co_rating_pairs_shuffled", sql_of("co_rating_pairs"))
def co_rating_pairs_shuffled(x):
    """The same by the block join that a large table takes."""
    return P.shared_sums(x.ratings(), "item_id", "user_id", "rating_x10", 11, broadcast_rows=0).select("a", "b", "common", "dot")


@query("co_user_pairs", BASE + "," + user_pairs(V) + "SELECT a, b, common, dot FROM user_pairs_sums")
def co_user_pairs(x):
    return P.shared_sums(centered(x), "user_id", "item_id", "c", V + 1).select("a", "b", "common", "dot")


@query("item_item_cosine", BASE + "," + ITEM_PAIRS + "SELECT a, b, common, round_even(sim, 4) AS sim FROM item_pairs")
def item_item_cosine(x):
    return item_pairs(x).withColumn("sim", half_even("sim", 4))


@query("item_item_cosine_centered", BASE + ", nz AS (SELECT * FROM cx WHERE c <> 0)," + pairs("cp", "nz", "item_id", "user_id", "c", 10)
       + "SELECT a, b, common, round_even(sim, 4) AS sim FROM cp")
def item_item_cosine_centered(x):
    return P.centered_item_similarity(x.ratings(), 10).withColumn("sim", half_even("sim", 4))


@query("similarity_store", BASE + "," + STORE + "SELECT a, b, round_even(sim, 4) AS sim FROM store")
def similarity_store(x):
    return store(x).select("a", "b", half_even("sim", 4).alias("sim"))


@query("similarity_band", BASE + "," + ITEM_PAIRS + "SELECT a, b, round_even(sim, 4) AS sim FROM item_pairs WHERE sim >= 0.75 AND sim <= 0.999")
def similarity_band(x):
    return P.in_band(item_pairs(x)).select("a", "b", half_even("sim", 4).alias("sim"))


@query("topk_neighbours", BASE + "," + STORE + """
SELECT item_id, neighbour, round_even(sim, 4) AS sim, rank FROM (
  SELECT a AS item_id, b AS neighbour, sim, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM store)
WHERE rank <= 30""")
def topk_neighbours(x):
    best = ordering.top_per_group(store(x), ["a"], [F.col("sim").desc(), F.col("b")], 30)
    return best.select(F.col("a").alias("item_id"), F.col("b").alias("neighbour"), half_even("sim", 4).alias("sim"),
                       F.col("rank").cast("long").alias("rank"))


@query("user_user_cosine", BASE + "," + user_pairs(V) + "SELECT a, b, common, round_even(sim, 4) AS sim FROM user_pairs")
def user_user_cosine(x):
    return similar_users(x).withColumn("sim", half_even("sim", 4))


@query("topk_users", BASE + "," + USER_NEIGHBOURS + "SELECT a, b, common, round_even(sim, 4) AS sim, rank FROM chosen")
def topk_users(x):
    return chosen(x).select("a", "b", "common", half_even("sim", 4).alias("sim"), F.col("rank").cast("long").alias("rank"))


@query("user_similarity_scaled", BASE + "," + user_pairs(V) + """
, span AS (SELECT a, min(sim) AS lo, max(sim) AS hi FROM user_pairs_both GROUP BY a)
SELECT p.a, b, round_even(CASE WHEN hi > lo THEN (sim - lo) / (hi - lo) * 2 - 1 ELSE -1.0 END, 4) AS scaled
FROM user_pairs_both p JOIN span s ON p.a = s.a
WHERE abs(CASE WHEN hi > lo THEN (sim - lo) / (hi - lo) * 2 - 1 ELSE -1.0 END) >= 0.6""")
def user_similarity_scaled(x):
    pairs_ = similar_users(x)
    return models.scaled_user_similarity(pairs_).select("a", "b", half_even("scaled", 4).alias("scaled"))


@query("adaptive_support", BASE + "," + user_pairs(0) + """
, ranked AS (SELECT a, common, row_number() OVER (PARTITION BY a ORDER BY common DESC, b) AS rn FROM user_pairs_both),
chosen_v AS (SELECT a, CAST(least(25, coalesce(max(CASE WHEN rn = 100 THEN common END) - 1, 0)) AS INTEGER) AS support FROM ranked GROUP BY a)
SELECT v.a, support, count(*) AS candidates FROM chosen_v v JOIN user_pairs_both p ON p.a = v.a AND common > support GROUP BY 1, 2""")
def adaptive_support(x):
    """The support is lowered below the floor of the shared pairs for the users who need it."""
    pairs_ = similar_users(x, 10)
    return prediction.lowered_support(centered(x), pairs_, x.ratings().select("user_id").distinct(), 25, 100)


@query("neighbour_predictions", BASE + "," + PREDICTIONS + "SELECT user_id, item_id, votes, round_even(estimate, 4) AS estimate FROM predictions")
def neighbour_predictions(x):
    return predictions(x).withColumn("estimate", half_even("estimate", 4))


@query("neighbour_predictions_synthetic", BASE + "," + user_pairs(V) + f"""
, v AS (SELECT a AS user_id, cu.item_id, avg(cu.c / 100.0 * sim) AS m, count(*) AS votes
        FROM user_pairs_both p JOIN cu ON cu.user_id = p.b WHERE sim >= 0.5 GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT v.user_id, item_id, votes, round_even(least(m + mean_rating, 10.0), 4) AS estimate FROM v JOIN user_means u ON u.user_id = v.user_id""")
def neighbour_predictions_synthetic(x):
    """The cut by similarity instead of by count, unrounded products, capped at 10."""
    near = prediction.neighbours_above(similar_users(x), 0.5)
    out = prediction.weighted_predictions(near, centered(x), R.means(x.ratings(), "user_id"), 2)
    return out.withColumn("estimate", half_even("estimate", 4))


@query("item_based_predictions", BASE + "," + STORE + """
, s AS (SELECT user_id, b AS item_id, sum(sim * c / 10.0) AS w, sum(sim) AS weight FROM cx JOIN store ON a = cx.item_id GROUP BY 1, 2)
SELECT s.user_id, s.item_id, round_even(w / weight + i.mean_rating, 4) AS estimate
FROM s JOIN item_means i ON i.item_id = s.item_id JOIN user_means u ON u.user_id = s.user_id
WHERE w / weight + i.mean_rating > u.mean_rating""")
def item_based_predictions(x):
    ratings = x.ratings()
    out = prediction.item_predictions(store(x), R.center(ratings, "item_id"), R.means(ratings, "item_id"), R.means(ratings, "user_id"))
    return out.withColumn("estimate", half_even("estimate", 4))


@query("item_based_predictions_shuffled", sql_of("item_based_predictions"))
def item_based_predictions_shuffled(x):
    """The same by the join that a large store takes."""
    ratings = x.ratings()
    out = prediction.item_predictions(
        store(x), R.center(ratings, "item_id"), R.means(ratings, "item_id"), R.means(ratings, "user_id"), broadcast_rows=0)
    return out.withColumn("estimate", half_even("estimate", 4))


@query("best_similarity_predictions", BASE + "," + STORE + """
, cand AS (SELECT user_id, b AS target, round_even(sim, 2) AS s, cx.item_id, c FROM cx JOIN store ON a = cx.item_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, target ORDER BY s DESC, item_id DESC) AS rn FROM cand) WHERE rn = 1),
e AS (SELECT b.user_id, target AS item_id, least(round_even(c / 10.0 * s + i.mean_rating, 1), 10.0) AS estimate, u.mean_rating AS um
      FROM best b JOIN item_means i ON i.item_id = target JOIN user_means u ON u.user_id = b.user_id)
SELECT user_id, item_id, estimate FROM e WHERE estimate > um
AND NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = e.user_id AND r.item_id = e.item_id)""")
def best_similarity_predictions(x):
    ratings = x.ratings()
    return prediction.best_similarity_predictions(
        store(x), R.center(ratings, "item_id"), R.means(ratings, "item_id"), R.means(ratings, "user_id"), ratings)


_TOP = """
SELECT user_id, r.item_id, s_name AS name, rank, round_even(estimate, 4) AS estimate FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY estimate DESC, item_id) AS rank FROM predictions p
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = p.user_id AND r.item_id = p.item_id)) r
LEFT JOIN supplier ON s_suppkey = r.item_id WHERE rank <= 30"""


def _names(x):
    return x.table("supplier").select(F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("name"))


@query("recommendations_topk", BASE + "," + PREDICTIONS + _TOP)
def recommendations_topk(x):
    out = prediction.recommend(predictions(x), x.ratings(), _names(x), 30)
    return out.select("user_id", "item_id", "name", F.col("rank").cast("long").alias("rank"), half_even("estimate", 4).alias("estimate"))


@query("anti_join_unrated", BASE + "," + PREDICTIONS + """
SELECT user_id, item_id FROM predictions p
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = p.user_id AND r.item_id = p.item_id)""")
def anti_join_unrated(x):
    return predictions(x).select("user_id", "item_id").join(
        x.ratings().select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


@query("rated_and_predicted", BASE + "," + PREDICTIONS + """
SELECT p.user_id, p.item_id, rating_x10, round_even(estimate, 4) AS estimate
FROM predictions p JOIN ratings r ON r.user_id = p.user_id AND r.item_id = p.item_id""")
def rated_and_predicted(x):
    return predictions(x).join(x.ratings(), ["user_id", "item_id"]).select(
        "user_id", "item_id", "rating_x10", half_even("estimate", 4).alias("estimate"))


@query("user_scores", BASE + "," + PREDICTIONS + "," + scores("predictions") + """
SELECT user_id, round_even(mae + 1e-9, 4) AS mae, round_even(rmse + 1e-9, 4) AS rmse, recall, recommended, overlap FROM user_scores""")
def user_scores(x):
    return user_scores_of(x).select(
        "user_id", half_even(F.col("mae") + 1e-9, 4).alias("mae"), half_even(F.col("rmse") + 1e-9, 4).alias("rmse"),
        "recall", "recommended", "overlap")


@query("macro_metrics", BASE + "," + PREDICTIONS + "," + scores("predictions") + f"SELECT {MACRO} FROM user_scores WHERE overlap > 0")
def macro_metrics(x):
    return E.macro_scores(user_scores_of(x))


_SET = """
, full_set AS (SELECT u.user_id, CASE WHEN s.user_id IS NULL THEN 0 ELSE mae END AS mae,
  CASE WHEN s.user_id IS NULL THEN 0 ELSE rmse END AS rmse, CASE WHEN s.user_id IS NULL THEN 0 ELSE recall END AS recall,
  CASE WHEN s.user_id IS NULL THEN 0 ELSE recommended END AS recommended, overlap
  FROM (SELECT c_custkey AS user_id FROM customer) u LEFT JOIN user_scores s ON s.user_id = u.user_id)
"""


def _set_scores(x):
    users = x.table("customer").select(F.col("c_custkey").alias("user_id"))
    return E.with_missing_users(user_scores_of(x), users)


@query("set_scores", BASE + "," + PREDICTIONS + "," + scores("predictions") + _SET + f"""
SELECT {MACRO} FROM full_set WHERE overlap > 0 OR overlap IS NULL""")
def set_scores(x):
    return E.macro_scores(_set_scores(x))


@query("catalog_coverage", BASE + "," + PREDICTIONS + """
SELECT count(DISTINCT item_id) AS seen,
       round_even(count(DISTINCT item_id) / (SELECT count(*) FROM supplier) * 100, 2) AS coverage
FROM predictions p JOIN user_means u ON u.user_id = p.user_id WHERE estimate > mean_rating""")
def catalog_coverage(x):
    return E.coverage(predictions(x), R.means(x.ratings(), "user_id"), catalog(x))


_COHORT = """
, cohorts AS (SELECT user_id, CASE WHEN n <= (SELECT median(n) FROM user_means) THEN 'under' ELSE 'over' END AS cohort FROM user_means)
"""


def _cohort_scores(x):
    counts = x.ratings().groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return E.macro_scores(user_scores_of(x).join(E.cohorts(counts), "user_id"), ["cohort"])


@query("cohort_scores", BASE + "," + PREDICTIONS + "," + scores("predictions") + _COHORT + f"""
SELECT cohort, {MACRO} FROM user_scores JOIN cohorts USING (user_id) WHERE overlap > 0 GROUP BY cohort""")
def cohort_scores(x):
    return _cohort_scores(x)


GRID_V, GRID_N, GRID_K = (25, 20, 15, 10, 7, 5, 3), (15, 10, 5, 3, 2), 250

_GRID_COVERAGE = """
gcov AS (SELECT v, n, round_even(count(DISTINCT item_id) / (SELECT count(*) FROM supplier) * 100, 2) AS coverage
         FROM (SELECT p.v, p.n, p.item_id FROM grid_predictions p JOIN user_means u ON u.user_id = p.user_id WHERE estimate > mean_rating) GROUP BY v, n)
"""


def _grid_sql(vs, ns, k: int) -> str:
    return user_pairs(min(vs)) + f"""
, grid_v AS (SELECT unnest({list(vs)}) AS v), grid_n AS (SELECT unnest({list(ns)}) AS n),
gc AS MATERIALIZED (SELECT v, a, b, sim FROM (
  SELECT v, a, b, sim, row_number() OVER (PARTITION BY v, a ORDER BY sim DESC, b) AS rank
  FROM user_pairs_both, grid_v WHERE common > v) WHERE rank <= {k}),
gv AS MATERIALIZED (SELECT v, a AS user_id, cu.item_id, CAST(sum(round_even(cu.c * sim / 10, 0)) AS BIGINT) AS total, count(*) AS votes
       FROM gc JOIN cu ON cu.user_id = gc.b GROUP BY 1, 2, 3),
grid_predictions AS MATERIALIZED (
  SELECT v, grid_n.n, gv.user_id, gv.item_id, round_even(total / votes, 0) / 10.0 + mean_rating AS estimate
  FROM gv JOIN user_means u ON u.user_id = gv.user_id JOIN grid_n ON votes >= grid_n.n WHERE round_even(total / votes, 0) > 0),
""" + scores("grid_predictions", "v, n, ") + f"""
, gm AS (SELECT v, n, {MACRO} FROM user_scores WHERE overlap > 0 GROUP BY v, n),""" + _GRID_COVERAGE


_GRID = _grid_sql(GRID_V, GRID_N, GRID_K)


def _grid(x, vs=GRID_V, ns=GRID_N, k=GRID_K):
    """All parameter choices in one pass, written once for the session.

    A pair joins the neighbour's ratings once, with the list of supports under which it is
    among the ``k`` best; sums for every support come from that one join.
    """
    def make(path):
        pairs_ = P.mirror(P.centered_user_similarity(x.ratings(), min(vs)))
        with_v = pairs_.withColumn("v", F.explode(F.filter(F.array(*map(F.lit, vs)), lambda v: F.col("common") > v)))
        near = ordering.top_per_group(with_v, ["v", "a"], [F.col("sim").desc(), F.col("b")], k)
        users = R.means(x.ratings(), "user_id")
        wide = prediction.grid_predictions(near, centered(x), users, vs, min(ns))
        both = wide.withColumn("n", F.explode(F.filter(F.array(*map(F.lit, ns)), lambda n: F.col("votes") >= n)))
        both = materialise(both, "grid-predictions")
        macro = E.macro_scores(E.user_scores(both, actual(x), users, extra=("v", "n")), ["v", "n"])
        macro.join(E.coverage(both, users, catalog(x), ["v", "n"]).drop("seen"), ["v", "n"]).write.parquet(path)

    return x.spark.read.parquet(x.written(f"grid-{vs}-{ns}-{k}", make))


# A search over the votes alone, at one support.
ONLY_N = (30, 25, 20, 15, 10, 5, 3, 2)


@query("votes_grid", BASE + "," + _grid_sql((V,), ONLY_N, GRID_K) + "SELECT gm.n, mae, rmse, recall, mean_recommended, median_recommended, users, coverage FROM gm JOIN gcov USING (v, n)")
def votes_grid(x):
    return _grid(x, (V,), ONLY_N).drop("v")


@query("parameter_grid", BASE + "," + _GRID + "SELECT gm.*, coverage FROM gm JOIN gcov USING (v, n)")
def parameter_grid(x):
    return _grid(x)


@query("composite_score", BASE + "," + _GRID + """
SELECT v, n, round_even((1 - mae) * 100 + recall + coverage / 10, 4) AS score FROM gm JOIN gcov USING (v, n)""")
def composite_score(x):
    return E.composite(_grid(x)).orderBy(F.col("score").desc()).select("v", "n", "score")


_IMPROVE = "CASE WHEN a.{m} <> 0 THEN round_even((b.{m} - a.{m}) / a.{m} * {s}, 2) END"


@query("score_improvement", BASE + "," + _GRID + """
, a AS (SELECT n, mae, rmse, recall FROM gm WHERE v = 20), b AS (SELECT n, mae, rmse, recall FROM gm WHERE v = 10)
""" + " UNION ALL ".join(
    f"SELECT a.n, '{m}' AS metric, {_IMPROVE.format(m=m, s=s)} AS improvement FROM a JOIN b USING (n)"
    for m, s in (("mae", -100), ("rmse", -100), ("recall", 100))))
def score_improvement(x):
    grid = _grid(x)
    metrics = ["mae", "rmse", "recall"]
    return E.improvement(grid.filter("v = 20").select("n", *metrics), grid.filter("v = 10").select("n", *metrics), "n", metrics)


def _bias_sql(sweeps: int) -> str:
    ctes = ["r0 AS (SELECT user_id, item_id, rating_x10 / 10.0 AS r FROM ratings)", "mu AS (SELECT avg(r) AS mu FROM r0)",
            "u0 AS (SELECT DISTINCT user_id, 0.0::DOUBLE AS bu FROM r0)"]
    for k in range(1, sweeps + 1):
        ctes.append(f"i{k} AS MATERIALIZED (SELECT item_id, sum(r - mu - bu) / (10.0 + count(*)) AS bi FROM r0 JOIN u{k-1} USING (user_id), mu GROUP BY item_id)")
        ctes.append(f"u{k} AS MATERIALIZED (SELECT user_id, sum(r - mu - bi) / (15.0 + count(*)) AS bu FROM r0 JOIN i{k} USING (item_id), mu GROUP BY user_id)")
    return ", " + ", ".join(ctes)


@query("bias_baseline", BASE + _bias_sql(10) + """
SELECT 'item' AS side, item_id AS id, round_even(bi, 4) AS bias FROM i10
UNION ALL SELECT 'user', user_id, round_even(bu, 4) FROM u10""")
def bias_baseline(x):
    _, items, users = models.bias_baseline(x.ratings())
    return items.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), half_even("bi", 4).alias("bias")).unionByName(
        users.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), half_even("bu", 4).alias("bias")))


def hash_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 10) AS BIGINT)"


_SPLIT = f"""SELECT user_id, CASE WHEN h % 10000 < 125 THEN 'test' WHEN h % 10000 < 250 THEN 'validation' ELSE 'train' END AS part
FROM (SELECT c_custkey AS user_id, {hash_sql("c_custkey || ':42'")} AS h FROM customer)"""


@query("model_scores", BASE + _bias_sql(10) + f"""
, chosen AS (SELECT user_id FROM ({_SPLIT}) WHERE part = 'validation'),
predictions AS (SELECT c.user_id, s_suppkey AS item_id, mu + coalesce(bi, 0) + coalesce(bu, 0) AS estimate FROM chosen c CROSS JOIN supplier CROSS JOIN mu
  LEFT JOIN i10 ON i10.item_id = s_suppkey LEFT JOIN u10 ON u10.user_id = c.user_id),
""" + scores("predictions") + f"SELECT {{MACRO}} FROM user_scores WHERE overlap > 0".replace("{MACRO}", MACRO))
def model_scores(x):
    """Scores of the bias model over all items, for the users of the validation part.

    What belongs to these users, and the items' biases, go to every task where they are small, so that
    the product of users and items is not shuffled.
    """
    ratings = x.ratings()
    mu, items, users = models.bias_baseline(ratings, sweeps=10)
    chosen_ = models.split_users(x.table("customer").select(F.col("c_custkey").alias("user_id"))).where("part = 'validation'")
    mine = lambda rows: sent(rows.join(chosen_.select("user_id"), "user_id", "left_semi"))
    estimates = models.bias_predictions(R.every_item(chosen_.select("user_id"), catalog(x)), mu, sent(items), mine(users))
    return E.macro_scores(E.user_scores(estimates, mine(actual(x)), mine(R.means(ratings, "user_id"))))


@query("user_split", _SPLIT)
def user_split(x):
    return models.split_users(x.table("customer").select(F.col("c_custkey").alias("user_id")))


@query("cv_folds", BASE + f""", f AS (SELECT rating_x10, CAST({hash_sql("user_id || ':' || item_id || ':42'")} % 3 AS INTEGER) AS fold FROM ratings)
SELECT fold, count(*) AS held, CAST(sum(rating_x10) AS BIGINT) AS total_x10 FROM f GROUP BY fold""")
def cv_folds(x):
    """What each fold of the cross-validation holds out."""
    return models.folds_of(x.ratings()).groupBy("fold").agg(F.count(F.lit(1)).alias("held"), F.sum("rating_x10").alias("total_x10"))


@query("als_cv")
def als_cv(x):
    return models.factorisation_cv(x.ratings())


@query("gradient_cv")
def gradient_cv(x):
    """Factors and biases by gradient steps with the reference solver's parameters, on the folds of ``cv_folds``."""
    return factorisation.gradient_cv(x.ratings()).withColumn("rmse", half_even("rmse", 6))


def _unit_sql(seed: int) -> str:
    return f"(({hash_sql(f"user_id || ':' || item_id || ':{seed}'")} + 1) / 1099511627777.0::DOUBLE)"


@query("normal_predictor", BASE + f"""
, st AS (SELECT avg(rating_x10) AS m, stddev_samp(rating_x10) AS s FROM ratings)
SELECT user_id, item_id, round_even(greatest(0.0, least(10.0, (m + sqrt(-2 * ln({_unit_sql(43)})) * cos(2 * pi() * {_unit_sql(44)}) * s) / 10)), 4) AS estimate
FROM ratings, st""")
def normal_predictor(x):
    ratings = x.ratings()
    estimates = models.normal_predictions(ratings.select("user_id", "item_id"), ratings)
    return estimates.withColumn("estimate", half_even("estimate", 4))


# The least of the reference's targets.
TARGET = 50


def _synthetic(x):
    return synthetic.synthetic_ratings(R.center(x.ratings(), "item_id"), P.in_band(item_pairs(x)), TARGET)


def _rounded(rows):
    return rows.withColumns({c: half_even(c, 6) for c in ("confidence", "sim")})


_SYNTHETIC = BASE + "," + STORE + "," + synthetic_sql(TARGET)
_ROUNDED = "* REPLACE (round_even(confidence, 6) AS confidence, round_even(sim, 6) AS sim)"


@query("synthetic_ratings", _SYNTHETIC + f"SELECT {_ROUNDED} FROM synthetic")
def synthetic_ratings(x):
    return _rounded(_synthetic(x))


@query("synthetic_confidence_cut", _SYNTHETIC + f"SELECT {_ROUNDED} FROM cut")
def synthetic_confidence_cut(x):
    return _rounded(synthetic.confidence_cut(_synthetic(x), TARGET))


# Least similarity of neighbours among expanded profiles. The reference takes .8, which leaves no row
# of the given tables (0 at sf0.01, against 40,048 at .5).
NEAR = 0.5


@query("recommend_flow", _SYNTHETIC + ", expanded AS (SELECT user_id, item_id, tenths * 10 AS c FROM cut)," + pairs("near", "expanded", "user_id", "item_id", "c", V) + f"""
, v AS (SELECT a AS user_id, e.item_id, avg(e.c / 100.0 * sim) AS m, count(*) AS votes
        FROM near_both JOIN expanded e ON e.user_id = b WHERE sim >= {NEAR} GROUP BY 1, 2 HAVING count(*) >= {N}),
predictions AS (SELECT v.user_id, item_id, votes, round_even(least(m + mean_rating, 10.0), 6) AS estimate FROM v JOIN user_means u ON u.user_id = v.user_id)""" + _TOP.replace("round_even(estimate, 4) AS estimate", "estimate"))
def recommend_flow(x):
    """Centre, expand, find neighbours among the expanded profiles, predict, drop what is rated, name."""
    expanded = synthetic.confidence_cut(_synthetic(x), TARGET).select(
        "user_id", "item_id", (F.col("tenths") * 10).alias("c"))
    pairs_ = P.support_cosine(expanded, "user_id", "item_id", "c", V + 1)
    near = prediction.neighbours_above(pairs_, NEAR)
    users = R.means(x.ratings(), "user_id")
    estimates = prediction.weighted_predictions(near, expanded, users, N).withColumn("estimate", half_even("estimate", 6))
    out = prediction.recommend(estimates, x.ratings(), _names(x), 30)
    return out.select("user_id", "item_id", "name", F.col("rank").cast("long").alias("rank"), "estimate")
