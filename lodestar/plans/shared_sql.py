"""Common table expressions used by the SQL of several queries."""

RATINGS = """
ratings AS (
  SELECT user_id, item_id, rating_x10 FROM (
    SELECT o_custkey AS user_id, l_suppkey AS item_id, CAST(l_quantity * 2 AS INTEGER) AS rating_x10,
           row_number() OVER (PARTITION BY o_custkey, l_suppkey
                              ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS rn
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE rn = 1)
"""

MEANS = """
user_totals AS (SELECT user_id, count(*) AS n, CAST(sum(rating_x10) AS BIGINT) AS t FROM ratings GROUP BY user_id),
item_totals AS (SELECT item_id, count(*) AS n, CAST(sum(rating_x10) AS BIGINT) AS t FROM ratings GROUP BY item_id),
user_means AS (SELECT user_id, n, t / n / 10.0 AS mean_rating FROM user_totals),
item_means AS (SELECT item_id, n, t / n / 10.0 AS mean_rating FROM item_totals)
"""

CENTERED = """
cx AS (SELECT user_id, r.item_id, CAST(round_even((rating_x10 * n - t) / n, 0) AS BIGINT) AS c
       FROM ratings r JOIN item_totals i ON r.item_id = i.item_id),
cu AS (SELECT r.user_id, item_id, CAST(round_even((rating_x10 * n - t) * 10 / n, 0) AS BIGINT) AS c
       FROM ratings r JOIN user_totals u ON r.user_id = u.user_id)
"""

BASE = f"WITH RECURSIVE {RATINGS}, {MEANS}, {CENTERED}"


def pairs(name: str, source: str, entity: str, via: str, value: str, more_than: int) -> str:
    return f"""
{name}_sums AS (
  SELECT p.{entity} AS a, q.{entity} AS b, count(*) AS common,
         CAST(sum(CAST(p.{value} AS BIGINT) * q.{value}) AS BIGINT) AS dot,
         CAST(sum(CAST(p.{value} AS BIGINT) * p.{value}) AS BIGINT) AS sq_a,
         CAST(sum(CAST(q.{value} AS BIGINT) * q.{value}) AS BIGINT) AS sq_b
  FROM {source} p JOIN {source} q ON p.{via} = q.{via} AND p.{entity} < q.{entity}
  GROUP BY 1, 2 HAVING count(*) > {more_than}),
{name} AS (SELECT a, b, common, CAST(dot AS DOUBLE) / sqrt(CAST(sq_a AS DOUBLE) * CAST(sq_b AS DOUBLE)) AS sim
           FROM {name}_sums WHERE sq_a > 0 AND sq_b > 0),
{name}_both AS (SELECT a, b, common, sim FROM {name} UNION ALL SELECT b, a, common, sim FROM {name})
"""


ITEM_PAIRS = pairs("item_pairs", "ratings", "item_id", "user_id", "rating_x10", 10)
STORE = ITEM_PAIRS + """,
store AS (SELECT a, b, sim FROM item_pairs_both WHERE sim >= 0.75 AND sim <= 0.999)
"""

# Support, neighbours and votes of the reference's recommendations.
V, K, N = 7, 250, 5


def user_pairs(v: int) -> str:
    return pairs("user_pairs", "cu", "user_id", "item_id", "c", v)


USER_NEIGHBOURS = user_pairs(V) + f""",
chosen AS (SELECT a, b, common, sim, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM user_pairs_both) WHERE rank <= {K})
"""

PREDICTIONS = USER_NEIGHBOURS + f""",
votes AS (
  SELECT a AS user_id, cu.item_id, CAST(sum(round_even(cu.c * sim / 10, 0)) AS BIGINT) AS total, count(*) AS votes
  FROM chosen JOIN cu ON cu.user_id = chosen.b GROUP BY 1, 2),
predictions AS (
  SELECT v.user_id, v.item_id, votes, round_even(total / votes, 0) / 10.0 + mean_rating AS estimate
  FROM votes v JOIN user_means u ON v.user_id = u.user_id
  WHERE votes >= {N} AND round_even(total / votes, 0) > 0)
"""


def scores(source: str, extra: str = "") -> str:
    """Per-user scores of a prediction table; ``extra`` is a comma-terminated key list."""
    keys = ", ".join(f"p.{k.strip()}" for k in extra.split(",") if k.strip())
    keys = keys + ", " if keys else ""
    return f"""
scored AS (
  SELECT {keys}p.user_id,
         avg(abs(estimate - rating_x10 / 10.0)) AS mae,
         sqrt(avg((estimate - rating_x10 / 10.0) * (estimate - rating_x10 / 10.0))) AS rmse,
         count(*) FILTER (estimate > mean_rating) AS recommended,
         count(*) FILTER (rating_x10 / 10.0 > mean_rating) AS relevant,
         count(*) FILTER (rating_x10 / 10.0 > mean_rating AND estimate > mean_rating) AS hits,
         count(rating_x10) AS overlap
  FROM {source} p JOIN user_means u ON p.user_id = u.user_id
  LEFT JOIN ratings r ON r.user_id = p.user_id AND r.item_id = p.item_id
  GROUP BY {keys}p.user_id),
user_scores AS (
  SELECT {extra}user_id, mae, rmse, recommended, overlap,
         CASE WHEN relevant > 0 AND recommended > 0 THEN round_even(hits / relevant * 100, 2) ELSE 0.0 END AS recall
  FROM scored)
"""


def synthetic(target: int) -> str:
    """The expansion of profiles as a state machine: a step is one user at one place of the round's snapshot.

    The state of a user is its profile as lists in order of insertion, the place ``spot``, the
    length ``size`` of the snapshot and the round. A step adds the best neighbour not yet held; a
    round ends behind its snapshot or where nothing can be added, and the next one follows if it added
    anything and the target is not reached.
    """
    return f"""
lists AS (SELECT a AS item_id, list(b ORDER BY sim DESC, b) AS others, list(sim ORDER BY sim DESC, b) AS sims FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM store) WHERE rank <= {2 * target} GROUP BY a),
machine AS (
  SELECT user_id, list(item_id ORDER BY item_id) AS items, list(c ORDER BY item_id) AS tenths, list(1.0::DOUBLE) AS confidence, list(1.0::DOUBLE) AS sims,
    list(item_id ORDER BY item_id) AS origins, list(0::BIGINT) AS iterations, list(0::BIGINT) AS degrees,
    1::BIGINT AS spot, count(*) AS size, 1::BIGINT AS round, count(*) < {target} AS open, count(*) >= {target} AS whole FROM cx GROUP BY user_id
  UNION ALL
  SELECT user_id, CASE WHEN step > 0 THEN list_append(items, others[step]) ELSE items END, CASE WHEN step > 0 THEN list_append(tenths, CAST(round_even(tenths[spot] * steps[step], 0) AS BIGINT)) ELSE tenths END,
    CASE WHEN step > 0 THEN list_append(confidence, confidence[spot] * steps[step]) ELSE confidence END, CASE WHEN step > 0 THEN list_append(sims, steps[step]) ELSE sims END,
    CASE WHEN step > 0 THEN list_append(origins, items[spot]) ELSE origins END, CASE WHEN step > 0 THEN list_append(iterations, round) ELSE iterations END,
    CASE WHEN step > 0 THEN list_append(degrees, degrees[spot] + 1) ELSE degrees END,
    CASE WHEN ended THEN 1 ELSE spot + 1 END, CASE WHEN ended THEN held ELSE size END, CASE WHEN ended THEN round + 1 ELSE round END,
    NOT ended OR (held > size AND held < {target}), whole
  FROM (SELECT *, len(items) + CASE WHEN step > 0 THEN 1 ELSE 0 END AS held, step = 0 OR spot = size AS ended FROM (
    SELECT m.*, l.others, l.sims AS steps, coalesce(list_position(list_transform(l.others, lambda o: list_contains(m.items, o)), false), 0) AS step
    FROM machine m LEFT JOIN lists l ON l.item_id = m.items[m.spot] WHERE m.open))),
synthetic AS (
  SELECT user_id, items[i] AS item_id, CASE WHEN whole THEN 0 ELSE i - 1 END AS pos, tenths[i] AS tenths, confidence[i] AS confidence, sims[i] AS sim, origins[i] AS rec_from,
    iterations[i] AS iteration, degrees[i] AS degrees FROM (SELECT *, unnest(range(1, len(items) + 1)) AS i FROM machine WHERE NOT open)),
cut AS (
  SELECT * EXCLUDE (rank, n_real) FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.user_id, degrees > 0 ORDER BY confidence DESC, item_id) AS rank, n_real
    FROM synthetic s JOIN (SELECT user_id, count(*) AS n_real FROM synthetic WHERE degrees = 0 GROUP BY 1) r ON r.user_id = s.user_id)
  WHERE degrees = 0 OR rank <= {target} - n_real)
"""


MACRO = """round_even(avg(mae), 4) AS mae, round_even(avg(rmse), 4) AS rmse, round_even(avg(recall), 4) AS recall,
  round_even(avg(recommended), 4) AS mean_recommended, median(recommended) AS median_recommended, count(*) AS users"""
