"""Nested XML items made from the given tables, written, scanned and flattened."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed_values import (
    ACTUALLY_MAJOR_CATEGORIES, ACTUALLY_MECHANICS, ACTUALLY_THEMES, DROP_SUBCATEGORIES, MECHANIC_GROUPS, RARE_THRESHOLDS,
)
from ..operators import catalog, extract as X
from ..session import scratch_path
from ..sources import readers, writers
from ..streaming import jobs, keyed
from .inputs import CATALOG_CATEGORIES, ITEM_RECORDS
from .registry import query, sql_of


def items(x):
    return readers.xml_items(x.spark, x.item_files())


COUNTS = "c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)"


@query("xml_item_scan", f"WITH {COUNTS} SELECT p_partkey AS item_id, CAST(coalesce(n, 0) AS INTEGER) AS num_ratings, p_name || ' & ' || p_type AS description FROM part LEFT JOIN c ON l_partkey = p_partkey")
def xml_item_scan(x):
    return items(x).select(
        F.col("_id").alias("item_id"), F.col("statistics.ratings.usersrated._value").alias("num_ratings"), "description")


@query("xml_user_scan", """
SELECT CAST(user_id AS VARCHAR) AS username, event_id AS item_id, CASE WHEN event_type <> 'error' THEN value END AS rating,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS lastmodified FROM events""")
def xml_user_scan(x):
    rows = readers.user_collections(x.spark, x.collection_files())
    return rows.withColumn("lastmodified", F.date_format("lastmodified", "yyyy-MM-dd HH:mm:ss"))


@query("from_xml_column", "SELECT p_partkey AS item_id, p_name AS name, p_retailprice / 100 AS average FROM part")
def from_xml_column(x):
    texts = x.nested().select(F.to_xml(F.struct("*"), {"rowTag": "item"}).alias("doc"))
    parsed = readers.parse_items(texts, "doc")
    return parsed.select(
        F.col("_id").alias("item_id"), X.primary_name().alias("name"),
        F.col("statistics.ratings.average._value").alias("average"))


@query("popularity_gate", f"WITH {COUNTS} SELECT l_partkey AS item_id FROM c WHERE n >= 30 AND l_partkey IN (SELECT p_partkey FROM part)")
def popularity_gate(x):
    return X.gate(items(x)).select(F.col("_id").alias("item_id"))


@query("attribute_projection", f"""WITH {COUNTS} SELECT p_partkey AS item_id, p_size + 1950 AS year, p_size % 5 AS min_players, p_size % 5 + 2 AS max_players,
p_size * 10 AS playtime, p_size * 5 AS min_playtime, p_size * 15 AS max_playtime, p_size % 18 AS min_age, CAST(coalesce(n, 0) AS INTEGER) AS num_ratings,
p_retailprice / 100 AS avg_rating, p_retailprice / 200 AS bayes_rating, CAST(NULL AS DOUBLE) AS std_dev, p_size * 3 AS num_owned, p_size * 2 AS num_want,
p_size AS num_wish, p_size * 4 AS num_weights, p_size / 10 AS weight FROM part LEFT JOIN c ON l_partkey = p_partkey""")
def attribute_projection(x):
    return X.attributes(items(x))


@query("identity_fields", """SELECT p_partkey AS item_id, p_name AS name, p_name || ' & ' || p_type AS description,
CASE WHEN p_size % 7 <> 0 THEN 'pic' || p_partkey ELSE 'None' END AS image FROM part""")
def identity_fields(x):
    return X.identity(items(x))


@query("typed_child_counts", """SELECT p_partkey AS item_id, 1 AS num_alternates, CAST(p_size % 3 = 1 AS INTEGER) AS num_expansions,
CAST(p_size % 8 = 0 AS INTEGER) AS num_implementations, CAST(p_size % 8 = 0 AS INTEGER) AS is_reimplementation FROM part""")
def typed_child_counts(x):
    return X.child_counts(items(x))


@query("rank_map", """SELECT p_partkey AS item_id, CAST(p_partkey + 1 AS VARCHAR) AS "Rank:boardgame",
CASE WHEN p_size % 3 = 0 THEN 'Not Ranked' ELSE CAST(p_size AS VARCHAR) END AS "Rank:thematic", CAST(NULL AS VARCHAR) AS "Rank:amiga" FROM part""")
def rank_map(x):
    return X.rank_columns(items(x), ["Rank:boardgame", "Rank:thematic", "Rank:amiga"], ["amiga"])


@query("family_attribute", """SELECT p_partkey AS item_id, CASE WHEN p_size % 2 = 0 THEN string_split(p_name, ' ')[2]
WHEN p_size % 3 = 0 THEN string_split(p_name, ' ')[1] END AS family FROM part""")
def family_attribute(x):
    return X.family(items(x))


@query("presence_flag", "SELECT p_partkey AS item_id, CAST(p_size % 5 = 0 AS INTEGER) AS kickstarted FROM part")
def presence_flag(x):
    return X.presence(items(x), "Crowdfunding", "kickstarted")


@query("component_list", "SELECT p_partkey AS item_id, CASE WHEN p_size % 4 = 0 THEN 'Component: ' || p_type ELSE '' END AS components FROM part")
def component_list(x):
    return X.components(items(x)).withColumn("components", F.array_join("components", ","))


@query("bridge_explode", """
SELECT p_partkey AS item_id, 'category' AS kind, p_type AS value FROM part UNION ALL SELECT p_partkey, 'designer', p_brand FROM part
UNION ALL SELECT p_partkey, 'publisher', 'House ' || p_size FROM part UNION ALL SELECT p_partkey, 'expansion', p_name || ' X' FROM part WHERE p_size % 3 = 1""")
def bridge_explode(x):
    """All bridges from one scan: kinds are exploded together instead of one pass each."""
    kinds = ["category", "designer", "publisher", "expansion"]
    return X.bridges(items(x), kinds)


@query("mechanics_bridge", """SELECT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS value FROM part
UNION ALL SELECT p_partkey, 'Legacy' FROM part WHERE p_size % 7 = 0""")
def mechanics_bridge(x):
    return X.mechanics(items(x))


@query("award_bridge", "SELECT p_partkey AS item_id, trim(regexp_replace(p_brand || ' Winner', '[0-9]', '', 'g')) AS value FROM part")
def award_bridge(x):
    return X.awards(items(x))


@query("ratings_explode", """SELECT 'u' || l_orderkey AS username, l_partkey AS item_id, l_quantity / 5 AS rating, l_returnflag || ' ' || l_linestatus AS value FROM lineitem""")
def ratings_explode(x):
    return X.comments(readers.xml_items(x.spark, x.comment_files()))


@query("dated_ratings_explode", """
SELECT CAST(user_id AS VARCHAR) AS username, count(*) AS n, count(*) FILTER (event_type <> 'error') AS rated, strftime(max(ts), '%Y-%m-%d') AS last_date FROM events GROUP BY user_id""")
def dated_ratings_explode(x):
    rows = readers.user_collections(x.spark, x.collection_files())
    return rows.groupBy("username").agg(
        F.count(F.lit(1)).alias("n"), F.count("rating").alias("rated"), F.date_format(F.max("lastmodified"), "yyyy-MM-dd").alias("last_date"))


_FLAGS = """f AS (SELECT l_partkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r
FROM lineitem GROUP BY 1)"""


@query("poll_majority", f"""WITH {_FLAGS} SELECT p_partkey AS item_id, CASE WHEN l_partkey IS NULL THEN NULL WHEN a >= n AND a >= r THEN 'No text'
WHEN n >= r THEN 'Some text' ELSE 'Much text' END AS answer FROM part LEFT JOIN f ON l_partkey = p_partkey""")
def poll_majority(x):
    return items(x).select(F.col("_id").alias("item_id"), X.majority("Language Dependence").alias("answer"))


_PLAYERS = """s AS (SELECT l_partkey, l_linenumber, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n,
  count(*) FILTER (l_returnflag = 'R') AS r, sum(count(*)) OVER (PARTITION BY l_partkey) AS total FROM lineitem GROUP BY 1, 2)"""


@query("poll_weighted_winner", f"""WITH {_PLAYERS}, w AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY a + 0.5 * n DESC, l_linenumber) AS rn FROM s)
SELECT p_partkey AS item_id, CAST(l_linenumber AS VARCHAR) AS best_players FROM part LEFT JOIN w ON l_partkey = p_partkey AND rn = 1""")
def poll_weighted_winner(x):
    return items(x).select(F.col("_id").alias("item_id"), X.weighted_winner("User Suggested Number of Players").alias("best_players"))


@query("poll_good_options", f"""WITH {_PLAYERS},
g AS (SELECT l_partkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS good FROM s WHERE total > 30 AND (a + n) / total > 0.15 GROUP BY 1),
w AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY 2 * a + n DESC, l_linenumber) AS rn FROM s WHERE total > 30)
SELECT p_partkey AS item_id, CASE WHEN p_partkey IN (SELECT l_partkey FROM s) THEN coalesce(good, '') END AS good_players,
       CASE WHEN 2 * a + n > 0 THEN CAST(w.l_linenumber AS VARCHAR) WHEN w.l_partkey IS NOT NULL THEN '0' END AS best_gated
FROM part LEFT JOIN g ON g.l_partkey = p_partkey LEFT JOIN w ON w.l_partkey = p_partkey AND rn = 1""")
def poll_good_options(x):
    """Ratio .15, not the default .5: votes are spread over seven options here, and no option reaches half of an item's votes (0 of 6,214 at sf0.01)."""
    title = "User Suggested Number of Players"
    return items(x).select(
        F.col("_id").alias("item_id"), F.array_join(X.good_options(title, ratio=0.15), ",").alias("good_players"),
        X.gated_best(title).alias("best_gated"))


@query("xml_compaction", "SELECT 'group' || p_size % 7 AS combined, count(*) AS items FROM part GROUP BY 1")
def xml_compaction(x):
    source, target = scratch_path(x.spark, "small"), scratch_path(x.spark, "combined")
    grouped = x.nested().withColumn("grp", F.concat(F.lit("group"), (F.col("yearpublished._value") - 1950).cast("int") % 7))
    writers.write_items(grouped, source, by="grp", records=ITEM_RECORDS)
    return writers.compact_xml(x.spark, source, target)


@query("file_manifest", "SELECT 'grp=group' || p_size % 7 AS folder, true AS sized, count(*) FILTER (p_size < 0) AS others FROM part GROUP BY 1")
def file_manifest(x):
    """Listed item files by folder: one folder per group of sizes, and nothing with another suffix."""
    grouped = x.nested().withColumn("grp", F.concat(F.lit("group"), (F.col("yearpublished._value") - 1950).cast("int") % 7))
    path = x.written("manifest", lambda p: writers.write_items(grouped, p, by="grp"))
    folder = F.element_at(F.split("path", "/"), -2)
    return readers.manifest(x.spark, path, "xml").groupBy(folder.alias("folder")).agg(
        (F.min("length") > 0).alias("sized"), F.count_if(~F.endswith("path", F.lit(".xml"))).alias("others"))


# --- the catalog job ------------------------------------------------------------------------------

_NAMES = "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in CATALOG_CATEGORIES) + "]"


def _in(names) -> str:
    return "(" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + ")"


_ACCEPTED = f"""{COUNTS}, k AS (SELECT p_partkey AS item_id, part.*, n, {_NAMES}[(p_size + 1950) % {len(CATALOG_CATEGORIES)} + 1] AS category
  FROM part JOIN c ON l_partkey = p_partkey WHERE n >= 30 AND p_size + 1950 <= 1990)"""

_MERGED = "CASE " + " ".join(f"WHEN lower(value) LIKE '%{k}%' THEN '{v}'" for k, v in MECHANIC_GROUPS.items()) + " ELSE value END"


@query("catalog_bridges", f"""WITH {_ACCEPTED},
cat AS (SELECT item_id, p_type AS value FROM k UNION ALL SELECT item_id, category FROM k),
mech AS (SELECT item_id, unnest(string_split(p_name, ' ')) AS value FROM k UNION ALL SELECT item_id, 'Legacy' FROM k WHERE p_size % 7 = 0
  UNION ALL SELECT item_id, CASE {' '.join("WHEN value = '" + a + "' THEN '" + b + "'" for a, b in ACTUALLY_MECHANICS.items())} END FROM cat WHERE value IN {_in(ACTUALLY_MECHANICS)})
SELECT DISTINCT item_id, 'theme' AS kind, value FROM cat WHERE value IN {_in(ACTUALLY_THEMES)}
UNION ALL SELECT DISTINCT item_id, 'category', value FROM cat WHERE value NOT IN {_in([*DROP_SUBCATEGORIES, *ACTUALLY_MECHANICS, *ACTUALLY_THEMES, *ACTUALLY_MAJOR_CATEGORIES])}
UNION ALL SELECT DISTINCT item_id, 'mechanic', {_MERGED} FROM mech WHERE {_MERGED} NOT ILIKE '%turn order%'
UNION ALL SELECT item_id, 'designer', p_brand FROM k WHERE p_brand IN (SELECT p_brand FROM k GROUP BY 1 HAVING count(*) > {RARE_THRESHOLDS['designer']})
UNION ALL SELECT item_id, 'publisher', 'House ' || p_size FROM k WHERE p_size IN (SELECT p_size FROM k GROUP BY 1 HAVING count(*) > {RARE_THRESHOLDS['publisher']})""")
def catalog_bridges(x):
    """XML to the pruned and routed bridges of the items that pass the gate."""
    return catalog.bridges(catalog.accepted(readers.xml_items(x.spark, x.catalog_files()), 1990))


_MAJOR_FLAGS = ", ".join(f"CAST(category = '{name.replace(chr(39), chr(39) * 2)}' AS TINYINT) AS \"{flag}\"" for name, flag in ACTUALLY_MAJOR_CATEGORIES.items())


@query("catalog_fact", f"""WITH {_ACCEPTED}, total AS (SELECT count(*) AS rows_ FROM k), houses AS (SELECT p_size AS house, count(*) AS held FROM k GROUP BY 1)
SELECT CAST(item_id AS SMALLINT) AS item_id, p_name AS name, CAST(p_size + 1950 AS SMALLINT) AS year, CAST(CASE WHEN p_size % 5 = 0 THEN 2 ELSE p_size % 5 END AS TINYINT) AS min_players,
  CAST(least(p_size * 10, 480) AS SMALLINT) AS playtime, CAST(n AS TINYINT) AS num_ratings, p_retailprice / 100 AS avg_rating,
  CAST(p_partkey + 1 AS SMALLINT) AS "Rank:boardgame", CAST(CASE WHEN p_size % 3 = 0 THEN (SELECT rows_ + 1 FROM total) ELSE p_size END AS SMALLINT) AS "Rank:thematic",
  CAST(p_size % 3 <> 0 AS TINYINT) AS "Cat:Thematic", {_MAJOR_FLAGS}, CAST(p_size % 5 = 0 AS TINYINT) AS kickstarted, CAST(held <= {RARE_THRESHOLDS['publisher']} AS TINYINT) AS low_entry,
  CASE WHEN p_size % 2 = 0 THEN string_split(p_name, ' ')[2] WHEN p_size % 3 = 0 THEN string_split(p_name, ' ')[1] END AS family
FROM k JOIN houses ON house = p_size""")
def catalog_fact(x):
    """XML to the clean fact table: gate, attributes, ranks, flags and narrow integers."""
    table = catalog.facts(catalog.accepted(readers.xml_items(x.spark, x.catalog_files()), 1990), ["Rank:boardgame", "Rank:thematic"])
    return table.select(
        "item_id", "name", "year", "min_players", "playtime", "num_ratings", "avg_rating", "`Rank:boardgame`", "`Rank:thematic`", "`Cat:Thematic`",
        *[f"`{flag}`" for flag in ACTUALLY_MAJOR_CATEGORIES.values()], "kickstarted", "low_entry", "family")


@query("catalog_fact_counters", f"""
WITH facts AS ({sql_of("catalog_fact")}) SELECT count(*) AS items, sum(num_ratings) AS ratings,
  count(*) FILTER (kickstarted = 1) AS kickstarted, count(*) FILTER (low_entry = 1) AS low_entry, count(*) FILTER (family IS NULL) AS without_family FROM facts""")
def catalog_fact_counters(x):
    """Counters of the catalog job, taken by the tasks that write the fact table."""
    counters = writers.write_counted(catalog_fact(x), scratch_path(x.spark, "facts"), {
        "items": F.count(F.lit(1)), "ratings": F.sum("num_ratings"), "kickstarted": F.count_if(F.col("kickstarted") == 1),
        "low_entry": F.count_if(F.col("low_entry") == 1), "without_family": F.count_if(F.col("family").isNull())})
    return writers.counter_row(x.spark, counters)


# --- streams, run until nothing is left -------------------------------------------------------

@query("incremental_xml_ingest", f"WITH {COUNTS} SELECT p_partkey AS item_id, CAST(coalesce(n, 0) AS INTEGER) AS num_ratings FROM part LEFT JOIN c ON l_partkey = p_partkey")
def incremental_xml_ingest(x):
    target, checkpoint = scratch_path(x.spark, "ingested"), scratch_path(x.spark, "checkpoint")
    jobs.ingest_xml(x.spark, x.item_files(), target, checkpoint).awaitTermination()
    return x.spark.read.parquet(target)


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(x):
    target, checkpoint = scratch_path(x.spark, "deduped"), scratch_path(x.spark, "checkpoint")
    events = jobs.read_events(x.spark, x.folder, "events.parquet", x.table("events").schema)
    # Whole spans of time come late here, so no watermark may drop a row or forget a key.
    once = jobs.dedup(events.select("ts", "user_id", "event_type"), "ts", ["user_id", "event_type"])
    jobs.write_append(once, target, checkpoint).awaitTermination()
    return x.spark.read.parquet(target).select("user_id", "event_type")


@query("stream_item_stats", """
WITH u AS (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) / 100 AS total, CAST(sum(cents * cents) AS BIGINT) / 10000 AS total_sq FROM u GROUP BY event_type""")
def stream_item_stats(x):
    target, checkpoint = scratch_path(x.spark, "stats"), scratch_path(x.spark, "checkpoint")
    events = jobs.read_events(x.spark, x.folder, "events.parquet", x.table("events").schema)
    jobs.item_stats(events, "event_type", "value", target, checkpoint).awaitTermination()
    latest = jobs.latest_stats(x.spark, target, "event_type")
    return latest.select("event_type", "n", "total", "total_sq")


@query("stream_first_of_keys", "SELECT user_id, event_type, count(*) AS times, epoch_us(min(ts)) // 1000 AS first_ms FROM events GROUP BY 1, 2")
def stream_first_of_keys(x):
    """Keyed state instead of dropped duplicates; beside each key's first row the rows that the batch table has."""
    target, checkpoint = scratch_path(x.spark, "first"), scratch_path(x.spark, "checkpoint")
    events = jobs.read_events(x.spark, x.folder, "events.parquet", x.table("events").schema).select("ts", "user_id", "event_type")
    keyed.write_first_of_keys(events, "ts", ["user_id", "event_type"], target, checkpoint).awaitTermination()
    times = x.table("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("times"))
    first = x.spark.read.parquet(target).select("user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("first_ms"))
    return first.join(times, ["user_id", "event_type"]).select("user_id", "event_type", "times", "first_ms")


@query("stream_rating_bands", sql_of("item_rating_bands"))
def stream_rating_bands(x):
    """The bands of every item from totals that are updated in place."""
    target, checkpoint = scratch_path(x.spark, "totals"), scratch_path(x.spark, "checkpoint")
    rated = x.ratings()
    stream = x.spark.readStream.schema(rated.schema).parquet(x.ratings_path()).withColumn("rating", F.col("rating_x10") / F.lit(10.0))
    keyed.write_running_totals(stream, "item_id", "rating", target, checkpoint).awaitTermination()
    return keyed.bands_of_totals(jobs.latest_stats(x.spark, target, "item_id"), "item_id")


QUIET_HOURS = 12


@query("stream_settled_users", f"""
WITH u AS (SELECT user_id, epoch_us(max(ts)) // 1000 AS last_ms, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_units FROM events GROUP BY 1)
SELECT user_id, n, total_units, last_ms, last_ms + {QUIET_HOURS} * 3600000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) AS settled FROM u""")
def stream_settled_users(x):
    """Totals of every user, and whether event time has passed their newest event by some hours: told by timers."""
    target, checkpoint = scratch_path(x.spark, "settled"), scratch_path(x.spark, "checkpoint")
    events = jobs.read_events(x.spark, x.folder, "events.parquet", x.table("events").schema)
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    keyed.write_running_totals(events, "user_id", "value", target, checkpoint, unit=100, time="ts", quiet_ms=QUIET_HOURS * 3_600_000).awaitTermination()
    return jobs.latest_stats(x.spark, target, "user_id").select("user_id", "n", "total_units", "last_ms", "settled")
