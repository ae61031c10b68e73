"""Nested catalog items to a fact table and bridge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import (
    FAMILY_MECHANICS, GOOD_PLAYER_RATIO, MIN_ITEM_RATINGS, MIN_POLL_VOTES, POLL_WEIGHTS, RANK_DEFAULT,
)

# Link types are this prefix and a kind; a fixed value of the item format.
LINK_PREFIX = "boardgame"

RATINGS = "statistics.ratings"

# Scalar attributes: output name -> path. Fixed names of the item format.
ATTRIBUTES = {
    "year": "yearpublished._value",
    "min_players": "minplayers._value",
    "max_players": "maxplayers._value",
    "playtime": "playingtime._value",
    "min_playtime": "minplaytime._value",
    "max_playtime": "maxplaytime._value",
    "min_age": "minage._value",
    "num_ratings": f"{RATINGS}.usersrated._value",
    "avg_rating": f"{RATINGS}.average._value",
    "bayes_rating": f"{RATINGS}.bayesaverage._value",
    "std_dev": f"{RATINGS}.stddev._value",
    "num_owned": f"{RATINGS}.owned._value",
    "num_want": f"{RATINGS}.wanting._value",
    "num_wish": f"{RATINGS}.wishing._value",
    "num_weights": f"{RATINGS}.numweights._value",
    "weight": f"{RATINGS}.averageweight._value",
}


def links(kind: str) -> Column:
    """Values of the links of one kind, in document order."""
    typed = F.filter("link", lambda x: x["_type"] == LINK_PREFIX + kind)
    return F.transform(typed, lambda x: x["_value"])


def gate(items: DataFrame, minimum: int = MIN_ITEM_RATINGS) -> DataFrame:
    return items.filter(F.col(f"{RATINGS}.usersrated._value") >= minimum)


def attributes(items: DataFrame) -> DataFrame:
    return items.select(F.col("_id").alias("item_id"), *[F.col(p).alias(n) for n, p in ATTRIBUTES.items()])


def primary_name() -> Column:
    return F.get(F.filter("name", lambda n: n["_type"] == "primary"), F.lit(0))["_value"]


def identity(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("_id").alias("item_id"),
        primary_name().alias("name"),
        "description",
        F.coalesce("image", F.lit("None")).alias("image"),
    )


def child_counts(items: DataFrame) -> DataFrame:
    alternates = F.filter("name", lambda n: n["_type"] == "alternate")
    inbound = F.exists(
        "link", lambda x: (x["_type"] == LINK_PREFIX + "implementation") & (x["_inbound"] == "true")
    )

    def size(array):
        return F.coalesce(F.size(array), F.lit(0))

    return items.select(
        F.col("_id").alias("item_id"),
        size(alternates).alias("num_alternates"),
        size(links("expansion")).alias("num_expansions"),
        size(links("implementation")).alias("num_implementations"),
        F.coalesce(inbound, F.lit(False)).cast("int").alias("is_reimplementation"),
    )


def rank_map(items: DataFrame, excluded: list[str]) -> DataFrame:
    """``Rank:<name>`` -> value; a missing value gets the default."""
    ranks = F.transform(
        F.filter(f"{RATINGS}.ranks.rank", lambda r: ~r["_name"].isin(excluded) if excluded else F.lit(True)),
        lambda r: F.struct(
            F.concat(F.lit("Rank:"), r["_name"]).alias("key"),
            F.coalesce(r["_value"], F.lit(str(RANK_DEFAULT))).alias("value"),
        ),
    )
    return items.select(F.col("_id").alias("item_id"), F.map_from_entries(ranks).alias("ranks"))


def rank_columns(items: DataFrame, names: list[str], excluded: list[str] = ()) -> DataFrame:
    mapped = rank_map(items, list(excluded))
    return mapped.select("item_id", *[F.try_element_at("ranks", F.lit(n)).alias(n) for n in names])


def tagged_family(tag: str, compat: bool = False) -> Column:
    """First family link that mentions ``tag``, without the tag.

    ``compat`` strips the tag's characters from both ends instead of the prefix.
    """
    first = F.get(F.filter(links("family"), lambda v: F.contains(v, F.lit(tag))), F.lit(0))
    if compat:
        return F.trim(F.btrim(first, F.lit(tag)))
    return F.trim(F.regexp_replace(first, f"^{tag}\\s*", ""))


def family(items: DataFrame, compat: bool = False) -> DataFrame:
    return items.select(
        F.col("_id").alias("item_id"),
        F.coalesce(tagged_family("Game:", compat), tagged_family("Series:", compat)).alias("family"),
    )


def presence(items: DataFrame, word: str, out: str) -> DataFrame:
    hit = F.exists(links("family"), lambda v: F.contains(v, F.lit(word)))
    return items.select(F.col("_id").alias("item_id"), F.coalesce(hit, F.lit(False)).cast("int").alias(out))


def components(items: DataFrame) -> DataFrame:
    """Component family tags of an item, as a list."""
    named = F.filter(links("family"), lambda v: F.contains(v, F.lit("Component")))
    return items.select(F.col("_id").alias("item_id"), named.alias("components"))


def bridge(items: DataFrame, kind: str) -> DataFrame:
    return items.select(F.col("_id").alias("item_id"), F.explode(links(kind)).alias("value"))


def bridges(items: DataFrame, kinds: list[str]) -> DataFrame:
    """``(item_id, kind, value)`` for several kinds in one scan of the items."""

    def tagged(kind):
        return F.transform(links(kind), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    return items.select(F.col("_id").alias("item_id"), F.inline(F.flatten(F.array(*map(tagged, kinds)))))


def mechanics(items: DataFrame) -> DataFrame:
    """Mechanic links plus an indicator for each family tag that is one."""
    tagged = [
        F.when(F.array_contains(links("family"), tag), F.lit(name)) for tag, name in FAMILY_MECHANICS.items()
    ]
    both = F.concat(F.coalesce(links("mechanic"), F.array().cast("array<string>")), F.array_compact(F.array(*tagged)))
    return items.select(F.col("_id").alias("item_id"), F.explode(both).alias("value"))


def awards(items: DataFrame) -> DataFrame:
    return bridge(items, "honor").select(
        "item_id", F.trim(F.regexp_replace("value", "[0-9]", "")).alias("value")
    )


def comments(items: DataFrame) -> DataFrame:
    return items.select(F.col("_id").alias("item_id"), F.explode("comments.comment").alias("c")).select(
        F.col("c._username").alias("username"), "item_id",
        F.col("c._rating").try_cast("double").alias("rating"), F.col("c._value").alias("value"),
    )


# --- polls ---------------------------------------------------------------------------

def poll(title: str) -> Column:
    return F.get(F.filter("poll", lambda p: p["_title"] == title), F.lit(0))


def _first_best(scored: Column, option: str, score: str) -> Column:
    """First option with the highest score: only a strictly higher one replaces it."""
    start = F.struct(F.lit(-1.0).alias("s"), F.lit(None).cast("string").alias("o"))
    return F.aggregate(
        scored, start,
        lambda acc, x: F.when(
            x[score].cast("double") > acc["s"],
            F.struct(x[score].cast("double").alias("s"), x[option].cast("string").alias("o")),
        ).otherwise(acc),
    )["o"]


def majority(title: str) -> Column:
    """Winner of a poll with one result set; no votes at all still choose the first option."""
    options = F.get(poll(title)["results"], F.lit(0))["result"]
    return _first_best(options, "_value", "_numvotes")


def _player_scores(title: str, weights: dict[str, float]) -> Column:
    def weighted(result_set):
        return F.aggregate(
            result_set["result"], F.lit(0.0),
            lambda acc, r: acc + r["_numvotes"] * sum(
                (F.when(r["_value"] == name, F.lit(w)).otherwise(F.lit(0.0)) for name, w in weights.items()),
                F.lit(0.0),
            ),
        )

    return F.transform(
        poll(title)["results"],
        lambda rs: F.struct(rs["_numplayers"].alias("option"), weighted(rs).alias("score")),
    )


def weighted_winner(title: str) -> Column:
    """Option with the highest sum of votes x {1, .5, 0}; ties go to the first."""
    return _first_best(_player_scores(title, POLL_WEIGHTS), "option", "score")


def good_options(title: str, min_votes: int = MIN_POLL_VOTES, ratio: float = GOOD_PLAYER_RATIO) -> Column:
    """Options that more than ``ratio`` of all voters call best or recommended; none for small polls."""
    total = poll(title)["_totalvotes"]
    scores = _player_scores(title, {"Best": 1.0, "Recommended": 1.0})
    passing = F.filter(scores, lambda s: s["score"] / total > ratio)
    return F.when(total > min_votes, F.transform(passing, lambda s: s["option"])).when(
        total.isNotNull(), F.array().cast("array<string>")
    )


def gated_best(title: str, min_votes: int = MIN_POLL_VOTES) -> Column:
    """Option with the highest 2 x best + recommended in a poll with enough votes; "0" if none scored."""
    scores = _player_scores(title, {"Best": 2.0, "Recommended": 1.0})
    scored = F.filter(scores, lambda s: s["score"] > 0)
    return F.when(
        poll(title)["_totalvotes"] > min_votes,
        F.coalesce(_first_best(scored, "option", "score"), F.lit("0")),
    )
