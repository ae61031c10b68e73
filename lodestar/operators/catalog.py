"""The catalog job: nested items to one clean fact table and its bridges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import (
    ACTUALLY_MAJOR_CATEGORIES, ACTUALLY_MECHANICS, ACTUALLY_THEMES, DROP_COLUMNS, DROP_SUBCATEGORIES, PLAYTIME_CAP, RANK_FLAGS,
    RARE_THRESHOLDS,
)
from ..functions.scalars import cap, narrowest_integer
from ..session import materialise
from . import conform as C, extract as X, tables as T


def accepted(items: DataFrame, year: int) -> DataFrame:
    """Items with enough ratings that are released by ``year``, each id once, written once for both outputs."""
    rated = X.gate(items)
    released = C.released(rated.withColumn("year", F.col(X.ATTRIBUTES["year"])), year).drop("year")
    return materialise(released.dropDuplicates(["_id"]), "catalog-items")


def bridges(items: DataFrame) -> DataFrame:
    """``(item_id, kind, value)`` of accepted items.

    Categories are routed by the rule lists: some go, some are mechanics or themes, and the
    major ones become flags of the fact table. Mechanics are merged; rare publishers and
    designers leave.
    """
    linked = C.drop_rows(X.bridges(items, ["category", *[k for k in RARE_THRESHOLDS]]), [])
    of = lambda kind: linked.where(F.col("kind") == kind).select("item_id", "value")
    routed = C.route_categories(of("category"), DROP_SUBCATEGORIES, ACTUALLY_MECHANICS, ACTUALLY_THEMES, ACTUALLY_MAJOR_CATEGORIES)
    bucket = lambda name: routed.where(F.col("bucket") == name).select("item_id", "value")
    made = {
        "category": bucket("rest"), "theme": bucket("theme"),
        "mechanic": C.compact_mechanics(X.mechanics(items).unionByName(bucket("mechanic"))),
    } | {kind: C.prune_rare(of(kind), threshold) for kind, threshold in RARE_THRESHOLDS.items()}
    return T.union_tables([rows.distinct().select("item_id", F.lit(kind).alias("kind"), "value") for kind, rows in made.items()])


def facts(items: DataFrame, ranks: list[str]) -> DataFrame:
    """One clean row per accepted item: attributes, names, counts, ranks, flags, narrow integers."""
    linked = X.bridges(items, ["category", "publisher"])
    of = lambda kind: linked.where(F.col("kind") == kind).select("item_id", "value")
    parts = [X.attributes(items), X.identity(items), X.child_counts(items), X.rank_columns(items, ranks), X.family(items),
             X.presence(items, "Crowdfunding", "kickstarted"), C.low_entry_flag(of("publisher"), RARE_THRESHOLDS["publisher"])]
    table = reduce(lambda a, b: a.join(b, "item_id", "left"), parts)
    table = C.fill_ranks(C.rank_flags(table, RANK_FLAGS), ranks)
    table = C.category_flags(table, of("category"), ACTUALLY_MAJOR_CATEGORIES)
    table = T.drop_columns(table, DROP_COLUMNS).withColumns({
        "min_players": C.min_players(F.col("min_players")), "playtime": cap(F.col("playtime"), PLAYTIME_CAP)})
    table = materialise(table, "catalog-facts")  # narrowing reads the bounds first
    whole = [name for name, kind in table.dtypes if kind in ("tinyint", "smallint", "int", "bigint")]
    return _narrow(table, whole)


def _narrow(table: DataFrame, columns: list[str]) -> DataFrame:
    """``narrowest_integer`` for names with colons."""
    plain = {c: f"c{i}" for i, c in enumerate(table.columns)}
    narrow = narrowest_integer(table.withColumnsRenamed(plain), [plain[c] for c in columns])
    return narrow.withColumnsRenamed({v: k for k, v in plain.items()})
