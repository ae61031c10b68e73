"""The given tables seen as catalog, ratings and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixed_values import ACTUALLY_MAJOR_CATEGORIES, ACTUALLY_MECHANICS, ACTUALLY_THEMES, DROP_SUBCATEGORIES
from ..operators import tables
from ..session import enough_splits, scratch_path, shuffles_dropped
from ..sources import writers

CATALOG_CATEGORIES = [
    *DROP_SUBCATEGORIES, *ACTUALLY_MECHANICS, *ACTUALLY_THEMES[:20], *ACTUALLY_MAJOR_CATEGORIES, "Card Game", "Puzzle"]

# Nested items, about 4 KB each, in a file.
ITEM_RECORDS = 20_000

_WRITTEN: dict[tuple[str, str, str, str], str] = {}


class Inputs:
    """Lazy access to the tables of one folder and to what is derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def state(self) -> str:
        """Names, lengths and times of the given files, as the file system lists them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        listed = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return ";".join(sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in listed))

    def written(self, label: str, write) -> str:
        """Write a derived input once per session into the shared folder; returns its path.

        Once more if the files of the given tables have changed since.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, self.state(), label)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, label)
            with shuffles_dropped(self.spark):
                write(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]

    # --- ratings ----------------------------------------------------------------------

    def raw_ratings(self) -> DataFrame:
        """Every order line as a rating; users and items repeat."""
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderstatus")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.col("l_suppkey").alias("item_id"),
            (F.col("l_quantity") * 2).cast("int").alias("rating_x10"),
        )
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    def ratings(self) -> DataFrame:
        """The deduplicated ratings as a table, written once per session.

        Most queries read it more than once with different columns, which would
        otherwise repeat the join and the dedup for every reading.
        """
        path = self.ratings_path()
        return self.spark.read.schema("user_id BIGINT, item_id BIGINT, rating_x10 INT").parquet(path)

    def ratings_path(self) -> str:
        """The folder of the ratings, written once per session."""
        return self.written("ratings", lambda p: self.first_ratings().write.parquet(p))

    def first_ratings(self) -> DataFrame:
        """``(user_id, item_id, rating_x10)``: the first order line of each user and item."""
        first = tables.keep_first(
            self.raw_ratings().select(
                "user_id", "item_id", "rating_x10", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
            ),
            ["user_id", "item_id"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
        )
        return first.select("user_id", "item_id", "rating_x10")

    # --- catalog ----------------------------------------------------------------------

    def items(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
            F.col("p_type").alias("type"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
        )

    def words(self) -> DataFrame:
        """Bridge of items and the words of their names."""
        return self.items().select("item_id", F.explode(F.split("name", " ")).alias("value"))

    def editions(self) -> DataFrame:
        """Bridge of items and a value that few items share."""
        return self.items().select("item_id", F.concat_ws(" ", "name", F.col("size").cast("string")).alias("value"))

    def mechanics(self) -> DataFrame:
        """Bridge with mechanic-like values made from names and sizes."""
        noun = F.split("name", " ")[1]
        kind = F.pmod("size", F.lit(6))
        value = (
            F.when(kind == 0, F.lit("Turn Order: Auction"))
            .when(kind == 1, F.concat(F.lit("Turn Order: "), noun))
            .when(kind == 2, F.lit("Card Drafting"))
            .when(kind == 3, F.concat(F.lit("Worker "), noun))
            .when(kind == 4, noun)
            .otherwise(F.concat(F.lit("Tableau "), noun, F.lit(" Legacy")))
        )
        return self.items().select("item_id", value.alias("value"))

    def features(self) -> DataFrame:
        """Long features of items in weighted groups."""
        items = self.items()
        parts = [
            items.select("item_id", F.lit("designers").alias("grp"), F.concat(F.lit("d:"), "brand").alias("feature")),
            items.select("item_id", F.lit("categories").alias("grp"), F.concat(F.lit("c:"), "type").alias("feature")),
            self.words().select("item_id", F.lit("mechanics").alias("grp"), F.concat(F.lit("m:"), "value").alias("feature")),
            items.select("item_id", F.lit("themes").alias("grp"), F.concat(F.lit("t:"), F.col("size").cast("string")).alias("feature")),
        ]
        return tables.union_tables(parts)

    # --- reviews and documents ----------------------------------------------------------

    def documents(self) -> DataFrame:
        return enough_splits(self.table("documents"))

    def reviews(self) -> DataFrame:
        """Documents as reviews: the source is the item, the document the user."""
        return self.documents().select(
            F.substring("source", 4, 10).cast("long").alias("item_id"), F.col("doc_id").alias("user_id"),
            (F.pmod(F.col("doc_id") * 7, F.lit(91)) + 10).cast("int").alias("rating_x10"), F.col("text").alias("value"),
        )

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").alias("major"))

    # --- nested items -------------------------------------------------------------------

    def nested(self) -> DataFrame:
        """One nested item per part, in the shape of the XML schema."""
        per_line = self.table("lineitem").groupBy("l_partkey", "l_linenumber").agg(
            *[F.count_if(F.col("l_returnflag") == f).cast("int").alias(n) for f, n in (("A", "a"), ("N", "n"), ("R", "r"))]
        )

        def answers(*pairs):
            return F.array(*[F.struct(F.lit(label).alias("_value"), count.alias("_numvotes")) for label, count in pairs])

        # A part has at most as many poll rows as there are line numbers.
        per_part = per_line.groupBy("l_partkey").agg(
            F.array_sort(F.collect_list(F.struct("l_linenumber", "a", "n", "r"))).alias("sets"),
            F.sum("a").cast("int").alias("ta"), F.sum("n").cast("int").alias("tn"), F.sum("r").cast("int").alias("tr"),
        )
        total = F.col("ta") + F.col("tn") + F.col("tr")
        players = F.struct(
            F.lit("User Suggested Number of Players").alias("_title"), total.alias("_totalvotes"),
            F.transform("sets", lambda s: F.struct(
                s["l_linenumber"].cast("string").alias("_numplayers"),
                answers(("Best", s["a"]), ("Recommended", s["n"]), ("Not Recommended", s["r"])).alias("result"),
            )).alias("results"),
        )
        language = F.struct(
            F.lit("Language Dependence").alias("_title"), total.alias("_totalvotes"),
            F.array(F.struct(
                F.lit(None).cast("string").alias("_numplayers"),
                answers(("No text", F.col("ta")), ("Some text", F.col("tn")), ("Much text", F.col("tr"))).alias("result"),
            )).alias("results"),
        )
        words = F.split("p_name", " ")
        size = F.col("p_size")

        def link(kind, value, when=None, inbound=False):
            made = F.struct(
                F.lit(f"boardgame{kind}").alias("_type"), value.alias("_value"),
                F.lit("true" if inbound else None).cast("string").alias("_inbound"),
            )
            return made if when is None else F.when(when, made)

        links = F.array_compact(F.array(
            link("category", F.col("p_type")), link("designer", F.col("p_brand")),
            link("publisher", F.concat(F.lit("House "), size.cast("string"))),
            link("mechanic", words[0]), link("mechanic", words[1]),
            link("family", F.concat(F.lit("Component: "), "p_type"), size % 4 == 0),
            link("family", F.concat(F.lit("Game: "), words[1]), size % 2 == 0),
            link("family", F.concat(F.lit("Series: "), words[0]), size % 3 == 0),
            link("family", F.concat(F.lit("Crowdfunding: "), "p_brand"), size % 5 == 0),
            link("family", F.lit("Mechanism: Legacy"), size % 7 == 0),
            link("expansion", F.concat("p_name", F.lit(" X")), size % 3 == 1),
            link("implementation", F.concat("p_name", F.lit(" I")), size % 8 == 0, inbound=True),
            link("honor", F.concat(F.lit("20"), F.lpad(size.cast("string"), 2, "0"), F.lit(" "), "p_brand", F.lit(" Winner"))),
        ))

        def value(col):
            return F.struct(col.alias("_value"))

        rank = lambda name, v: F.struct(F.lit(name).alias("_name"), v.cast("string").alias("_value"))
        ranks = F.array(
            rank("boardgame", F.col("p_partkey") + 1),
            rank("thematic", F.when(size % 3 == 0, F.lit("Not Ranked")).otherwise(size.cast("string"))),
            rank("amiga", size),
        )
        ratings = F.struct(
            value(F.coalesce(total, F.lit(0))).alias("usersrated"), value(F.col("p_retailprice") / 100).alias("average"),
            value(F.col("p_retailprice") / 200).alias("bayesaverage"), value(F.lit(None).cast("double")).alias("stddev"),
            value(size * 3).alias("owned"), value(size * 2).alias("wanting"), value(size).alias("wishing"),
            value(size * 4).alias("numweights"), value(size / 10).alias("averageweight"),
            F.struct(ranks.alias("rank")).alias("ranks"),
        )
        part = self.table("part").join(per_part, F.col("p_partkey") == F.col("l_partkey"), "left")
        return part.select(
            F.col("p_partkey").alias("_id"), F.lit("boardgame").alias("_type"),
            F.array(
                F.struct(F.lit("alternate").alias("_type"), F.col("p_brand").alias("_value")),
                F.struct(F.lit("primary").alias("_type"), F.col("p_name").alias("_value")),
            ).alias("name"),
            F.concat(F.col("p_name"), F.lit(" & "), F.col("p_type")).alias("description"),
            F.when(size % 7 != 0, F.concat(F.lit("pic"), F.col("p_partkey").cast("string"))).alias("image"),
            value(size + 1950).alias("yearpublished"), value(size % 5).alias("minplayers"), value(size % 5 + 2).alias("maxplayers"),
            value(size * 10).alias("playingtime"), value(size * 5).alias("minplaytime"), value(size * 15).alias("maxplaytime"),
            value(size % 18).alias("minage"),
            F.when(F.col("sets").isNotNull(), F.array(players, language)).alias("poll"),
            links.alias("link"),
            F.struct(ratings.alias("ratings")).alias("statistics"),
        )

    def item_files(self) -> str:
        return self.written("items", lambda path: writers.write_items(self.nested(), path, records=ITEM_RECORDS, compression="gzip"))

    def catalog_files(self) -> str:
        """The nested items with one more category each, by size, from the rule lists and beside them."""
        names = F.array(*map(F.lit, CATALOG_CATEGORIES))
        more = F.struct(
            F.lit("boardgamecategory").alias("_type"), F.get(names, F.col("yearpublished._value") % len(CATALOG_CATEGORIES)).alias("_value"),
            F.lit(None).cast("string").alias("_inbound"))
        items = self.nested().withColumn("link", F.concat("link", F.array(more)))
        return self.written("catalog", lambda path: writers.write_items(items, path, records=ITEM_RECORDS, compression="gzip"))

    def comment_files(self) -> str:
        """Rating pages: an item element per comment, so that no item is gathered in one task."""
        comment = F.struct(
            F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("_username"),
            (F.col("l_quantity") / 5).cast("string").alias("_rating"),
            F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("_value"),
        )
        paged = self.table("lineitem").select(
            F.col("l_partkey").alias("_id"),
            F.struct(F.lit(1).alias("_page"), F.array(comment).alias("comment")).alias("comments"),
        )
        return self.written("comments", lambda path: writers.write_items(paged, path))

    def collection_files(self) -> str:
        """One folder of rated items per event user."""
        rows = self.table("events").select(
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("collection"),
            F.col("event_id").alias("_objectid"),
            F.struct(F.when(F.col("event_type") == "error", "N/A").otherwise(F.col("value").cast("string")).alias("_value")).alias("rating"),
            F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("_lastmodified")).alias("status"),
        )
        return self.written("collections", lambda path: writers.write_items(
            rows.repartition("collection"), path, by="collection"))
