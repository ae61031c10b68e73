"""Document fingerprints: bottom-k sketches of shingle hashes, by built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordering import numbered
from ..session import materialise
from .tables import id_and_text
from .wording import let, window_hashes, words

WORDS, K = 5, 64


def bottom_k(text: Column, k: int = K, size: int = WORDS) -> Column:
    """The ``k`` least distinct hashes of the text's shingles, ascending; none without words."""
    hashes = let(words(text), lambda w: window_hashes(w, size))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(one: Column, other: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for, as of two parts of a text."""
    return F.slice(F.sort_array(F.array_union(one, other)), 1, k)


def resemblance(one: Column, other: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both; 1 if both have none."""
    union = merge(one, other, k)
    common = F.size(F.array_intersect(union, F.array_intersect(one, other)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact for fewer than ``k``."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(one: Column, other: Column, k: int = K) -> Column:
    """Estimated share of the first's shingles that the second has too; 1 if the first has none."""
    union = distinct_shingles(merge(one, other, k), k)
    share = resemblance(one, other, k) * union / distinct_shingles(one, k)
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def merge_parts(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts.

    Hashes leave as rows, and only the ``k`` least of each key get past the shuffle of a
    rank limit, so that a key with a third of all parts is no larger than others.
    """
    from pyspark.sql import Window

    hashes = parts.select(key, F.explode(sketch).alias("h")).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy("h"))
    least = hashes.withColumn("place", place).where(F.col("place") <= k)
    merged = least.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch))
    return parts.select(key).distinct().join(merged, key, "left").withColumn(
        sketch, F.coalesce(F.col(sketch), F.array().cast("array<bigint>")))


def as_text(sketch: Column) -> Column:
    """Sixteen hexadecimal digits for each hash; empty without shingles."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprint(docs: DataFrame, k: int = K, size: int = WORDS) -> DataFrame:
    """``doc_id, sketch`` of every whole text; a missing text is an empty one."""
    return id_and_text(docs).select("doc_id", bottom_k(F.col("text"), k, size).alias("sketch"))


def against_edits(docs: DataFrame, k: int = K, size: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last quarter of code points replaced by the first as many of the
    next document in ascending ``doc_id``; after the last comes the first. Rows that share an id
    are ordered by a hash of their text, and rows that repeat both are one in this order but all
    are returned. A missing text is an empty one; two texts without words are alike (1.0). An
    empty table gives no rows; extra columns are ignored.

    Ids alone are numbered. The texts then move once, by id; what they lend to the document
    before them (at most a quarter of its length, and the fingerprint) moves again.
    """
    keyed = id_and_text(docs).withColumn("key", F.xxhash64("text"))
    rows = keyed.groupBy("doc_id", "key").agg(F.max(F.char_length("text")).cast("long").alias("n"), F.count("*").alias("times"))
    order = numbered(rows, ["doc_id", "key"], "finger-order")
    total, repeated = order.agg(F.count("*"), F.max("times")).first()
    before = order.select(
        F.pmod(F.col("rank") + 1, F.lit(max(1, total))).alias("rank"), F.col("doc_id").alias("to_id"), F.col("key").alias("to_key"),
        F.floor(F.col("n") / 4).cast("int").alias("lent"))
    links = materialise(order.select("rank", "doc_id", "key").join(before, "rank").drop("rank"), "finger-links")

    texts = keyed.select("doc_id", "key", "text", bottom_k(F.col("text"), k, size).alias("sketch"))
    here = links.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "to_id", "to_key", "lent")
    lending = texts.join(here, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select(
        "to_id", "to_key", F.expr("substring(text, 1, lent)").alias("lent_text"), F.col("sketch").alias("next_sketch"))
    if (repeated or 1) > 1:
        lending = lending.groupBy("to_id", "to_key").agg(F.first("lent_text").alias("lent_text"), F.first("next_sketch").alias("next_sketch"))
    both = texts.join(lending, F.col("doc_id").eqNullSafe(F.col("to_id")) & (F.col("key") == F.col("to_key")))
    n = F.char_length("text")
    edited = both.select(
        "doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), "lent_text").alias("edited"))
    edited = edited.select("*", bottom_k(F.col("edited"), k, size).alias("edited_sketch"))
    return edited.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
