"""Quality rules with a divergence test against language references, by built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .wording import let, window_hashes, words

# Character classes beside letters, white space and the rest; each pattern is what the class is not.
CLASSES = {"upper": r"\P{Lu}+", "digit": r"\P{Nd}+", "symbol": r"[^#*$%&|<>]+", "mark": r"[^!-/:-@\[-`{-~]+"}
# Common words of a language: at most so many, each with at least so large a share of its words.
COMMON_WORDS, LEAST_SHARE = 40, 0.004
# A document is judged by its characters or words only if it has so many of them.
LEAST_CHARS, LEAST_WORDS = 100, 40
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.26, 0.45
# References of up to so many languages are sent to every task; beyond, Spark joins by language.
BROADCAST_LANGUAGES = 10_000


def distance(one: Column, other: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two arrays of shares."""
    def part(p, q):
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    each = F.zip_with(one, other, lambda p, q: (part(p, q) + part(q, p)) / 2)
    total = F.aggregate(each, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(F.lit(0.0), total))


def shares(counts: Column) -> Column:
    """An array of counts divided by its sum; zeros stay zeros."""
    total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x)
    return let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(0.0)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(tokens: Column, size: int = 5) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the text.

    Window hashes with their places in the low bits are sorted, so that equal windows are
    neighbours; the places of those are sorted again and their cover added up. Texts whose
    windows are all distinct end before that.
    """
    def cover(h):
        bits = F.length(F.bin(F.size(h)))
        def placed(low):
            packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))
            def same(x, y, low):
                return F.coalesce((F.get(h, x.bitwiseAND(low).cast("int")) == F.get(h, y.bitwiseAND(low).cast("int"))), F.lit(False))
            def starts(p):
                twice = F.filter(p, lambda x, j: same(x, F.get(p, j - 1), low) | same(x, F.get(p, j + 1), low))
                return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(low).cast("int")))
            return let(packed, lambda p: let(starts(p), covered))
        return let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, placed)

    def covered(at):
        steps = F.zip_with(F.slice(at, 2, F.greatest(F.lit(0), F.size(at) - 1)), F.slice(at, 1, F.greatest(F.lit(0), F.size(at) - 1)),
                           lambda later, earlier: F.least(F.lit(size), later - earlier))
        return F.when(F.size(at) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(size), lambda acc, x: acc + x))

    return F.when(F.size(tokens) < size + 1, F.lit(0)).otherwise(let(window_hashes(tokens, size), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(cover(h)))).cast("long")


def base_rules(docs: DataFrame, *keep: str) -> DataFrame:
    """The base counts of every whole text, the columns ``keep``, and class counts and lower-case words.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    def measured(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).alias("n_repeat_words"))
    rows = rows.select(
        *keep, class_counts(F.col("_text")).alias("_classes"), let(words(F.col("_text")), measured).alias("_w"),
        duplicate_lines(F.col("_text")).alias("n_dup_lines"), words(F.lower("_text")).alias("_lower"))
    return rows.select(
        *keep, "_w.n_words", "_w.word_chars", F.get("_classes", F.lit(2)).alias("n_symbols"), "n_dup_lines", "_w.n_repeat_words",
        ((F.col("_w.n_words") < 10) | (100 * F.col("_w.n_repeat_words") > 20 * F.col("_w.n_words"))).alias("base_failed"),
        F.col("_classes").cast("array<double>").alias("_classes"), "_lower")


def class_counts(text: Column) -> Column:
    """Upper-case letters, digits, symbols, other marks, white space, and all the rest of a text.

    Plain lower-case letters belong to no named class; without them the classes' patterns meet
    a third of the text.
    """
    def left(rest, pattern):
        return F.char_length(F.regexp_replace(rest, pattern, "")).cast("long")

    def counted(rest):
        upper, digit, symbol, mark = (left(rest, CLASSES[name]) for name in ("upper", "digit", "symbol", "mark"))
        white = left(rest, r"[^\x20\x09-\x0D]+")
        return let(F.array(upper, digit, symbol, mark, white), lambda c: F.array(
            c[0], c[1], c[2], c[3] - c[2], c[4],
            F.greatest(F.lit(0).cast("long"), F.char_length(text).cast("long") - c[0] - c[1] - c[3] - c[4])))

    return let(F.regexp_replace(text, "[a-z]+", ""), counted)


def references(docs: DataFrame) -> DataFrame:
    """One row per language: shares of character classes, common words, their shares and the rest.

    Counted over all documents, those without a language together. Words are added up within
    each task before the shuffle, so that a frequent word or language is one row per task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("lang"), text.alias("_text"))
    classes = rows.select("lang", class_counts(F.col("_text")).alias("c")).groupBy("lang").agg(
        F.array(*[F.sum(F.get("c", F.lit(i))) for i in range(6)]).cast("array<double>").alias("counts"))

    counted = materialise(rows.select("lang", F.explode(words(F.lower("_text"))).alias("word")).groupBy("lang", "word").count(), "word-counts")
    totals = few(materialise(counted.groupBy("lang").agg(F.sum("count").alias("all")), "language-totals"))
    order = Window.partitionBy("lang").orderBy(F.col("count").desc(), "word")
    common = counted.join(totals, "lang").where(F.col("count") >= LEAST_SHARE * F.col("all"))
    common = common.withColumn("place", F.row_number().over(order)).where(F.col("place") <= COMMON_WORDS)
    share = F.col("count") / F.col("all")
    common = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", share.alias("share")))).alias("w"))
    common = common.select("lang", F.col("w.word").alias("common"), F.col("w.share").alias("s"))
    joined = classes.join(common, "lang", "left").select(
        "lang", shares(F.col("counts")).alias("class_ref"), F.coalesce("common", F.array().cast("array<string>")).alias("common"),
        F.coalesce("s", F.array().cast("array<double>")).alias("s"))
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x))
    return materialise(joined.select("lang", "class_ref", "common", F.concat("s", F.array(rest)).alias("word_ref")), "language-references")


def few(languages: DataFrame) -> DataFrame:
    """A written table of a row per language, to be broadcast if its count allows it."""
    return F.broadcast(languages) if languages.count() <= BROADCAST_LANGUAGES else languages


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``class_distance, word_distance, base_failed, kept``.

    A document fails the method if its class histogram or its common-word histogram is farther
    from its language's than the limit and it is long enough to tell. A missing text is an empty
    one and fails the base rules; a missing language is a language of its own. Repeated rows are
    all returned, an empty table gives no rows, extra columns are ignored.
    """
    refs = few(references(docs))
    rows = docs.select("doc_id", "text", F.coalesce(F.col("lang"), F.lit("")).alias("lang"))
    rows = base_rules(rows, "doc_id", "lang").join(refs, "lang")
    def histogram(found, common):
        own = F.transform(common, lambda c: (F.size(found) - F.size(F.array_remove(found, c))).cast("double"))
        return F.concat(own, F.array((F.col("n_words") - F.size(found)).cast("double")))
    known = F.filter("_lower", lambda w: F.array_contains(F.col("common"), w))
    rows = rows.withColumn("_words", let(known, lambda found: histogram(found, F.col("common"))))
    rows = rows.withColumns({
        "class_distance": distance(shares(F.col("_classes")), F.col("class_ref")),
        "word_distance": distance(shares(F.col("_words")), F.col("word_ref")),
    })
    odd = ((F.col("word_chars") >= LEAST_CHARS) & (F.col("class_distance") > MOST_CLASS_DISTANCE)) | (
        (F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > MOST_WORD_DISTANCE))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance",
                       "base_failed", (~F.col("base_failed") & ~odd).alias("kept"))
