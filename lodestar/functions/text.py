"""Text expressions. Word characters are Unicode letters, digits and underscore."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from .fixed_values import STOP_WORDS, TOKEN_PATTERN


_BLANKS = " \t\n\r\f\v"


def strip(text) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(text, F.lit(_BLANKS))


def _stop_word_pattern(words=STOP_WORDS) -> str:
    """One alternation, grouped by first letter so that most words fail on one comparison."""
    by_letter: dict[str, list[str]] = defaultdict(list)
    for word in words:
        by_letter[word[0]].append(word[1:])
    groups = [f"{letter}(?:{'|'.join(rest)})" for letter, rest in sorted(by_letter.items())]
    return f"(?i) (?:{'|'.join(groups)})(?= |$)"


def remove_stop_words(text) -> Column:
    """Drop stop words from a text split on single spaces.

    A space is put in front, so that every word owns the space before it and one
    compiled regular expression does what split, filter and join would.
    """
    padded = F.concat(F.lit(" "), text)
    return F.substr(F.regexp_replace(padded, _stop_word_pattern(), ""), F.lit(2))


def token_count(text) -> Column:
    return F.regexp_count(text, F.lit(TOKEN_PATTERN))


def is_quality(text, more_than: int) -> Column:
    return token_count(text) > more_than


def normalise(text) -> Column:
    """Keep words, spaces and periods; trim; lower."""
    return F.lower(strip(F.regexp_replace(text, r"[^\p{L}\p{N}_\s.]", "")))


def replace_all(text, rules: dict[str, str]) -> Column:
    """Ordered literal replacements; a PLACEHOLDER target means: leave alone."""
    for old, new in rules.items():
        if new != "PLACEHOLDER":
            text = F.replace(text, F.lit(old), F.lit(new))
    return text


def normalise_components(text, rules: dict[str, str] | None = None) -> Column:
    """Drop line breaks and tabs, split camel case, lower, replace, keep ``word . , :``."""
    text = F.regexp_replace(text, "[\n\r\t]", "")
    text = F.regexp_replace(text, "([a-z0-9])([A-Z])", "$1 $2")
    text = replace_all(F.lower(text), rules or {})
    return strip(F.regexp_replace(text, r"[^\p{L}\p{N}_\s.,:]", ""))


def simplify_category(text, prefixes: dict[str, str], strip_to: list[str]) -> Column:
    """Rewrite known prefixes in order, then collapse to a strip word the text begins with."""
    for old, new in prefixes.items():
        if new != "PLACEHOLDER":
            text = F.when(
                F.startswith(text, F.lit(old)), F.replace(text, F.lit(old), F.lit(new))
            ).otherwise(text)
    collapsed = text
    for word in reversed(strip_to):
        collapsed = F.when(F.startswith(text, F.lit(word)), F.lit(word)).otherwise(collapsed)
    return collapsed


def _plain(text) -> Column:
    return strip(F.replace(F.regexp_replace(text, r"[^\p{L}\p{N}_\s]", ""), F.lit("  "), F.lit(" ")))


def split_components(text, rules: dict[str, str] | None = None, words: int = 5) -> Column:
    """Headings of a "heading: reason." text: the last sentence before each colon, five words."""
    pieces = F.split(normalise_components(text, rules), ":")
    heads = F.transform(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda x: F.substring_index(x, ". ", -1),
    )
    heads = F.filter(heads, lambda x: strip(x) != "")
    return F.transform(
        heads, lambda x: F.array_join(F.slice(F.split(_plain(x), " "), 1, words), " ")
    )


def add_sentiment(df: DataFrame, column: str, prefixes: dict[str, str], strip_to: list[str], rules=None,
                  out: str = "elements") -> DataFrame:
    """Add ``STRUCT<components, sentences>``: headings, and each heading with its cleaned reason.

    The normalised text and the headings become columns first, so that they are
    computed once per row and not once per heading.
    """
    prepared = df.withColumns({
        "_row": normalise_components(F.col(column), rules),
        "_heads": split_components(F.col(column), rules),
    })

    def sentence(head):
        after = F.call_function("substring_index", F.col("_row"), F.concat(head, F.lit(":")), F.lit(-1))
        reason = remove_stop_words(_plain(F.substring_index(after, ".", 1)))
        label = simplify_category(head, prefixes, strip_to)
        return F.replace(F.concat(label, F.lit(" "), reason), F.lit("  "), F.lit(" "))

    elements = F.struct(
        F.transform(
            F.filter("_heads", lambda h: h != ""),
            lambda h: simplify_category(h, prefixes, strip_to),
        ).alias("components"),
        F.transform(F.array_distinct("_heads"), sentence).alias("sentences"),
    )
    return prepared.withColumn(out, elements).drop("_row", "_heads")


def clean_review(text, plain: bool = True, collapse: bool = True) -> Column:
    """Lower case without stop words.

    ``plain`` keeps ASCII letters, digits and spaces only, which empties reviews in other
    scripts; ``collapse`` makes double spaces single.
    """
    if plain:
        text = F.regexp_replace(text, "[^A-Za-z0-9 ]+", "")
    text = remove_stop_words(F.lower(text))
    return F.replace(text, F.lit("  "), F.lit(" ")) if collapse else text


def clean_description(text) -> Column:
    """Drop ampersand entities, digits and punctuation other than periods; lower; trim."""
    text = F.replace(text, F.lit("&amp"), F.lit(""))
    text = F.regexp_replace(text, "[0-9]+", "")
    return strip(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_\s.]", "")))


def name_key(text) -> Column:
    return F.lower(F.regexp_replace(text, r"[^A-Za-z0-9\s]+", ""))


def words(text, pattern: str = r"[\p{L}\p{N}_]+") -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def drop_words(tokens, banned) -> Column:
    """Tokens that are not in another array of words."""
    return F.filter(tokens, lambda t: ~F.array_contains(banned, t))


def word_prefixes(text) -> Column:
    """Every prefix of whole words, shortest first."""
    parts = F.split(text, " ")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), " ")
    )


def ngrams(tokens) -> Column:
    """Unigrams followed by bigrams."""
    size = F.size(tokens)
    pairs = F.transform(
        F.slice(tokens, F.lit(1), F.greatest(size - 1, F.lit(0))),
        lambda t, i: F.concat_ws(" ", t, F.get(tokens, i + 1)),
    )
    return F.concat(tokens, pairs)


def any_contains(text, needles: list[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(text, F.lit(needle))
    return hit
