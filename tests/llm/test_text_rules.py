import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestar.llm import divergence, fingerprints

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text) if w]


def base(text):
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_rules(odd, texts, nothing, given, spark):
    made = [(i, " ".join(["ab cd ef gh ij"] * n) + tail) for i, (n, tail) in enumerate([(1, ""), (2, ""), (3, " kl"), (9, "\nx\nx\n\nx"), (1, " ab cd ef gh ij")])]
    extra = spark.createDataFrame([(i, t, "en") for i, t in made], "doc_id bigint, text string, lang string")
    for docs, rows in ((odd, texts), given, (extra, made)):
        got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in divergence.judge(docs).collect()), key=repr)
        want = []
        for d, t in rows:
            b = base(t)
            want.append((d, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]))
        assert got == sorted(want, key=repr)
    assert divergence.judge(nothing).collect() == []


def distance(p, q):
    total = 0.0
    for x, y in zip(p, q):
        for a, b in ((x, y), (y, x)):
            if a > 0:
                total += a * math.log2(2 * a / (a + b)) / 2
    return math.sqrt(max(0.0, total))


def test_divergence_by_brute_force(given, spark):
    docs, _ = given
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    def classes(t):
        upper, digit = sum(c.isupper() and c.isalpha() for c in t), sum(c.isdecimal() for c in t)
        symbol = len(re.findall(r"[#*$%&|<>]", t))
        mark = len(re.findall(r"[!-/:-@\[-`{-~]", t)) - symbol
        white = len(re.findall(r"[\x20\x09-\x0D]", t))
        return [upper, digit, symbol, mark, white, len(t) - upper - digit - symbol - mark - white]
    by_lang, common = {}, {}
    for _, t, lang in rows:
        by_lang[lang] = [a + b for a, b in zip(by_lang.get(lang, [0] * 6), classes(t))]
        common.setdefault(lang, Counter()).update(words(t.lower()))
    refs = {}
    for lang, counted in common.items():
        total = sum(counted.values())
        top = sorted((w for w in counted if counted[w] >= divergence.LEAST_SHARE * total), key=lambda w: (-counted[w], w))[:divergence.COMMON_WORDS]
        shares = [counted[w] / total for w in sorted(top)]
        refs[lang] = (sorted(top), [*shares, max(0.0, 1 - sum(shares))])
    scale = lambda x: [a / sum(x) if sum(x) else 0.0 for a in x]
    got = {r.doc_id: r for r in divergence.judge(docs).collect()}
    for d, t, lang in rows:
        n = Counter(words(t.lower()))
        own = [n[w] for w in refs[lang][0]]
        own.append(sum(n.values()) - sum(own))
        assert got[d].class_distance == pytest.approx(distance(scale(classes(t)), scale(by_lang[lang])), abs=1e-9)
        assert got[d].word_distance == pytest.approx(distance(scale(own), refs[lang][1]), abs=1e-9)


def test_odd_documents_are_rejected(given, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    got = divergence.judge(given[0]).collect()
    bad = [r for r in got if labels.get(r.doc_id) == 0]
    good = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(r.kept for r in bad) <= 0.2 * len(bad)


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_edits(given):
    docs, texts = given
    texts = sorted(texts)
    got = {r.doc_id: r for r in fingerprints.against_edits(docs).collect()}
    assert len(got) == len(texts)
    errors, by_text = [], {}
    for i, (d, t) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        quarter = len(t) // 4
        edited = t[:len(t) - quarter] + following[:quarter]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        errors.append(abs(got[d].near_edited - likeness(shingles(t), shingles(edited))))
        assert abs(got[d].near_next - likeness(shingles(t), shingles(following))) < 0.25
        assert by_text.setdefault(t, got[d].fingerprint) == got[d].fingerprint
    assert sum(errors) / len(errors) < 0.05 and max(errors) < 0.3


def test_fingerprint_edge_cases(odd, texts, nothing, spark):
    rows = fingerprints.against_edits(odd).collect()
    assert sorted((r.doc_id, r.n_chars) for r in rows if r.doc_id is not None) == sorted((d, len(t)) for d, t in texts if d is not None)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.against_edits(nothing).collect() == []
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id bigint, text string")
    assert fingerprints.against_edits(one).first().near_next == 1.0


def test_sketch_estimates(spark):
    a, b = [" ".join(f"t{i}" for i in range(lo, lo + 3000)) for lo in (0, 1500)]
    row = spark.createDataFrame([(a, b)], "a string, b string").select(fingerprints.bottom_k(F.col("a"), 256).alias("a"), fingerprints.bottom_k(F.col("b"), 256).alias("b"))
    got = row.select(fingerprints.resemblance(F.col("a"), F.col("b"), 256).alias("r"), fingerprints.containment(F.col("a"), F.col("b"), 256).alias("c"),
                     fingerprints.distinct_shingles(F.col("a"), 256).alias("n"), fingerprints.merge(F.col("a"), F.col("b"), 256).alias("m")).first()
    assert abs(got.r - 1 / 3) < 0.1 and abs(got.c - 0.5) < 0.15 and abs(got.n / 2996 - 1) < 0.25
    parts = spark.createDataFrame([("x", a), ("x", b), ("y", "")], "k string, text string").select("k", fingerprints.bottom_k(F.col("text"), 256).alias("sketch"))
    merged = {r.k: r.sketch for r in fingerprints.merge_parts(parts, "k", k=256).collect()}
    assert merged["x"] == got.m and merged["y"] == []


@pytest.mark.parametrize("name", ["op3_divergence_rules", "op10_bottom_k_fingerprints"])
def test_plans_are_native(spark, name):
    from lodestar.llm.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
