import random

import pytest

from lodestar.llm import licenses


def test_longest_rising():
    draw = random.Random(2)
    for _ in range(300):
        values = draw.sample(range(12), draw.randint(0, 9))
        best = 0
        for mask in range(1 << len(values)):
            chosen = [v for i, v in enumerate(values) if mask >> i & 1]
            best = max(best, len(chosen) if chosen == sorted(chosen) else 0)
        found = licenses.longest_rising(values)
        assert len(found) == best and all(values[a] < values[b] for a, b in zip(found, found[1:]))


def test_patience_matches_are_ordered_and_equal():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ([draw.choice("abcdefgh") for _ in range(draw.randint(0, 12))] for _ in range(2))
        found = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))


@pytest.mark.parametrize("name", sorted(licenses.NOTICES))
def test_each_notice_is_found_among_prose(spark, name):
    noise = " ".join(f"the w{i} license of this" for i in range(60))
    text = f"{noise}\n{licenses.NOTICES[name]}\n{noise} {licenses.NOTICES[name]}"
    got = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert [(r.license, r.coverage) for r in got] == [(name, 1.0)] * 2
    for r in got:
        assert licenses.word_list(text[r.start:r.end]) == licenses.word_list(licenses.NOTICES[name])


def test_changed_words_lower_the_coverage(spark):
    words = licenses.NOTICES["MIT-permission"].split()
    few, many = list(words), list(words)
    for i in range(5, len(words), 12):
        few[i] = "changed"
    for i in range(0, len(words), 3):
        many[i] = "changed"
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(1, " ".join(few)), (2, " ".join(many))], "doc_id bigint, text string")).collect()}
    assert got[1].license == "MIT-permission" and 0.8 <= got[1].coverage < 1
    assert got[2].license is None


def test_odd_documents(odd, nothing, given):
    rows = licenses.scan(odd).collect()
    assert len(rows) == odd.count() and all(r.license is None for r in rows)
    assert licenses.scan(nothing).collect() == []
    docs, texts = given
    got = {r.doc_id: r.license for r in licenses.scan(docs).where("license is not null").collect()}
    for d, text in texts:
        if "Released under the MIT License" in text:
            assert got[d] == "MIT"
        if "licen" not in text.lower() and "permission" not in text.lower():
            assert d not in got


def found_in(text, notices=licenses.NOTICES, telling=licenses.TELLING):
    made = [licenses.Notice(name, words, 0.8, telling.get(name, ())) for name, words in notices.items()]
    low, words = text.lower(), licenses.word_list(text)
    rows = [(*f, n) for n in made if n.possible(low, low.__contains__) for f in n.find(words)]
    return [(n.name, first, last) for _, first, last, n in licenses.fullest(rows)]


@pytest.mark.parametrize("text", [
    "Released under the BSD License.", "Released under the Zope License.", "Licensed under the Mozilla Public License, Version 1.1.",
    "Licensed under CC BY 2.5.", "This work is licensed under the GNU Lesser General Public License, version 2.",
    "Released under the MIT no attribution License.", "Licensed under the Apache Software License, Version 1.1."])
def test_relatives_without_a_template_are_not_named(text):
    assert found_in(text) == []


@pytest.mark.parametrize("text, name", [
    ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"), ("licensed under a CC-BY-NC-SA 3.0", "CC-BY-NC-SA-3.0"),
    ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0"), ("available under the MIT license", "MIT"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0")])
def test_other_wordings_are_named(text, name):
    assert [f[0] for f in found_in(text)] == [name]


@pytest.mark.parametrize("name", sorted(licenses.NOTICES))
def test_notices_one_after_the_other_are_told_apart(name):
    text, size = licenses.NOTICES[name], len(licenses.word_list(licenses.NOTICES[name]))
    assert found_in(" ".join([text] * 12)) == [(name, i * size, (i + 1) * size - 1) for i in range(12)]
    # without telling words, too
    assert found_in(" ".join([text] * 12), {name: text}, {}) == [(name, i * size, (i + 1) * size - 1) for i in range(12)]


def test_changed_words_beside_the_telling_ones():
    draw = random.Random(4)
    for name, text in licenses.NOTICES.items():
        words = licenses.word_list(text)
        telling = {w for run in licenses.TELLING[name] for w in licenses.word_list(run)}
        free = [i for i, w in enumerate(words) if w not in telling]
        for i in draw.sample(free, min(len(free), len(words) // 10)):
            words[i] = f"other{i}"
        got = found_in(" ".join(["prose"] * 30 + words + ["prose"] * 30))
        assert [f[0] for f in got] == [name]
        place, run = next((licenses.places_of(r, words)[0], r) for r in map(licenses.word_list, licenses.TELLING[name]))
        broken = words[:place + 1] + ["foreign"] + words[place + 1:]
        assert name not in [f[0] for f in found_in(" ".join(broken))] or len(run) < 2


def test_telling_words_have_to_be_in_the_text():
    with pytest.raises(ValueError, match="gnu"):
        licenses.Notice("x", "Released under the MIT License.", 0.8, ["GNU"])


def test_stretches_apart_are_those_of_the_plain_scan():
    draw = random.Random(5)
    for _ in range(200):
        found = [(draw.random(), a, a + draw.randint(0, 6)) for a in (draw.randint(0, 30) for _ in range(draw.randint(0, 15)))]
        plain = []
        for item in sorted(found, key=lambda f: -f[0]):
            if all(item[2] < k[1] or item[1] > k[2] for k in plain):
                plain.append(item)
        assert licenses.apart(found, lambda f: -f[0]) == sorted(plain, key=lambda f: f[1])
