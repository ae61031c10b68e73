"""Ranks, packing, routing, text and the other rules, on small hand-made cases."""

import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions import identity, scalars, text
from lodestar.functions.fixed_values import ACTUALLY_MAJOR_CATEGORIES, ACTUALLY_MECHANICS, ACTUALLY_THEMES, DROP_SUBCATEGORIES, STOP_WORDS
from lodestar.operators import pairs, conform, evaluation, extract, features, frontier, models, ordering, pairs, ratings, reviews, similarity, tables
from lodestar.sources import readers, writers


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


# --- ranks -------------------------------------------------------------------------------

@pytest.mark.parametrize("tasks", [8, 800])
@pytest.mark.parametrize("descending", [True, False])
def test_global_rank_with_a_hot_value_and_nulls(spark, descending, tasks):
    rng = random.Random(1)
    rows = [(i, 5.0 if i % 3 == 0 else None if i % 50 == 1 else rng.choice([1.0, 2.5, 9.0, 7.25, i / 7])) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, score double").repartition(5)
    got = {r.id: r.rank for r in ordering.global_rank(df, "score", "id", descending=descending, tasks=tasks).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, 0 if r[1] is None else -r[1] if descending else r[1], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(order)}


def test_hashed_rank_equals_rank_of_the_whole_group(spark):
    from pyspark.sql import Window as W

    df = spark.range(400).select((F.col("id") % 3).alias("g"), F.col("id").alias("u")).withColumn("h", identity.stable_hash("u"))
    ranked = ordering.hashed_rank(df, ["g"], "u", buckets=16)
    plain = F.row_number().over(W.partitionBy("g").orderBy("h", "u"))
    assert ranked.withColumn("p", plain).filter("p <> rank").count() == 0


def test_quality_table_keeps_other_scripts(spark):
    from lodestar.operators import reviews

    text = "Очень хорошая игра, и мы будем играть в неё снова: весело, быстро и просто!"
    df = spark.createDataFrame([(1, 1, 80, text), (2, 1, 80, None)], "user_id long, item_id long, rating_x10 int, value string")
    assert [r.value for r in reviews.quality_table(df).collect()] == [text.lower()]


def test_lowered_support_equals_lowering_step_by_step(spark):
    from lodestar.operators import prediction

    rng = random.Random(4)
    rows = [(u, i, rng.choice([-20, -5, 5, 30])) for u in range(40) for i in rng.sample(range(30), rng.randint(1, 22))]
    df = spark.createDataFrame(rows, "user_id long, item_id long, c long")
    items = {}
    for u, i, _ in rows:
        items.setdefault(u, set()).add(i)
    want = {}
    for u in items:
        common = [len(items[u] & items[o]) for o in items if o != u and items[u] & items[o]]
        v = 12
        while v > 0 and sum(n > v for n in common) < 15:
            v -= 1
        want[u] = (v, sum(n > v for n in common))
    high = pairs.support_cosine(df, "user_id", "item_id", "c", 9)
    got = prediction.lowered_support(df, high, df.select("user_id").distinct(), 12, 15).collect()
    assert {r.a: (r.support, r.candidates) for r in got} == {u: w for u, w in want.items() if w[1]}


@pytest.mark.parametrize("n,tiles", [(10, 3), (29, 29), (61, 29), (5, 29)])
def test_tile_is_ntile(spark, n, tiles):
    from pyspark.sql import Window as W

    df = spark.range(1, n + 1).select(F.col("id").alias("r"))
    wrong = df.select(ordering.tile(F.col("r"), F.lit(n), tiles).alias("t"), F.ntile(tiles).over(W.orderBy("r")).alias("e"))
    assert wrong.filter("t <> e").count() == 0


def pack(pages, target):
    groups, fill, group = [], 0, 1
    for p in pages:
        if fill >= target:
            fill, group = 0, group + 1
        fill += p
        groups.append(group)
    return groups


@pytest.mark.parametrize("pages,groups", [([5, 3, 3, 2, 1], 3), ([1] * 40, 7), ([9, 9, 4, 4, 4, 1, 1, 1, 1, 0, 0], 4), ([100, 1, 1, 1], 29)])
def test_page_packing(spark, pages, groups):
    rows = [(i, p) for i, p in enumerate(pages)]
    got = {r.item_id: r.grp for r in frontier.pack_pages(spark.createDataFrame(rows, "item_id long, pages int"), groups).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    expected = pack([p for _, p in order], max(math.ceil(sum(pages) / groups), 1))
    assert got == {item: g for (item, _), g in zip(order, expected)}


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    plan = ordering.top_per_group(df, ["g"], [F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- cleaning ------------------------------------------------------------------------------

def test_categories_are_routed_once(spark):
    rows = [(1, v) for v in ("Wargame", "Fantasy", "Dice", "Book", "Puzzle")]
    out = conform.route_categories(spark.createDataFrame(rows, "item_id long, value string"), DROP_SUBCATEGORIES,
                                   ACTUALLY_MECHANICS, ACTUALLY_THEMES, ACTUALLY_MAJOR_CATEGORIES)
    assert {(r.value, r.bucket) for r in out.collect()} == {
        ("Wargame", "major"), ("Fantasy", "theme"), ("Dice Rolling", "mechanic"), ("Puzzle", "rest")}


def test_mechanics_are_merged_before_turn_order_leaves(spark):
    rows = [(1, v) for v in ("Turn Order: Auction", "Turn Order: Random", "Card Drafting", "Open Drafting", "Dice")]
    out = conform.compact_mechanics(spark.createDataFrame(rows, "item_id long, value string"))
    assert sorted(r.value for r in out.collect()) == ["Auction or Bidding", "Dice", "Drafting"]


def test_rare_values(spark):
    rows = [(1, "x"), (2, "x"), (1, "y"), (2, "y"), (3, "y")]
    df = spark.createDataFrame(rows, "item_id long, value string")
    assert {r.value for r in conform.prune_rare(df, 2).collect()} == {"y"}
    assert {r.item_id: r.low_entry for r in conform.low_entry_flag(df, 2).collect()} == {1: 1, 2: 1, 3: 0}


def test_not_ranked(spark):
    df = spark.createDataFrame([(i, "Not Ranked" if i == 0 else str(i)) for i in range(10)], "id long, `Rank:wargames` string")
    flags = {"Rank:wargames": "Cat:War"}
    first = conform.fill_ranks(conform.rank_flags(df, flags), ["Rank:wargames"]).filter("id = 0").first()
    assert first["Cat:War"] == 0 and first["Rank:wargames"] == 11
    assert conform.rank_flags(df, flags, compat=True).filter("id = 0").first()["Cat:War"] == 1


def test_min_players(spark):
    df = spark.createDataFrame([(None,), (0,), (1,)], "p int").select(conform.min_players(F.col("p")).alias("m"))
    assert [r.m for r in df.collect()] == [2, 2, 1]


def test_narrowest_integer(spark):
    df = scalars.narrowest_integer(spark.createDataFrame([(1, 300, 70000), (-5, 2, 3)], "a int, b int, c long"), ["a", "b", "c"])
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["tinyint", "smallint", "int"]


def test_last_table_wins(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    b = spark.createDataFrame([(2, "b"), (3, None)], "k int, v string")
    assert {r.k: r.v for r in tables.last_wins([a, b], ["k"]).collect()} == {1: "a", 2: "b", 3: None}


def test_group_members_of_wanted_items(spark):
    df = spark.createDataFrame([(1, "f"), (2, "f"), (3, "g"), (4, "h"), (5, "h")], "item long, fam string")
    got = tables.group_members(df, "item", "fam", spark.createDataFrame([(1,), (3,)], "item long")).collect()
    assert sorted((r.fam, r.item, r.others) for r in got) == [("f", 1, 1), ("f", 2, 1)]


def test_two_way_difference(spark):
    a, b = spark.range(3), spark.range(1, 4)
    assert {(r.id, r.side) for r in tables.difference(a, b).collect()} == {(0, "left"), (3, "right")}


# --- ratings ---------------------------------------------------------------------------------

def test_bands(spark):
    df = spark.createDataFrame([(1, 1, 60), (2, 1, 80), (3, 2, 50)], "user_id long, item_id long, rating_x10 int")
    got = {r.item_id: r for r in ratings.item_bands(df).collect()}
    assert (got[1].overall_mean, got[1].overall_std, got[1].two_under, got[1].one_under, got[1].one_over) == (7.0, 1.41, 4.17, 5.59, 8.41)
    assert got[2].overall_std is None and got[2].one_over is None and got[2].overall_mean == 5.0


def test_scores_of_a_user(spark):
    predicted = spark.createDataFrame([(1, 1, 7.0), (1, 2, 5.0)], "user_id long, item_id long, estimate double")
    actual = spark.createDataFrame([(1, 1, 8.0), (1, 2, 4.0)], "user_id long, item_id long, rating double")
    users = spark.createDataFrame([(1, 6.0)], "user_id long, mean_rating double")
    row = evaluation.user_scores(predicted, actual, users).first()
    assert (row.mae, row.rmse, row.recall) == (1.0, 1.0, 100.0)
    literal = evaluation.user_scores(predicted, actual, users, compat=True).first()
    assert literal.recall == 50.0


def test_perfect_predictor(spark):
    actual = spark.createDataFrame([(u, i, float(i + u)) for u in range(3) for i in range(4)], "user_id long, item_id long, rating double")
    users = actual.groupBy("user_id").agg(F.avg("rating").alias("mean_rating"))
    scores = evaluation.user_scores(actual.withColumnRenamed("rating", "estimate"), actual, users)
    row = evaluation.macro_scores(scores).first()
    assert (row.mae, row.rmse, row.recall) == (0.0, 0.0, 100.0)


def test_users_without_predictions_score_zero(spark):
    scores = spark.createDataFrame([(1, 2.0, 2.0, 50.0, 4, 3), (2, None, None, 0.0, 1, 0)],
                                   "user_id long, mae double, rmse double, recall double, recommended long, overlap long")
    row = evaluation.macro_scores(evaluation.with_missing_users(scores, spark.range(1, 4).toDF("user_id"))).first()
    assert row.users == 2 and row.mae == 1.0 and row.mean_recommended == 2.0  # user 2 is skipped, user 3 counts as zero


def test_unrated_fill_in_blocks(spark):
    rated = spark.createDataFrame([(1, 0), (1, 7), (2, 3)], "user_id long, item_id long")
    got = ratings.fill_unrated(spark.range(1, 3).toDF("user_id"), spark.range(10).toDF("item_id"), rated, block=3).collect()
    assert {(r.user_id, r.item_id) for r in got} == {(u, i) for u in (1, 2) for i in range(10)} - {(1, 0), (1, 7), (2, 3)}
    assert len(got) == 17


def test_splits_are_stable_and_close_to_their_shares(spark):
    users = spark.range(20000).toDF("user_id")
    parts = {r.part: r["count"] for r in models.split_users(users, 0.1, 0.1).groupBy("part").count().collect()}
    assert abs(parts["test"] - 2000) < 200 and abs(parts["validation"] - 2000) < 200
    assert models.split_users(users).exceptAll(models.split_users(users.repartition(7))).count() == 0


# --- text --------------------------------------------------------------------------------------

SAMPLES = ["the The quick  brown fox", "", "a", "don't STOP the music now", " the  end ", "not a stop-word here", "and and and x",
           "theory of them; was", "is", "i  i you", "ma'am ma"]


def test_stop_words_like_split_filter_join(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string").select("t", text.remove_stop_words(F.col("t")).alias("k"))
    for r in df.collect():
        assert r.k == " ".join(w for w in r.t.split(" ") if w.lower() not in set(STOP_WORDS)), repr(r.t)


def test_families_and_prefixes(spark):
    rows = [(1, ["Game: Carcassonne", "Series: X"]), (2, ["Series: Catan Stories", "Other"]), (3, [])]
    df = spark.createDataFrame(rows, "_id long, v array<string>").select(
        "_id", F.transform("v", lambda v: F.struct(F.lit("boardgamefamily").alias("_type"), v.alias("_value"))).alias("link"))
    assert {r.item_id: r.family for r in extract.family(df).collect()} == {1: "Carcassonne", 2: "Catan Stories", 3: None}
    assert extract.family(df, compat=True).filter("item_id = 1").first().family == "Carcassonn"


def test_sentiment_elements(spark):
    source = "Theme: A great and vivid theme. Price: too high!"
    made = text.add_sentiment(spark.createDataFrame([(source,)], "t string"), "t", {"price": "cost"}, ["theme"]).first().elements
    assert made.components == ["theme", "cost"]
    assert made.sentences == ["theme great vivid theme", "cost high"]


def test_summary_sections(spark):
    full = "### What is this game about?\nTrains.\n\n### Pros\n- **Fun**: yes\n- Quick: yes\n\n### Cons\n- Long: very\n"
    short = "Trains.\n\n### Pros\n- Fun: yes"
    df = spark.createDataFrame([(full,), (short,)], "s string")
    a, b = df.select(*[c.alias(n) for n, c in reviews.parse_summary(F.col("s")).items()]).collect()
    assert (a.generated_description, a.generated_pros, a.generated_cons) == ("Trains.", "Fun: yes Quick: yes", "Long: very")
    assert b.generated_pros == "Fun: yes" and b.generated_cons is None


def test_freshness(spark):
    df = spark.createDataFrame([("20240102",), ("20240101",), (None,)], "d string")
    fresh = df.select(reviews.is_fresh(F.col("d"), F.lit("2024-01-31").cast("date")).alias("f"))
    assert [r.f for r in fresh.collect()] == [True, False, False]


def test_uuid5(spark):
    for name in ("plain", "Café ☕ größe", ""):
        assert one(spark, identity.uuid5(F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


def test_upsert_is_idempotent(spark):
    objects = reviews.with_uuid(spark.range(5).select("id", F.lit("x").alias("kind")), ["id", "kind"])
    once = reviews.upsert(objects.limit(0), objects.unionByName(objects))
    assert once.count() == 5 and reviews.upsert(once, objects).count() == 5
    assert reviews.delete(once, objects.filter("id < 2")).count() == 3


def test_longest_prefix_words_and_characters(spark):
    texts = spark.createDataFrame([(1, "art style great"), (2, "artwork fine"), (3, "none")], "id long, text string")
    keys = spark.createDataFrame([("art",), ("art style",)], "key string")
    assert {r.id: r.key for r in similarity.longest_prefix(texts, keys).collect()} == {1: "art style", 2: None, 3: None}
    assert {r.id: r.key for r in similarity.longest_prefix(texts, keys, characters=True).collect()} == {1: "art style", 2: "art", 3: None}


# --- samples -------------------------------------------------------------------------------------

def review_rows(n, words=8):
    strata = [80] * (n // 2) + [60] * (3 * n // 10) + [40] * (n - n // 2 - 3 * n // 10)
    return [(i, 1, r, " ".join(f"word{j}" for j in range(words))) for i, r in enumerate(strata)]


def test_quotas(spark):
    df = spark.createDataFrame(review_rows(2600), "user_id long, item_id long, rating_x10 int, value string")
    counts = {r.stratum: r["count"] for r in reviews.stratified_reviews(df).groupBy("stratum").count().collect()}
    assert counts == {8: 130, 6: 78, 4: 52}


def test_small_samples_keep_everything(spark):
    rows = review_rows(1000) + [(5000, 1, 80, None), (5001, 1, 80, "too short")]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating_x10 int, value string")
    assert reviews.stratified_reviews(df).count() == 1000


def test_contexts_are_bounded(spark):
    df = spark.createDataFrame(review_rows(1000), "user_id long, item_id long, rating_x10 int, value string")
    parts = reviews.grouped_context(reviews.stratified_reviews(df), size=300).collect()
    assert sorted(p.reviews for p in parts) == [100, 300, 300, 300]


# --- features and vectors ---------------------------------------------------------------------------

def test_constant_column_goes_to_the_lower_end(spark):
    df = scalars.scale_columns(spark.createDataFrame([(1, 3), (2, 3)], "item_id int, v int"), {"v": (0.2, 0.9)})
    assert [r.v for r in df.collect()] == [0.2, 0.2]


@pytest.mark.parametrize("min_sim", [0.0, 0.3, 0.6, 0.9])
def test_profile_cosine(spark, min_sim):
    rng = random.Random(11)
    rows = []
    for item in range(80):
        held = {"hot"} | {f"f{rng.randint(0, 12)}" for _ in range(rng.randint(1, 4))}
        rows += [(item, f, {"hot": 0.5}.get(f, 1.0)) for f in held]
    got = {(r.a, r.b): (r.sim, r.held_a, r.held_b)
           for r in similarity.profile_cosine(spark.createDataFrame(rows, "item_id long, feature string, weight double"), min_sim).collect()}
    vectors = {}
    for item, f, w in rows:
        vectors.setdefault(item, {})[f] = w
    groups = {}
    for item in sorted(vectors):
        groups.setdefault(tuple(sorted(vectors[item].items())), []).append(item)
    expected = {}
    names = sorted((items[0], len(items), dict(v)) for v, items in groups.items())
    for i, (a, na, va) in enumerate(names):
        for b, nb, vb in names[i + 1:]:
            dot = sum(w * vb.get(f, 0.0) for f, w in va.items())
            sim = dot / math.sqrt(sum(w * w for w in va.values()) * sum(w * w for w in vb.values()))
            if round(sim, 2) >= min_sim and round(sim, 2) < 1.0 and dot > 0:
                expected[a, b] = (round(sim, 2), na, nb)
    assert got.keys() == expected.keys()
    assert all(abs(got[k][0] - expected[k][0]) < 0.0101 and got[k][1:] == expected[k][1:] for k in got)


@pytest.mark.parametrize("rows", [7, 1000])
def test_nearest_in_blocks(spark, rows):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(40, 6))
    matrix[20:30] = matrix[0]  # copies
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(matrix)], "id long, vec array<double>")
    got = {(r.id, r.rank): (r.other, r.distance) for r in similarity.nearest(df, df, 4, rows=rows).collect()}
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    distance = np.round(1 - unit @ unit.T, 6)
    for i in range(40):
        order = sorted((distance[i, j], j) for j in range(40) if j != i)[:4]
        assert [got[i, r + 1] for r in range(4)] == [(j, d) for d, j in order]


def test_ensemble_counts_a_missing_model_as_one(spark):
    rows = [("a", 1, 2, 0.2), ("b", 1, 2, 0.5)]
    df = spark.createDataFrame(rows, "model string, id long, other long, distance double")
    assert similarity.ensemble(df, ["a", "b", "c"]).first().average_score == 0.57


def test_absolute_differences(spark):
    values = [1.0, 1.2, 1.2, 1.9, 3.0]
    df = spark.createDataFrame(list(enumerate(values)), "item_id long, w double")
    got = {(r.x_a, r.x_b): (r.difference, r.held_b) for r in similarity.abs_diff_pairs(df, "w", 0.8).collect()}
    assert got == {(1.0, 1.2): (0.2, 2), (1.2, 1.9): (0.7, 1)}


# --- polls and files ----------------------------------------------------------------------------------

def poll_df(spark, sets, total):
    results = [(n, [("Best", b), ("Recommended", r), ("Not Recommended", x)]) for n, b, r, x in sets]
    schema = ("_id long, poll array<struct<_title:string,_totalvotes:int,results:array<struct<_numplayers:string,"
              "result:array<struct<_value:string,_numvotes:int>>>>>>")
    return spark.createDataFrame([(1, [("P", total, results)])], schema)


def test_polls(spark):
    tie = poll_df(spark, [("2", 3, 0, 0), ("3", 3, 0, 0)], 6)
    assert tie.select(extract.weighted_winner("P").alias("w")).first().w == "2"
    none = poll_df(spark, [("1", 0, 0, 0), ("2", 0, 0, 0)], 0)
    assert none.select(extract.weighted_winner("P").alias("w")).first().w == "1"
    assert none.select(extract.majority("Missing").alias("w")).first().w is None
    for total, expected in ((30, ([], None)), (31, (["2"], "2"))):
        row = poll_df(spark, [("2", 10, 6, 0), ("3", 5, 2, 8)], total).select(
            extract.good_options("P").alias("g"), extract.gated_best("P").alias("b")).first()
        assert (row.g, row.b) == expected


def test_gate_is_inclusive(spark):
    df = spark.createDataFrame([(i, (((n,),),)) for i, n in enumerate((29, 30, 31))],
                               "_id long, statistics struct<ratings:struct<usersrated:struct<_value:int>>>")
    assert [r._id for r in extract.gate(df).orderBy("_id").collect()] == [1, 2]


def test_bad_numbers_and_empty_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<items><item id="1"><minage value="12"/></item><item id="x"><minage value="old"/></item></items>')
    (tmp_path / "empty.xml").write_text("<items></items>")
    items = readers.xml_items(spark, str(tmp_path))
    assert sorted(((r.item_id, r.min_age) for r in extract.attributes(items).collect()), key=repr) == [(1, 12), (None, None)]


def test_unknown_suffix(spark):
    with pytest.raises(ValueError):
        readers.read(spark, "/tmp/table.xyz")


def test_user_name_comes_from_the_file(spark, tmp_path):
    (tmp_path / "user_ann b.xml").write_text('<items><item objectid="7"><rating value="N/A"/><status lastmodified="2024-01-02 03:04:05"/></item></items>')
    row = readers.user_collections(spark, str(tmp_path)).first()
    assert row.item_id == 7 and row.rating is None and row.lastmodified.year == 2024 and row.username.startswith("ann")


@pytest.mark.parametrize("suffix", ["parquet", "tsv", "csv", "jsonl"])
def test_formats_by_suffix(spark, tmp_path, suffix):
    df = spark.createDataFrame([(1, "a\tb"), (2, "c,d")], "id long, name string")
    path = writers.write(df, str(tmp_path / f"t.{suffix}"))
    assert sorted(readers.read(spark, path, "id long, name string").collect()) == sorted(df.collect())


def test_key_value_batches(spark, tmp_path):
    target = str(tmp_path)

    def put(batch):
        import json
        import os
        import uuid

        with open(os.path.join(target, uuid.uuid4().hex), "w") as out:
            json.dump(batch, out)

    rows = spark.range(25).select(F.col("id").cast("string").alias("game_id"), F.when(F.col("id") > 3, "x").alias("value"))
    writers.put_batches(rows.coalesce(1), put, size=10)
    import json

    batches = [json.load(open(f)) for f in tmp_path.iterdir()]
    assert sorted(map(len, batches)) == [5, 10, 10]
    assert {"game_id": "0"} in [r for b in batches for r in b]  # nulls are left out


def test_means_are_joined_without_python_or_cross_products(spark):
    from lodestar.operators import pairs

    df = spark.createDataFrame([(1, 1, 50), (2, 1, 60)], "user_id long, item_id long, rating_x10 int")
    plan = pairs.centered_item_similarity(df, 1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_no_shared_folder_on_a_cluster_is_an_error(monkeypatch):
    from types import SimpleNamespace

    from lodestar import session

    context = SimpleNamespace(applicationId="none", master="yarn", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(SimpleNamespace(sparkContext=context))


def test_skewed_join_is_split_by_the_runtime(spark):
    """The final plan of the neighbours' join marks the split of a user that many share."""
    from lodestar.operators import prediction

    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        chosen = spark.range(0, 40000, 1, 8).select(
            F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500).alias("b"), F.lit(0.9).alias("sim"))
        rated = spark.range(500).select(F.col("id").alias("user_id"), F.lit(1).alias("item_id"), F.lit(50).alias("c"))
        users = spark.range(40000).select(F.col("id").alias("user_id"), F.lit(5.0).alias("mean_rating"))
        out = prediction.neighbour_predictions(chosen, rated, users, 1)
        assert out.count() == 40000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
