"""Invariants of the composite operators on the stand-in data (sf0.01)."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from lakemart.functions.order import global_index, index_within
from lakemart.plans import q_apps, q_mart, standins as S
from lakemart.operators import labels, nested as N, roster as RO, tournament as TR


@pytest.fixture(scope="module")
def team_rows(spark):
    return q_apps.teams(spark, SF01).collect()


def test_teams_are_disjoint_and_full(spark):
    s, _, _ = q_apps._aligned(spark, SF01)
    drawn = RO.draw_teams(s, n_teams=8, size=5, seed=42).collect()
    assert len(drawn) == 40 and len({r.name for r in drawn}) == 40
    assert Counter(r.team for r in drawn) == {t: 5 for t in range(8)}


def test_roles_are_distinct_members(team_rows):
    assert len(team_rows) == 8
    seen = set()
    for r in team_rows:
        roles = [r.leader, r.tank, r.damage, r.the_other_guy, r.the_other_guy2]
        assert None not in roles and len(set(roles)) == 5
        assert not seen & set(roles)
        seen |= set(roles)
        assert r.team_name.startswith("Team: ") and r.team_name[6:] in roles


def test_pair_count_and_every_bracket_has_a_winner(spark):
    t = q_apps.teams(spark, SF01)
    b = TR.draw_brackets(t, n=4, seed=7)
    sizes = Counter(r.bracket for r in b.collect())
    pairs = TR.pairs(b).count()
    assert pairs == sum(n * (n - 1) // 2 for n in sizes.values())
    winners = TR.play_round(b).collect()
    assert sorted(w.bracket for w in winners) == sorted(sizes)


def test_tournament_rounds(spark):
    final = TR.tournament(q_apps.teams(spark, SF01), n=4, seed=7).collect()
    by_round = Counter(r["round"] for r in final)
    assert by_round == {1: 4, 2: 2, 3: 1}
    r1 = {r.winner for r in final if r["round"] == 1}
    r2 = {r.winner for r in final if r["round"] == 2}
    r3 = {r.winner for r in final if r["round"] == 3}
    assert r2 <= r1 and r3 <= r2


def test_bracket_of_one_team_has_a_winner(spark):
    t = spark.createDataFrame([("A", 1.0, 1.0, 0), ("B", 2.0, 0.5, 1), ("C", 0.0, 0.0, 0)],
                              "team_name string, top_average_speed double, top_average_height double, flight_count int")
    out = TR.tournament(t, n=4, seed=1).collect()
    assert {r["round"] for r in out} == {1, 2, 3}
    assert len([r for r in out if r["round"] == 3]) == 1


def test_shards_differ_by_at_most_one(spark):
    pairs = q_apps._all_pairs(spark, SF01)
    sizes = [r["count"] for r in labels.assign_shards(pairs, 5).groupBy("shard").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sum(sizes) == pairs.count()


def test_split_is_disjoint_complete_and_30_percent(spark):
    e = S.table(spark, SF01, "embeddings")
    split = labels.train_validation_split(e, 0.3, label="label", key="vec_id", seed=7)
    rows = split.select("vec_id", "label", "split").collect()
    assert len(rows) == e.count() and len({r.vec_id for r in rows}) == len(rows)
    per_label = Counter(r.label for r in rows)
    val = Counter(r.label for r in rows if r.split == "validation")
    for lab, n in per_label.items():
        assert val[lab] == int(n * 0.3)


def test_bridge_keys_are_in_dimension(spark):
    m = q_mart.movies_whole(spark, SF01)
    for name in ("genres", "companies", "countries", "languages"):
        ent = N.ENTITIES[name]
        ex = N.explode_entities(m, ent)
        missing = N.bridge(ex, ent).join(N.dimension(ex, ent), ent.key[1], "left_anti").count()
        assert missing == 0, name


def test_surrogate_key_is_unique_and_dense(spark):
    dim = q_mart.mart_genre_dim(spark, SF01).collect()
    keys = sorted(r.genre_id for r in dim)
    assert keys == list(range(1, len(dim) + 1))
    assert len({r.genre_name for r in dim}) == len(dim)


def _skewed(spark, n=30000):
    # one label holds a third of all rows
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("label"),
        F.md5(F.col("id").cast("string")).alias("k"))


def test_global_index_is_exact_row_number(spark):
    df = _skewed(spark)
    got = {r.id: r.rn for r in global_index(df, ["k", "id"], "rn", ranges=7).collect()}
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id"))).collect()}
    assert got == want


def test_index_within_matches_window_under_skew(spark):
    df = _skewed(spark)
    got = {r.id: r.rn for r in index_within(df, ["label"], ["k", "id"], "rn", ranges=9).collect()}
    w = Window.partitionBy("label").orderBy("k", "id")
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_global_index_with_nulls_and_single_range(spark):
    df = spark.createDataFrame([(None,), ('b',), ('a',), (None,), ('c',)], 'k string').withColumn('i', F.monotonically_increasing_id())
    got = sorted((r.k is None, r.k, r.rn) for r in global_index(df, ['k', 'i'], 'rn', ranges=3).collect())
    assert [x[2] for x in sorted(got, key=lambda t: t[2])] == [1, 2, 3, 4, 5]
    assert {r.k: r.rn for r in global_index(df.where('k is not null'), ['k'], 'rn', ranges=1).collect()} == {'a': 1, 'b': 2, 'c': 3}


def test_global_index_empty_and_more_ranges_than_rows(spark):
    empty = spark.createDataFrame([], "k string")
    assert global_index(empty, ["k"], "rn", ranges=4).count() == 0
    small = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert {r.k: r.rn for r in global_index(small, ["k"], "rn", ranges=16).collect()} == {"a": 1, "b": 2, "c": 3}


def test_fewer_rows_than_shards(spark):
    df = spark.createDataFrame([("x", "g"), ("y", "g")], "imdb_id string, genre string")
    assert sorted(r.shard for r in labels.assign_shards(df, 5).collect()) == [0, 1]


def test_tournament_with_one_team(spark):
    t = spark.createDataFrame([("Solo", 1.0, 1.0, 1)],
                              "team_name string, top_average_speed double, top_average_height double, flight_count int")
    out = TR.tournament(t, n=4, seed=1).collect()
    assert {r.winner for r in out} == {"Solo"} and len(out) == 3
