"""Exact selection: order statistics, shard ranges, per-group cuts."""

import random

import pytest
from pyspark.sql import functions as F

from lakemart.functions import select as S
from lakemart.operators import labels as LB
from plan_report import plan_text


@pytest.fixture
def small(monkeypatch):
    """Rounds with few splitters and tiny fetches, so that every path runs."""
    monkeypatch.setattr(S, "SPLITTERS", 3)
    monkeypatch.setattr(S, "SAMPLED", 24)
    monkeypatch.setattr(S, "FETCH", 6)


def _rows(kind: str) -> list[tuple]:
    rng = random.Random(5)
    if kind == "distinct":
        return [(f"k{i:04d}", None if i % 50 == 0 else rng.choice("abc")) for i in range(400)]
    if kind == "hot":                                   # one key holds most rows, the smallest one at that
        return [("a", "x")] * 300 + [(rng.choice("bcdefg"), rng.choice(["x", None])) for _ in range(60)]
    return [(None, None)] * 40 + [("z", "z")] * 200 + [(None, "a")] * 30


@pytest.mark.parametrize("kind", ["distinct", "hot", "nulls"])
def test_cuts_equal_the_sorted_rows(spark, small, kind):
    rows = _rows(kind)
    df = spark.createDataFrame(rows, "a string, b string").repartition(3)
    ordered = sorted(rows, key=lambda r: tuple((v is not None, v or "") for v in r))
    ranks = [1, 2, 17, len(rows) // 2, len(rows) - 1, len(rows)]
    for rank, cut in zip(ranks, S.cuts(df, ["a", "b"], ranks)):
        assert cut.key == ordered[rank - 1]
        assert (cut.below, cut.ties) == (ordered.index(cut.key), ordered.count(cut.key))


@pytest.mark.parametrize("kind", ["distinct", "hot", "nulls"])
def test_place_cuts_like_ntile_also_inside_repeats(spark, small, kind):
    rows = [(a, b, i % 3) for i, (a, b) in enumerate(_rows(kind))]
    df = spark.createDataFrame(rows, "a string, b string, c int").repartition(3)
    got = LB.assign_shards(df, 7, order=("a", "b")).collect()
    assert sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, rows))
    sizes = [sum(r.shard == s for r in got) for s in range(7)]
    assert sizes == [e - s for s, e in LB.balanced_ranges(len(rows), 7)]
    key = [tuple((v is not None, v or "") for v in (r.a, r.b)) for r in got]
    for s in range(6):
        assert max(k for k, r in zip(key, got) if r.shard == s) <= min(k for k, r in zip(key, got) if r.shard == s + 1)


def test_shards_of_few_or_no_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "imdb_id string, genre string")
    assert sorted((r.imdb_id, r.shard) for r in LB.assign_shards(df, 5).collect()) == [("a", 0), ("b", 1)]
    assert LB.assign_shards(df.limit(0), 5).collect() == []


def test_shard_plan_places_rows_without_exchange(spark):
    df = spark.range(50_000).select(F.format_string("tt%07d", "id").alias("imdb_id"), F.lit("g").alias("genre"))
    placed = LB.assign_shards(df, 5)
    text = plan_text(placed)
    assert "Exchange" not in text and "Window" not in text
    assert [r["count"] for r in placed.groupBy("shard").count().orderBy("shard").collect()] == [10_000] * 5


def test_split_equals_the_sorted_draws_with_a_hot_label(spark):
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"l{i % 7}", i % 900) for i in range(3000)]
    df = spark.createDataFrame(rows, "label string, id int").repartition(4)
    split = LB.train_validation_split(df, 0.3, seed=11)
    drawn = split.select("label", "split", LB.draw_key(11, "id").alias("d")).collect()
    for label in {r.label for r in drawn}:
        mine = sorted((r.d, r.split) for r in drawn if r.label == label)
        cut = mine[int(len(mine) * 0.3) - 1][0]
        assert all((s == "validation") == (d <= cut) for d, s in mine)
    text = plan_text(split)
    assert "rangepartitioning" not in text.lower() and "SinglePartition" not in text


def test_split_takes_nothing_where_the_fraction_is_below_one_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "label string, id int")
    assert {r.split for r in LB.train_validation_split(df, 0.3).collect()} == {"train"}
    assert LB.train_validation_split(df.limit(0), 0.3).collect() == []


def test_group_cuts_inside_one_bin(spark):
    # draws that share their leading digits: the histogram leaves one bin to refine
    df = spark.range(500).select(F.lit("g").alias("g"), F.format_string("abcd%04x", F.col("id") % 100).alias("d"))
    cut = S.group_cuts(df, "g", "d", F.col("n") / 2).first()
    assert cut["cut"] == sorted(f"abcd{i % 100:04x}" for i in range(500))[249]


def test_fetch_plan_with_one_id_on_a_third_of_the_rows(spark):
    rows = [(0, "hot", f"g{i % 9}") for i in range(3000)] + [(i % 4, f"id{i % 2500}", f"g{i % 5}") for i in range(6000)]
    rows += [(1, "n", None), (1, "n", None), (2, "m", None), (2, "m", "a")]
    df = spark.createDataFrame(rows, "shard int, imdb_id string, genre string").repartition(6)
    plan = LB.fetch_plan(df)
    got = plan.collect()
    assert len(got) == len(rows)
    hot = [r for r in got if r.imdb_id == "hot"]
    assert sorted(r.genre for r in hot if r.action == "copy") == [f"g{i}" for i in range(1, 9)]
    assert [r.genre for r in hot if r.action == "fetch"] == ["g0"] and all(r.source == "images/g0/hot.jpg" for r in hot if r.action == "copy")
    assert sorted((r.action, r.genre) for r in got if r.imdb_id == "n") == [("fetch", None), ("present", None)]
    assert sorted((r.action, r.genre or "") for r in got if r.imdb_id == "m") == [("copy", ""), ("fetch", "a")]
    text = plan_text(plan)
    assert "Window" not in text and "partial_count" in text and "partial_min" in text
