"""Keys that stay, the tagged entity table, knock-out folds, pair blocks, the fit certificate."""

import itertools

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from lakemart import session
from lakemart.operators import labels as LB, nested as N, roster as RO, tournament as TR
from lakemart.plans import nested_standins as NS, standins as ST
from lakemart.sources import sinks as K
from plan_report import plan_text, summarize

TEAM = "team_name string, top_average_speed double, top_average_height double, flight_count int"


def test_a_refresh_changes_no_old_key(spark):
    def names(*x):
        return spark.createDataFrame([(v,) for v in x], "g string")
    first = N.surrogate_key(names("b", "d", "b", None), "g", "k")
    second = N.surrogate_key(names("a", "c", "d", "e", "c", None), "g", "k", existing=first)
    third = N.surrogate_key(names("aa"), "g", "k", existing=second)
    assert sorted((r.k, r.g) for r in second.collect()) == [(1, "b"), (2, "d"), (3, "a"), (4, "c"), (5, "e")]
    assert sorted((r.k, r.g) for r in third.collect()) == [(1, "b"), (2, "d"), (3, "a"), (4, "c"), (5, "e"), (6, "aa")]
    empty = N.surrogate_key(names("z"), "g", "k", existing=first.limit(0))
    assert [(r.k, r.g) for r in empty.collect()] == [(1, "z")]
    assert N.surrogate_key(names("b"), "g", "k", existing=first).count() == 2
    assert dict(first.dtypes) == dict(second.dtypes)


def test_tagged_entities_equal_the_single_columns(spark):
    movies = NS.movies_whole(spark, SF001)
    odd = spark.createDataFrame([(-1, None, "[", "[]", "[{'id': None, 'name': 'x'}]")],
                                "id int, production_companies string, production_countries string, spoken_languages string, genres string")
    movies = movies.select(*odd.columns).unionByName(odd)
    ents = {k: e for k, e in N.ENTITIES.items() if e.source == "metadata"}
    tagged = N.tagged_entities(movies, ents)
    for name, e in {**ents, "actors": N.ENTITIES["actors"]}.items():
        src = movies if name in ents else NS.credits_text(spark, SF001)
        t = tagged if name in ents else N.tagged_entities(src, {name: e})
        got, want = N.entity_rows(t, name, e), N.explode_entities(src, e)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_star_schema_writes_once_per_source_and_drops_its_folders(spark):
    star = N.star_schema(NS.movies_whole(spark, SF001), NS.credits_text(spark, SF001),
                         NS.keywords_text(spark, SF001), NS.ratings_raw(spark, SF001))
    assert len(star) == 14 and len(star.folders) == 4          # three tagged tables and the movie columns
    text = plan_text(star["genres_movies_ext"])
    assert "PartitionFilters" in text and "genres" in text.split("PartitionFilters")[1][:80]
    paths = list(star.folders)
    star.release()
    fs = spark._jvm.org.apache.hadoop.fs.Path(paths[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not any(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p)) for p in paths)


def test_scratch_lies_in_one_folder_of_the_application(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0] and spark.sparkContext.applicationId in a
    df, path = session.landed(spark.range(3), "gone")
    session.remove(spark, path)
    assert df.columns == ["id"] and not spark._jvm.java.io.File(session.local_path(path)).exists()


def test_pairs_of_a_large_bracket_spread_over_tasks(spark):
    n = 5000
    teams = spark.range(n).select(F.format_string("t%05d", "id").alias("team_name"), (F.col("id") % 97).cast("double").alias("top_average_speed"),
                                  (F.col("id") % 89).cast("double").alias("top_average_height"), (F.col("id") % 3).cast("int").alias("flight_count"),
                                  F.lit(0).alias("bracket"))
    # a shuffled join, as on teams too many to broadcast
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = TR.pairs(teams.repartition(4))
        per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sum(per_task) == n * (n - 1) // 2
    assert len(per_task) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(per_task) < 0.3 * sum(per_task)


def test_pair_blocks_equal_all_combinations(spark):
    names = [f"n{i}" for i in range(40)] + [None, "n3"]
    rows = [(t, float(i), 1.0, i % 2, i % 3) for i, t in enumerate(names)]
    df = spark.createDataFrame(rows, TEAM + ", bracket int")
    want = sorted((a[4], *sorted((a[0], b[0]))) for a, b in itertools.combinations([r for r in rows if r[0]], 2) if a[4] == b[4] and a[0] != b[0])
    for block in (1, 4, 1000):
        got = TR.pairs(df, block=block)
        assert sorted((r.bracket, r.team_a, r.team_b) for r in got.collect()) == want
        assert all(r.team_a < r.team_b for r in got.collect())
        speed = {(r[0], r[1]) for r in rows}
        assert all((r.team_a, r.a_top_average_speed) in speed and (r.team_b, r.b_top_average_speed) in speed for r in got.collect())


def test_knock_out_equals_rounds_of_pairs(spark):
    rows = [(f"team {i * 7 % 23:02d}", float(i % 5), float(i % 7) if i % 6 else None, i % 3) for i in range(23)]
    teams = spark.createDataFrame(rows, TEAM)
    for n in (1, 3, 4, 8):
        got = {tuple(r) for r in TR.tournament(teams, n=n, seed=3).collect()}
        want, current, rnd = set(), session.cut_lineage(TR.draw_brackets(teams, n, 3)), 1
        width = n
        while True:
            won = TR.play_round(current).collect()
            want |= {(rnd, r.bracket, r.winner, r.wins) for r in won}
            if width <= 1:
                break
            nxt = spark.createDataFrame([(r.bracket // 2, r.winner) for r in won], "bracket int, team_name string")
            current = session.cut_lineage(nxt.join(teams, "team_name"))
            width, rnd = (width + 1) // 2, rnd + 1
        assert got == want, n


def test_knock_out_is_one_small_lazy_plan(spark):
    teams = spark.createDataFrame([(f"t{i}", 1.0, 2.0, 0) for i in range(64)], TEAM)
    plans = [summarize(plan_text(TR.tournament(teams, n=n)))["shuffles"] for n in (4, 16, 64)]
    assert plans[0] == plans[1] == plans[2] <= 2                 # the draw's exchange serves every round
    text = plan_text(TR.tournament(teams, n=64))
    assert "Join" not in text and "parquet" not in text.lower()  # nothing paired by a join, nothing landed


def test_certificate_tells_a_fit_from_an_unfinished_one(spark):
    data = LB.to_features(spark.range(300).select(
        (F.col("id") % 3).cast("int").alias("label"),
        F.array(*[F.when(F.col("id") % 3 == k, 1.0).otherwise(0.0) + F.rand(k) for k in range(3)]).alias("embedding")))
    data = session.cut_lineage(data)
    done = LB.fit_certificate(LB.train_classifier(data, max_iter=200, reg=0.05, tol=1e-9, standardize=False), data, reg=0.05).first()
    early = LB.fit_certificate(LB.train_classifier(data, max_iter=1, reg=0.05, standardize=False), data, reg=0.05).first()
    assert done.gradient_norm < 1e-4 < early.gradient_norm
    assert done.objective < early.objective < done.null_loss and abs(done.null_loss - 1.0986) < 1e-3
    assert done.shifted_objective >= done.objective and early.shifted_objective < early.objective


def test_preview_rows_and_clustered_buckets(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b.c` string")
    assert [tuple(r) for r in K.preview_rows(df, 5).collect()] == [("1", "NULL"), ("2", "x")]
    assert K.preview_rows(df, 1).count() == 1
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_buckets")
    path = session.scratch_path(spark, "t-buckets")
    K.save_external(spark.range(1000).repartition(16), path, "t_buckets.b", bucket_by=["id"], buckets=4)
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files == 4 and spark.table("t_buckets.b").count() == 1000
    assert "Exchange" not in plan_text(spark.table("t_buckets.b").groupBy("id").count())
    spark.sql("DROP SCHEMA t_buckets CASCADE")


def test_integral_ratings_of_the_landing_file_hold_no_impossible_value(spark):
    r = entry.queries()["prj_conform_ratings"](spark, SF001)
    n = r.agg(F.count_if(F.isnan("rating")).alias("nan"), F.count_if(F.abs("rating") == 1e12).alias("big"),
              F.count_if(F.col("rating").isNull()).alias("none")).first()
    whole = entry.queries()["prj_conform_ratings_integral"](spark, SF001)
    assert min(n) > 0 and whole.where(F.col("rating").isNull()).count() == sum(n)


def test_draft_from_raw_tables_equals_teams_of_the_aligned_ones(spark):
    raw = [f(spark, SF001) for f in (ST.hero_stats, ST.hero_info, ST.hero_powers)]
    nobody = spark.createDataFrame([(None,), ("only powers",)], "name string")
    raw[2] = raw[2].unionByName(nobody, allowMissingColumns=True)
    for n_teams, size, seed in ((8, 5, 42), (3, 4, 1), (40, 5, 9)):
        want = RO.build_teams(*RO.aligned_heroes(*raw), n_teams, size, seed)
        got = RO.draft_teams(*raw, n_teams, size, seed)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    empty = [t.limit(0) for t in raw]
    assert RO.draft_teams(*empty).collect() == []
