"""The end-to-end jobs at sf0.001: outputs exist and agree with the queries."""

import os

import pytest

from conftest import SF001
from lakemart import jobs
from lakemart.session import local_path, scratch_path


@pytest.mark.parametrize("name", sorted(jobs.JOBS))
def test_job_runs_and_writes(spark, name):
    out = scratch_path(spark, f"job-{name}")
    kwargs = {"db": f"t_job_{name}"} if name in ("lake", "star") else {}
    counts = jobs.JOBS[name](spark, SF001, out, **kwargs)
    tables = {k: v for k, v in counts.items() if not k.startswith("unparsed_")}
    assert tables and all(v > 0 for v in tables.values()), counts
    assert os.listdir(local_path(out))
    if name == "star":
        assert len(tables) == 14
        assert {k: v for k, v in counts.items() if k.startswith("unparsed_")} == {
            f"unparsed_{e}": 0 for e in ("companies", "countries", "languages", "genres", "actors", "keywords")}
    if name == "teams":
        assert counts == {"teams": 8, "tournament": 7}
    if name == "heroes":
        assert set(counts) == {"top_good", "top_bad"} and max(counts.values()) <= 10
    if "db" in kwargs:
        spark.sql(f"DROP SCHEMA {kwargs['db']} CASCADE")


def test_keywords_job_matches_query(spark):
    import __spark_entry__ as entry
    out = scratch_path(spark, "job-kw")
    counts = jobs.keywords_job(spark, SF001, out)
    assert counts["resultset"] == entry.queries()["text_keywords"](spark, SF001).count()
    back = spark.read.option("header", True).csv(f"{out}/resultset")
    assert back.columns == ["ArticleID", "Category", "Tag", "Frequency"]


def test_labels_from_bucketed_mart_match_and_join_without_shuffle(spark):
    import contextlib
    import io
    from lakemart.sources import readers as R
    db = "t_job_bucketed"
    jobs.star_job(spark, SF001, scratch_path(spark, "job-star-b"), db=db, buckets=4)
    from_mart = jobs.labels_job(spark, SF001, scratch_path(spark, "job-labels-m"), n=None, db=db)
    direct = jobs.labels_job(spark, SF001, scratch_path(spark, "job-labels-d"), n=None)
    assert from_mart == direct
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # force the sort-merge join
    try:
        movies, bridge = R.read_table(spark, f"{db}.movies_table_ext"), R.read_table(spark, f"{db}.genres_movies_ext")
        joined = movies.select("id", "imdb_id").join(bridge, movies.id == bridge.movie_id)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP SCHEMA {db} CASCADE")


def test_cli_prints_counts(spark, capsys):
    import json
    out = scratch_path(spark, "job-cli")
    jobs.main(["teams", "--sf", SF001, "--out", out])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"teams": 8, "tournament": 7}
