"""Sources, sinks, catalog and the incremental ingest on small files made here."""

import os

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakemart.operators import clean
from lakemart.session import scratch_path, local_path
from lakemart.sources import catalog as C, readers as R, sinks as K
from lakemart.streaming.ingest import ingest


def _write(path, name, text):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), name), "w") as f:
        f.write(text)
    return path


def test_read_delimited_quotes_and_trailing_separator(spark):
    p = _write(scratch_path(spark, "t-delim"), "r.csv",
               '1,10,3.5,01/05/2001 10:00:00,\n2,"20",4,1/5/2001 9:05:00,\n')
    df = R.read_delimited(spark, p, ["user_id", "movie_id", "rating", "created_at"], trailing_sep=True)
    assert df.columns == ["user_id", "movie_id", "rating", "created_at"]
    typed = clean.conform_ratings(df).orderBy("user_id").collect()
    assert [r.rating for r in typed] == [3.5, 4.0]
    assert [str(r.created_at) for r in typed] == ["2001-01-05 10:00:00", "2001-01-05 09:05:00"]
    integral = clean.conform_ratings(df, integral=True).orderBy("user_id").collect()
    assert [r.rating for r in integral] == [3, 4]


def test_read_delimited_without_quotes_splits_every_separator(spark):
    p = _write(scratch_path(spark, "t-noquote"), "m.csv", '1,"Foo, The (1995)",Drama\n')
    honoured = R.read_delimited(spark, p, ["movie_id", "title", "genres"]).collect()[0]
    plain = R.read_delimited(spark, p, ["movie_id", "title", "genres"], quotes=False).collect()[0]
    assert (honoured.title, honoured.genres) == ("Foo, The (1995)", "Drama")
    assert (plain.title, plain.genres) == ('"Foo', ' The (1995)"')


def test_conform_users_bad_dates_are_null(spark):
    p = _write(scratch_path(spark, "t-users"), "u.csv", "7,Ann,Lee,13/45/1990,GE,02/03/2015\nx,Bo,Li,,GE,bad\n")
    rows = clean.conform_users(R.read_delimited(spark, p, ["user_id", "first_name", "last_name", "birth_date",
                                                           "country", "registration_date"])).collect()
    good = [r for r in rows if r.user_id == 7][0]
    assert good.birth_date is None and str(good.registration_date) == "2015-02-03" and good.registration_year == 2015
    bad = [r for r in rows if r.user_id is None][0]
    assert bad.registration_date is None and bad.registration_year is None


def test_multiline_csv_directory_and_per_field_nulls(spark):
    root = scratch_path(spark, "t-multi")
    _write(root, "part-0.csv", 'id,revenue,overview\n1,5,"line one\nline ""two"""\n')
    _write(root, "part-1.csv", 'id,revenue,overview\n2,99999999999,"a, b"\n')
    schema = StructType([StructField("id", IntegerType()), StructField("revenue", IntegerType()),
                         StructField("overview", StringType())])
    rows = {r.id: r for r in R.read_csv_multiline(spark, root, schema).collect()}
    assert rows[1].overview == 'line one\nline "two"' and rows[1].revenue == 5
    assert rows[2].revenue is None and rows[2].overview == "a, b"


def test_wordlist_and_labelled_files(spark):
    p = _write(scratch_path(spark, "t-words"), "w.txt", "a\nthe\n\n.\na\n")
    assert sorted(r.word for r in R.read_wordlist(spark, p).collect()) == ["", ".", "a", "the"]
    root = scratch_path(spark, "t-files")
    _write(os.path.join(root, "Drama"), "tt1.jpg", "xx")
    _write(os.path.join(root, "Comedy"), "tt1.jpg", "xxx")
    files = {(r.label, r.length) for r in R.scan_labelled_files(spark, root).collect()}
    assert files == {("Drama", 2), ("Comedy", 3)}


def test_sinks_round_trip(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t_sinks")
    df = spark.createDataFrame([(1, "GE", 2015), (2, "GE", 2016), (3, "US", 2015)],
                               "user_id int, country string, registration_year int")
    ext = K.save_external(df, scratch_path(spark, "t-ext"), "t_sinks.ext")
    assert ext.count() == 3 and C.table_type(spark, "t_sinks.ext") == "EXTERNAL"
    part = K.save_partitioned(df, scratch_path(spark, "t-part"), "t_sinks.part", ["country", "registration_year"])
    assert part.columns[-2:] == ["country", "registration_year"] and part.count() == 3
    # dynamic overwrite of one partition keeps the others
    K.insert_into(spark.createDataFrame([(9, "GE", 2015)], df.schema).select("user_id", "country",
                                                                             "registration_year"),
                  "t_sinks.part", overwrite=True)
    assert sorted(r.user_id for r in spark.table("t_sinks.part").collect()) == [2, 3, 9]
    ctas = K.create_table_as(spark, "t_sinks.ctas", "SELECT country, count(*) AS n FROM t_sinks.ext GROUP BY country")
    assert {(r.country, r.n) for r in ctas.collect()} == {("GE", 2), ("US", 1)}
    path = K.export_parquet(spark, "t_sinks.ctas", scratch_path(spark, "t-export"))
    assert path.endswith("/t_sinks.ctas.parquet") and spark.read.parquet(path).count() == 2
    out = K.write_csv(df, scratch_path(spark, "t-csv"), header=True, keys=["country"])
    assert {"country=GE", "country=US"} <= set(os.listdir(local_path(out)))
    spark.sql("DROP SCHEMA t_sinks CASCADE")


def test_catalog_lifecycle(spark):
    db = "t_catalog"
    C.create_database(spark, db, location=scratch_path(spark, "t-db"))
    assert C.database_exists(spark, db)
    C.describe_database(spark, db, "it's a mart")
    assert C.database_comment(spark, db) == "it's a mart"
    C.create_table(spark, f"{db}.t", StructType([StructField("a", IntegerType())]))
    assert spark.table(f"{db}.t").count() == 0
    C.drop_table(spark, f"{db}.t")
    assert not spark.catalog.tableExists(f"{db}.t")
    C.drop_database(spark, db)
    C.drop_database(spark, db)  # missing is fine
    assert not C.database_exists(spark, db)


def test_incremental_ingest_picks_up_only_new_files(spark):
    landing = scratch_path(spark, "t-landing")
    target, ckpt = scratch_path(spark, "t-target"), scratch_path(spark, "t-ckpt")
    cols = ["user_id", "movie_id", "rating", "created_at"]
    _write(landing, "a.csv", "1,10,3.5,01/05/2001 10:00:00,\n")
    ingest(spark, landing, cols, clean.conform_ratings, target, ckpt, trailing_sep=True)
    assert spark.read.parquet(target).count() == 1
    _write(landing, "b.csv", "2,20,n/a,01/06/2001 10:00:00,\n3,30,2,01/07/2001 10:00:00,\n")
    ingest(spark, landing, cols, clean.conform_ratings, target, ckpt, trailing_sep=True)
    rows = spark.read.parquet(target).orderBy("user_id").collect()
    assert [r.user_id for r in rows] == [1, 2, 3] and rows[1].rating is None


def test_save_star_schema_writes_external_tables(spark):
    from conftest import SF001
    from lakemart.operators import nested as N
    from lakemart.plans import nested_standins as NS
    star = N.star_schema(NS.movies_whole(spark, SF001), NS.credits_text(spark, SF001),
                         NS.keywords_text(spark, SF001), NS.ratings_raw(spark, SF001))
    saved = K.save_star_schema(star, scratch_path(spark, "t-mart"), "t_mart")
    assert len(saved) == 14
    for name, df in star.items():
        assert C.table_type(spark, f"t_mart.{name}") == "EXTERNAL"
        assert saved[name].count() == df.count(), name
    spark.sql("DROP SCHEMA t_mart CASCADE")


def test_incremental_ingest_into_partitions(spark):
    from pyspark.sql import functions as F
    landing = scratch_path(spark, "t-landing-p")
    target, ckpt = scratch_path(spark, "t-target-p"), scratch_path(spark, "t-ckpt-p")
    cols = ["user_id", "movie_id", "rating", "created_at"]

    def typed(df):
        return clean.conform_ratings(df).withColumn("year", F.year("created_at"))

    _write(landing, "a.csv", "1,10,3.5,01/05/2001 10:00:00,\n2,11,4,03/02/2002 10:00:00,\n")
    ingest(spark, landing, cols, typed, target, ckpt, partition_by=["year"], trailing_sep=True)
    _write(landing, "b.csv", "3,12,5,07/07/2001 10:00:00,\n")
    ingest(spark, landing, cols, typed, target, ckpt, partition_by=["year"], trailing_sep=True)
    assert {"year=2001", "year=2002"} <= set(os.listdir(local_path(target)))
    got = sorted((r.year, r.user_id) for r in spark.read.parquet(target).collect())
    assert got == [(2001, 1), (2001, 3), (2002, 2)]
