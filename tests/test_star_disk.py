"""What the star schema's steps leave on disk while later ones run, and what they exchange."""

import os
import time
from datetime import datetime

import pytest
from conftest import SF001
from plan_report import plan_text
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakemart import session
from lakemart.functions.fixed import DENY_IMDB_IDS
from lakemart.operators import nested as N
from lakemart.operators.clean import deny_and_strip
from lakemart.plans import landing as L, nested_standins as NS
from lakemart.sources import readers as R


def _shuffles(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return files.mkString("\n").count("shuffle_")


def _scratch(spark) -> set[str]:
    folder = os.path.dirname(session.local_path(session.scratch_path(spark, "x")))
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def _settled(spark, at_most: int) -> bool:
    """Shuffle files are removed by a thread of their own."""
    for _ in range(50):
        if _shuffles(spark) <= at_most:
            return True
        time.sleep(0.1)
    return False


def test_a_landed_table_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    keep, before = spark.conf.get(key, None), _shuffles(spark)
    df, path = session.landed(spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).count(), "t-landed")
    assert _settled(spark, before) and spark.conf.get(key, None) == keep
    assert df.count() == 500
    session.remove(spark, path)
    with pytest.raises(Exception):
        session.landed(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), "t-fails")
    assert spark.conf.get(key, None) == keep


def test_star_counts_leave_only_the_counts(spark):
    scratch, before = _scratch(spark), _shuffles(spark)
    got = entry.queries()["mart_star_counts"](spark, SF001)
    left = _scratch(spark) - scratch
    assert len(left) == 14 and all(f.startswith("star-count-") for f in left)
    assert _settled(spark, before)
    assert got.columns == ["table", "rows"] and got.count() == 14


def test_a_source_goes_once_its_rows_are_landed(spark, monkeypatch):
    folders, seen = {}, {}
    sources = NS.file_sources(spark, SF001, folders)
    assert sorted(folders) == ["credits", "keywords", "metadata"]
    assert not [f for f in _scratch(spark) if f.startswith(("metadata-rows-", "metadata-items-"))]
    land = N.StarSchema.land

    def watch(self, df, name, *by, **more):
        seen[name] = {s for s, f in folders.items() if os.path.exists(session.local_path(f))}
        return land(self, df, name, *by, **more)
    monkeypatch.setattr(N.StarSchema, "land", watch)
    star = N.star_schema(*sources, landed_source=lambda s: session.remove(spark, folders[s]))
    assert seen == {"metadata": {"metadata", "credits", "keywords"}, "entities-metadata": {"credits", "keywords"},
                    "entities-credits": {"credits", "keywords"}, "entities-keywords": {"keywords"}}
    assert star["actors_movies_ext"].count() > 0
    star.release()


def test_parts_of_a_table_read_as_one(spark):
    parts = {v: spark.range(n).select(F.lit(v).alias("kind"), "id") for v, n in (("a", 3), ("b", 0), ("c", 2))}
    df, path = session.landed_parts(parts, "kind", "t-parts")
    assert df.columns == ["kind", "id"] and dict(df.dtypes)["kind"] == "string"
    assert sorted(map(tuple, df.collect())) == [("a", 0), ("a", 1), ("a", 2), ("c", 0), ("c", 1)]
    assert "PartitionFilters" in plan_text(df.where("kind = 'a'")) and df.where("kind = 'b'").count() == 0
    session.remove(spark, path)


def _tables(spark) -> str:
    d = session.scratch_path(spark, "t-star")
    tables = {
        "region": ([(0, "R"), (1, "Q"), (1, "Q")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0), (1, "M", 1), (2, "L", 9), (None, "K", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "S", 0), (2, "T", 1), (3, "U", 2), (4, "V", None), (5, "W", 7)],
                     "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(1, "P", "T", 5), (2, None, "O", None), (3, 'x\r\ny "z", \'w\'\r', "", 7)], "p_partkey long, p_name string, p_type string, p_size int"),
        "orders": ([(k, 1, "F", 10.0, datetime(2000, 1, 1), "5-LOW") for k in [*range(1, 30), 2, None, None]],
                   "o_orderkey int, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k, 1 + (k or 0) % 3, 1 + ((k or 0) + n) % 6, n, "R" if n else None) for k in [*range(1, 26), None, 99] for n in range(3)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def test_items_of_an_order_equal_the_plain_joins(spark):
    d = _tables(spark)
    li, s, n, r, p = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("lineitem", "supplier", "nation", "region", "part"))
    flat = (li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey).join(p, li.l_partkey == p.p_partkey))
    values = ["p_partkey", "p_name", "s_name", "s_suppkey", "n_nationkey", "n_name", "r_regionkey", "r_name",
              "l_linenumber", "l_returnflag", "p_size", "p_type"]
    items = {}
    for row in flat.select("l_orderkey", *values).collect():
        items.setdefault(row[0], []).append(repr(tuple(row[1:])))
    keys = [*range(1, 30), 2, None, None]
    want = sorted(((k, sorted(items.get(k, []) if k else [])) for k in keys), key=repr)
    assert any(len(v) > len(set(v)) for v in items.values())          # a region that comes twice

    def rows(df):
        return [(x[0], sorted(repr(tuple(i[c] for c in values)) for i in x[1])) for x in df.select("_o.o_orderkey", "_items").collect()]
    assert sorted(rows(NS.order_items(spark, d)), key=repr) == want
    landed, _ = session.landed(NS.item_values(spark, d), "t-items")
    parts = [rows(NS.order_items(spark, d, items=landed, part=(i, 3))) for i in range(3)]
    assert sorted(sum(parts, []), key=repr) == want and all(parts)


def test_large_exchanges_are_not_on_disk_together(spark, monkeypatch):
    d, seen, land = _tables(spark), [], session.landed_parts
    monkeypatch.setattr(L, "ORDER_PARTS", 3)

    def watch(parts, by, name):
        seen.append([plan_text(df).count("REPARTITION_BY_COL") for df in parts.values()])
        assert all("SortMergeJoin" not in plan_text(df) for df in parts.values())
        return land(parts, by, name)
    monkeypatch.setattr(session, "landed_parts", watch)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        movies, credits, keywords = L.movie_files(spark, d)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert len(seen) == 1 and len(seen[0]) == 3 and all(seen[0])
    assert credits.count() == keywords.count() == 32


def test_files_of_the_star_are_read_without_an_exchange(spark):
    folders = {}
    sources = L.movie_files(spark, _tables(spark), folders)
    schemas = {"metadata": L.METADATA_SCHEMA, "credits": L.CREDITS_SCHEMA, "keywords": L.KEYWORDS_SCHEMA}
    for got, (name, schema) in zip(sources, schemas.items()):
        want = R.read_csv_multiline(spark, folders[name], schema)
        if name == "metadata":
            want = deny_and_strip(want, "imdb_id", DENY_IMDB_IDS)
        assert "Exchange" not in plan_text(got) and "Exchange" in plan_text(want)
        assert got.schema == want.schema
        rows = sorted(map(repr, got.collect()))
        assert rows == sorted(map(repr, want.collect())) and len(rows) >= 30
        assert name != "metadata" or any("x\\r\\ny" in r for r in rows)
