"""Steps whose work per task, or per evaluation of their input, must not grow with the tables."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from lakemart.functions import select as S
from lakemart.plans import landing as L
from lakemart.plans import nested_standins as NS
from lakemart.session import local_path, scratch_path
from lakemart.sources.readers import read_csv_multiline


def _parts(path: str) -> list[str]:
    return [f for f in os.listdir(local_path(path)) if f.startswith("part-")]


def test_metadata_files_are_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(L, "CSV_RECORDS", 40)
    df = spark.range(1000).select(F.lit("[]").alias("cast"), F.lit('a\n"b",').alias("crew"), F.col("id").cast("int").alias("id")).repartition(4)
    path = L._csv_files(df, L.CREDITS_SCHEMA, "t-credits")
    assert len(_parts(path)) >= 25
    got = read_csv_multiline(spark, path, L.CREDITS_SCHEMA)
    assert sorted(r.id for r in got.collect()) == list(range(1000))
    assert {(r.cast, r.crew) for r in got.collect()} == {("[]", 'a\n"b",')}


def test_open_ranges_share_their_passes(spark, monkeypatch):
    monkeypatch.setattr(S, "SPLITTERS", 7)
    monkeypatch.setattr(S, "SAMPLED", 100)
    monkeypatch.setattr(S, "FETCH", 50)
    seen = spark.sparkContext.accumulator(0)
    rdd = spark.sparkContext.parallelize(range(4000), 2).map(lambda i: (seen.add(1), (f"k{i:05d}",))[1])
    df = spark.createDataFrame(rdd, "a string")
    ranks = [500, 1000, 1500, 2000, 2500, 3000, 3500]
    assert [c.key[0] for c in S.cuts(df, ["a"], ranks, 4000)] == [f"k{r - 1:05d}" for r in ranks]
    assert seen.value <= 4000 * 14                        # a few rounds of at most three passes, not of two a range


def test_orders_without_or_with_repeated_keys_keep_their_rows(spark):
    d = scratch_path(spark, "t-orders")
    tables = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "S", 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(1, "P", "T", 5)], "p_partkey long, p_name string, p_type string, p_size int"),
        "orders": ([(k, 1, "F", 10.0, datetime(2000, 1, 1), "5-LOW") for k in (1, 2, 2, None, None, 3)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 1, 1, 1, "N"), (2, 1, 1, 1, "N"), (2, 1, 1, 2, "R"), (None, 1, 1, 1, "N"), (3, 9, 1, 1, "N"), (4, 1, 1, 1, "N")],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    got = sorted(((r.id, r.keywords) for r in NS.metadata_text(spark, d).collect()), key=repr)
    one = "{'id': 5, 'name': 'T'}"
    assert got == sorted([(1, f"[{one}]"), (2, f"[{one}, {one}]"), (2, f"[{one}, {one}]"), (None, None), (None, None), (3, None)], key=repr)
