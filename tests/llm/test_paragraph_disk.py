"""What the steps of the paragraph dedup leave on disk while later ones run."""
import glob
import os

from lakemart.llm import paragraphs as P
from lakemart.llm import scratch
from lakemart.session import local_path
from pyspark.sql import functions as F


def test_shuffle_files_of_ended_steps_are_removed(spark):
    def held():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")
    scratch.sweep(spark)
    before = held()
    _, path = scratch.land(spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.min(F.struct("id")).alias("m")), "swept")
    assert held() > before
    scratch.sweep(spark)
    assert held() <= before
    scratch.drop(spark, path)


def test_passages_start_without_tables_of_the_units(spark, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(80))
    near = passage.split()
    near[40] = "other"
    rows = [(0, f"Start here. {passage}. End."), (1, f"Other start {passage}"), (2, " ".join(near) + ". And so on it goes.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    folder = os.path.dirname(local_path(scratch.scratch_path(spark, "x")))
    old, seen, land = set(glob.glob(folder + "/llm-*")), {}, P.land

    def watch(df, name):
        out = land(df, name)
        seen[name] = {os.path.basename(p)[4:-13] for p in set(glob.glob(folder + "/llm-*")) - old}
        return out
    monkeypatch.setattr(P, "land", watch)
    assert P.repeated_paragraphs(docs).select("doc_id").distinct().count() >= 2
    assert seen["paragraph-reach"] == {"paragraphs", "paragraph-components", "paragraph-reach"}
    assert seen["passage-windows"] == {"paragraph-rows", "passage-windows"}
