"""Pipeline stages on clashing column names, repeated and missing ids, and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from conftest import SF001
from lakemart.llm import langid, scratch, toxicity
from lakemart.session import local_path

TEXT = "The committee met on Monday to discuss the harvest and the weather of the coming season in the valley."
SHAPE = ("doc_id bigint, text string, lang string, source string, n_chars bigint, _id int, _row int, part int, row int, `a.b` string, "
         "id string, key string, d int, h int, _h string, _x string, first int")


def table(spark, rows):
    full = [(i, t, la, s, len(t or ""), 1, 2, 3, 4, "x", "y", "z", 5, 6, "p", "q", 7) for i, t, la, s in rows]
    return spark.createDataFrame(full, SHAPE).repartition(2)


@pytest.fixture(scope="module")
def rows():
    return [(i, f"{TEXT} Number {i} of {i * 7919} pages.", "en", "news" if i % 3 else "web") for i in range(40)] + [
        (3, "another text under a used id, with words of its own and nothing else", None, None),
        (None, "a row without id that is as good as any other row of the table here", "de", "web"),
        (None, None, None, None), (100, "", "", ""), (101, " \n ", "en", "web"), (101, " \n ", "en", "web")]


def test_stages_take_any_extra_columns_and_keep_rows(spark, rows):
    docs = table(spark, rows)
    for name, stage in CP.STAGES:
        out = stage(spark, docs, SF001)
        assert name == "tokens" or out.columns == CP.COLUMNS
        docs, _ = scratch.land(out, f"test-{name}")
        if name != "tokens":
            assert docs.where("text like 'another text under%'").count() >= 1
            assert docs.where("text like 'a row without id%'").count() >= 1
            # the next stage meets clashing names again
            docs = docs.select("*", *[F.lit(1).alias(c) for c in ("_id", "_row", "part", "row", "a.b", "id", "key", "d", "h", "first")])
    assert docs.count() > 0


def test_pipeline_on_an_empty_table_gives_no_rows(spark, rows):
    docs = table(spark, rows).limit(0)
    for name, stage in CP.STAGES:
        docs, _ = scratch.land(stage(spark, docs, SF001), f"empty-{name}")
        assert docs.count() == 0


def test_a_stage_drops_what_the_stage_before_wrote(spark, rows):
    docs = table(spark, rows).select(*CP.COLUMNS)
    kept, _ = scratch.land(CP.near_dedup(spark, docs, SF001), "test-kept")
    left = list(CP._left)
    assert left
    CP.decontaminate(spark, kept, SF001)
    exists = [spark._jvm.java.io.File(local_path(p)).exists() for p in left]
    assert not any(exists) and kept.count() > 0
    # a folder that the next stage's documents still read stays
    lazy = CP.near_dedup(spark, docs, SF001)
    CP.decontaminate(spark, lazy, SF001)
    assert lazy.count() == kept.count()


def test_ties_and_repeated_rows_get_equal_scores(spark):
    docs = spark.createDataFrame([(i % 7, "der Hund läuft schnell" if i % 2 else "the dog runs fast", "de" if i % 2 else "en") for i in range(60)],
                                 "doc_id int, text string, lang string")
    got = langid.identify(docs, F.lit(False)).collect()
    assert len(got) == 60 and len({(r.lang_pred, round(r.score, 12)) for r in got}) == 2
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id int, toxic int")
    scored = toxicity.toxicity(docs, labels, F.lit(False)).collect()
    assert len(scored) == 60 and len({round(r.score, 12) for r in scored}) <= 2
