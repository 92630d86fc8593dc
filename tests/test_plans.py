"""Plan-shape regressions for the properties the scale design relies on
(checked on the initial adaptive plan, before execution)."""

import pytest

import __spark_entry__ as entry
from conftest import SF01
from plan_report import plan_text, summarize

Q = entry.queries()


@pytest.fixture(scope="module")
def plans(spark):
    names = ["fact_top_titles", "text_keywords", "tag_lists", "cogroup_grades", "tour_final",
             "top_by_alignment", "fact_silent_users", "nest_dim_genres"]
    out = {}
    for n in names:
        text = plan_text(Q[n](spark, SF01))
        out[n] = (text, summarize(text))
    return out


def test_year_range_reaches_the_scan(plans):
    text, s = plans["fact_top_titles"]
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert s["topk"]


def test_keywords_move_neither_texts_nor_tokens(plans):
    text, s = plans["text_keywords"]
    assert s["shuffles"] == 0 and "Python" not in text and "Arrow" not in text


def test_aggregations_are_partial_before_shuffles(plans):
    for n in ("tag_lists", "fact_top_titles", "cogroup_grades"):
        text, _ = plans[n]
        assert "partial_" in text, n


def test_grade_join_is_co_partitioned(plans):
    _, s = plans["cogroup_grades"]
    assert s["shuffles"] == 2 and s["sort_merge_joins"] == 1


def test_tournament_plan_stays_small(plans):
    _, s = plans["tour_final"]
    assert s["shuffles"] <= 12      # the draft of the teams and all rounds, in one lazy plan


def test_top_k_uses_group_limit(plans):
    text, _ = plans["top_by_alignment"]
    assert "WindowGroupLimit" in text


def test_silent_users_is_an_anti_join_without_expand(plans):
    text, _ = plans["fact_silent_users"]
    assert "LeftAnti" in text and "Expand" not in text


def test_metadata_fixture_shuffles_line_items_once_before_the_aggregate(plans):
    text, s = plans["nest_dim_genres"]
    assert "REPARTITION_BY_COL" in text and s["shuffles"] <= 3


def test_metadata_texts_are_built_after_the_last_exchange(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as on side tables too large to broadcast
    try:
        text = plan_text(Q["nest_repair"](spark, SF01))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "collect_list" in text and "collect_list(concat" not in text
    above = text.split("\n\n")[0].split(" Exchange (")[0]             # what runs once orders and items have met
    assert "ObjectHashAggregate" in above and " Sort (" not in above and "REPARTITION_BY_COL" in text
