"""Decisions per row where ids repeat or are missing."""

import random

import corpus_pipeline
from lakemart.llm import near_dup


def test_pipeline_decides_per_row(spark, tmp_path):
    rng = random.Random(8)

    def prose(n):
        return " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))
    item, a, b, c, d = (prose(n) for n in (20, 40, 40, 40, 40))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint"

    def frame(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], shape).repartition(3)

    def run(stage, rows):
        key = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")
        return sorted(((r.doc_id, r.text) for r in stage(spark, frame(rows), str(tmp_path)).collect()), key=key)
    # a contaminated row takes no other row of its id with it, and a null id does not save it
    assert run(corpus_pipeline.decontaminate, [(7, a), (7, b + " " + item), (7, c), (None, item), (None, d), (8, None)]) == sorted(
        [(7, a), (7, c)]) + [(8, None), (None, d)]
    # one copy of every text stays, whatever other texts its id has; null ids are near-duplicates too
    rows = [(1, a), (5, a), (5, b), (5, b), (5, c), (None, c), (None, d), (None, d), (9, None), (9, None), (9, ""), (4, " ")]
    want = sorted([(5, b), (5, c)])
    assert run(corpus_pipeline.near_dedup, rows) == [(1, a), (4, " "), *want, (9, None), (9, ""), (None, d)]


def test_near_duplicates_of_repeated_ids_are_sets(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a + " z"), (1, b), (3, b + " z"), (3, c), (4, c + " z")]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {(1, 37, 1, True), (2, 38, 1, False), (3, 38, 1, False), (3, 37, 3, True), (4, 38, 3, False)}
