"""Worked examples of the original pipelines and the golden tables of the survey."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lakemart.functions.nested import parse_array
from lakemart.functions.text import title_text, title_year, tokens
from lakemart.operators import grades, labels, tournament
from lakemart.sources.readers import rows


def test_grade_report_worked_example(spark):
    mid = rows(spark, [("Student1", 100.0), ("Student2", 50.0), ("Student3", 75.0)], "student string, grade double")
    proj = rows(spark, [("Student1", 100.0), ("Student2", 50.0), ("Student4", 90.0), ("Student5", 99.0)],
                "student string, grade double")
    got = {r.student: r.message for r in grades.grade_report(mid, proj).collect()}
    assert got == {
        "Student1": "Student1 has passed the subject with avg grade of 100.0",
        "Student2": "Student2 has passed the subject with avg grade of 50.0",
        "Student3": "Student3 has failed the subject with avg grade of 37.5",
        "Student4": "Student4 has failed the subject with avg grade of 45.0",
        "Student5": "Student5 has failed the subject with avg grade of 49.5",
    }


def test_repeated_grade_key_takes_smallest(spark):
    mid = rows(spark, [("A", 80.0), ("A", 20.0)], "student string, grade double")
    proj = rows(spark, [("A", 40.0)], "student string, grade double")
    r = grades.grade_report(mid, proj).collect()[0]
    assert (r.midterm, r.avg_grade, r.passed) == (20.0, 30.0, False)


def test_pairs_of_four_teams(spark):
    t = rows(spark, [(n, 0, 1.0, 1.0, 0) for n in "ABCD"],
             "team_name string, bracket int, top_average_speed double, top_average_height double, flight_count int")
    got = sorted((r.team_a, r.team_b) for r in tournament.pairs(t).collect())
    assert got == [("A", "B"), ("A", "C"), ("A", "D"), ("B", "C"), ("B", "D"), ("C", "D")]


def test_title_golden_table(spark):
    df = rows(spark, [("Foo: Bar (1995)",), ("Toy Story (1995)",), ("NoYear",), ("A: B: C (2001)",)], "t string")
    got = {r.t: (r.title, r.year) for r in df.select("t", title_text("t").alias("title"),
                                                      title_year("t").alias("year")).collect()}
    assert got["Foo: Bar (1995)"] == ("Bar Foo", 1995)
    assert got["Toy Story (1995)"] == ("Toy Story", 1995)
    assert got["NoYear"] == (None, None)
    assert got["A: B: C (2001)"] == ("B: C A", 2001)


GENRE = ArrayType(StructType([StructField("id", IntegerType()), StructField("name", StringType())]))


def test_json_repair_golden_table(spark):
    cells = ["[{'id': 1, 'name': 'A'}]", "[{'id': 1, 'name': None}]", """[{'id': 1, 'name': "O'B"}]""",
             "broken", "[]", "[{'id': 1, 'name': 'O\\'B'}]", """[{'id': 1, 'name': "say \\"x\\""}]""",
             "[{'id': 1, 'name': 'A', 'flag': True}]"]
    df = rows(spark, [(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = {r.i: r.p for r in df.select("i", parse_array("c", GENRE).alias("p")).collect()}
    assert [tuple(e) for e in got[0]] == [(1, "A")]
    assert [tuple(e) for e in got[1]] == [(1, None)]
    assert [tuple(e) for e in got[2]] == [(1, "O'B")]
    assert got[3] is None
    assert got[4] == []
    assert got[5] is None and got[6] is None and got[7] is None


def test_tokenizer_strict_and_spec(spark):
    df = rows(spark, [("a,b c, d: e! f? g. h\ni",)], "t string")
    strict = df.select(tokens("t").alias("x")).collect()[0].x
    spec = df.select(tokens("t", "spec").alias("x")).collect()[0].x
    assert strict == ["a,b", "c", "d", "e", "f", "g", "h\ni"]
    assert spec == ["a", "b", "c", "d", "e", "f", "g.", "h", "i"]


def test_balanced_ranges_rule():
    assert [e - s for s, e in labels.balanced_ranges(11, 3)] == [4, 4, 3]
    assert labels.balanced_ranges(10, 5) == [(0, 2), (2, 4), (4, 6), (6, 8), (8, 10)]


def test_assign_shards_matches_ntile(spark):
    df = spark.range(11).select(F.col("id").cast("string").alias("imdb_id"), F.lit("g").alias("genre"))
    sizes = sorted((r.shard, r["count"]) for r in labels.assign_shards(df, 3).groupBy("shard").count().collect())
    assert sizes == [(0, 4), (1, 4), (2, 3)]


def test_parse_report_counts_cells_lost_to_the_repair_rule(spark):
    from lakemart.operators import nested as N
    cells = ["[{'id': 1, 'name': 'A'}]", "[{'id': 1, 'name': 'O\\'B'}]", None, "[]",
             "[{'id': 2, 'name': 'B', 'x': True}]"]
    df = rows(spark, [(c,) for c in cells], "genres string")
    got = {r.entity: (r.text_cells, r.failed_cells) for r in N.parse_report(df).collect()}
    assert got == {"genres": (4, 2)}
