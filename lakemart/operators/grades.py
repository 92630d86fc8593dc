"""Grade report: full outer join of two grade lists by student."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import GRADE_FAILED, GRADE_PASSED, PASSING_GRADE


def grade_report(midterm: DataFrame, project: DataFrame, passing: float = PASSING_GRADE,
                 key: str = "student", grade: str = "grade") -> DataFrame:
    """(student, midterm, project, avg_grade, passed, message).  A missing part
    counts 0.0; a repeated student keeps its smallest grade (explicit order).
    Each side is reduced to one row per student (partial aggregation) before
    the full join, so the join is one-to-one."""
    # A missing name is one student, as in a co-group.  Grouping both sides on
    # (name or '', name is null) makes the full join a plain equi-join on the
    # columns both sides are already partitioned by (no extra shuffle, unlike
    # a <=> join condition).
    gk = [F.coalesce(F.col(key), F.lit("")).alias("_k"), F.col(key).isNull().alias("_null")]
    m = midterm.groupBy(*gk).agg(F.min(grade).cast("double").alias("midterm"))
    p = project.groupBy(*gk).agg(F.min(grade).cast("double").alias("project"))
    j = m.join(p, ["_k", "_null"], "full").withColumn(key, F.when(~F.col("_null"), F.col("_k")))
    mid, proj = F.coalesce("midterm", F.lit(0.0)), F.coalesce("project", F.lit(0.0))
    avg = (mid + proj) / 2.0
    passed = avg >= passing
    msg = F.concat(F.col(key), F.when(passed, F.lit(GRADE_PASSED)).otherwise(F.lit(GRADE_FAILED)),
                   avg.cast("string"))
    return j.select(key, mid.alias("midterm"), proj.alias("project"), avg.alias("avg_grade"),
                    passed.alias("passed"), msg.alias("message"))
