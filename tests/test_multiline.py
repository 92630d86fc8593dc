"""Multi-line CSV read by many tasks equals the one-task read, wherever splits fall."""

import csv
import os
import random

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from lakemart.session import local_path, scratch_path
from lakemart.sources import multiline as M, readers as R

SCHEMA = StructType([StructField("id", IntegerType()), StructField("a b", StringType()),
                     StructField("n", DoubleType()), StructField("b", StringType())])


def _file(spark, lines: str | None = None, end: str = "\n", files: int = 2) -> str:
    root = scratch_path(spark, "t-multiline")
    os.makedirs(local_path(root))
    rng = random.Random(4)
    for f in range(files):
        with open(os.path.join(local_path(root), f"p{f}.csv"), "w", newline="", encoding="utf-8") as h:
            if lines is not None:
                h.write(lines)
                continue
            w = csv.writer(h, lineterminator=end)
            w.writerow(["id", "a\nheader \"line\"", "n", "b"])
            for i in range(120):
                odd = ["".join(rng.choice(["x", '"', "\n", ",", "y z", "é", '"\n"', "\n\n", '",\n"']) for _ in range(rng.randint(0, 9)))
                       for _ in range(2)]
                w.writerow([i if i % 7 else "bad", odd[0], i / 3 if i % 5 else "n/a", odd[1]])
    return root


def _rows(df) -> list:
    return sorted(tuple(map(repr, r)) for r in df.collect())


@pytest.fixture
def split_at(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_size(n: int):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield set_size
    for k, v in keep.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [13, 50, 333, 1 << 20])
def test_split_read_equals_the_one_task_read(spark, split_at, size):
    root = _file(spark)
    want = _rows(R.read_csv_multiline(spark, root, SCHEMA, split=False))
    split_at(size)
    df = R.read_csv_multiline(spark, root, SCHEMA)
    assert len(want) == 240 and _rows(df) == want
    if size == 333:
        assert M._lines(spark, root).rdd.getNumPartitions() > 20


def test_carriage_returns_blank_lines_and_an_open_quote(spark, split_at):
    split_at(9)
    crlf = _file(spark, 'id,a,n,b\r\n1,"x\r\ny",2.5,"q"\r\n\r\n2,"",,""\r\n', files=1)
    got = sorted(tuple(r) for r in R.read_csv_multiline(spark, crlf, SCHEMA).collect())
    assert got == [(1, "x\r\ny", 2.5, "q"), (2, None, None, None)] or got == [(1, "x\r\ny", 2.5, "q"), (2, "", None, "")]
    records = M.csv_records(spark, _file(spark, 'id,a\n1,"open\nto the\nend\n', files=1))
    assert sorted(r.record for r in records.where("not first").collect()) == ['1,"open\nto the\nend']
    only_header = _file(spark, "id,a,n,b\n", files=1)
    assert R.read_csv_multiline(spark, only_header, SCHEMA).collect() == []
    assert R.read_csv_multiline(spark, _file(spark, "", files=1), SCHEMA).collect() == []


def test_text_is_exchanged_once(spark):
    from plan_report import plan_text
    text = plan_text(R.read_csv_multiline(spark, _file(spark, files=1), SCHEMA))
    assert text.count("REPARTITION_BY_COL") >= 1 and "Python" not in text
    # everything else that is exchanged is one row per split, or a split's fragments
    assert "CartesianProduct" not in text and "NestedLoop" not in text
