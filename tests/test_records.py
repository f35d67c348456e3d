"""CSV with line breaks in quoted values, read in splits: against Python's csv module and Spark's own reader."""

import csv
import random

import pytest
from pyspark.sql import types as T

from mentions.sources.records import csv_records
from mentions.sources.tables import read_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
BITS = ["x", "word ", '"', '""', "\n", "\n\n", ",", ",\n", "é😀", "\r\n", " ", "'", '"\n"', "\\"]


def write(path, rows, end="\n", header=("id", "a", "b")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


def made(n, seed, longest=12):
    rng = random.Random(seed)
    return [(i, *("v" + "".join(rng.choices(BITS, k=rng.randrange(longest))) + "v" for _ in range(2))) for i in range(n)]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, path):
    return sorted(tuple(r) for r in read_csv(spark, str(path), SCHEMA).collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_python(spark, tmp_path, small_splits, end):
    rows = made(300, 1)
    write(tmp_path / "t.csv", rows, end)
    assert spark.read.text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 20
    assert read(spark, tmp_path / "t.csv") == rows


def test_records_over_several_splits(spark, tmp_path, small_splits):
    rows = [(0, "a\n" * 700 + 'q"q', "b"), (1, "c", "d"), (2, "\n" * 900, "\n,\n" * 300), (3, "e", '"\n' * 400)]
    write(tmp_path / "t.csv", rows)
    assert read(spark, tmp_path / "t.csv") == rows


def test_files_of_a_folder_and_column_order(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").mkdir()
    rows = made(200, 2)
    for k in range(4):
        write(tmp_path / "t.csv" / f"part-{k}.csv", [(b, i, a) for i, a, b in rows[k::4]], header=("b", "id", "a"))
    assert read(spark, tmp_path / "t.csv") == rows


def test_same_as_whole_file_reader(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,a,b\n1,,""\n\n2,"x\ny", z \n3,"",""""\n')
    own = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(SCHEMA).csv(str(tmp_path / "t.csv"))
    assert read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).orderBy("id").collect() == own.orderBy("id").collect()


def test_wrong_files_fail(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,a,b\n1,x,"y\n2,x,y\n')
    with pytest.raises(Exception, match="not closed"):
        read(spark, tmp_path / "open.csv")
    (tmp_path / "short.csv").write_text("id,a,b\n1,x\n")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        read(spark, tmp_path / "short.csv")
    (tmp_path / "two.csv").mkdir()
    write(tmp_path / "two.csv" / "a.csv", [(1, "x", "y")])
    write(tmp_path / "two.csv" / "b.csv", [(1, "x", "y")], header=("id", "b", "a"))
    with pytest.raises(Exception, match="another header"):
        read(spark, tmp_path / "two.csv")


def test_lines_are_shuffled_once(spark, tmp_path, small_splits):
    """One scan counts quotes, one shuffles lines; the exchange serves join, running counts, records and both branches."""
    write(tmp_path / "t.csv", made(50, 3))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = csv_records(spark, str(tmp_path / "t.csv"))
        assert len(found.collect()) == 51
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert final.count("FileScan text") == 2
    assert "ReusedExchange" in final and "Python" not in final and "MapInArrow" not in final
