import os
import tempfile

from pyspark.sql import functions as F

from pointlake.functions.rowindex import with_dense_index
from pointlake.sources.points import read_points
from pointlake.sources.text import read_lines


def test_dense_index_follows_file_then_line_order(spark):
    d = tempfile.mkdtemp(prefix="pl-rowindex-")
    expected = []
    for name, n in [("b.txt", 700), ("a.txt", 1300), ("c.txt", 5)]:
        with open(os.path.join(d, name), "w") as f:
            for i in range(n):
                f.write(f"{name}:{i}\n")
    for name, n in sorted([("b.txt", 700), ("a.txt", 1300), ("c.txt", 5)]):
        expected += [f"{name}:{i}" for i in range(n)]
    # small splits so one file spans several partitions
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_lines(spark, d, with_ids=True).orderBy("line_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line_id for r in rows] == list(range(len(expected)))
    assert [r.value for r in rows] == expected


def test_blank_lines_kept_and_counted(spark):
    d = tempfile.mkdtemp(prefix="pl-lines-")
    with open(os.path.join(d, "x.txt"), "w") as f:
        f.write("a b\n\n  \nc\r\nd")
    rows = read_lines(spark, d, with_ids=True).orderBy("line_id").collect()
    assert [r.value for r in rows] == ["a b", "", "  ", "c", "d"]


def test_points_from_text_ids_in_file_order(spark, fixture_path):
    pts = read_points(spark, fixture_path("points_959.csv"))
    assert pts.count() == 959
    ids = pts.agg(F.min("point_id"), F.max("point_id"), F.countDistinct("point_id")).first()
    assert tuple(ids) == (0, 958, 959)
    first = pts.filter("point_id = 0").first().point
    with open(fixture_path("points_959.csv")) as f:
        assert first == [float(x) for x in f.readline().strip().split(",")]


def test_dense_index_on_generic_scan(spark, fixture_path):
    df = with_dense_index(spark.read.text(fixture_path("points_16.txt")), "rid")
    assert [r.rid for r in df.orderBy("rid").collect()] == list(range(16))


def test_lines_without_ids_and_min_partitions(spark, fixture_path):
    lines = read_lines(spark, fixture_path("words_5.txt"), min_partitions=3)
    assert lines.columns == ["value"] and lines.count() == 5
    assert lines.rdd.getNumPartitions() == 3


def test_row_ids_start_no_job_while_the_plan_is_built(spark, fixture_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building plans")
    with_dense_index(spark.read.text(fixture_path("points_959.csv")), "rid")
    read_lines(spark, fixture_path("words_5.txt"), with_ids=True)
    assert not list(tracker.getJobIdsForGroup("plan-only"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_row_ids_of_an_empty_file(spark):
    d = tempfile.mkdtemp(prefix="pl-empty-")
    open(os.path.join(d, "x.txt"), "w").close()
    assert read_lines(spark, d, with_ids=True).collect() == []
