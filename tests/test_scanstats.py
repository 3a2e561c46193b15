"""Row-group statistics: what a filter must examine, against the rows themselves."""

from datetime import datetime

from pyspark.sql import functions as F

from civicflow.plans import layout
from civicflow.plans.scanstats import Within, equals, examined, matches, row_groups
from civicflow.plans.tables import clean_store, layout_store
from civicflow.schema import CLEAN_SCHEMA
from civicflow.session import scratch_path

TYPE = [equals("complaint_type", "click-1")]
DATES = [Within("created_date", datetime(2024, 1, 3), datetime(2024, 1, 4))]


def read_for(spark, path, filters):
    return examined(row_groups(spark, path, [f.column for f in filters]), filters, CLEAN_SCHEMA).first()


def test_examined_covers_what_is_returned_and_hive_reads_less(spark, sf01):
    b = [equals("borough", "BROOKLYN")]
    rows = {k: read_for(spark, layout_store(spark, sf01, k), b) for k in ("arrival", "hive", "ranked")}
    returned = clean_store(spark, sf01).where(matches(b)).count()
    assert all(r.rows_total == 9606 and r.rows_examined >= returned for r in rows.values())
    assert rows["hive"].rows_examined == returned < rows["ranked"].rows_examined < rows["arrival"].rows_examined


def test_the_curve_prunes_by_type_and_by_date(spark, sf01):
    for filters in (TYPE, DATES):
        curve, clustered = (read_for(spark, layout_store(spark, sf01, k), filters) for k in ("curve", "ranked"))
        returned = clean_store(spark, sf01).where(matches(filters)).count()
        assert returned <= curve.rows_examined < clustered.rows_examined


def test_every_group_with_a_match_is_opened(spark, sf01):
    """Against the rows of each file: nothing that matches stands in a group that was ruled out."""
    path = layout_store(spark, sf01, "curve")
    for filters in (TYPE, DATES, [*TYPE, *DATES], [Within("latitude", 40.2, None)], [Within("unique_key", None, "3")]):
        may = F.lit(True)
        for f in filters:
            may = may & f.may_match(F.col("statistics"), CLEAN_SCHEMA[f.column].dataType)
        opened = {r.path for r in row_groups(spark, path, [f.column for f in filters]).where(may).collect()}
        table = layout.read_layout(spark, path).select("*", F.col("_metadata.file_path").alias("file"))
        assert {r.file for r in table.where(matches(filters)).select("file").distinct().collect()} <= opened


def test_nulls_awkward_folders_and_missing_statistics(spark):
    rows = [(b, None if b == "A/B=c d" else 1.0, k) for k, b in enumerate(["A/B=c d", "A/B=c d", "%41", None, "é"])]
    df = spark.createDataFrame(rows, "borough string, latitude double, seq long")
    path = scratch_path(spark, "t-odd")
    df.write.partitionBy("borough").parquet(path)
    for value, n in (("A/B=c d", 2), ("%41", 1), ("é", 1), ("A", 0)):
        assert read_for(spark, path, [equals("borough", value)]).rows_examined == n
    # a group of nulls only cannot match; a column without statistics rules nothing out
    assert read_for(spark, path, [Within("latitude", 0.0, None)]).rows_examined == 3
    assert read_for(spark, path, [equals("agency", "x")]).rows_examined == 5
    empty = scratch_path(spark, "t-none")
    df.limit(0).write.parquet(empty)
    assert read_for(spark, empty, [equals("borough", "x")]).rows_examined == 0


def test_morton_code_interleaves(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "x int, y int")
    assert df.select(layout.morton_code([F.col("x"), F.col("y")], 3)).first()[0] == 0b100111
