"""Layouts (pruning, equivalence, scan report) and the distributed samples."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicflow.fixtures import read_table
from civicflow.operators.sample import global_rank, head_sample, systematic_sample
from civicflow.plans import layout
from civicflow.plans.scanstats import equals
from civicflow.plans.tables import clean_store
from civicflow.session import scratch_path


def test_partitioned_layout_prunes_and_agrees(spark, sf01):
    clean = clean_store(spark, sf01)
    flat, hive = scratch_path(spark, "t-flat"), scratch_path(spark, "t-hive")
    layout.write_flat(clean, flat)
    layout.write_partitioned(clean, hive)
    q = layout.borough_count(spark, hive, "BROOKLYN")
    assert "PartitionFilters: [isnotnull(borough" in q._jdf.queryExecution().executedPlan().toString()
    row = layout.equivalence(spark, flat, hive, "BROOKLYN").first()
    assert row.flat_n == row.hive_n == 1893 and row.same is True
    # partition values read back as text with their original spelling
    assert layout.read_layout(spark, hive).select("borough").distinct().count() == 5


def test_scan_report_shows_where_the_rows_stand(spark, sf01):
    clean = clean_store(spark, sf01)
    flat, hive = scratch_path(spark, "t-report-flat"), scratch_path(spark, "t-report-hive")
    layout.write_flat(clean.repartition(6), flat)
    layout.write_partitioned(clean, hive)
    condition = [equals("borough", "BROOKLYN")]
    report = {r.layout: r for r in layout.scan_report(spark, [("flat", flat, condition), ("hive", hive, condition)]).collect()}
    assert report["flat"].rows_returned == report["hive"].rows_returned == 1893
    assert report["hive"].files_with_rows == 1 < report["flat"].files_with_rows == 6


def test_a_new_layout_leaves_no_old_partitions(spark, sf001):
    clean = clean_store(spark, sf001)
    some = clean.where("borough = 'BROOKLYN'")
    for write in (layout.write_partitioned, layout.write_hash_spread):
        path = scratch_path(spark, "t-fewer")
        write(clean, path)
        write(some, path)
        assert spark.read.parquet(path).count() == some.count()


def test_hash_spread_is_even(spark, sf01):
    path = scratch_path(spark, "t-spread")
    layout.write_hash_spread(clean_store(spark, sf01), path, buckets=4)
    counts = layout.spread_counts(spark, path).collect()
    assert len(counts) == 20
    per_borough = {}
    for r in counts:
        per_borough.setdefault(r.borough, []).append(r["count"])
    assert all(max(v) < 1.3 * min(v) for v in per_borough.values())


def test_global_rank_equals_single_task_row_number(spark, sf01):
    events = read_table(spark, sf01, "events").select("event_id", "ts")
    order = [F.col("ts").desc(), F.col("event_id").asc()]
    ours = global_rank(events, order).select("event_id", "rank")
    brute = events.select("event_id", (F.row_number().over(Window.orderBy(*order)) - 1).alias("rank"))
    assert ours.exceptAll(brute).count() == 0 and brute.exceptAll(ours).count() == 0


def test_systematic_sample_pages_and_cap(spark, sf01):
    events = read_table(spark, sf01, "events").select("event_id", "ts")
    order = [F.col("ts").desc(), F.col("event_id").asc()]
    s = systematic_sample(events, order, page=100, stride=1000).collect()
    assert len(s) == 1000 and all(r["rank"] % 1000 < 100 for r in s)
    capped = systematic_sample(events, order, page=100, stride=1000, cap=3000).collect()
    assert len(capped) == 300 and max(r["rank"] for r in capped) < 2100


def test_head_sample_is_ingest_order(spark, sf01):
    raw = read_table(spark, sf01, "events").withColumnRenamed("event_id", "seq")
    assert [r.seq for r in head_sample(raw, 5).collect()] == [0, 1, 2, 3, 4]


def test_csv_export_round_trips_awkward_text(spark):
    from datetime import datetime

    from civicflow.schema import CLEAN_SCHEMA
    from civicflow.sources.sinks import export_csv, read_csv

    rows = [
        ("1", "A", "Noise", 'line one\nline "two", three', "PHONE", "open", "BRONX", "00000", 0.0, -73.5,
         datetime(2026, 5, 1, 2, 6, 3, 123456), 1),
        ("2", "B", "Heat", None, "ONLINE", "closed", "QUEENS", "11201", 40.5, 0.0, datetime(2026, 5, 1), 2),
        ("3", "C", "", "", "MOBILE", "open", "BROOKLYN", "10451", 1.0, 2.0, datetime(2026, 5, 1), 3),
    ]
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    path = scratch_path(spark, "t-csv")
    export_csv(df, path)
    back = read_csv(spark, path, CLEAN_SCHEMA)
    assert sorted(back.collect()) == sorted(df.collect())


def test_partition_values_round_trip(spark):
    from datetime import datetime

    from civicflow.schema import CLEAN_SCHEMA

    boroughs = ["A/B", "X=Y", "STATEN ISLAND", "00000", "%41"]
    rows = [(str(i), "A", "T", None, "PHONE", "open", b, "00000", 0.0, 0.0, datetime(2026, 5, 1), i)
            for i, b in enumerate(boroughs)]
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    path = scratch_path(spark, "t-hive-values")
    layout.write_partitioned(df, path)
    back = layout.read_layout(spark, path)
    assert sorted(r.borough for r in back.collect()) == sorted(boroughs)
    assert layout.borough_count(spark, path, "A/B").first()["count"] == 1
