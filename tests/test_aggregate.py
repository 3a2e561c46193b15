"""Answers over the clean store: expected figures, invariants, summary records."""

from pyspark.sql import functions as F

from civicflow.operators import aggregate as agg
from civicflow.operators.summary import explode_records, summary_answers, summary_records
from civicflow.plans.tables import clean_store


def test_answers_and_invariants(spark, sf01):
    clean = clean_store(spark, sf01)
    n = clean.count()
    q1 = agg.region_volume(clean).collect()
    q3 = agg.hourly(clean).collect()
    q4 = agg.channels(clean).collect()
    assert sum(r["count"] for r in q1) == sum(r["count"] for r in q3) == sum(r["count"] for r in q4) == n
    assert [r.borough for r in q1] == ["MANHATTAN", "BRONX", "STATEN ISLAND", "BROOKLYN", "QUEENS"]
    assert [r.hour for r in q3] == sorted(r.hour for r in q3)
    top = [(r.complaint_type, r["count"]) for r in agg.top_types(clean, 5).collect()]
    assert top == [("click-1", 524), ("purchase-1", 518), ("signup-1", 513), ("error-1", 510), ("view-2", 505)]
    share = {r.channel_type: r.pct for r in agg.channel_share(clean).collect()}
    assert share == {"MOBILE": 33.7, "PHONE": 33.7, "ONLINE": 32.6}


def test_slices_from_rollup_equal_scans(spark, sf01):
    clean = clean_store(spark, sf01)
    rollup = agg.slice_rollup(clean).cache()
    for b, t in [("BROOKLYN", "click-1"), ("BRONX", "view-0"), ("NOWHERE", "x")]:
        scanned = agg.slice_count(clean, b, t).first()["count"]
        looked_up = agg.slice_from_rollup(rollup, b, t).first()["count"]
        assert scanned == looked_up
    assert agg.slice_count(clean, "BROOKLYN", "click-1").first()["count"] == 84
    assert [tuple(r) for r in agg.pick_slice(clean).collect()] == [("BRONX", "click-0")]
    assert sorted(r.borough for r in agg.distinct_regions(clean).collect()) == [
        "BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"]
    rollup.unpersist()


def test_top_k_ties_break_on_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b",)], "complaint_type string")
    assert [r.complaint_type for r in agg.top_types(df, 2).collect()] == ["a", "b"]


def test_union_keeps_bag_semantics(spark):
    a = spark.createDataFrame([(1, "x")], "seq long, k string")
    b = spark.createDataFrame([("x", 1)], "k string, seq long")
    assert agg.union_frames([a, b, a]).count() == 3


def test_summary_records(spark, sf01):
    clean = clean_store(spark, sf01)
    records = {r.aggregation_name: r for r in summary_records(summary_answers(clean)).collect()}
    assert set(records) == {"borough_volume", "top_complaint_types", "complaints_by_hour", "reporting_channels"}
    assert [r.record_count for r in records.values()] == [len(r.data) for r in records.values()]
    assert records["top_complaint_types"].record_count == 5
    assert [e.key for e in records["complaints_by_hour"].data] == [str(h) for h in range(24)]
    assert records["borough_volume"].data[0].key == "MANHATTAN"
    assert records["borough_volume"].description.startswith("Total complaints by borough")
    long = explode_records(summary_records(summary_answers(clean)))
    assert long.count() == 37
    assert long.where(F.col("position") == 1).count() == 4


def test_profiles_on_a_bounded_head(spark, sf01):
    from civicflow.fixtures import raw_requests
    from civicflow.operators.profile import health_check, null_ranking

    ranked = null_ranking(raw_requests(spark, sf01), sample_size=100).collect()
    assert {r.rows for r in ranked} == {100}
    assert [r.column_name for r in ranked][:2] == ["channel_type", "descriptor"]
    health = {r.column_name: r for r in health_check(clean_store(spark, sf01), sample_size=500).collect()}
    # event 0 has no agency, so seq 0 never reaches the clean table
    assert health["seq"].rows == 500 and health["seq"].zeros == 0 and health["latitude"].zeros > 0
    empty = health_check(clean_store(spark, sf01).limit(0)).collect()
    assert all(r.null_pct is None and r.rows == 0 for r in empty)


def test_raw_shape_line(spark, sf01):
    from civicflow.fixtures import raw_requests
    from civicflow.operators.profile import frame_shape

    r = frame_shape(raw_requests(spark, sf01)).first()
    assert (r.rows, r.columns) == (10_000, 12)
    assert r.schema.startswith("unique_key: string")


def test_empty_inputs(spark, sf01):
    from civicflow.fixtures import raw_requests
    from civicflow.queries import _cross_batch, _halves_united

    empty_raw = raw_requests(spark, sf01).limit(0)
    assert _cross_batch(spark, empty_raw).count() == 0
    assert _halves_united(clean_store(spark, sf01).limit(0)).count() == 0
    assert agg.channel_share(clean_store(spark, sf01).limit(0)).count() == 0
