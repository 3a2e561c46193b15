"""Normalisation, quarantine and the invariants of the clean layer."""

import json

from pyspark.sql import functions as F

from civicflow.fixtures import raw_requests
from civicflow.operators.validate import is_valid
from civicflow.plans.clean import clean_rows, parse_requests, quarantine_rows
from civicflow.schema import CLEAN_COLUMNS, RAW_SCHEMA


def rows(spark, *dicts):
    full = []
    for i, d in enumerate(dicts):
        r = {f: None for f in RAW_SCHEMA.fieldNames()}
        r["seq"] = i
        r.update(d)
        full.append(r)
    return spark.createDataFrame(full, RAW_SCHEMA)


OK = dict(unique_key="sr-58", agency="PARKS", complaint_type="Fallen tree", open_data_channel_type="MOBILE",
          created_date="2023-11-07T21:14:45.500")


def test_normalisation(spark):
    raw = rows(spark, dict(OK, borough="Staten island", status="Re-Opened"))
    r = clean_rows(parse_requests(raw)).collect()[0]
    assert (r.borough, r.status, r.zip_code, r.latitude, r.longitude) == ("STATEN ISLAND", "re-opened", "00000", 0.0, 0.0)


def test_failure_scenarios_are_quarantined(spark):
    raw = rows(
        spark,
        {"unique_key": "only a key"},
        {"unique_key": "no agency", "complaint_type": "", "agency": None},
        {"unique_key": "no date", "created_date": "yesterday"},
        dict(OK, borough="BRONX", status="Open"),
    )
    parsed = parse_requests(raw)
    assert clean_rows(parsed).count() == 1
    q = {r.record_id: r for r in quarantine_rows(parsed, batch_id=7).collect()}
    assert set(q) == {"only a key", "no agency", "no date"}
    assert all(r.error_type == "validation_error" and r.batch_id == 7 for r in q.values())
    # the empty complaint type alone would pass; the missing fields are named in order
    assert q["no agency"].error_fields == ["agency", "channel_type", "status", "borough", "created_date"]
    assert "created_date" in q["no date"].error_fields
    assert json.loads(q["only a key"].original_record) == {"unique_key": "only a key"}


def test_bad_record_without_key_is_unknown(spark):
    q = quarantine_rows(parse_requests(rows(spark, {"agency": "A"}))).collect()
    assert q[0].record_id == "unknown"


def test_keep_first_is_smallest_seq(spark):
    raw = rows(spark, dict(OK, borough="a", status="first"), dict(OK, borough="b", status="second"))
    raw = raw.withColumn("seq", F.when(F.col("borough") == "a", 5).otherwise(3))
    r = clean_rows(parse_requests(raw)).collect()
    assert len(r) == 1 and r[0].status == "second"


def test_invalid_row_never_shadows_a_valid_duplicate(spark):
    raw = rows(spark, {"unique_key": "sr-58", "agency": None}, dict(OK, borough="x", status="s"))
    r = clean_rows(parse_requests(raw)).collect()
    assert len(r) == 1 and r[0].seq == 1


def test_invariants_and_expected_figures(spark, sf01):
    raw = raw_requests(spark, sf01)
    parsed = parse_requests(raw).cache()
    total = raw.count()
    valid = parsed.where(is_valid()).count()
    bad = quarantine_rows(parsed)
    clean = clean_rows(parsed).cache()
    n_clean = clean.count()
    assert total == 10_000
    assert bad.count() == 202 and valid == 9_798 and total == valid + bad.count()
    assert n_clean == 9_606 == clean.select("unique_key").distinct().count()
    by_fields = {tuple(r.error_fields): r["count"] for r in bad.groupBy("error_fields").count().collect()}
    assert by_fields == {("agency",): 102, ("created_date",): 98, ("agency", "created_date"): 2}
    boroughs = {r.borough: r["count"] for r in clean.groupBy("borough").count().collect()}
    assert boroughs == {"MANHATTAN": 1979, "BRONX": 1930, "STATEN ISLAND": 1924, "BROOKLYN": 1893, "QUEENS": 1880}
    zeros = clean.agg(
        F.count_if(F.col("latitude") == 0).alias("lat"), F.count_if(F.col("longitude") == 0).alias("lon"),
        F.count_if(F.col("zip_code") == "00000").alias("zip"), F.count_if(F.col("descriptor").isNull()).alias("d"),
    ).first()
    assert (zeros.lat, zeros.lon, zeros.zip, zeros.d) == (2219, 2214, 873, 3200)
    assert clean.columns == list(CLEAN_COLUMNS)
    parsed.unpersist()
    clean.unpersist()
