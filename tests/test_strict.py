"""Strict JSON source: absent vs null, JSON types, the record model's type rules."""

import json
from datetime import datetime

from civicflow.fixtures import raw_requests
from civicflow.plans.clean import clean_rows, parse_requests, quarantine_rows
from civicflow.session import scratch_path
from civicflow.sources.jsonl import read_jsonl, read_jsonl_strict, strict_fields, write_jsonl

GOOD = {"unique_key": "731", "agency": "PARKS", "complaint_type": "Fallen tree", "open_data_channel_type": "MOBILE",
        "status": "Assigned", "borough": "queens", "created_date": "2023-11-07T21:14:45.500"}


def parse(spark, *records):
    lines = [json.dumps(r) if isinstance(r, dict) else r for r in records]
    df = spark.createDataFrame([(x,) for x in lines], "_line string")
    return parse_requests(strict_fields(df))


def one_clean(spark, record):
    out = clean_rows(parse(spark, record)).collect()
    return out[0] if out else None


def reasons(spark, record):
    q = quarantine_rows(parse(spark, record)).collect()
    return (q[0].record_id, q[0].error_fields) if q else None


def test_numbers_in_string_fields_are_rejected(spark):
    assert reasons(spark, {**GOOD, "unique_key": 731}) == ("731", ["unique_key"])
    assert reasons(spark, {**GOOD, "descriptor": 7}) == ("731", ["descriptor"])
    assert reasons(spark, {**GOOD, "incident_zip": 10451}) == ("731", ["zip_code"])


def test_alias_wins_when_present_even_as_null(spark):
    both = {**GOOD, "open_data_channel_type": None, "channel_type": "ONLINE"}
    assert reasons(spark, both) == ("731", ["channel_type"])
    own = {k: v for k, v in GOOD.items() if k != "open_data_channel_type"} | {"channel_type": "ONLINE"}
    assert one_clean(spark, own).channel_type == "ONLINE"


def test_zip_defaults_and_record_ids(spark):
    assert one_clean(spark, {**GOOD, "incident_zip": None}).zip_code == "00000"
    assert one_clean(spark, GOOD).zip_code == "00000"
    assert one_clean(spark, {**GOOD, "zip_code": "11201"}).zip_code == "11201"
    missing_key = {k: v for k, v in GOOD.items() if k != "unique_key"}
    assert reasons(spark, missing_key) == ("unknown", ["unique_key"])
    assert reasons(spark, {**GOOD, "unique_key": None}) == (None, ["unique_key"])


def test_coordinates_by_type(spark):
    cases = [(40.5, 40.5), (True, 1.0), ("N/A", 0.0), ({"x": 1}, 0.0), (None, 0.0), ("1_000", 1000.0)]
    for given, expected in cases:
        assert one_clean(spark, {**GOOD, "latitude": given}).latitude == expected, given


def test_numeric_dates_are_unix_time(spark):
    expect = datetime(2024, 5, 1, 2, 6, 3)
    assert one_clean(spark, {**GOOD, "created_date": 1714529163}).created_date == expect
    assert one_clean(spark, {**GOOD, "created_date": 1714529163000}).created_date == expect
    assert reasons(spark, {**GOOD, "created_date": True}) == ("731", ["created_date"])
    assert one_clean(spark, {**GOOD, "created_date": "05/01/2026 02:06:03 PM"}).created_date.hour == 14


def test_malformed_line_keeps_its_text(spark):
    q = quarantine_rows(parse(spark, "{broken", GOOD)).collect()
    assert len(q) == 1 and q[0].original_record == "{broken" and q[0].record_id == "unknown"


def test_strict_equals_lenient_on_an_all_text_feed(spark, sf001):
    path = scratch_path(spark, "t-strict")
    write_jsonl(raw_requests(spark, sf001), path, mode="overwrite")
    lenient = clean_rows(parse_requests(read_jsonl(spark, path)))
    strict = clean_rows(parse_requests(read_jsonl_strict(spark, path)))
    assert strict.count() == lenient.count() > 0
    assert strict.exceptAll(lenient).count() == 0
    ql = quarantine_rows(parse_requests(read_jsonl(spark, path))).select("seq", "error_fields")
    qs = quarantine_rows(parse_requests(read_jsonl_strict(spark, path))).select("seq", "error_fields")
    assert qs.exceptAll(ql).count() == 0 and ql.exceptAll(qs).count() == 0


def test_strict_streaming_ingest(spark, sf001):
    from civicflow.streaming.ingest import IngestPaths, run_ingest
    from civicflow.sources.jsonl import arrival_bounds, land_arrival
    from civicflow.sources.sinks import read_clean

    raw = raw_requests(spark, sf001)
    root = scratch_path(spark, "t-strict-stream")
    paths = IngestPaths(f"{root}/landing", f"{root}/clean", f"{root}/quarantine", f"{root}/_ckpt")
    for lo, hi in arrival_bounds(raw, 2):
        land_arrival(raw, paths.landing, lo, hi)
        run_ingest(spark, paths, strict=True)
    got = read_clean(spark, paths.clean)
    want = clean_rows(parse_requests(raw))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
