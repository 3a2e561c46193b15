"""The whole clean plan against a plain-Python brute force on random small feeds."""

import math
from datetime import datetime

from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from civicflow.plans.clean import clean_rows, parse_requests, quarantine_rows
from civicflow.schema import RAW_SCHEMA, REQUIRED_FIELDS
from tests.test_parse import DATE_CASES, NUMBER_CASES

TEXT = st.sampled_from([None, "", "x", "Bronx", "bronx", "QUEENS", "Closed", "OPEN"])
DATES = st.sampled_from([
    None, "2026-05-01T02:06:03.000", "2026-05-01T02:06:03.000Z", "05/01/2026 02:06:03 AM", "20260501", "2026-W18-5",
    "2026-02-29", "invalid-date-format", "2026-05-01T02:06:03+05:30", "12/31/2025 11:59:59 PM",
])
COORDS = st.sampled_from([None, "", "N/A", "40.81", "-73.5", "1_000", "1.5d", "nan", "abc"])


@st.composite
def feeds(draw):
    n = draw(st.integers(1, 30))
    rows = []
    for seq in draw(st.permutations(list(range(100, 100 + n)))):
        rows.append({
            "seq": seq,
            "unique_key": draw(st.sampled_from([None, "k1", "k2", "k3", "k4"])),
            "agency": draw(st.sampled_from([None, "A", "B"])),
            "complaint_type": draw(st.sampled_from([None, "Noise", ""])),
            "descriptor": draw(st.sampled_from([None, "d"])),
            "open_data_channel_type": draw(st.sampled_from([None, "PHONE"])),
            "channel_type": draw(st.sampled_from([None, "ONLINE"])),
            "status": draw(TEXT),
            "borough": draw(TEXT),
            "incident_zip": draw(st.sampled_from([None, "10451"])),
            "zip_code": draw(st.sampled_from([None, "11201"])),
            "latitude": draw(COORDS),
            "longitude": draw(COORDS),
            "created_date": draw(DATES),
        })
    return rows


def _n(x):
    """NaN never equals NaN; compare it as a marker."""
    return "NaN" if isinstance(x, float) and math.isnan(x) else x


def brute_force(rows):
    parsed = []
    for r in rows:
        p = {
            "seq": r["seq"], "unique_key": r["unique_key"], "agency": r["agency"],
            "complaint_type": r["complaint_type"], "descriptor": r["descriptor"],
            "channel_type": r["open_data_channel_type"] if r["open_data_channel_type"] is not None else r["channel_type"],
            "status": r["status"].lower() if r["status"] is not None else None,
            "borough": r["borough"].upper() if r["borough"] is not None else None,
            "zip_code": next((z for z in (r["incident_zip"], r["zip_code"]) if z is not None), "00000"),
            "latitude": NUMBER_CASES[r["latitude"]], "longitude": NUMBER_CASES[r["longitude"]],
            "created_date": DATE_CASES[r["created_date"]] and datetime.fromisoformat(DATE_CASES[r["created_date"]]),
        }
        p["errors"] = [f for f in REQUIRED_FIELDS if p[f] is None]
        parsed.append(p)
    valid = [p for p in parsed if not p["errors"]]
    first = {}
    for p in sorted(valid, key=lambda p: p["seq"]):
        first.setdefault(p["unique_key"], p)
    clean = {(p["seq"], p["unique_key"], p["channel_type"], p["status"], p["borough"], p["zip_code"],
              _n(p["latitude"]), _n(p["longitude"]), p["created_date"]) for p in first.values()}
    bad = {(p["seq"], p["unique_key"] or "unknown", tuple(p["errors"])) for p in parsed if p["errors"]}
    return clean, bad


# Each example runs Spark jobs: no shrinking (a failure prints the full example instead).
@settings(max_examples=20, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(feeds())
def test_clean_plan_equals_brute_force(spark, rows):
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    parsed = parse_requests(raw)
    got_clean = {
        (r.seq, r.unique_key, r.channel_type, r.status, r.borough, r.zip_code, _n(r.latitude), _n(r.longitude),
         r.created_date)
        for r in clean_rows(parsed).collect()
    }
    got_bad = {(r.seq, r.record_id, tuple(r.error_fields)) for r in quarantine_rows(parsed).collect()}
    want_clean, want_bad = brute_force(rows)
    assert got_bad == want_bad
    assert got_clean == want_clean
