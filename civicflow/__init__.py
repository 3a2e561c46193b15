"""civicflow: service-request analytics on Spark.

Raw JSON lines -> validated, normalised, de-duplicated clean table (+ quarantine)
-> volume / top-k / hour-of-day / channel-share answers, slices, rollups, layouts,
and resumable ingest with Structured Streaming.  Everything is expressed with the
DataFrame API so Catalyst plans it; no Python UDF runs in the hot path.
"""

__version__ = "0.1.0"
