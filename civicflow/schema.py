"""Schemas and fixed values of the service-request data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source system's field names and defaults) ---
# Field names of a validated record, in declaration order.
CLEAN_FIELDS = (
    "unique_key",
    "agency",
    "complaint_type",
    "descriptor",
    "channel_type",
    "status",
    "borough",
    "zip_code",
    "latitude",
    "longitude",
    "created_date",
)
# Required fields (present, non-null), in declaration order.
REQUIRED_FIELDS = (
    "unique_key",
    "agency",
    "complaint_type",
    "channel_type",
    "status",
    "borough",
    "created_date",
)
DEFAULT_ZIP = "00000"
# Error types of a quarantined record.
VALIDATION_ERROR = "validation_error"
UNKNOWN_RECORD_ID = "unknown"
# --- end of fixed values ---

# Ingest order.  A feed may number its records (``seq``); ``_order`` is the order that "first" means:
# seq where there is one, then the place in the source (file, block of the file, line in the block).
# Rows of landed batches are ordered by their batch before all that: first written wins.
BATCH = "batch_id"
SEQ = "seq"
ORDER = "_order"
PLACE = "_place"
PLACE_TYPE = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("line", T.LongType())]
)

# Raw input: every field arrives as a JSON string (or is missing).  Both an alias and
# the field's own name are accepted, so both columns are declared.
RAW_FIELDS = (
    "unique_key",
    "agency",
    "complaint_type",
    "descriptor",
    "open_data_channel_type",
    "channel_type",
    "status",
    "borough",
    "incident_zip",
    "zip_code",
    "latitude",
    "longitude",
    "created_date",
)
CORRUPT_RECORD = "_corrupt_record"
# The whole line of a record, with every field it had.
RAW_LINE = "_line"
JSON_TYPES = "_json_types"
# Columns of a raw frame that are no fields of the feed.
INTERNAL_COLUMNS = (SEQ, CORRUPT_RECORD, RAW_LINE, JSON_TYPES, ORDER, PLACE, BATCH)

RAW_SCHEMA = T.StructType(
    [T.StructField(SEQ, T.LongType())]
    + [T.StructField(f, T.StringType()) for f in RAW_FIELDS]
)
RAW_SCHEMA_WITH_CORRUPT = T.StructType(
    RAW_SCHEMA.fields + [T.StructField(CORRUPT_RECORD, T.StringType())]
)

CLEAN_COLUMNS = CLEAN_FIELDS + (SEQ,)
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("unique_key", T.StringType()),
        T.StructField("agency", T.StringType()),
        T.StructField("complaint_type", T.StringType()),
        T.StructField("descriptor", T.StringType()),
        T.StructField("channel_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField(SEQ, T.LongType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField(SEQ, T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_fields", T.ArrayType(T.StringType())),
        T.StructField("error_message", T.StringType()),
        T.StructField("original_record", T.StringType()),
        T.StructField("quarantined_at", T.TimestampType()),
    ]
)
