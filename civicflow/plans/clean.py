"""Raw requests -> (clean, quarantine).

    raw - select(parse, alias, defaults, case) - stage (table, parsed once)
        stage - valid - keep_first(unique_key, ingest order) - clean
        stage - invalid - error_fields - quarantine record

``project_requests`` is the bare projection: who selects a few of its columns reads and parses
those only.  ``stage_requests`` writes it once, with the original record of rejected rows, and
both outputs read the stage.  ``parse_requests`` puts a row barrier behind the projection for
plans that filter on parsed columns without a stage (micro-batches): a filter on generator
output is not pushed below it, so the parse is not copied into the filter.  The barrier also
stops column pruning, which is why column-wise readers use the projection.

The only shuffle is the exchange on ``unique_key`` of the de-duplication, after a partial
per-partition limit.

Two input kinds: the lenient raw frame (every field text, absent = null) and the strict
frame from ``read_jsonl_strict`` (JSON types known, see ``functions/strict.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions import strict
from civicflow.functions.normalize import column_or_null, lower_case, null_flags, resolve_alias, upper_case, zip_code
from civicflow.functions.parse import coordinate_of, created_date_of, parse_coordinate, parse_created_date
from civicflow.operators.dedup import keep_first
from civicflow.operators.validate import ERROR_FIELDS, TYPE_ERRORS, invalid_rows, is_valid, valid_rows
from civicflow.schema import (
    BATCH,
    CLEAN_COLUMNS,
    CORRUPT_RECORD,
    DEFAULT_ZIP,
    PLACE,
    RAW_FIELDS,
    RAW_LINE,
    REQUIRED_FIELDS,
    SEQ,
    UNKNOWN_RECORD_ID,
    VALIDATION_ERROR,
)

ORIGINAL = "_original"
RECORD_ID = "_record_id"
_REQUIRED_TEXT = ("unique_key", "agency", "complaint_type", "status", "borough")


def row_barrier(df: DataFrame) -> DataFrame:
    """Same rows and columns; filters above it cannot be pushed into the expressions below."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def _original_source(raw: DataFrame) -> Column:
    """What the quarantine needs to rebuild the original record: the line, or the fields.

    Only references: the JSON text is produced after the invalid-row filter, so valid
    rows (which the barrier does not prune) never pay for serialisation.
    """
    if RAW_LINE in raw.columns:
        return F.struct(F.col(RAW_LINE).alias("line"))
    fields = [F.col(f) for f in RAW_FIELDS if f in raw.columns]
    return F.struct(column_or_null(raw, CORRUPT_RECORD).alias("line"), F.struct(*fields).alias("fields"))


def _original_record(parsed: DataFrame) -> Column:
    src = parsed.schema[ORIGINAL].dataType
    line = F.col(f"{ORIGINAL}.line")
    if "fields" in src.fieldNames():
        return F.coalesce(line, F.to_json(F.col(f"{ORIGINAL}.fields")))
    return line


def _parsed_or_null(raw: DataFrame, name: str, of_column, parse) -> Column:
    """The shared, prebuilt parser when the input has the column; else the parse of null."""
    return of_column(name) if name in raw.columns else parse(F.lit(None).cast("string"))


def _lenient_fields(raw: DataFrame) -> list[Column]:
    c = lambda name: column_or_null(raw, name)
    return [
        c("unique_key").alias("unique_key"),
        c("agency").alias("agency"),
        c("complaint_type").alias("complaint_type"),
        c("descriptor").alias("descriptor"),
        resolve_alias(raw, "open_data_channel_type", "channel_type").alias("channel_type"),
        lower_case(c("status")).alias("status"),
        upper_case(c("borough")).alias("borough"),
        zip_code(raw).alias("zip_code"),
        _parsed_or_null(raw, "latitude", coordinate_of, parse_coordinate).alias("latitude"),
        _parsed_or_null(raw, "longitude", coordinate_of, parse_coordinate).alias("longitude"),
        _parsed_or_null(raw, "created_date", created_date_of, parse_created_date).alias("created_date"),
        F.coalesce(c("unique_key"), F.lit(UNKNOWN_RECORD_ID)).alias(RECORD_ID),
        F.array().cast("array<string>").alias(TYPE_ERRORS),
    ]


def _strict_fields(raw: DataFrame) -> list[Column]:
    text = {f: (strict.value(raw, f), strict.json_type(raw, f)) for f in RAW_FIELDS}
    text["channel_type"] = strict.resolve_alias(raw, "open_data_channel_type", "channel_type")
    text["zip_code"] = strict.resolve_alias(raw, "incident_zip", "zip_code")
    s = {f: strict.string_field(*text[f]) for f in (*_REQUIRED_TEXT, "descriptor", "channel_type", "zip_code")}
    checks = [(f, strict.string_type_error(text[f][1])) for f in (*_REQUIRED_TEXT, "channel_type")]
    checks += [(f, strict.string_type_error(text[f][1])) for f in ("descriptor", "zip_code")]
    checks += [("created_date", strict.date_type_error(text["created_date"][1]))]
    order = {f: i for i, f in enumerate(("unique_key", "agency", "complaint_type", "descriptor", "channel_type",
                                         "status", "borough", "zip_code", "created_date"))}
    checks.sort(key=lambda fc: order[fc[0]])
    type_errors = F.filter(F.array(*[F.when(bad, F.lit(f)) for f, bad in checks]), lambda x: x.isNotNull())
    return [
        s["unique_key"].alias("unique_key"),
        s["agency"].alias("agency"),
        s["complaint_type"].alias("complaint_type"),
        s["descriptor"].alias("descriptor"),
        s["channel_type"].alias("channel_type"),
        lower_case(s["status"]).alias("status"),
        upper_case(s["borough"]).alias("borough"),
        F.coalesce(s["zip_code"], F.lit(DEFAULT_ZIP)).alias("zip_code"),
        strict.coordinate(*text["latitude"]).alias("latitude"),
        strict.coordinate(*text["longitude"]).alias("longitude"),
        strict.created_date(*text["created_date"]).alias("created_date"),
        strict.record_id(raw).alias(RECORD_ID),
        type_errors.alias(TYPE_ERRORS),
    ]


def project_requests(raw: DataFrame) -> DataFrame:
    """Every raw row with its typed, normalised fields and the quarantine's inputs."""
    fields = _strict_fields(raw) if strict.is_strict(raw) else _lenient_fields(raw)
    place = [F.col(c) for c in (BATCH, PLACE) if c in raw.columns]
    seq = F.col(SEQ) if SEQ in raw.columns else F.lit(None).cast("long").alias(SEQ)
    return raw.select(seq, *fields, _original_source(raw).alias(ORIGINAL), *place)


def parse_requests(raw: DataFrame) -> DataFrame:
    """``project_requests`` behind a row barrier."""
    return row_barrier(project_requests(raw))


def slim_requests(parsed: DataFrame) -> DataFrame:
    """Parsed rows as they are kept: only rejected rows have their original record and its id."""
    return parsed.withColumns({c: F.when(~is_valid(), F.col(c)) for c in (ORIGINAL, RECORD_ID)})


def stage_requests(raw: DataFrame, path: str) -> DataFrame:
    """The parsed rows written once; only rejected rows keep their original record."""
    slim = slim_requests(parse_requests(raw))
    slim.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(slim.schema).parquet(path)


def ingest_order(df: DataFrame) -> list[str]:
    """What "first" means: the batch it came with, then the feed's own number, else the place in the source."""
    return [c for c in (BATCH, SEQ, PLACE) if c in df.columns]


def clean_rows(parsed: DataFrame) -> DataFrame:
    """Valid rows, one per ``unique_key`` (the first in ingest order wins), in the clean schema."""
    order = ingest_order(parsed)
    rows = valid_rows(parsed).select(*CLEAN_COLUMNS, *[c for c in order if c not in CLEAN_COLUMNS])
    return keep_first(rows, "unique_key", order).select(*CLEAN_COLUMNS)


def error_fields() -> Column:
    """Names of the missing required fields, then of the fields with a wrong JSON type."""
    missing = null_flags(REQUIRED_FIELDS)
    return F.array_distinct(F.concat(missing, F.col(TYPE_ERRORS)))


def quarantine_rows(parsed: DataFrame, batch_id: int | Column = 0) -> DataFrame:
    """One record per rejected row: reason fields, type, id and the original record."""
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    bad = invalid_rows(parsed).withColumn(ERROR_FIELDS, error_fields())
    return bad.select(
        bid.cast("long").alias("batch_id"),
        F.col(SEQ),
        F.col(RECORD_ID).alias("record_id"),
        F.lit(VALIDATION_ERROR).alias("error_type"),
        F.col(ERROR_FIELDS).alias("error_fields"),
        F.concat(F.lit("invalid or missing: "), F.array_join(ERROR_FIELDS, ", ")).alias("error_message"),
        _original_record(parsed).alias("original_record"),
        F.current_timestamp().alias("quarantined_at"),
    )
