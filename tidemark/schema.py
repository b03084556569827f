"""Fixed schemas and limits of the record model."""

from __future__ import annotations

from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

KEY = "id"
ORDER = "updated_at"

# Column names and types of an incoming record.
RAW_SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("email", StringType()),
        StructField("status", StringType()),
        StructField("updated_at", TimestampNTZType()),
        StructField("payload", StringType()),
    ]
)

PROCESSED_AT = "_etl_processed_at"
BATCH_ID = "_etl_batch_id"
AUDIT_COLUMNS = (PROCESSED_AT, BATCH_ID)

# The audit time is a UTC wall-clock value: the target declares a timestamp
# without zone, and a zone-free type cannot drift with the session zone.
TARGET_SCHEMA = StructType(
    RAW_SCHEMA.fields
    + [StructField(PROCESSED_AT, TimestampNTZType()), StructField(BATCH_ID, StringType())]
)

# Character limits of the target's text columns.
VARCHAR_LIMITS = {"name": 255, "email": 255, "status": 50, BATCH_ID: 50}

# Fixed value: accepted shape of a textual updated_at (no zone, "T", 0-9 fraction digits).
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,9})?$"

# Text that can be a 64-bit integer; surrounding blanks are allowed.
INTEGER_TEXT = r"^\s*[+-]?0*\d{1,19}\s*$"

# Fixed value: rows per slice unless the caller says otherwise.
BATCH_SIZE = 100_000

# Fixed value: longest error message kept in a failed-file log.
MESSAGE_LIMIT = 1000

LISTING_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
    ]
)

MARK_SCHEMA = StructType(
    [
        StructField("last_successful_run", StringType()),
        StructField("last_processed_file", StringType()),
        StructField("records_processed", LongType()),
        StructField("watermark_id", StringType()),
    ]
)

FAILED_SCHEMA = StructType(
    [
        StructField("error_type", StringType()),
        StructField("error_message", StringType()),
        StructField("record_count", LongType()),
        StructField("timestamp", StringType()),
        StructField("original_filename", StringType()),
        StructField(
            "additional_context",
            StructType(
                [
                    StructField("file_key", StringType()),
                    StructField("exception_type", StringType()),
                ]
            ),
        ),
    ]
)

# Working columns carried between reading and the upsert; never part of a target.
PATH = "_path"
ROW = "_row"
BATCH = "_batch"
SEQ = "_seq"
ERRORS = "_errors"
RAW = "_raw_record"
SUPPLIED = "_supplied"
# Dates of single columns where they are not the row's: partial rows leave columns of several ages.
DATES = "_dates"
