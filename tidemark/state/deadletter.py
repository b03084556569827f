"""Failed-file log: one JSON row per failure, in folders by date."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import failed_log_name, short_message
from tidemark.schema import FAILED_SCHEMA
from tidemark.session import empty_table, exists, one_row

LOG_SCHEMA = T.StructType(
    FAILED_SCHEMA.fields
    + [T.StructField("log_name", T.StringType()), T.StructField("failed_date", T.DateType())]
)


def failed_rows(
    failures: DataFrame, timestamp: str | Column, failed_date: date | Column | None = None
) -> DataFrame:
    """Log rows from ``path, error_type, error_message, records``.

    Rows are appended, so two paths whose safe names collide, or two failures of one
    file on a day, do not overwrite each other.
    """
    moment = timestamp if isinstance(timestamp, Column) else F.lit(timestamp)
    day = failed_date
    if day is None:
        day = F.substring(moment, 1, 10).cast("date")
    elif not isinstance(day, Column):
        day = F.lit(day)
    return failures.select(
        F.col("error_type"),
        short_message(F.col("error_message")).alias("error_message"),
        F.coalesce(F.col("records"), F.lit(0)).cast("bigint").alias("record_count"),
        moment.alias("timestamp"),
        F.col("path").alias("original_filename"),
        F.struct(
            F.col("path").alias("file_key"), F.col("error_type").alias("exception_type")
        ).alias("additional_context"),
        failed_log_name(F.col("path")).alias("log_name"),
        day.alias("failed_date"),
    )


def write_failed_log(rows: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add rows to the log. A repeated ``run_id`` replaces what it wrote before for the same days."""
    named = rows.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("failed_date", "run_id").json(path)


def log_failure(
    spark: SparkSession,
    path: str,
    filename: str,
    error: BaseException,
    record_count: int,
    now: datetime,
) -> None:
    """Log one exception raised on the driver."""
    row = {
        "path": filename,
        "error_type": type(error).__name__,
        "error_message": str(error),
        "records": record_count,
    }
    schema = T.StructType.fromDDL(
        "path string, error_type string, error_message string, records bigint"
    )
    write_failed_log(failed_rows(one_row(spark, row, schema), now.isoformat()), path)


def read_failed_log(spark: SparkSession, path: str, failed_date: date | str | None = None) -> DataFrame:
    """All failures, or those of one day (only that day's folder is read)."""
    if not exists(spark, path):
        return empty_table(spark, LOG_SCHEMA)
    rows = spark.read.schema(LOG_SCHEMA).json(path).select(*LOG_SCHEMA.fieldNames())
    if failed_date is not None:
        rows = rows.where(F.col("failed_date") == F.lit(failed_date).cast("date"))
    return rows


def failures_of(log: DataFrame, filename: str) -> DataFrame:
    return log.where(F.col("original_filename") == filename)


def read_foreign_log(spark: SparkSession, path: str) -> DataFrame:
    """Logs written by other tools as one indented JSON object per file."""
    return spark.read.schema(FAILED_SCHEMA).option("multiLine", "true").json(path)
