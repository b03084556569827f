"""File discovery by a stream that stops once it has caught up.

The stream carries file names, not rows; each of its batches becomes one incremental
run with the same isolation of bad files. Spark remembers paths it has seen, so this
takes new paths only: a file replaced under its old name, or one much older than the
newest (see the source option ``maxFileAge``), needs the ledger mode instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.incremental import RunOptions, run_incremental
from tidemark.schema import LISTING_SCHEMA
from tidemark.sources.listing import PARQUET
from tidemark.state.ledger import Ledger


def run_available(
    spark: SparkSession,
    source: str,
    root: str,
    options: RunOptions | None = None,
    files_per_run: int | None = None,
) -> list[dict]:
    """Process every path not seen before; returns the totals of the runs made.

    A batch that is delivered again after a crash finds its run in the ledger and is
    skipped, so its rows are applied once.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(T.StructType([*LISTING_SCHEMA.fields, T.StructField("content", T.BinaryType())]))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET)
    )
    if files_per_run:
        reader = reader.option("maxFilesPerTrigger", files_per_run)
    listing = reader.load(source).select("path", "modificationTime", "length")
    totals: list[dict] = []

    def one_run(batch: DataFrame, number: int) -> None:
        # The files are part of the name: after a lost checkpoint numbers start over.
        files = F.bit_xor(F.xxhash64("path", "modificationTime")).alias("files")
        run_id = f"stream-{number}-{batch.agg(files).first()['files']}"
        session = batch.sparkSession
        if not Ledger(session, f"{root}/state").has(run_id):
            totals.append(run_incremental(session, source, root, options, batch, run_id))

    query = (
        listing.writeStream.foreachBatch(one_run)
        .option("checkpointLocation", f"{root}/state/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return totals
