"""New files become landing rows.

``land_stream`` merges each batch of new CSV files into the landing tables of a store, as a run over a folder
does: files are read per header, files of an unknown header are set aside, and only the buckets a batch touches are
rewritten. A replayed batch meets its own rows, so it changes nothing.

For other row streams ``ingest`` keeps an append-only log; the table is the last row per key.

Every micro-batch overwrites its own ``_batch`` partition, so a replayed batch leaves one copy. The
cost of a batch is its own rows, never the table. ``compact`` folds the log into one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import dedupe_keep_last
from ..plans.landing import LandingRun, land_files
from ..sources.csv_files import SEQ, csv_files_at, null_tokens
from ..sources.tables import LayerStore, write_audit

BATCH = "_batch"


def land_batch(store: LayerStore, multi_line: bool = True):
    """The ``foreachBatch`` body for a stream of file paths; returns what was landed, for callers that test it."""

    def body(batch: DataFrame, batch_id: int) -> LandingRun:
        # One short row per new file, at most ``max_files`` of them.
        found = sorted((r["path"], r["modificationTime"]) for r in batch.select("path", "modificationTime").collect())
        files = csv_files_at(store.spark, sorted(found, key=lambda f: (f[1], f[0])))
        done = land_files(store.spark, files, store, multi_line)
        if done.skipped:
            rows = store.spark.createDataFrame([(p, batch_id) for p in done.skipped], "path string, batch long")
            write_audit(rows, f"{store.root}/audit", f"batch-{batch_id}", "skipped_files")
        return done

    return body


def land_stream(store: LayerStore, folder: str, checkpoint: str, max_files: int = 100, multi_line: bool = True) -> None:
    """Land all CSV files of a folder not seen before, ``max_files`` a batch, then stop.

    The stream holds paths only; contents are read by the batch that lands them.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    paths = (
        store.spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files).load(folder).filter("length > 0").select("path", "modificationTime")
    )
    query = (
        paths.writeStream.foreachBatch(lambda b, i: (land_batch(store, multi_line)(b, i), None)[1])
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def csv_stream(spark: SparkSession, folder: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """CSV files as they arrive; a file whose header does not follow the schema fails the batch."""
    rows = (
        spark.readStream.schema(schema)
        .options(header=True, sep=separator, encoding="ISO-8859-1", quote='"', escape='"', enforceSchema=False)
        .csv(folder)
    )
    sequence = F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return null_tokens(rows.select(*schema.names, sequence.alias(SEQ)))


def write_batch(log_path: str, keys: list[str], order_by: list[str]):
    """The ``foreachBatch`` body: last row per key of the batch into the batch's partition."""

    def body(batch: DataFrame, batch_id: int) -> None:
        if SEQ in batch.columns:
            # Row numbers exist only inside a batch, right on its scan.
            row = F.monotonically_increasing_id().alias("row")
            batch = batch.withColumn(SEQ, F.struct(f"{SEQ}.*", row))
        last = dedupe_keep_last(batch, keys, order_by)
        (
            last.withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH).parquet(log_path)
        )

    return body


def ingest(stream: DataFrame, log_path: str, checkpoint: str, keys: list[str], order_by: list[str]) -> None:
    """Take in all files not seen before, then stop."""
    query = (
        stream.writeStream.foreachBatch(write_batch(log_path, keys, order_by))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def current_rows(
    log: DataFrame, keys: list[str], order_by: list[str], arrival_wins: bool = True
) -> DataFrame:
    """Last row per key by arrival, or by ``order_by`` alone; rows with a NULL key all stay."""
    order = [BATCH, *order_by] if arrival_wins else [*order_by, BATCH]
    return dedupe_keep_last(log, keys, order).drop(BATCH)


def compact(spark: SparkSession, log_path: str, new_path: str, keys: list[str], order_by: list[str]) -> None:
    """Write the current rows as the base (batch -1) of a new log; readers move over afterwards."""
    rows = current_rows(spark.read.parquet(log_path), keys, order_by)
    rows.withColumn(BATCH, F.lit(-1).cast("long")).write.partitionBy(BATCH).parquet(new_path)
