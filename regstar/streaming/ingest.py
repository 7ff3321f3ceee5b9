"""Incremental CSV ingest with Structured Streaming.

Two forms, both with ``trigger(availableNow=True)``: they process the backlog
and stop, which is the "incremental, not continuous" refresh of a scheduled
pipeline.

``ingest_stream`` takes files of any header. A file-listing stream
(``binaryFile``, path column only) finds new files; its checkpoint records which
files were taken, so each file is processed once. Every micro-batch runs the
batch ingest on its new files and writes them under ``batch_id=<n>`` with
overwrite, so a replayed batch rewrites the same output instead of duplicating it.

``ingest_known`` takes folders whose header is known: the harmonising projection
runs on the CSV stream itself and Spark's Parquet sink commits the files.

Kept schema: with ``schema_path`` the stream keeps columns that no golden column
takes. Each batch that brings new ones records the wider schema as the next
version (a file named by the batch, so a replay rewrites it). ``read_evolved``
reads all batches with the newest version; Parquet gives NULL where an older
file lacks a column, and no footers are merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from regstar.domain import registrations as R
from regstar.operators.harmonize import harmonize_columns
from regstar.sources.csv_ingest import BINARY_FILE_SCHEMA, as_literal, header_schema, ingest_csv_paths, split_header

#: Files of one micro-batch: bounds the paths and headers that the driver holds at once.
MAX_FILES = 5000


def kept_schema(spark: SparkSession, schema_path: str, before: int | None = None) -> list[str]:
    """Column names of the newest recorded version (of the batches before ``before``); [] if there is none.

    One row a version: batch and names. Versions only grow.
    """
    try:
        log = spark.read.schema("batch_id long, names array<string>").json(f"{schema_path.rstrip('/')}/*")
        rows = log.filter(F.col("batch_id") < before) if before is not None else log
        last = rows.orderBy(F.desc("batch_id")).first()
    except Exception as e:  # noqa: BLE001 - the first batch finds no folder
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    return [] if last is None else list(last["names"])


def _keep_schema(batch: DataFrame, batch_id: int, schema_path: str) -> None:
    spark = batch.sparkSession
    known = kept_schema(spark, schema_path, batch_id)
    names = known + [n for n in batch.columns if n not in known]
    if names != known:
        spark.createDataFrame([(batch_id, names)], "batch_id long, names array<string>").coalesce(1).write.mode("overwrite").json(
            f"{schema_path.rstrip('/')}/version-{batch_id:012d}")


def ingest_stream(spark: SparkSession, source: str, output: str, checkpoint: str, glob: str | None = None,
                  sep: str = ",", aliases: Mapping[str, str] = R.HEADER_ALIASES,
                  golden: Sequence[str] = R.GOLDEN_COLUMNS, max_files_per_trigger: int = MAX_FILES,
                  available_now: bool = True, schema_path: str | None = None, malformed: bool = False):
    """Start the ingest stream; returns the StreamingQuery (already finished if available_now).

    ``schema_path``, outside ``source``, turns the kept schema on; ``malformed``
    is that of ``ingest_csv``.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files_per_trigger)))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listing = reader.load(source).select("path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [as_literal(r["path"]) for r in batch.collect()]  # at most max_files_per_trigger
        rows = paths and ingest_csv_paths(batch.sparkSession, paths, sep, aliases, golden, malformed=malformed, extra=schema_path is not None)
        if rows:
            if schema_path is not None:
                _keep_schema(rows, batch_id, schema_path)
            rows.write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch_id={batch_id}")

    writer = listing.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def read_bronze(spark: SparkSession, output: str) -> DataFrame:
    """The ingested rows (all batches); ``batch_id`` is a partition column."""
    return spark.read.parquet(output)


def read_evolved(spark: SparkSession, output: str, schema_path: str) -> DataFrame:
    """The ingested rows with the newest kept schema; rows of older batches have NULL in later columns."""
    fields = [T.StructField(n, T.StringType(), True) for n in kept_schema(spark, schema_path)]
    return spark.read.schema(T.StructType([*fields, T.StructField("batch_id", T.LongType(), True)])).parquet(output)


def csv_stream(spark: SparkSession, source: str, header: str, sep: str = ",", aliases: Mapping[str, str] = R.HEADER_ALIASES,
               golden: Sequence[str] = R.GOLDEN_COLUMNS, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """New files of a folder whose files all have ``header``, harmonised on the stream itself."""
    names = split_header(header, sep)
    raw = (spark.readStream.schema(header_schema(names)).option("header", "true").option("sep", sep).option("mode", "PERMISSIVE")
           .option("multiLine", str("\n" in header).lower()).option("maxFilesPerTrigger", str(max_files_per_trigger)).csv(source))
    return harmonize_columns(raw, aliases, golden, headers=names)


def ingest_known(spark: SparkSession, headers: Mapping[str, str], output: str, checkpoint: str, sep: str = ",",
                 aliases: Mapping[str, str] = R.HEADER_ALIASES, golden: Sequence[str] = R.GOLDEN_COLUMNS):
    """Ingest folders with known headers ({folder: header line}) into Parquet; returns the finished query."""
    stream = None
    for folder, header in headers.items():
        rows = csv_stream(spark, folder, header, sep, aliases, golden)
        stream = rows if stream is None else stream.unionByName(rows)
    query = (stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query
