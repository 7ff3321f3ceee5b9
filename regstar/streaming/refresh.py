"""Incremental silver refresh from a stream of bronze records.

Keep-latest is a maximum per registration key, so it can be taken of parts and
then of the parts' results. Each micro-batch writes the winners among its own
rows, with the phase-A columns (key, repaired and parsed dates), as one
``batch_id`` partition of a Parquet table; it reads and rewrites nothing that is
stored, so a batch costs what it brings. Silver is keep-latest over that table.

A replayed batch overwrites its own partition with the same rows. ``rewrite`` is
the scheduled job that folds a state table into a new one of a row per key;
later batches go to the new table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.operators.clean import CleanOptions, dedup_columns, finish_clean
from regstar.operators.dedup import keep_latest_by
from regstar.operators.quality import expect_or_drop
from regstar.plans import medallion as Md


def merge_batch(batch: DataFrame, batch_id: int, state_path: str, opts: CleanOptions = CleanOptions()) -> None:
    """Store the winners of one batch of bronze rows."""
    latest = keep_latest_by(dedup_columns(batch, opts), [Md.REG_KEY], Md.latest_order())
    latest.write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/batch_id={batch_id}")


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The latest row per key over all batches stored."""
    return keep_latest_by(spark.read.parquet(state_path).drop("batch_id"), [Md.REG_KEY], Md.latest_order())


def read_silver(spark: SparkSession, state_path: str, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Silver as the rows stored so far give it."""
    return finish_clean(expect_or_drop(read_state(spark, state_path), Md.SILVER_EXPECTATIONS), opts)


def rewrite(spark: SparkSession, state_path: str, new_path: str) -> None:
    """Fold the state into ``new_path``, under the number of its last batch."""
    last = spark.read.parquet(state_path).agg(F.max("batch_id")).first()[0]
    read_state(spark, state_path).write.mode("overwrite").parquet(f"{new_path.rstrip('/')}/batch_id={last}")


def refresh_stream(spark: SparkSession, source: str, schema, state_path: str, checkpoint: str,
                   max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """Run the refresh over new files in ``source`` (availableNow); returns the finished query."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.load(source).writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, state_path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
