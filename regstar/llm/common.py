"""Helpers shared by the operators: staged tables, size-checked broadcasts, row keys."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import regstar
from regstar.session import materialize

#: A side is broadcast only if its stored copy has at most so many bytes and rows.
BROADCAST_BYTES = 8 << 20
BROADCAST_ROWS = 500_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once per application.

    Executors need not have it installed: Spark sends them the archive, and
    those that start later fetch it too.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(regstar.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="regstar-"), "regstar.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    Cuts the lineage at a durable copy, so that a lost executor costs the
    tasks it ran and not the whole chain before them.
    """
    return materialize(df, name)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a frame that was just read back by ``stage``."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def is_small(staged: DataFrame) -> bool:
    """Whether a staged frame's stored size and rows are within the bounds above."""
    return stored_bytes(staged) <= BROADCAST_BYTES and staged.count() <= BROADCAST_ROWS


def small_side(staged: DataFrame) -> DataFrame:
    """A broadcast hint for a small staged frame; else the frame as it is, for a shuffle join."""
    return F.broadcast(staged) if is_small(staged) else staged


def row_key(*cols: Column) -> Column:
    """A 64-bit key of a row's id and text, for joining derived facts back to it.

    The operators that use it check what they joined against the row's own
    text, so two rows with one key (equal rows, or a collision) do no harm.
    """
    return F.xxhash64(*cols)


def text_of(col: str | Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")
