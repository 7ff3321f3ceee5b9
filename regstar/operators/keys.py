"""Dense surrogate keys (1..n in a global order) without a single-partition sort.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into one
task. The ``range`` method here gives the same keys with a distributed sort:

1. range-partition on the order (Spark samples the keys for split points) and
   sort within partitions;
2. tag each row with its partition id and ``monotonically_increasing_id``,
   whose low 33 bits are the row's position inside its partition;
3. write that frame once to the shared checkpoint folder and read it back,
   so the positions are fixed even if a task is retried or an executor is
   lost (an eager ``checkpoint`` would compute the input twice);
4. count rows per partition (one row per partition), turn the counts into
   running offsets, and broadcast them: their size is bounded by the number of
   partitions, not by the data;
5. key = offset of the partition + position + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regstar.session import materialize, shuffled

_POSITION_BITS = 33
MOST_INT = (1 << 31) - 1


def _cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _finish(df: DataFrame, name: str, key: Column, prefix: str | None, as_int: bool = False) -> DataFrame:
    if as_int:  # the tables' schema asks for it; beyond its range the query fails rather than wraps
        key = F.when(key <= MOST_INT, key).otherwise(F.raise_error(F.lit(f"{name}: more keys than an int holds"))).cast("int")
    if prefix is not None:
        key = F.concat(F.lit(prefix), key.cast("string"))
    return df.withColumn(name, key)


def dense_key(df: DataFrame, order: Sequence, name: str, prefix: str | None = None,
              method: str = "range", num_partitions: int | None = None,
              natural: Sequence[str] | None = None, as_int: bool = True) -> DataFrame:
    """Add ``name`` = 1..n in ``order`` (ascending, NULLs first, like ``orderBy``).

    method="range" (default): distributed (see module doc).
    method="plain": ``row_number()`` over a global window: every row in one task.
    method="hash": stable 64-bit hash of ``natural`` (or the order columns);
    keys survive reloads when new names arrive, but are not dense, and two
    names can share one (about n^2 / 2^65 of n names); it is always a long.
    ``as_int=False`` leaves dense keys long.
    """
    order_cols = _cols(order)
    if method == "plain":
        key = F.row_number().over(Window.orderBy(*order_cols))
        return _finish(df, name, key, prefix, as_int)
    if method == "hash":
        cols = _cols(natural) if natural else order_cols
        return _finish(df, name, F.xxhash64(*cols), prefix)
    if method != "range":
        raise ValueError(f"unknown method {method!r}")

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = materialize(df.repartitionByRange(max(1, n), *order_cols)
                         .sortWithinPartitions(*order_cols)
                         .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}),
                         "dense-key")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    position = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POSITION_BITS)
    key = F.col("_off") + position + 1
    keyed = tagged.join(F.broadcast(offsets), "_pid")
    return _finish(keyed, name, key, prefix, as_int).drop("_pid", "_mid", "_off")



class KeyRegistry:
    """Dense keys that last over loads: an append-only Parquet table under ``path``.

    A load adds the names that no earlier load has, numbered on from the
    greatest key by the distributed sort of ``dense_key``; nothing stored is
    rewritten. Each load is a folder ``load=<n>``, so repeating a load rewrites
    its own names with the same keys. Loads are numbered in order, by one writer.
    A name may have NULLs.
    """

    def __init__(self, spark: SparkSession, path: str, load: int):
        self.spark, self.path, self.load = spark, path.rstrip("/"), load

    def known(self, name: str, schema: str, upto: int) -> DataFrame:
        """The names of dimension ``name`` that loads up to ``upto`` have given a key."""
        reader = self.spark.read.schema(schema + ", load int")
        try:
            found = reader.parquet(f"{self.path}/{name}")
        except Exception as e:  # noqa: BLE001 - the first load finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)
        return found.filter(F.col("load") <= upto).drop("load")

    def keyed(self, df: DataFrame, natural: Sequence[str], key_col: str, prefix: str | None = None) -> DataFrame:
        """``df``, of distinct ``natural`` names, with their keys; new names get the next ones."""
        names = df.select(*natural)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names.schema.fields) + ", _key long"
        before = self.known(key_col, schema, self.load - 1)
        columns = [F.col(n).alias(f"_n{i}") for i, n in enumerate(natural)]

        def same(left: DataFrame) -> Column:
            cond = F.lit(True)
            for i, n in enumerate(natural):
                cond = cond & left[n].eqNullSafe(F.col(f"_n{i}"))
            return cond

        last = before.agg(F.max("_key")).first()[0] or 0
        new = names.join(shuffled(before.select(*columns)), same(names), "left_anti")
        numbered = dense_key(new, list(natural), "_key", as_int=False).withColumn("_key", F.col("_key") + last)
        numbered.write.mode("overwrite").parquet(f"{self.path}/{key_col}/load={self.load}")
        every = shuffled(self.known(key_col, schema, self.load).select(*columns, "_key"))
        return _finish(df.join(every, same(df)).drop(*[f"_n{i}" for i in range(len(natural))]).withColumnRenamed("_key", "_number"),
                       key_col, F.col("_number"), prefix, as_int=True).drop("_number")
