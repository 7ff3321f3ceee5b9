"""Writing datasets as tables (parquet files or catalog tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                mode: str = "overwrite", partition_by: list[str] | None = None,
                bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Write ``df`` to ``path`` (parquet) or as catalog ``table``.

    With ``bucket_by`` (number, columns) the rows of a bucket are dealt together
    first, so each bucket is one sorted file, and tables that are bucketed alike
    join on these columns without a shuffle. Only a catalog table remembers its
    buckets; with a ``path`` too, its files lie there.
    """
    if bucket_by:
        if not table:
            raise ValueError("only a catalog table can be bucketed")
        n, cols = bucket_by
        df = df.repartition(n, *cols)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
        if path:
            writer = writer.option("path", path)
    if table:
        writer.format("parquet").saveAsTable(table)
    elif path:
        writer.parquet(path)
    else:
        raise ValueError("give a path or a table name")

