"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regstar.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (u, v); the component is its smallest node.

    Each round is a few aggregates and joins over the links: every node first
    hands its larger neighbours to the smallest one, then its smaller ones. The
    table stays as long as the links and ends as a star around each smallest
    node. A hub's rows are reduced by partial aggregates, and AQE may split the
    joins. Each round's table is stored, so a round is the unit of recovery.
    Links of a node with itself, NULL links and repeated links change nothing.
    """
    e = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, last = stage(e, "links"), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            break
        last = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
