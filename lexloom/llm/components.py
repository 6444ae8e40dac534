"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.llm.store import drop, keep


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of a link reaches, by alternating large-star and small-star.

    Each link goes from its larger node u to its smaller v, and the least v of each u is a table of its own. Large-star ties u to the least
    of v; small-star ties each v of u, and u, to the least of u. All are done once each u has one v and no v is a u. Tables are
    written to the shared folder; the driver sees only counts. Edges are joined to written tables, so that Spark splits the edges of a
    node with very many. Links with a null end are left out, as are links of a node with itself; no links give an empty table.
    """
    spark = links.sparkSession
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = keep(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        first = _least(edges)
        large = keep(edges.join(first.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved")), "large")
        all_, moved = large.agg(F.count("*"), F.count_if("moved")).first()
        ended = not moved and first.count() == all_
        drop(spark, first)
        if ended:
            drop(spark, large)
            break
        least = _least(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        after = keep(small.distinct(), "edges")
        for table in (edges, large, least):
            drop(spark, table)
        edges = after
    heads = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least v of each u, summed up before it is dealt, so that a node with very many is no single task's work."""
    return keep(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
