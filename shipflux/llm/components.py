"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.session import staged


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in `links` (a, b): root is the smallest id of its component.

    A round points every id to its smallest neighbour, follows the pointers to
    their ends by doubling, and replaces the links by links between ends, until
    none are left. Every step is a written table, so a lost executor costs one step.
    """
    edges = staged(links.select("a", "b").filter("a <> b"), "links")
    both = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id")))
    roots = staged(both.distinct().withColumn("root", F.col("id")), "roots")
    while not edges.isEmpty():
        mirrored = edges.union(edges.select("b", "a")).toDF("id", "near")
        pointers = staged(mirrored.groupBy("id").agg(F.least(F.min("near"), F.col("id")).alias("end")), "pointers")
        while True:
            ahead = pointers.select(F.col("id").alias("end"), F.col("end").alias("beyond"))
            jumped = staged(
                pointers.join(ahead, "end", "left").select("id", "end", F.coalesce("beyond", "end").alias("beyond")),
                "pointers",
            )
            pointers = jumped.select("id", F.col("beyond").alias("end"))
            if jumped.filter("end <> beyond").isEmpty():
                break
        ends = pointers.withColumnRenamed("id", "root")
        roots = staged(
            roots.join(ends, "root", "left").select("id", F.coalesce("end", "root").alias("root")), "roots"
        )
        edges = staged(
            edges.join(pointers.toDF("a", "x"), "a")
            .join(pointers.toDF("b", "y"), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    return roots
