"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.session import stage


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with) for every node of ``links`` (``a``, ``b``).

    Each round every node takes the smallest root of its neighbours, hands it on to its old
    root, and roots follow their roots; the rounds end when nothing changes, after about the
    logarithm of the longest chain. A round is written to the shared folder, so a lost executor
    repeats only its part. Nulls and links to itself are left out.
    """
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = stage(links.union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root"))
    while True:
        roots = stage(roots.select("node", "root"), "roots")
        near = both.join(roots, both["b"] == roots["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        seen = roots.join(near, "node", "left")
        offers = seen.select("node", F.least("root", "near").alias("root"), F.col("root").alias("was")).union(
            seen.select(F.col("root").alias("node"), F.col("near").alias("root"), F.lit(None).cast(roots.schema["root"].dataType).alias("was")))
        best = stage(offers.groupBy("node").agg(F.min("root").alias("root"), F.max("was").alias("was")), "offers")
        ends = best.select(F.col("node").alias("root"), F.col("root").alias("end"))
        moved = best.join(ends, "root").select("node", F.col("end").alias("root"), F.col("was"))
        if best.where("root <> was").isEmpty():
            return roots
        roots = moved
