"""Connected components of an undirected graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every end of ``edges`` (``a, b``): the least node it is linked to.

    Alternates two steps that keep what is connected so. First each node hands its larger
    neighbours to the least of its neighbourhood, then each node hands itself and its smaller
    neighbours to the least of those. What is left is a star around the least node of each
    component. The number of rounds grows with the logarithm of the longest path; every round
    is written to the shared folder, and the driver only sees whether it changed anything.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    links = stored(links.distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), "m")
        links = larger.where("u <> m").select("u", F.col("m").alias("v")).distinct()
        # Each node's links to smaller ones: they and the node itself go to the least of them.
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        smaller = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = smaller.where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))
        ).distinct()
        links = stored(links, "links")
        after = _state(links)
        if after == state:
            break
        state = after
    roots = links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    own = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return roots.unionByName(own)


def _state(links: DataFrame):
    mark = F.xxhash64("u", "v")
    return links.agg(
        F.count(F.lit(1)), F.bit_xor(mark),
        F.sum(F.pmod(mark, F.lit(1_000_003)).cast("decimal(20,0)")),
    ).first()
