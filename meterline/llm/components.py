"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import written


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that occurs in a link with two different,
    non-null ends; root is the smallest node of its component.

    Each step replaces links by links to the smallest neighbour and shrinks
    every component toward a star, in about log(n) steps. Neighbour lists are
    never gathered: the smallest neighbour is a pre-aggregated minimum, written and
    joined back, so that Spark can split the links of a node that has very many."""
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = written(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u")
        edges = written(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
