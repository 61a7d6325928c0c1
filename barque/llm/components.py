"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barque.llm.storage import discard, stored


def _hooked(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each (u, v) beside the least neighbour of u; and the table of those, to discard afterwards."""
    least = stored(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return pairs.join(least, "u"), least


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) to (id, component): the smallest id that each id can reach. Ids without edges are left out.

    Alternates large-star and small-star steps (a logarithmic number of rounds, whatever the shape), each a grouped
    minimum and a join that Spark may split on a hot id. Each round is a table in the shared folder.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooked, least = _hooked(both)
        large = hooked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stored(large, "large")
        discard(least)
        small, least = _hooked(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        after = stored(small.filter("u > v").distinct(), "small")
        seen = tuple(after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        discard(now, large, least)
        now = after
        if seen == mark or not seen[0]:
            break
        mark = seen
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
