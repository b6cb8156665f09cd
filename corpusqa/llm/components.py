"""Connected components of a link table by alternating star contractions.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): a
large-star round ties every larger neighbour of a node to the smallest node it
can see, a small-star round does so for the smaller ones. Both are a grouped
minimum (combined map-side) and an equi-join, so a component of any size is
never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import stored


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    return (
        large.join(low, "a")
        .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .filter("a <> b")
        .distinct()
    )


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b long, non-null) -> (node, root): every linked node and the
    smallest node of its component (its root included). No links: no rows."""
    links = stored(links.filter("a <> b").select("a", "b"), "links")
    digest = _digest(links)
    while digest[0]:
        new = stored(_round(links), "stars")
        before, digest = digest, _digest(new)
        links = new
        if digest == before:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
