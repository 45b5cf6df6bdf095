"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _largest_to_least(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its least neighbour."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .filter("u != v").distinct()


def _all_to_least(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them; every link points down."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every linked node but each component's least, which is the label.

    ``links`` has long columns u and v.  Rounds of two star steps turn every component into a
    star around its least node; sums are taken map-side first, and the joins have one row per
    node on one side, so adaptive execution can split a node with very many links.
    """
    state = stored(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    before = None
    while True:
        n, mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, mark) == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = n, mark
        state = stored(_all_to_least(_largest_to_least(state)), "stars")
