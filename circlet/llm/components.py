"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circlet.llm.common import materialize


def _star(arcs: DataFrame, small: bool) -> DataFrame:
    """Links every node's neighbours to the smallest of them. A node with most of the links makes a skewed join, which
    adaptive execution splits; its minimum is made in the map tasks first."""
    both = arcs if small else arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v_min")).select("u", F.least("u", "v_min").alias("m"))
    met = both.join(least, "u")
    if small:
        moved = met.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*")
    else:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach. ``links`` has columns a and b."""
    arcs = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "arcs")
    seal = None
    while True:
        arcs = materialize(_star(_star(arcs, small=False), small=True), "arcs")
        now = arcs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seal:
            return arcs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seal = now
