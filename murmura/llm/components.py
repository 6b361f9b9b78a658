"""Connected components of a link table, as alternating star contractions over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.storage import Scratch


def components(links: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node in ``links(a, b)``.

    Each round lets every node point its larger neighbours, then its smaller ones, at the smallest of
    them; after about as many rounds as the logarithm of the longest path all point at the root. Minima
    are combined on the map side and joined back, so a hub is never gathered in one task. Each round is
    written to the shared folder, which cuts the lineage, and the one before is removed. Null ends and self-links are ignored.
    """
    scratch = Scratch(links.sparkSession, f"llm-{name}")
    edges = scratch.keep(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "round",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = scratch.keep(_small_star(_large_star(edges)), "round")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
