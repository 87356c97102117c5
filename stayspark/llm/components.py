"""Connected components of links by alternating large and small stars, in DataFrame functions; nothing goes to the driver.

Every round is written to the shared folder, so lineage stays short. The number of rounds grows as the logarithm of the
longest path. Null ends are dropped; a node without links is no row of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import discard, materialise


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are tied to the least of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b")


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    own = least.select(F.col("m").alias("a"), "b")
    return edges.join(least, "b").where(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(own)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; the component is its least node."""
    edges = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where((F.col("a") != F.col("b")) & F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = materialise(edges.distinct(), "edges")
    while True:
        new = materialise(_small(_large(edges).distinct()).where(F.col("a") < F.col("b")).distinct(), "edges")
        # A forest of stars: every node has one smaller neighbour, which is no one's larger one.
        roots = new.select(F.col("a").alias("b")).distinct()
        done = new.groupBy("b").count().where("count > 1").limit(1).count() == 0 and new.join(roots, "b", "left_semi").limit(1).count() == 0
        discard(edges)
        edges = new
        if done:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
