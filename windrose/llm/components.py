"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import discard, stored


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node has several smaller neighbours, or one that has a smaller one itself."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    nodes = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return bool(nodes.agg(F.max(F.col("out") + F.col("into") > 1)).first()[0])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is its smallest node.

    Alternates two star steps until every node is tied to its component and to nothing else: all
    larger neighbours of a node are tied to its smallest neighbour, then all smaller ones. Rounds grow
    with the logarithm of the longest path. Smallest neighbours are aggregated before the shuffle and
    written, so that the joins have plain tables on both sides and Spark can split a node with very
    many edges. No task holds a neighbourhood. Edges with a null end are ignored; a loop makes its
    node a component.
    """
    spark = edges.sparkSession
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs, pairs_path = stored(pairs.distinct(), "edges")
    current, path = pairs.where("a <> b"), None
    while _unsettled(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = least.select(F.col("a").alias("n"), F.least("a", "low").alias("low"))
        least, least_path = stored(least, "low")
        larger = both.join(least, F.col("a") == F.col("n")).where("b > a")
        tied = larger.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        tied, tied_path = stored(tied, "tied")
        least2 = tied.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        least2, least2_path = stored(least2, "low")
        smaller = tied.join(least2, F.col("a") == F.col("n")).where("b <> low")
        after = (
            smaller.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(least2.select(F.col("n").alias("a"), F.col("low").alias("b")))
            .distinct()
        )
        after, after_path = stored(after, "edges")
        discard(spark, least_path, tied_path, least2_path, *filter(None, [path]))
        current, path = after, after_path
    loops = pairs.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ties = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # A node with a loop and other edges has its component from those.
    found = ties.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
    found, _ = stored(found, "components")
    discard(spark, pairs_path, *filter(None, [path]))
    return found
