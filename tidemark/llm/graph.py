"""Connected components of a link table, without gathering links or components in one place."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that is not the smallest of its component; the component is the smallest node.

    Alternates two steps until nothing changes: every node points its larger neighbours to the smallest neighbour, then
    its smaller ones. The number of rounds grows with the logarithm of the longest chain. Minima are combined before they
    shuffle, and the joins back are plain equi-joins, which adaptive execution splits at a hub of many links. Each round
    is a written table, so a lost executor costs no earlier round. Links with a null end or both ends equal are ignored.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = settle(ends.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        pointed = larger.join(least, "u")
        smaller = pointed.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
