"""Connected components of a link table, in Spark (large-star / small-star contraction).

Each round replaces links by links to the smallest neighbour; stars are reached after about log(diameter) rounds.
Minima are pre-aggregated in tasks and written before they are joined back, so that both sides of the join come
straight from a table and the adaptive skew join can split a node that a third of all links touch. The table of minima
also tells whether stars are reached: that one answer and the number of links are all that reaches the driver. No
table of a round has more than two rows per link, so the number of links bounds the files worth writing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link between different nodes, the smallest node it is linked with
    through any number of links. Links may repeat and point either way; nulls and self links are ignored."""
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    edges = links.where((F.col(a) != F.col(b))).select(u.cast("long").alias("u"), v.cast("long").alias("v")).distinct()
    edges = cut(edges, "links")
    most = 2 * edges.count()
    while True:
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("o")).union(edges.select("v", "u"))
        up = F.col("o") < F.col("n")
        low = cut(both.groupBy("n").agg(F.min("o").alias("m"), F.count_if(up).alias("up"),
                                        F.count_if(~up).alias("down")), "links-low", most)
        # stars: every node is either the smallest of its component or linked with that one alone
        if low.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty():
            break
        low = low.select("n", F.least("n", "m").alias("m"))
        large = both.join(low, "n").where(F.col("o") > F.col("n")).select(F.col("o").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct(), "links-large", most)
        small_low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "links-low", most)
        small = large.join(small_low, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(small_low.select("u", F.col("m").alias("v"))).distinct(), "links", most)
    return low.select(F.col("n").alias("node"), F.least("n", "m").alias("component"))
