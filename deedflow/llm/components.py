"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def _tidy(edges: DataFrame) -> DataFrame:
    return cut(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (node, comp) of every node with an edge to another; comp is one node of the component.

    Each level hooks every node to its smallest neighbour (itself included), follows that pointer once more and contracts
    the edges; levels end when no edge is left. Everything is aggregation and equi-joins on tables in the shared
    folder: a hub's edges are pre-aggregated and its lookups are joins that Spark can split.
    """
    edges, maps, made = _tidy(edges), [], []
    while not edges.isEmpty():
        made.append(edges)
        both = edges.union(edges.select("v", "u"))
        hook = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        jump = hook.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        hook = cut(hook.join(jump, "p", "left").select("u", F.coalesce("pp", "p").alias("p")))
        maps.append(hook)
        left = hook.select("u", F.col("p").alias("a"))
        right = hook.select(F.col("u").alias("v"), F.col("p").alias("b"))
        edges = _tidy(edges.join(left, "u").join(right, "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
    if maps:
        made.append(edges)
    drop_cut(*made)
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    out = maps[-1]
    for hook in reversed(maps[:-1]):
        deeper = out.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        out = hook.join(deeper, "p", "left").select("u", F.coalesce("pp", "p").alias("p"))
    out = cut(out.select(F.col("u").alias("node"), F.col("p").alias("comp")))
    drop_cut(*maps)
    return out
