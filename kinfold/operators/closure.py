"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.skew import HOT_ROWS, large, lookup_join
from kinfold.sources.scratch import cut_lineage

MAX_ROUNDS = 60


def connected_components(
    edges: DataFrame, hot_rows: int = HOT_ROWS, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; a component is named by its
    smallest node.

    Every round replaces the edges by others with the same components, following the published
    large-star / small-star method: first each node hands its larger neighbours to its smallest
    one, then its smaller neighbours. The edges never grow in number, and after a number of
    rounds logarithmic in the longest path each component is a star around its smallest node. A
    node with very many neighbours is salted (``lookup_join``). Every
    round is written to the shared folder, so a lost executor costs one round at most.
    """
    down = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where("u <> v")
    down = cut_lineage(down.distinct(), "edges")
    done, degree = _shape(down)
    for _ in range(max_rounds):
        if done:
            break
        larger = _large_star(down, hot_rows, degree)
        down = cut_lineage(_small_star(larger, hot_rows, degree), "edges")
        done, degree = _shape(down)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    children = down.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = down.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return children.unionByName(centres)


def _hand_over(edges: DataFrame, smallest: DataFrame, hot_rows: int, degree: int) -> DataFrame:
    """Join edges with the smallest neighbour of their ``u``; nodes with very many are salted."""
    if degree < hot_rows:
        return edges.join(large(smallest), "u")
    return lookup_join(edges, smallest, ["u"], weight="n", min_rows=hot_rows)


def _large_star(down: DataFrame, hot_rows: int, degree: int) -> DataFrame:
    both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(
        F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n")
    )
    # Only larger neighbours move, so only the reversed edges (from v up to u) are needed here.
    up = down.select(F.col("v").alias("u"), F.col("u").alias("larger"))
    moved = _hand_over(up, smallest, hot_rows, degree)
    return moved.select(F.col("larger").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(down: DataFrame, hot_rows: int, degree: int) -> DataFrame:
    smallest = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _hand_over(down, smallest, hot_rows, degree)
    kept = smallest.select("u", F.col("m").alias("v"))
    return (
        moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(kept)
        .distinct()
    )


def _shape(down: DataFrame) -> tuple[bool, int]:
    """Is every component a star around its smallest node, and what is the highest degree?

    In such stars every node has one smaller neighbour or none, and no centre has one.
    """
    ends = down.select("u", F.lit(1).alias("below")).unionByName(
        down.select(F.col("v").alias("u"), F.lit(0).alias("below"))
    )
    per_node = ends.groupBy("u").agg(F.sum("below").alias("below"), F.count("*").alias("n"))
    loose = (F.col("below") > 1) | ((F.col("below") == 1) & (F.col("n") > 1))
    row = per_node.agg(F.count_if(loose).alias("loose"), F.max("n").alias("degree")).first()
    return row.loose == 0, row.degree or 0
