"""Connected components of a link table, with Spark joins only.

Alternating large-star and small-star rounds: every round replaces links by links to a smaller neighbour
until each node points at the smallest node it can reach.  Nodes are 64-bit integers.  A hub is never
gathered: its smallest neighbour is an aggregate, and the join back is one that Spark can split.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, first: str, second: str, name: str = "links") -> DataFrame:
    """(node, root) of every linked node, root being the smallest node reachable.

    Self-links and repeated links are harmless; a NULL end drops the link.  Without links the result is empty.
    """
    u, v = F.col(first).cast("bigint"), F.col(second).cast("bigint")
    current = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), (u.isNotNull() & v.isNotNull()).alias("ok"))
    current = materialise(current.filter("ok and u > v").drop("ok").distinct(), name)
    state = _state(current)
    while state[0]:
        current = materialise(_small_star(_large_star(current)), name)
        last, state = state, _state(current)
        if last == state:
            break
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
