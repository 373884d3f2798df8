"""Connected components of a graph given as links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link; the root is the least node of its component.

    A round gives every node the least root among its neighbours and then its root's root; paths halve, so the
    number of rounds grows with the logarithm of their length. Rounds are stored, links never leave the executors.
    """
    forth = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    back = links.select(F.col(b).alias("node"), F.col(a).alias("other"))
    both = saved(forth.unionByName(back).filter("node != other").distinct(), "links")
    roots = saved(both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("other"), F.col("root").alias("r")), "other").groupBy("node").agg(F.min("r").alias("r"))
        stepped = roots.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "r").alias("root"))
        stepped = saved(stepped, "roots")
        above = stepped.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = stepped.join(above, "root", "left").select("node", "was", F.least("root", F.coalesce("top", "root")).alias("root"))
        jumped = saved(jumped, "roots")
        if jumped.filter("was != root").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
