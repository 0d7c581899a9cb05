"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from statcube.session import cut_lineage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours are linked to the smallest one instead.

    The large step moves the neighbours greater than a node, the small step the others and the node.
    The minimum is a partial aggregate and the join has one row per node on one side, so a node with
    many links is no burden to one task.
    """
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select("m", "b")
    else:
        moved = joined.where("b < a").select("m", F.explode(F.array("a", "b")))
    return moved.toDF("a", "b").where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable.  ``links`` has a and b, integers, with a < b.

    Large and small steps alternate until nothing changes, a number of rounds that grows with the
    logarithm of the longest chain.  Each round is checkpointed to the shared folder; only a count
    and a checksum come to the driver.
    """
    links, seen = _observed(links.distinct()), None
    while seen != links[1]:
        seen = links[1]
        links = _observed(_star(cut_lineage(_star(links[0], large=True)), large=False))
    return links[0].select(F.col("b").alias("node"), F.col("a").alias("component"))


def _observed(links: DataFrame) -> tuple[DataFrame, tuple]:
    """A checkpoint of the links with their number and a checksum, from the same pass."""
    seen = Observation()
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    cut = cut_lineage(links.observe(seen, F.count("*").alias("n"), checksum.alias("sum")))
    # Without rows there may be no pass to observe.
    return cut, () if cut.isEmpty() else (seen.get["n"], seen.get["sum"])
