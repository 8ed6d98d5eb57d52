"""Connected components of links in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import cut


def _some(rows: DataFrame) -> bool:
    return bool(rows.limit(1).count())


def _roots(links: DataFrame, stage: str) -> tuple[DataFrame, int]:
    """(``n``, ``p``) for every node of ``links``: where the pointers to the
    smallest neighbour end.  A node smaller than its neighbours is a root.

    Pointers double until all have arrived, so a path of ``k`` pointers takes
    about log2(k) joins; pointers that have arrived are not joined again.
    """
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("p"))
    table = cut(least.select(F.col("a").alias("n"), F.least("a", "p").alias("p"), (F.col("a") < F.col("p")).alias("done")), stage)
    jumps = 0
    while _some(table.where("NOT done")):
        up = table.select(F.col("n").alias("n2"), F.col("p").alias("p2"), F.col("done").alias("done2"))
        moved = table.where("NOT done").join(up, F.col("p") == F.col("n2")).select("n", F.col("p2").alias("p"), F.col("done2").alias("done"))
        table = cut(table.where("done").union(moved), stage)
        jumps += 1
    return table.select("n", "p"), jumps


def components(links: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(``node``, ``label``) of every node of ``links`` (``a``, ``b``): the
    label is the smallest node reachable.  Null and self links are ignored; no
    links give no rows.

    Each round points every node at its smallest neighbour, follows the
    pointers to their roots and contracts the links to the roots.  A root that
    nothing points at has, after the contraction, a smaller neighbour, so two
    rounds at least halve the nodes: the rounds grow with the logarithm of the
    nodes, and an ascending chain is one round.  Every step is written and
    read again, so plans stay short and a lost executor repeats one step.
    ``rounds`` receives the pointer jumps of each round.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = cut(links, "component-links")
    labels = None
    while _some(links):
        parent, jumps = _roots(links, "component-roots")
        if rounds is not None:
            rounds.append(jumps)
        named = parent.select(F.col("n").alias("node"), F.col("p").alias("label"))
        labels = named if labels is None else cut(
            labels.join(parent, F.col("label") == F.col("n"), "left").select("node", F.coalesce("p", "label").alias("label")),
            "component-labels")
        pa = parent.select(F.col("n").alias("a"), F.col("p").alias("pa"))
        pb = parent.select(F.col("n").alias("b"), F.col("p").alias("pb"))
        left = links.join(pa, "a").join(pb, "b").where("pa <> pb")
        links = cut(left.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "component-links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")) if labels is None else labels
