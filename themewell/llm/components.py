"""Connected components of a table of links, by rounds of hooking and shortcutting.

Each round every node learns the least label around it (a grouped minimum, so a
node with very many links is combined in each task before the shuffle), labels
are shortened through the labels of labels, and links whose ends agree are
dropped. Tables between rounds are written to the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.session import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each id in ``links`` the least id that can be reached from it.

    Null ends are ignored, repeated links and loops do no harm, and an empty
    table gives an empty one.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull()
    )
    ends = cut(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels, open_links = nodes.select("node", F.col("node").alias("component")), ends.where("a < b")
    while True:
        # Least neighbour of each end; ends are labels of earlier rounds, so these are few and ever fewer.
        both = open_links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        hook = both.groupBy(F.col("e.a").alias("from")).agg(F.min("e.b").alias("near"))
        hook = cut(hook.select("from", F.least("from", "near").alias("to")))
        if hook.isEmpty():
            return labels
        roots = _roots(hook)
        labels = cut(
            labels.join(roots.withColumnRenamed("from", "component"), "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")
            )
        )
        at = lambda end: roots.select(F.col("from").alias(end), F.col("root").alias(f"{end}_root"))
        moved = open_links.join(at("a"), "a").join(at("b"), "b").where("a_root <> b_root")
        open_links = cut(
            moved.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
        )


def _roots(hook: DataFrame) -> DataFrame:
    """(from, root): every pointer followed to its end; each step halves the way that is left."""
    step = hook
    while True:
        onward = step.select(F.col("from").alias("to"), F.col("to").alias("next"))
        doubled = cut(step.join(onward, "to").select("from", F.col("next").alias("to"), (F.col("next") < F.col("to")).alias("moved")))
        if doubled.where("moved").isEmpty():
            return doubled.select("from", F.col("to").alias("root"))
        step = doubled.drop("moved")


def merge(groups: np.ndarray, i: int, near: np.ndarray) -> np.ndarray:
    """Joins the groups of ``near`` to that of ``i`` and gives one of ``near`` for each group joined.

    ``groups`` holds a number per member and is changed. Calls for all members
    give a spanning forest, with one step per member and not per link.
    """
    found, first = np.unique(groups[near], return_index=True)
    new = found != groups[i]
    if new.any():
        groups[np.isin(groups, found[new])] = groups[i]
    return near[first[new]]
