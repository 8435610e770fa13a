"""Trees held as parent pointers, of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Deepest tree that is followed by default; a chain that goes on beyond it is an error, not a cut.
LEVELS = 100

_CLIMB = """
WITH RECURSIVE climb(node, ancestor, up, distance, path) MAX RECURSION LEVEL {levels} AS (
    SELECT key, key, parent, CAST(0 AS BIGINT), array(key) FROM {{nodes}}
    UNION ALL
    SELECT c.node, n.key, n.parent, c.distance + 1, array_append(c.path, n.key)
    FROM climb c JOIN {{nodes}} n ON n.key = c.up
    WHERE NOT array_contains(c.path, n.key)
) SELECT node, ancestor, up, distance, path FROM climb LIMIT ALL
"""


def _climbed(nodes: DataFrame, key: str, parent: str, levels: int) -> DataFrame:
    """Every node with itself and each ancestor, up to a root, a missing parent or the node at which a loop closes."""
    pointers = nodes.select(F.col(key).alias("key"), F.col(parent).alias("parent")).where(F.col("key").isNotNull()).distinct()
    return nodes.sparkSession.sql(_CLIMB.format(levels=int(levels)), nodes=pointers)


def closure(nodes: DataFrame, key: str, parent: str, levels: int = LEVELS) -> DataFrame:
    """node, ancestor, distance: every node with all nodes above it, the nearest at distance 1.

    A step of the recursion joins the whole level, so it takes as many steps as the tree is deep. A node in or below a loop has
    each node of the loop as ancestor once.
    """
    return _climbed(nodes, key, parent, levels).where("distance > 0").select("node", "ancestor", "distance")


def tree_report(nodes: DataFrame, key: str, parent: str, name: str, root=None, levels: int = LEVELS) -> DataFrame:
    """Per node its place in the tree: node, level, top, kind, path.

    ``level`` counts the nodes above it, ``top`` is the highest of them (itself for a root), ``path`` are the names from there
    down. ``kind`` is ``tree`` if the top's parent is null or ``root``, ``orphan`` if that parent is no node, ``loop`` if it is
    a node that the way up has passed already. A key should have one parent and one name; a repeated key with several has a row for
    each way up.
    """
    climbed = _climbed(nodes, key, parent, levels)
    names = nodes.select(F.col(key).alias("ancestor"), F.col(name).alias("__name"))
    named = climbed.join(names, "ancestor", "left")
    last = F.max_by(F.struct("ancestor", "up", "path"), "distance")
    chain = F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("d"), F.coalesce("__name", F.lit("?")).alias("n"))))
    tops = named.groupBy("node").agg(F.max("distance").alias("level"), last.alias("s"), chain.alias("chain"))
    ends = F.col("s.up").isNull() if root is None else F.col("s.up").isNull() | (F.col("s.up") == F.lit(root))
    kind = F.when(ends, "tree").when(F.array_contains("s.path", F.col("s.up")), "loop").otherwise("orphan")
    return tops.select(
        "node", "level", F.col("s.ancestor").alias("top"), kind.alias("kind"),
        F.array_join(F.transform("chain", lambda c: c["n"]), "/").alias("path"),
    )
