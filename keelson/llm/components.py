"""Connected components of a graph given as edges, by hooking and pointer jumping in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut

#: A key with a HEAVYth of all rows is hot: there are HEAVY of them at most, so they can be broadcast.
HEAVY = 1000
#: Rows up to which a counted table of keys (three integers each) is broadcast whole.
BROADCAST_ROWS = 200_000


def hot_join(rows: DataFrame, key: str, unique: DataFrame, n: int, n_unique: int, hot: DataFrame | None = None) -> DataFrame:
    """rows joined to `unique`, which has one row per key, by a column of one name; n and n_unique are the counted rows of both.

    A small table of keys is broadcast. Else keys that a thousandth of the rows share, HEAVY at most, meet their row by
    broadcast, so that no task gets all rows of one; the others by an ordinary join. Inputs are read more than once and
    should be cut. hot gives keys that are known already.
    """
    if n_unique <= BROADCAST_ROWS:
        return rows.join(F.broadcast(unique), key)
    hot = hot_keys(rows, key, n) if hot is None else hot
    some = F.broadcast(unique.join(F.broadcast(hot), key, "left_semi"))
    return rows.join(some, key).unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(unique, key))


def hot_keys(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.groupBy(key).count().where(F.col("count") >= max(2, n // HEAVY + 1)).select(key)


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of edges (u, v) reaches.

    A round lets every node and its present root take the smallest root among the neighbours, then replaces roots by
    their roots. Trees halve in depth each round, so rounds grow with the logarithm of the longest path. Minima are
    combined before the shuffle; the nodes with very many neighbours and the roots of giant components are joined by
    broadcast. Roots never grow, and the rounds end when none changes. Each round is cut by a checkpoint in the shared
    folder, so a lost executor repeats one round at most.
    """
    both = cut(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct())
    state = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")).withColumnRenamed("u", "node"))
    n_nodes = state.count()
    hubs = cut(hot_keys(both, "v", both.count())) if n_nodes > BROADCAST_ROWS else None  # the same in every round
    while True:
        seen = hot_join(both, "v", state.withColumnRenamed("node", "v"), 0, n_nodes, hubs).groupBy("u").agg(F.min("root").alias("low"))
        mine = state.join(seen, state["node"] == seen["u"]).select("node", "root", "low")
        offers = mine.select("node", "low").unionByName(mine.select(F.col("root").alias("node"), "low")).groupBy("node").agg(F.min("low").alias("low"))
        hooked = cut(state.join(offers, "node").select("node", "root", F.least("root", "low").alias("next")))
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        after = cut(hot_join(hooked, "next", jump, n_nodes, n_nodes).select("node", "root", F.least("next", "beyond").alias("next")))
        done = after.where("next <> root").isEmpty()
        state = after.select("node", F.col("next").alias("root"))
        if done:
            return state
