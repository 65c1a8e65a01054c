"""Connected components and ranks without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.session import cut_lineage, drop_tables


def connected_components(nodes: DataFrame, edges: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, node, root): the smallest node of each component, by repeated contraction.

    ``edges`` has columns (groups, a, b). Nodes are ordered by a hash; in every round each hangs
    under the first of its neighbours, the short chains that this makes are shortened, and only
    edges between different parents stay. The order is the same in all rounds: a node that stays
    after two of them comes before all that are two steps away, so at most half the nodes stay, and
    the leaves of a star meet its first one in the second round. The hash keeps chains short
    whatever the order of the ids.

    A round reads and writes live nodes and edges only. The tables of parents are then put
    together from the last round, the smallest, to the first, so that all rows that are shuffled add up
    to a multiple of nodes and edges. The smallest node of each root is found with a map-side step,
    and the nodes themselves are joined once.
    """
    live = cut_lineage(edges.filter("a <> b"))
    rounds = []
    while not live.isEmpty():
        parent = _parents(live, groups)
        rounds.append(parent)
        old, live = live, cut_lineage(
            _follow(_follow(live, parent, groups, "a"), parent, groups, "b")
            .filter("a <> b")
            .select(*groups, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
        drop_tables(old)
    drop_tables(live)
    if not rounds:
        return nodes.select(*groups, "node", F.col("node").alias("root"))
    found = rounds[-1]
    for parent in reversed(rounds[:-1]):
        found = _follow(parent, found, groups, "parent")
    found = cut_lineage(found.select(*groups, "node", F.col("parent").alias("root")))
    drop_tables(*rounds)
    smallest = found.groupBy(*groups, "root").agg(F.min("node").alias("_first"))
    named = found.join(smallest, [*groups, "root"]).select(*groups, "node", "_first")
    return nodes.join(named, [*groups, "node"], "left").select(
        *groups, "node", F.coalesce("_first", "node").alias("root")
    )


def _parents(live: DataFrame, groups: list[str]) -> DataFrame:
    def placed(name: str) -> Column:
        return F.struct(F.xxhash64(F.col(name)).alias("h"), F.col(name).alias("id"))

    both = live.select(*groups, "a", "b").unionByName(
        live.select(*groups, F.col("b").alias("a"), F.col("a").alias("b"))
    )
    first = both.groupBy(*groups, "a").agg(F.min(placed("b")).alias("m"))
    parent = first.select(*groups, F.col("a").alias("node"), F.least(placed("a"), "m")["id"].alias("parent"))
    chains = cut_lineage(parent)
    out = cut_lineage(_shorten(_shorten(chains, groups), groups))
    drop_tables(chains)
    return out


def _shorten(parent: DataFrame, groups: list[str]) -> DataFrame:
    grand = parent.select(*groups, F.col("node").alias("parent"), F.col("parent").alias("grand"))
    return parent.join(grand, [*groups, "parent"]).select(
        *groups, "node", F.col("grand").alias("parent")
    )


def _follow(df: DataFrame, parent: DataFrame, groups: list[str], column: str) -> DataFrame:
    """``df`` with the parents of ``column`` in its place; what is not in ``parent`` stays."""
    step = parent.select(*groups, F.col("node").alias(column), F.col("parent").alias("_up"))
    others = [c for c in df.columns if c not in (*groups, column)]
    return df.join(step, [*groups, column], "left").select(
        *groups, *others, F.coalesce("_up", column).alias(column)
    )


def rank_within(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """0-based position of each row in its group, for groups of any size.

    Rows are sorted by range over all tasks; a row's rank is its place in its own partition
    plus the rows its group has in earlier partitions. The partitioning is written down before
    it is used, so a recomputed task cannot shift it.
    """
    columns = df.columns
    sort_by = [*[F.col(g) for g in groups], *order]
    placed = cut_lineage(
        df.repartitionByRange(*sort_by)
        .sortWithinPartitions(*sort_by)
        .select(
            *columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_pos"),
        )
    )
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*groups, "_part").agg(
        F.count("*").alias("_n"), F.min("_pos").alias("_base")
    )
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return placed.join(offsets.drop("_n"), [*groups, "_part"]).select(
        *columns, (F.col("_pos") - F.col("_base") + F.col("_before")).cast("int").alias(name)
    )
