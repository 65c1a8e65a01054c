import numpy as np
import pytest
from pyspark.sql import functions as F

from emberfold import session
from emberfold.operators import components
from emberfold.operators.components import connected_components, rank_within


def test_components_of_random_graphs_and_a_long_path(spark):
    rng = np.random.default_rng(6)
    edges = [("random", int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2)) if a < b]
    path = rng.permutation(200)
    edges += [("path", int(min(a, b)), int(max(a, b))) for a, b in zip(path, path[1:])]
    nodes = [("random", i) for i in range(120)] + [("path", i) for i in range(200)]
    out = connected_components(
        spark.createDataFrame(nodes, "g STRING, node BIGINT"),
        spark.createDataFrame(edges, "g STRING, a BIGINT, b BIGINT"), ["g"],
    )
    root = {(r.g, r.node): r.root for r in out.collect()}
    assert len(root) == len(nodes)
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for g, a, b in edges:
        low, high = sorted([find((g, a)), find((g, b))])
        parent[high] = low
    assert root == {n: find(n)[1] for n in nodes}


@pytest.mark.parametrize("step", [1, 2])
def test_rounds_grow_with_the_logarithm_of_an_ordered_chain(spark, monkeypatch, step):
    """Ids that rise along the chain, as cells do along a front; with step 2 the links skip a cell."""
    rounds = []
    real = components._parents
    monkeypatch.setattr(components, "_parents", lambda *a: rounds.append(1) or real(*a))
    n = 4096
    nodes = spark.range(n).select(F.lit("g").alias("g"), F.col("id").alias("node"))
    edges = spark.range(n - step).select(F.lit("g").alias("g"), F.col("id").alias("a"), (F.col("id") + step).alias("b"))
    out = components.connected_components(nodes, edges, ["g"]).groupBy("root").count().collect()
    assert sorted((r.root, r["count"]) for r in out) == [(i, n // step) for i in range(step)]
    assert len(rounds) <= 14


def test_a_star_takes_few_rounds(spark, monkeypatch):
    """Copies around a hub: half the leaves stayed in every round when nodes were ordered anew."""
    rounds = []
    real = components._parents
    monkeypatch.setattr(components, "_parents", lambda *a: rounds.append(1) or real(*a))
    edges = spark.range(1, 3000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    out = connected_components(spark.range(3000).toDF("node"), edges, [])
    assert out.filter("root = 0").count() == 3000
    assert len(rounds) <= 3


@pytest.mark.parametrize("shape", ["chain", "star", "pairs"])
def test_rows_written_are_linear(spark, monkeypatch, shape):
    """All tables of all rounds together, also when one component holds every node; none is left behind."""
    written = []
    real = components.cut_lineage

    def counted(df):
        out = real(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(components, "cut_lineage", counted)
    n = 3000
    other = {"chain": F.col("id") + 1, "star": F.lit(0), "pairs": F.col("id").bitwiseXOR(F.lit(1))}[shape]
    nodes = spark.range(n).select(F.col("id").alias("node"))
    edges = spark.range(1, n - 1).select(F.col("id").alias("a"), other.cast("long").alias("b"))
    before = set(session.scratch_tables())
    out = components.connected_components(nodes, edges, [])
    # The table of roots is what the result reads.
    assert len(set(session.scratch_tables()) - before) == 1
    assert sum(written) <= 10 * n
    want = {"chain": [(0, 1), (1, n - 1)], "star": [(0, n - 1), (n - 1, 1)]}
    sizes = sorted((r.root, r["count"]) for r in out.groupBy("root").count().collect())
    if shape == "pairs":
        assert sizes == [(i, 2) for i in range(0, n, 2)]
    else:
        assert sizes == want[shape]


def test_no_edges(spark):
    out = connected_components(
        spark.createDataFrame([("x", 1), ("x", 2)], "g STRING, node BIGINT"),
        spark.createDataFrame([], "g STRING, a BIGINT, b BIGINT"), ["g"],
    )
    assert sorted((r.node, r.root) for r in out.collect()) == [(1, 1), (2, 2)]


def test_rank_spans_partitions(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.xxhash64("id").alias("v"),
    ).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = rank_within(df, ["g"], [F.col("v")], "r").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = {}
    for row in rows:
        groups.setdefault(row.g, []).append((row.v, row.r))
    assert len(rows) == 5000
    for members in groups.values():
        assert [r for _, r in sorted(members)] == list(range(len(members)))
