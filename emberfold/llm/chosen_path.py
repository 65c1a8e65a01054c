"""Near-duplicate groups by a chosen-path similarity join over minwise values of word shingles.

Every distinct set of shingles gets 64 minwise values. A tree deals the sets into nodes by one of
these values, and a node of too many sets is dealt on by two further values, chosen by a hash of the
path to it: sets of similarity s agree in each value with probability s, so that similar sets stay
together along some path while others part after few steps. Small nodes are compared exhaustively.
A pair at the threshold is missed by one tree with probability 1 - s (1 - q), q = (1 - s (1 - q))^2
being the chance that a path dies out below, and the number of independent trees follows from the
recall asked for (0.999999 for pairs at the threshold; more similar ones are missed more seldom).

Equal sets are one from the start, so copies cost nothing. In every node all sets are first compared
with the same three of them, and what is then linked counts as one; only pairs that are still apart
are compared further, so that a large group of near copies is not listed pair by pair. Nodes that the
last level leaves large are compared in square tiles, by 1024 parities that bound the difference of
two sets from below. A tile first proposes no more pairs than connect its sets (a forest); once the
links among them are known, it is compared again, at last with all pairs that are still apart. Pairs
with one of the first three that agree in too few of their values for the threshold (by six standard
deviations) are dropped; all others are confirmed on the full sets.

Defined cases: a null text, or one without words, has an empty set, is its own component and linked
with nothing; a text of fewer words than a shingle is one shingle as a whole; rows with an equal
doc_id are one document, each row with its own n_shingles, and link with whatever any of their texts
links with; a null doc_id has a null component, is linked with nothing and kept; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.llm import forests
from emberfold.llm.common import cut, discard, mix64, slices
from emberfold.llm.jaccard_join import shingle_sets

SHINGLE, PERCENT, RECALL = 5, 85, 0.999999
VALUES, HUBS = 64, 3
# Most sets of a node that is compared as it is; levels below which nodes are not dealt on.
LEAF, LEVELS = 2048, 8
# Rows of document ids up to which they are broadcast to the scan that fetches texts.
BROADCAST_ROWS = 2_000_000

_FACTORS = mix64(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def trees_for(percent: int, recall: float) -> int:
    """Trees that find a pair at the threshold with the given probability."""
    s, dies = percent / 100, 0.0
    for _ in range(100):
        dies = (1 - s * (1 - dies)) ** 2
    return math.ceil(math.log(1 - recall) / math.log(1 - s * (1 - dies)))


def least_agreement(percent: int) -> int:
    s = percent / 100
    return max(0, math.floor(VALUES * s - 6 * math.sqrt(VALUES * s * (1 - s))))


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """Row of 32-bit minwise values of each set (zeros for an empty one)."""
    out = np.zeros((len(sets), VALUES), np.int32)
    full = np.flatnonzero([len(s) for s in sets])
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0, *[len(sets[i]) for i in full[:-1]]])
        turned = np.empty_like(flat)
        for i, factor in enumerate(_FACTORS):
            np.multiply(flat, factor, out=turned)
            low = mix64(np.minimum.reduceat(turned, starts))
            out[full, i] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _summaries(width: int):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), width)
                values = pa.array(minwise(sets).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * VALUES, pa.int32()), values),
                        pa.array([forests.parities(s) for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "sig", "mins", "bits"],
                )

    return run


def _full_sets(width: int):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = [s.astype("<u8").tobytes() for s in shingle_sets(batch.column("text"), width)]
                sigs = [xxhash.xxh3_128_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())],
                    names=["doc_id", "sig", "set"],
                )

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _agreement(left: str, right: str) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, same: total + same
    )


class _Join:
    """The links between the distinct sets of a corpus."""

    def __init__(self, docs: DataFrame, base: DataFrame, sets: DataFrame, width: int, percent: int):
        self.docs, self.base, self.width, self.percent = docs, base, width, percent
        self.sets = sets

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """(a, b) of the distinct pairs that are similar enough on their full sets."""
        kind = self.docs.schema["doc_id"].dataType.simpleString()
        involved = cut(
            pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
            .join(self.base.select("row", "doc_id", "sig"), "row")
        )
        ids = involved.select("doc_id").distinct()
        ids = F.broadcast(ids) if involved.count() <= BROADCAST_ROWS else ids.hint("shuffle_hash")
        full = cut(
            self.docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
            .mapInArrow(_full_sets(self.width), f"doc_id {kind}, sig binary, set binary")
            .join(involved, ["doc_id", "sig"]).dropDuplicates(["row"]).select("row", "set")
        )
        out = cut(
            pairs.join(full.toDF("b", "set_b"), "b").join(full.toDF("a", "set_a"), "a")
            .mapInArrow(_confirm(self.percent), "a long, b long")
        )
        discard(involved, full)
        return out

    def near(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) whose sizes and values allow the similarity."""
        for side in ("a", "b"):
            mine = self.sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("mins").alias(f"m_{side}"))
            pairs = pairs.join(mine, side)
        return cut(
            pairs.filter(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
            .filter(_agreement("m_a", "m_b") >= least_agreement(self.percent)).select("a", "b")
        )

    def through_hubs(self, members: DataFrame) -> DataFrame:
        """Links of the sets of every node with up to three of them, the same in most nodes of a group."""
        hubs = members.groupBy("key").agg(
            *[F.min_by("node", F.xxhash64("node", F.lit(i))).alias(f"hub{i}") for i in range(HUBS)]
        )
        pairs = (
            members.join(hubs, "key")
            .select("node", F.explode(F.array_distinct(F.array(*[f"hub{i}" for i in range(HUBS)]))).alias("hub"))
            .filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        )
        near = self.near(pairs)
        out = self.confirmed(near)
        discard(near)
        return out

    def children(self, members: DataFrame) -> DataFrame:
        """The members of nodes dealt on by two values each, chosen by the path."""
        first = F.pmod(F.xxhash64("key", F.lit("first")), F.lit(VALUES)).cast("int")
        step = F.pmod(F.xxhash64("key", F.lit("second")), F.lit(VALUES - 1)).cast("int") + 1
        second = F.pmod(first + step, F.lit(VALUES))
        keys = [F.xxhash64("key", at, F.element_at("mins", at + 1)) for at in (first, second)]
        return members.join(self.sets.select("node", "mins"), "node").select("node", "root", F.explode(F.array(*keys)).alias("key"))

    def tiles(self, members: DataFrame) -> DataFrame:
        """Rows of tiles to be compared, from ``members`` (key, node, root); nodes of one root only are left out."""
        leaves, made = [], []
        for level in range(1, LEVELS + 1):
            alive = cut(forests.mixed_buckets(members))
            made.append(alive)
            last = level == LEVELS
            leaves.append((alive if last else alive.filter(F.col("size") <= LEAF)).withColumn("key", F.xxhash64("key", F.lit(level))))
            large = alive.filter(F.col("size") > LEAF)
            if last or large.isEmpty():
                break
            members = self.children(large)
        out = cut(forests.tile_rows(reduce(DataFrame.unionByName, leaves)))
        discard(*made)
        return out


def similar_components(
    docs: DataFrame, *, width: int = SHINGLE, percent: int = PERCENT, recall: float = RECALL
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = cut(
        docs.select("doc_id", "text")
        .mapInArrow(_summaries(width), f"doc_id {kind}, n long, sig binary, mins array<int>, bits binary")
        .withColumn("row", F.monotonically_increasing_id())
    )
    named = base.filter("doc_id IS NOT NULL AND n > 0")
    same = cut(named.groupBy("sig").agg(F.min("row").alias("node")))
    sets = cut(base.join(same.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "n", "mins", "bits"))
    join = _Join(docs, base, sets, width, percent)

    trees = trees_for(percent, recall)
    entries = sets.select("node", F.posexplode(F.slice("mins", 1, trees)).alias("tree", "value")).select(
        "node", F.xxhash64("tree", "value").alias("key")
    )
    shared = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key")
    members = cut(entries.join(shared, "key"))
    nodes = sets.select("node")
    links = join.through_hubs(members)
    roots = forests.grown(links, nodes, sets.select("node", "n", "bits"), join.tiles, members, join.confirmed, percent)

    # Rows of one doc_id with different texts tie their sets together.
    placed = cut(named.select("doc_id", "sig").distinct().join(same, "sig").select("doc_id", "node"))
    tied = placed.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("doc_id", "a")
    ties = placed.join(tied, "doc_id").filter("a <> node").select("a", F.col("node").alias("b"))
    final = forests.joined(roots, ties)
    discard(members, roots)
    labelled = placed.join(final, "node")
    smallest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = labelled.join(smallest, "root").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = base.select("doc_id", F.col("n").alias("n_shingles")).join(of, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
