"""Links among many sets that meet in buckets, without listing all pairs of a group.

A bucket is compared in tiles, square by square, by parities that bound the difference of two sets
from below. A tile first proposes no more pairs than connect the sets it holds (a forest); the
proposals are confirmed on the full sets, and what their links join is one from then on. After two
such rounds all pairs that are still apart are proposed. So whatever the size of a group of near
copies, few pairs are listed, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.common import cut, discard, mix64, runs
from emberfold.operators.components import connected_components

PARITIES, FORESTS = 1024, 2
# Rows of a tile's side.
TILE = 4096


def parities(own: np.ndarray) -> bytes:
    """Bits that each tell whether an odd number of shingles falls on it: sets differ in at least as many."""
    spots = np.bincount((mix64(own) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits(spots & 1).tobytes()


def _tile_pairs(rows: pa.Table, percent: int, forest: bool) -> pa.RecordBatch:
    """Pairs of one tile that are still apart and may be similar by size and parities.

    As a forest, only as many as connect what they all connect.
    """
    node = rows.column("node").combine_chunks()
    n, block = (rows.column(c).to_numpy() for c in ("n", "block"))
    diagonal = bool(rows.column("diagonal")[0].as_py())
    bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(len(n), -1)
    label = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy().copy()
    left, right = [], []
    for i in range(len(n) - 1):
        j = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not diagonal:
            j = j[block[j] != block[i]]
        j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
        if not len(j):
            continue
        apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
        j = j[apart <= (n[j] + n[i]) * (100 - percent) // (100 + percent)]
        if forest and len(j):
            met, first = np.unique(label[j], return_index=True)
            j = j[first]
            label[np.isin(label, met)] = label[i]
        left.append(np.full(len(j), i))
        right.append(j)
    places = [pa.array(np.concatenate([*x, np.empty(0, np.int64)])) for x in (left, right)]
    return pa.RecordBatch.from_arrays([node.take(x) for x in places], names=["a", "b"])


def _compare(percent: int, forest: bool):
    """Pairs of all tiles, from rows sorted by tile."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            starts, lengths = runs(rows.column("tile").to_numpy())
            for start, length in zip(starts[:-1], lengths[:-1]):
                yield _tile_pairs(rows.slice(start, length), percent, forest)
            held = rows.slice(starts[-1])
        if held is not None:
            yield _tile_pairs(held, percent, forest)

    return run


def mixed_buckets(members: DataFrame) -> DataFrame:
    """``members`` (key, node, root) of the buckets that hold several roots, with the bucket's size."""
    mixed = (
        members.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high").select("key", "size")
    )
    return members.join(mixed, "key")


def tile_rows(members: DataFrame) -> DataFrame:
    """Members (key, node, root, size) dealt into tiles: large buckets fall into blocks, every two of which meet."""
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        (F.col("block") == F.col("other")).alias("diagonal"), "block", "node", "root",
    )


def proposals(tiles: DataFrame, sketches: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Distinct pairs (a, b), a before b, of the tiles; ``sketches`` has (node, n, bits)."""
    kind = tiles.schema["node"].dataType.simpleString()
    return (
        tiles.join(sketches, "node").repartition("tile").sortWithinPartitions("tile")
        .mapInArrow(_compare(percent, forest), f"a {kind}, b {kind}")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def grown(
    links: DataFrame, nodes: DataFrame, sketches: DataFrame, tiles: Callable[[DataFrame], DataFrame],
    members: DataFrame, confirmed: Callable[[DataFrame], DataFrame], percent: int,
) -> DataFrame:
    """(node, root), a written table: components by ``links`` and all links between ``members`` (key, node) of one key.

    ``tiles`` makes a written table of tiles from members with their roots, ``confirmed`` one of the
    links among given pairs. Tiles without a proposal have no pair left that could be similar; where
    no proposal of a forest is confirmed the next forest would be the same, so all pairs follow at once.
    """
    roots = cut(connected_components(nodes, links, []))
    forest = FORESTS
    while forest >= 0:
        dealt = tiles(members.join(roots, "node").select("key", "node", "root"))
        found = cut(proposals(dealt, sketches, percent, forest > 0))
        discard(dealt)
        if found.isEmpty():
            discard(found)
            break
        more = confirmed(found)
        fruitless = more.isEmpty()
        if not fruitless:
            old, roots = roots, joined(roots, more)
            discard(old)
        discard(found, more)
        forest = 0 if fruitless and forest > 0 else forest - 1
    return roots


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after ``links`` (a, b) too, a written table; only the roots that they join are gone over."""
    of = [roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab"]
    between = cut(
        links.join(of[0], "a").join(of[1], "b").filter("a_root <> b_root")
        .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
    )
    ends = between.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    tops = connected_components(ends, between, []).select(F.col("node").alias("root"), F.col("root").alias("top"))
    out = cut(roots.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
    discard(between)
    return out
