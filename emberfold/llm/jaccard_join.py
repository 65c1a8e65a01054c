"""Exact Jaccard join of word-shingle sets by partitioning the universe of shingles.

Two sets of sizes r <= s whose Jaccard similarity reaches the threshold differ in at most
H = floor((1 - t) / (1 + t) * (r + s)) shingles. Sizes fall into bands; the shingles of a set of a
band are hashed into that band's fixed number of segments, so the differences between two sets are
spread over segments, and a choice of segments with allowances -1 (skipped), 0 (equal) or 1 (equal
but for one deletion) whose allowances plus one add up to more than H must contain a segment that
keeps its allowance. Every set is entered under all its segments, under the one-deletion
neighbourhood of the band's first segment, and also in the next band if its partners reach into it.
The larger set of a pair does the probing: it buys the cheapest allowances, by the true number of
entries that it would meet, segments that nobody shares being free. Candidates are verified on the
full sets, so the links are exact.

Equal sets are one node from the start. In a bucket of many members all pairs are never listed:
each is verified against one hub, the same for most buckets of a group, and what is linked so counts
as joined. Buckets that still hold several components are compared in tiles, which propose forests
until only single pairs are left apart (``forests``).

Defined cases: a null text, or one without words, has an empty set, is its own component and linked
with nothing; a text of fewer words than a shingle is one shingle as a whole; rows with an equal
doc_id are one document, each row with its own n_shingles (should their texts differ, all count for
equality, the one of the smallest signature for similarity); a null doc_id has a null component; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm import forests
from emberfold.llm.common import cut, discard, hash_words, mix64, shingle_hashes, slices, words_of

SHINGLE, PERCENT = 3, 90
# Ratio of the sizes at the ends of a band; spare segments, as a share of those needed.
BAND, SPARE = 1.5, 0.12
# Whether the members of a bucket are first compared with one of them.
HUBS = True
PARITIES = ["b0", "b1", "b2", "b3"]


def differences(sizes: int, percent: int) -> int:
    """Most shingles in which two sets can differ whose sizes add up to ``sizes``."""
    return sizes * (100 - percent) // (100 + percent)


@lru_cache(maxsize=8)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(lowest size, segments) of every band; the last bands lie beyond any text."""
    lows, low = [1], 1
    while low < 1 << 40:
        low = max(low + 1, math.ceil(low * BAND))
        lows.append(low)
    need = np.array([differences(2 * (high - 1), percent) for high in lows[1:]])
    return np.array(lows[:-1]), need + 1 + np.floor(need * SPARE).astype(np.int64)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    counts, codes, words = words_of(texts)
    hashes = hash_words(words)[codes]
    out, at = [], 0
    for n in counts:
        own = hashes[at : at + n]
        out.append(np.unique(shingle_hashes(own, min(width, n)) if n else own))
        at += n
    return out


def _entries(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, codes, set number), codes being band * 2^20 + 2 * segment + (1 for a deletion).

    A band has fewer than 2^19 segments for any text of less than some millions of words; beyond
    that segment numbers of one band wrap around in the code, which only labels cost rows.
    """
    lows, segments = bands(percent)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    own_band = np.searchsorted(lows, sizes, "right") - 1
    keys, codes, owners = [], [], []
    for up in (0, 1):
        band = own_band + up
        joins = (sizes > 0) & (100 * sizes >= (percent * lows[band] if up else 0))
        m = np.where(joins, segments[band], 0)
        base = np.cumsum(m) - m
        owner = np.repeat(np.arange(len(sets)), np.where(joins, sizes, 0))
        tokens = flat[np.repeat(joins, sizes)]
        value = mix64(tokens + np.uint64(0x632BE59BD9B4E019))
        segment = (mix64(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % m[owner].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(m.sum()), np.uint64)
        np.add.at(sums, base[owner] + segment, value)
        of = np.repeat(np.arange(len(sets)), m)
        number = np.arange(len(sums)) - base[of]
        drop = (segment == 0) & (m[owner] > 1)
        who = np.concatenate([of, owner[drop]])
        seg = np.concatenate([number, np.zeros(int(drop.sum()), np.int64)])
        kind = np.concatenate([np.zeros(len(of), np.int64), np.ones(int(drop.sum()), np.int64)])
        total = np.concatenate([sums, sums[base[owner[drop]]] - value[drop]])
        place = (band[who].astype(np.uint64) << np.uint64(40)) + seg.astype(np.uint64)
        keys.append(mix64(total + mix64(place)))
        codes.append((band[who] << 20) + ((seg & 0x7FFFF) << 1) + kind)
        owners.append(who)
    return np.concatenate(keys), np.concatenate(codes), np.concatenate(owners)


def _parities(own: np.ndarray) -> np.ndarray:
    """256 bits, each the parity of the shingles that fall on it: sets differ in at least as many."""
    spots = np.bincount((mix64(own) & np.uint64(255)).astype(np.int64), minlength=256)
    return np.packbits(spots & 1).view(np.int64)


def _summaries(width: int, percent: int):
    """Sizes, signatures and sketches of all rows, and the entries of the first row of each set in a task."""

    def run(batches):
        seen = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), width)
                sigs = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                named = batch.column("doc_id").is_valid().to_pylist()
                carries = []
                for sig, has_id, own in zip(sigs, named, sets):
                    carries.append(has_id and len(own) > 0 and sig not in seen)
                    if carries[-1]:
                        seen.add(sig)
                keys, codes, owner = _entries([s if c else s[:0] for s, c in zip(sets, carries)], percent)
                order = np.argsort(owner, kind="stable")
                ends = np.cumsum(np.bincount(owner, minlength=len(sets)))[:-1]
                split = lambda x: [p.tobytes() for p in np.split(x[order], ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sigs, pa.binary()),
                        pa.array(carries, pa.bool_()),
                        pa.array([forests.parities(s) for s in sets], pa.binary()),
                        *[pa.array(x) for x in np.array([_parities(s) for s in sets]).T],
                        pa.array(split(keys.astype("<u8")), pa.binary()),
                        pa.array(split(codes.astype("<i4")), pa.binary()),
                    ],
                    names=["doc_id", "n", "sig", "carries", "bits", *PARITIES, "keys", "codes"],
                )

    return run


def _spread(batches):
    for batch in batches:
        keys = [np.frombuffer(x, "<i8") for x in batch.column("keys").to_pylist()]
        codes = [np.frombuffer(x, "<i4") for x in batch.column("codes").to_pylist()]
        counts = np.array([len(k) for k in keys], np.int64)
        rows = np.repeat(np.arange(len(keys)), counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([*keys, np.empty(0, np.int64)])),
                pa.array(np.concatenate([*codes, np.empty(0, np.int32)])),
                batch.column("doc_id").take(pa.array(rows)),
            ],
            names=["key", "code", "doc"],
        )


def _shared(entries: DataFrame) -> DataFrame:
    """Entries whose key is another entry's too, with the key's exact and deletion entries."""
    deletion, of_key = F.col("code") % 2, Window.partitionBy("key")
    return entries.withColumns(
        {"exact": F.sum(1 - deletion).over(of_key), "deletions": F.sum(deletion).over(of_key)}
    ).filter("exact > 0 AND exact + deletions > 1")


def _probes(shared: DataFrame, percent: int) -> DataFrame:
    """(key, doc, n, want): what each set has bought; ``want`` is the kind of entry it meets there.

    A unit is one allowance step of one segment. Units that meet nobody are free; of the others a
    set buys the cheapest, as many as its allowance still needs.
    """
    lows, segments = bands(percent)
    levels = [int(n) for n in segments]
    band, segment = F.expr("code >> 20"), F.expr("(code >> 1) & 524287")
    # A set probes in its own band only; there the number of its segments is known.
    own = (
        shared.withColumns({"band": band, "segment": segment, "kind": F.col("code") % 2})
        .filter(F.col("n") >= F.array(*[F.lit(int(x)) for x in lows])[F.col("band")])
    )
    first = own.filter("kind = 0 AND exact > 1").select(
        "doc", "n", "band", "segment", F.lit(1).alias("unit"), (F.col("exact") - 1).alias("cost")
    )
    met = F.when(F.col("kind") == 0, F.col("deletions")).otherwise(F.col("exact"))
    base = F.max(F.when(F.col("kind") == 0, F.col("exact") - 1).otherwise(0))
    second = (
        own.filter("segment = 0").groupBy("doc", "n", "band", "segment")
        .agg(F.sum(met).alias("met"), base.alias("base"))
        # The second step of a segment is of no use without the first, so it comes no cheaper.
        .select("doc", "n", "band", "segment", F.lit(2).alias("unit"), F.greatest("met", "base").alias("cost"))
        .filter("cost > 0")
    )
    units = first.unionByName(second)
    per_set = Window.partitionBy("doc", "band")
    all_units = F.array(*[F.lit(m + (1 if m > 1 else 0)) for m in levels])[F.col("band")]
    needed = F.expr(f"2 * n * {100 - percent} div {100 + percent} + 1")
    bought = (
        units.withColumn("paid", F.row_number().over(per_set.orderBy("cost", "unit", "segment")))
        .withColumn("free", all_units - F.count("*").over(per_set))
        .filter(F.col("paid") <= needed - F.col("free"))
        .select("doc", "band", "segment", "unit")
    )
    mine = own.select("key", "doc", "n", "band", "segment", "kind")
    joined = mine.join(bought, ["doc", "band", "segment"])
    return joined.filter("unit = 2 OR kind = 0").select(
        "key", "doc", "n", F.when(F.col("unit") == 1, 0).otherwise(1 - F.col("kind")).alias("want")
    )


def _near(percent: int) -> Column:
    """Whether the sizes n and m and the parities b0.. and c0.. allow enough similarity."""
    apart = F.lit(0)
    for mine in PARITIES:
        apart = apart + F.bit_count(F.col(mine).bitwiseXOR(F.col(mine.replace("b", "c"))))
    return (
        (apart <= F.expr(f"(n + m) * {100 - percent} div {100 + percent}"))
        & (100 * F.col("n") >= percent * F.col("m")) & (100 * F.col("m") >= percent * F.col("n"))
    )


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            left, right = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
            keep = []
            for a, b in zip(left, right):
                x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _set_rows(width: int):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = [s.astype("<u8").tobytes() for s in shingle_sets(batch.column("text"), width)]
                sigs = [xxhash.xxh3_128_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())], names=["doc", "sig", "set"]
                )

    return run


def similar_components(docs: DataFrame, *, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = cut(
        docs.select("doc_id", "text").mapInArrow(
            _summaries(width, percent), f"doc_id {kind}, n long, sig binary, carries boolean, bits binary, b0 long, b1 long, b2 long, b3 long, keys binary, codes binary"
        )
    )
    named = base.filter("doc_id IS NOT NULL AND n > 0")
    # A task carries a set once, so that a group of copies has no more entries than tasks.
    same = named.filter("carries").groupBy("sig").agg(F.min("doc_id").alias("rep"))
    # doc -> rep of each text it stands for; a doc_id on several texts ties their reps together.
    member = named.select("doc_id", "sig").distinct().join(same, "sig").select("doc_id", "rep")
    reps = cut(
        named.filter("carries").join(same, "sig").filter("doc_id = rep")
        .groupBy("rep").agg(F.min(F.struct("sig", "n", "bits", *PARITIES)).alias("x")).select(F.col("rep").alias("doc"), "x.*").drop("sig")
    )
    roots = _linked(docs, base, reps, width, percent, kind)
    placed = member.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "doc_id", F.coalesce("root", "rep").alias("root")
    )
    labelled = cut(placed.groupBy("doc_id").agg(F.min("root").alias("root"), F.max("root").alias("last")))
    several = labelled.filter("root <> last").select("doc_id", F.col("root").alias("a"))
    if not several.isEmpty():
        ties = placed.withColumnRenamed("root", "b").join(several, "doc_id").filter("a <> b").select("a", "b")
        ends = labelled.select(F.explode(F.array("root", "last")).alias("node")).union(ties.select("b")).distinct()
        tops = forests.joined(ends.select("node", F.col("node").alias("root")), ties)
        labelled = labelled.join(tops.toDF("root", "top"), "root").select("doc_id", F.col("top").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = labelled.join(smallest, "root").select("doc_id", "component_id")
    out = base.select("doc_id", F.col("n").alias("n_shingles")).join(of, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _linked(docs: DataFrame, base: DataFrame, reps: DataFrame, width: int, percent: int, kind: str) -> DataFrame:
    """(node, root): components of those representatives of equal sets that meet another one, by verified links."""
    entries = (
        base.filter("carries").select("doc_id", "keys", "codes").mapInArrow(_spread, f"key long, code int, doc {kind}")
    )
    first = cut(_shared(entries).select("key", "code", "doc").join(reps.select("doc"), "doc", "left_semi"))
    shared = cut(_shared(first).join(reps.drop("bits"), "doc"))
    discard(first)
    bought = _probes(shared.drop(*PARITIES), percent)
    probes = cut(bought.join(reps.drop("n", "bits"), "doc"))
    other = [F.col("doc").alias("other"), F.col("n").alias("m"), *[F.col(b).alias(b.replace("b", "c")) for b in PARITIES]]
    members = cut(
        shared.withColumn("want", F.col("code") % 2)
        .join(probes.select("key", "want").distinct(), ["key", "want"], "left_semi").select("key", "want", *other)
    )
    discard(shared)
    involved = probes.select("doc").union(members.select("other")).distinct()
    sets = cut(
        docs.select("doc_id", "text").join(involved.withColumnRenamed("doc", "doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
        .mapInArrow(_set_rows(width), f"doc {kind}, sig binary, set binary")
        .groupBy("doc").agg(F.min(F.struct("sig", "set"))["set"].alias("set"))
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        return cut(
            pairs.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b")), "b")
            .join(sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a")), "a")
            .mapInArrow(_verify(percent), f"a {kind}, b {kind}")
        )

    links = docs.sparkSession.createDataFrame([], f"a {kind}, b {kind}")
    if HUBS:
        order = F.struct(F.xxhash64("other").alias("h"), *[c for c in members.columns if c not in ("key", "want")])
        hubs = members.groupBy("key", "want").agg(F.min(order).alias("hub")).select("key", "want", "hub.*").drop("h")
        near = probes.join(hubs, ["key", "want"]).filter("doc <> other").filter(_near(percent))
        links = confirmed(near.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct())
    # What meets under a bought key; of these the sets of one component need no further comparison.
    met = cut(
        probes.select("key", "want", "doc").union(members.select("key", "want", "other"))
        .select(F.xxhash64("key", "want").alias("key"), F.col("doc").alias("node")).distinct()
    )
    discard(probes, members)
    nodes = met.select("node").distinct()
    sketches = reps.select(F.col("doc").alias("node"), "n", "bits")
    roots = forests.grown(
        links, nodes, sketches, lambda rows: cut(forests.tile_rows(forests.mixed_buckets(rows))), met, confirmed, percent
    )
    discard(met, sets)
    return roots


def one_of_each(docs: DataFrame, *, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the members of a component other than its smallest doc_id."""
    gone = (
        similar_components(docs, width=width, percent=percent)
        .filter("doc_id <> component_id").select("doc_id").distinct()
    )
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
