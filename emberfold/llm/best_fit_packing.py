"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Lengths are whole numbers up to the sequence length, so the packing is planned on the histogram of
lengths, which has that many entries however large the corpus. A plan entry fills one bin greedily
(the longest piece left, then whatever is the largest that still fits), then replaces the bin's
smallest piece with the two unpacked pieces that fill the widened gap most tightly, if they leave
less; it is repeated for as many bins as the remaining counts allow. Pieces find their bin by their
rank among the pieces of their length, which Spark computes; nothing per document reaches the driver.

Defined cases: a null or empty text is the end token alone; a document longer than a sequence is
cut into full pieces after a first, possibly shorter one; repeated documents are packed each;
an empty table gives no rows; columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.common import slices
from emberfold.llm.tokens import chunk_encoder
from emberfold.session import cut_lineage

SEQUENCE = 1024


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of one bin, number of such bins)], using every counted length exactly once."""
    left = dict(counts)
    lengths = sorted(n for n, c in left.items() if c > 0)
    plan = []
    while lengths:
        used: Counter[int] = Counter()
        content, gap = [], capacity

        def free(n: int, used=used) -> int:
            return left.get(n, 0) - used[n]

        at = len(lengths) - 1
        while at >= 0:
            n = lengths[at]
            if n > gap:
                at = bisect_right(lengths, gap) - 1
            elif free(n) > 0:
                content.append(n)
                used[n] += 1
                gap -= n
            else:
                at -= 1
        if gap and len(content) > 1:
            smallest = content.pop()
            used[smallest] -= 1
            pair = _tightest_pair(lengths, free, gap + smallest, smallest)
            for n in pair or (smallest,):
                content.append(n)
                used[n] += 1
        times = min(left[n] // k for n, k in used.items() if k)
        plan.append((sorted(content, reverse=True), times))
        for n, k in used.items():
            left[n] -= k * times
        lengths = [n for n in lengths if left[n] > 0]
    return plan


def _tightest_pair(lengths, free, room: int, above: int) -> tuple[int, int] | None:
    """Two free lengths with the largest sum in (above, room]."""
    low, high, best = 0, bisect_right(lengths, room) - 1, above
    found = None
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > room or not free(b):
            high -= 1
        else:
            if a + b > best and free(a) and (a != b or free(a) > 1):
                best, found = a + b, (a, b)
            low += 1
    return found


class _Places:
    """Where the piece of a given rank among those of its length goes."""

    def __init__(self, plan: list[tuple[list[int], int]]):
        ranks: Counter[int] = Counter()
        by_length: dict[int, list[tuple]] = {}
        bins = 0
        for content, times in plan:
            offsets: dict[int, list[int]] = {}
            at = 0
            for n in content:
                offsets.setdefault(n, []).append(at)
                at += n
            for n, places in offsets.items():
                by_length.setdefault(n, []).append((ranks[n], len(places), bins, places))
                ranks[n] += len(places) * times
            bins += times
        self.by_length = by_length

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            parts = self.by_length[int(n)]
            starts = np.array([p[0] for p in parts])
            which = np.searchsorted(starts, ranks[rows], "right") - 1
            for w in np.unique(which):
                first, per_bin, bin0, places = parts[w]
                mine = rows[which == w]
                step = ranks[mine] - first
                sequence[mine] = bin0 + step // per_bin
                offset[mine] = np.array(places)[step % per_bin]
        return sequence, offset


def _pieces(path: str, end_id: int, capacity: int, keep_ids: bool, schema: pa.Schema):
    def run(batches):
        coder, seen = chunk_encoder(path), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, flat = coder.encode(batch.column("text"))
                at, rows = 0, []
                for doc, n in enumerate(counts):
                    ids = np.append(flat[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b]), ids[a:b] if keep_ids else None))
                doc, piece, start, length, crc, ids = zip(*rows) if rows else ((),) * 6
                rank = np.empty(len(rows), np.int64)
                for i, n in enumerate(length):
                    rank[i] = seen[n]
                    seen[n] += 1
                columns = [
                    batch.column("doc_id").take(pa.array(doc, pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(rows), part, np.int32)), pa.array(rank),
                ]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema)

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, capacity: int = SEQUENCE, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``keep_ids`` adds the token ids of each piece, from which ``sequences`` builds the sequences.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local", *(["ids"] if keep_ids else [])]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local long"
    cut = cut_lineage(
        docs.select("doc_id", "text").mapInArrow(
            _pieces(tokenizer_path, end_id, capacity, keep_ids, names), schema + ", ids array<int>" * keep_ids
        )
    )
    sizes = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # One count per possible length.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = cut.sparkSession.sparkContext.broadcast(_Places(plan_bins(counts, capacity)))

    def assign(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("local").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = places.value.find(length, rank)
            kept = [batch.column(n) for n in out if n not in ("sequence_id", "offset")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=out)

    out = [n for n in names if n not in ("part", "local")] + ["sequence_id", "offset"]
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return (
        cut.join(offsets.select("length", "part", "before"), ["length", "part"])
        .mapInArrow(assign, shape + ", sequence_id long, offset long")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing made with ``keep_ids``; a sequence holds a bounded number of ids."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
