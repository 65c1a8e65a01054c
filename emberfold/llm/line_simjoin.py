"""Line deduplication by an exact set-similarity join over all lines.

A line is the set of its distinct words (A-Z lower-cased). A line goes if an earlier line, by
(doc_id, line number), has a word set of Jaccard similarity ``percent`` or more, whether that line
stays or not. Words are ordered by rarity; two similar sets share a word within their prefixes, the
first |x| - ceil(t |x|) + 1 words of that order, so only prefix words are indexed. Pairs that meet
on a word must pass the length filter, the positional filter (the words after the meeting point
suffice for the overlap) and a comparison of 64 parities, which bounds the difference from below;
what is left is verified on the whole sets.

Equal sets are found by their signatures and count once in the index. In the list of one word each
line is compared with the earliest ``HUBS`` lines of the list and proposes the first ``PARTNERS`` that
pass; the rest of its list comes to bear only if none of these removes it, so a list of
thousands of near copies is never paired up. Rarity comes from a count sketch over all words, of fixed size; it decides the order of
words and so the speed, never the result.

Defined cases: null and empty texts and lines without a word are left alone (``min_words`` can ask for
more; it is 1 unless set); a document whose lines all go keeps its row with an empty text; rows with an equal doc_id
count as one document and lose the same line numbers; rows with a null doc_id are left alone;
``n_chars`` follows the text; an empty table gives no rows; other columns pass through. doc_id
is an integer.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.common import cut, discard, hash_words, let, mix64, pack, runs, slices, unpack, words_of

PERCENT, MIN_WORDS = 80, 1
HUBS, PARTNERS = 256, 4
# Parities that a pair is compared by before its sets are fetched: two to this power.
WIDE_BITS = 9
# Counters of the rarity sketch and bits of the request filter: fixed sizes of 4 MB and 2 MB.
SKETCH_BITS, FILTER_BITS, PARTS = 22, 24, 64
BLOCK_BYTES, WORDS_PER_SHARD = 3 << 20, 2_000_000
TOKEN_BITS = np.uint64(36)


def _columns(batch, *names):
    return [batch.column(n) for n in names]


def _blocks(min_words: int):
    """One row per few MB of text: the sets of its lines as codes of a small dictionary."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                doc_id = batch.column("doc_id").to_numpy()
                lines = pc.split_pattern(pc.fill_null(batch.column("text"), ""), "\n")
                per_doc = np.diff(lines.offsets.to_numpy()).astype(np.int64)
                counts, codes, words = words_of(lines.flatten())
                total, width = len(counts), max(len(words), 1)
                # Sorted and compared with the one before: ``np.unique`` hashes, which takes many times as long.
                pairs = np.sort(np.repeat(np.arange(total), counts) * width + codes)
                pairs = pairs[np.diff(pairs, prepend=-1) > 0]
                line, code = pairs // width, pairs % width
                size = np.bincount(line, minlength=total)
                code, size_of = code[size[line] >= min_words], size[size >= min_words]
                if not len(size_of):
                    continue
                # The most frequent words get the smallest codes, which pack best.
                often = np.bincount(code, minlength=width)
                order = np.argsort(-often, kind="stable")
                place = np.empty(width, np.int64)
                place[order] = np.arange(width)
                used = int((often > 0).sum())
                dictionary = hash_words(words)[order[:used]]
                code = place[code].astype(np.uint32)
                hashes = dictionary[code]
                starts = np.cumsum(size_of) - size_of
                doc = np.repeat(np.arange(len(doc_id)), per_doc)
                line_no = np.arange(total) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                kept = size >= min_words
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(part << 32) + number]),
                        *[pa.array([pack(x)]) for x in (
                            doc_id[doc[kept]].astype(np.int64), line_no[kept].astype(np.int32),
                            size_of.astype(np.int32), code, dictionary, often[order[:used]].astype(np.int32),
                            np.add.reduceat(mix64(hashes), starts),
                            np.add.reduceat(mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts),
                        )],
                    ],
                    names=BLOCK,
                )
                number += 1
            # What Arrow holds back of this batch would count against the executor for good.
            pa.default_memory_pool().release_unused()

    return run


BLOCK = ["block", "docs", "lines", "sizes", "codes", "words", "often", "sig_a", "sig_b"]


def _place_order(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Stable order by (doc, line): both sorted in one number with their places, several times faster than lexsort."""
    if not len(doc):
        return np.empty(0, np.int64)
    low, lines, places = int(doc.min()), int(line.max()).bit_length(), len(doc).bit_length()
    if (int(doc.max()) - low).bit_length() + lines + places > 64:
        return np.lexsort((line, doc))
    key = ((doc - low).astype(np.uint64) << np.uint64(lines)) | line.astype(np.uint64)
    placed = np.sort((key << np.uint64(places)) | np.arange(len(doc), dtype=np.uint64))
    return (placed & np.uint64((1 << places) - 1)).astype(np.int64)


def _by_set(doc, line, a, b) -> tuple[np.ndarray, np.ndarray]:
    """Order by (a, b, doc, line), and where a new set begins in it."""
    base, places = _place_order(doc, line), np.uint64(len(doc).bit_length())
    placed = np.sort((a[base] >> places << places) | np.arange(len(doc), dtype=np.uint64))
    order = base[(placed & ((np.uint64(1) << places) - np.uint64(1))).astype(np.int64)]
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    if (new[1:] & (placed[1:] >> places == placed[:-1] >> places)).any():
        # Different signatures that begin alike, once in hundreds of blocks.
        order = np.lexsort((line, doc, b, a))
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return order, new


def _firsts(batch_row: dict) -> tuple[np.ndarray, ...]:
    """Per line of a block: doc, line number, both signatures, and whether it is its set's first."""
    doc, line = unpack(batch_row["docs"], np.int64), unpack(batch_row["lines"], np.int32)
    a, b = unpack(batch_row["sig_a"], np.uint64), unpack(batch_row["sig_b"], np.uint64)
    order, new = _by_set(doc, line, a, b)
    # The same line number of rows with an equal doc_id is one line, not an earlier one.
    same = np.zeros(len(order), bool)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    same = (doc[order] == doc[order[lead]]) & (line[order] == line[order[lead]])
    first, leader = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order] = same
    leader[order] = new
    return doc, line, a, b, first, leader


def _signatures(local: bool):
    """Lines by signature: those that are the first of their set in the block, or (local) those that repeat it."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc, line, a, b, first, leader = _firsts(row)
                take = ~first if local else leader
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[take]) for x in (doc, line, a.view(np.int64), b.view(np.int64))],
                    names=["doc", "line", "sig_a", "sig_b"],
                )

    return run


def _sums(parts: DataFrame, kind) -> np.ndarray:
    """Sum of the tasks' arrays, each cut into PARTS parts; a fixed number of bytes."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(unpack(x, kind).astype(np.int64) for x in table.column("data").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "data": pa.array([pack(total)], pa.binary())})

    rows = parts.groupBy("part").applyInArrow(add, "part int, data binary").collect()
    return {r["part"]: unpack(r["data"], np.int64) for r in rows}


def _sketch(batches):
    total = np.zeros(1 << SKETCH_BITS, np.int32)
    for batch in batches:
        for words, often in zip(*(batch.column(c).to_pylist() for c in ("words", "often"))):
            spot = (unpack(words, np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
            np.add.at(total, spot, unpack(often, np.int32))
    yield _in_parts(total)


def _in_parts(total: np.ndarray) -> pa.RecordBatch:
    cut = np.split(total, PARTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(PARTS, dtype=np.int32)), pa.array([pack(c) for c in cut], pa.binary())], names=["part", "data"]
    )


def _whole(sums: dict[int, np.ndarray], size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for part, values in sums.items():
        out[part * len(values) : (part + 1) * len(values)] = values
    return out


def _postings(rarity, shards: int, percent: int):
    """Prefix words of each block's distinct sets, packed by shard of the word."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc, line, _, sig, _, leader = _firsts(row)
                size = unpack(row["sizes"], np.int32).astype(np.int64)
                hashes = unpack(row["words"], np.uint64)[unpack(row["codes"], np.uint32)]
                starts = np.cumsum(size) - size
                bits = np.bitwise_xor.reduceat(np.uint64(1) << (mix64(hashes) >> np.uint64(58)), starts)
                prefix = size - -(-size * percent // 100) + 1
                found = []
                step = 1 << 19
                for at in range(0, len(size), step):
                    mine = size[at : at + step]
                    own = hashes[starts[at] : starts[at] + mine.sum()]
                    rare = rarity.value[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
                    of = np.repeat(np.arange(len(mine), dtype=np.uint64), mine)
                    mixed = mix64(own) & ((np.uint64(1) << TOKEN_BITS) - np.uint64(1))
                    ranked = np.sort((((of << np.uint64(8)) | rare) << TOKEN_BITS) | mixed)
                    where = np.arange(len(ranked)) - np.repeat(np.cumsum(mine) - mine, mine)
                    lead = (where < np.repeat(prefix[at : at + step], mine)) & np.repeat(leader[at : at + step], mine)
                    # A word that occurs once in the corpus meets nobody.
                    lead &= ((ranked >> TOKEN_BITS) & np.uint64(255)) > 0
                    found.append((ranked[lead], where[lead], at))
                token = np.concatenate([f[0] & ((np.uint64(1) << TOKEN_BITS) - np.uint64(1)) for f in found])
                index = np.concatenate([(f[0] >> np.uint64(44)).astype(np.int64) + f[2] for f in found])
                where = np.concatenate([f[1] for f in found]).astype(np.int32)
                shard = (token % np.uint64(shards)).astype(np.int64)
                # Numbers of 16 bits are sorted by radix.
                order = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
                cuts, lengths = runs(shard[order])
                for c, n in zip(cuts, lengths):
                    o = order[c : c + n]
                    i = index[o]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(shard[o[0]])], pa.int32()), pa.array([row["block"]]),
                            *[pa.array([pack(x)]) for x in (
                                token[o], i.astype(np.int32), where[o], doc[i], line[i], size[i].astype(np.int32), bits[i], sig[i].astype(np.uint32))],
                        ],
                        names=["shard", "block", *POSTING],
                    )

    return run


POSTING = ["token", "index", "place", "doc", "line", "size", "bits", "sig"]
KINDS = [np.uint64, np.int32, np.int32, np.int64, np.int32, np.int32, np.uint64, np.uint32]


def _sorted_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of keys of TOKEN_BITS: sorted together with their places, several times faster than argsort."""
    low = np.uint64(64) - TOKEN_BITS
    if len(keys) >> int(low):
        return np.argsort(keys, kind="stable")
    placed = np.sort((keys << low) | np.arange(len(keys), dtype=np.uint64))
    return (placed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)


def _meet(percent: int):
    """Candidate pairs (kind 0) of one shard, and the entries of lists with more of them (1, 2)."""

    def run(table: pa.Table) -> pa.Table:
        packed = [table.column(c).to_pylist() for c in POSTING]
        p = {c: np.concatenate([unpack(x, k) for x in col]) for c, col, k in zip(POSTING, packed, KINDS)}
        p["block"] = np.repeat(table.column("block").to_numpy(), [len(unpack(x, np.int32)) for x in packed[1]])

        def pick(p, order):
            return {c: x[order] for c, x in p.items()}

        def listed(p):
            """Entries by word, each list in the order of places, without words that one line has."""
            order = _sorted_order(p["token"])
            _, n = runs(p["token"][order])
            return order[np.repeat(n, n) > 1]

        p = pick(p, _place_order(p["doc"], p["line"]))
        p = pick(p, np.sort(listed(p)))
        # Equal sets count once, by their first place.
        key = mix64(p["token"] + mix64(p["sig"]))
        order = _sorted_order(key >> (np.uint64(64) - TOKEN_BITS))
        same = np.zeros(len(order), bool)
        same[1:] = np.logical_and.reduce([p[c][order[1:]] == p[c][order[:-1]] for c in ("token", "sig", "bits", "size")])
        p = pick(p, np.sort(order[~same]))
        order = listed(p)
        q = pick(p, order)
        start, length = runs(q["token"])
        rank = np.arange(len(order)) - np.repeat(start, length)
        begin, length = np.repeat(start, length), np.repeat(length, length)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        proposed, more = np.zeros(len(order), np.int32), rank > HUBS
        x = np.flatnonzero(rank > 0)
        for k in range(HUBS):
            x = x[(rank[x] > k) & (proposed[x] <= PARTNERS)]
            if not len(x):
                break
            good = _may_match(q, x, begin[x] + k, percent)
            hit = x[good]
            proposed[hit] += 1
            enough = proposed[hit] > PARTNERS
            more[hit[enough]] = True
            left.append(hit[~enough])
            right.append(begin[hit[~enough]] + k)
        x, y = np.concatenate(left), np.concatenate(right)
        pairs = {
            "kind": np.zeros(len(x), np.int32), "token": q["token"][x].view(np.int64),
            "block": q["block"][x], "index": q["index"][x], "block_y": q["block"][y], "index_y": q["index"][y],
        }
        # Lists with a line that is not through with its partners; kind 2 marks such a line.
        long = np.flatnonzero(np.repeat(np.logical_or.reduceat(more, start), _lengths(start, len(order)))) if len(order) else x
        lists = {
            "kind": 1 + more[long].astype(np.int32), "token": q["token"][long].view(np.int64),
            "block": q["block"][long], "index": q["index"][long],
            "doc": q["doc"][long], "line": q["line"][long], "rank": rank[long].astype(np.int32), "place": q["place"][long], "size": q["size"][long], "bits": q["bits"][long].view(np.int64),
        }
        # Twice the same pair in one shard: once is enough.
        some = pa.table(pairs).group_by(["kind", "block", "index", "block_y", "index_y"]).aggregate([("token", "min")])
        some = some.rename_columns([c.replace("token_min", "token") for c in some.column_names])
        return pa.concat_tables([some.select(list(pairs)), pa.table(lists)], promote_options="default").select(MEETING)

    return run


def _lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


MEETING = ["kind", "token", "block", "index", "block_y", "index_y", "doc", "line", "rank", "place", "size", "bits"]
MEETING_TYPES = (
    "kind int, token long, block long, index int, block_y long, index_y int, doc long, line int, rank int, place int, size int, bits long"
)


def _may_match(q: dict, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Indexes of the pairs that pass; the parities, which most pairs fail, come first."""
    sx, sy = q["size"][x], q["size"][y]
    both = sx + sy
    overlap = -(-percent * both // (100 + percent))
    good = np.flatnonzero(np.bitwise_count(q["bits"][x] ^ q["bits"][y]) <= both - 2 * overlap)
    x, y, sx, sy, overlap = x[good], y[good], sx[good], sy[good], overlap[good]
    rest = (100 * sx >= percent * sy) & (100 * sy >= percent * sx)
    rest &= np.minimum(sx - q["place"][x], sy - q["place"][y]) >= overlap
    rest &= (q["doc"][x] != q["doc"][y]) | (q["line"][x] != q["line"][y])
    return good[rest]


def _may_match_columns(percent: int) -> Column:
    """The same filters over columns of two list entries ``x`` and ``y``."""
    c = lambda t, n: F.col(f"{t}.{n}")
    both = "(x.size + y.size)"
    overlap = F.expr(f"({percent} * {both} + {99 + percent}) div {100 + percent}")
    return (
        (F.struct(c("x", "doc"), c("x", "line")) != F.struct(c("y", "doc"), c("y", "line")))
        & (F.bit_count(c("x", "bits").bitwiseXOR(c("y", "bits"))) <= F.expr(both) - 2 * overlap)
        & (100 * c("x", "size") >= percent * c("y", "size")) & (100 * c("y", "size") >= percent * c("x", "size"))
        & (F.least(c("x", "size") - c("x", "place"), c("y", "size") - c("y", "place")) >= overlap)
    )


def _slot(block: np.ndarray, index: np.ndarray) -> np.ndarray:
    mixed = mix64(block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + index.astype(np.uint64))
    return (mixed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _requests(batches):
    asked = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in batches:
        spot = _slot(batch.column("block").to_numpy(), batch.column("index").to_numpy())
        np.bitwise_or.at(asked, spot >> 3, (1 << (spot & 7)).astype(np.uint8))
    yield _in_parts(asked)


def _of_lines(asked, kind: str):
    """The word sets, or the ``WIDE`` parities, of the lines that were asked for (and of few others)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                size = unpack(row["sizes"], np.int32).astype(np.int64)
                index = np.arange(len(size))
                spot = _slot(np.full(len(size), row["block"]), index)
                mine = index[(asked.value[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0]
                if not len(mine):
                    continue
                own = size[mine]
                ends = np.cumsum(own)
                place = np.arange(ends[-1]) + np.repeat((np.cumsum(size) - size)[mine] - (ends - own), own)
                hashes = unpack(row["words"], np.uint64)[unpack(row["codes"], np.uint32)[place]]
                if kind == "set":
                    data = [np.sort(hashes[end - n : end]).tobytes() for end, n in zip(ends.tolist(), own.tolist())]
                else:
                    data = _wide_parities(hashes, own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), row["block"], np.int64)), pa.array(mine.astype(np.int32)), pa.array(data, pa.binary())],
                    names=["block", "index", kind],
                )

    return run


def _wide_parities(words: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The size of each set, and bits that each hold the parity of the words that fall on them."""
    spots = (mix64(words ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - WIDE_BITS)).astype(np.int64)
    ends, out, step = np.cumsum(sizes), [], 1 << 12
    for at in range(0, len(sizes), step):
        n = sizes[at : at + step]
        here = spots[ends[at] - n[0] : ends[at + len(n) - 1]] + (np.repeat(np.arange(len(n)), n) << WIDE_BITS)
        odd = (np.bincount(here, minlength=len(n) << WIDE_BITS) & 1).astype(np.uint8).reshape(len(n), -1)
        rows = np.concatenate([n.astype("<u4").view(np.uint8).reshape(-1, 4), np.packbits(odd, axis=1)], axis=1)
        data, width = rows.tobytes(), rows.shape[1]
        out += [data[i : i + width] for i in range(0, len(data), width)]
    return out


def _near(percent: int):
    """Pairs whose wide parities allow enough similarity."""

    def run(batches):
        for batch in batches:
            sides = []
            for name in ("wide", "wide_y"):
                data = batch.column(name)
                flat = np.frombuffer(b"".join(data.to_pylist()), np.uint8).reshape(len(data), -1)
                sides.append((np.ascontiguousarray(flat[:, :4]).view(np.uint32).ravel().astype(np.int64), flat[:, 4:]))
            both = sides[0][0] + sides[1][0]
            apart = np.bitwise_count(sides[0][1] ^ sides[1][1]).sum(axis=1, dtype=np.int64)
            good = apart <= both - 2 * -(-percent * both // (100 + percent))
            yield batch.select(PAIR).filter(pa.array(good))

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set").to_pylist(), batch.column("set_y").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["block", "index"]).filter(pa.array(keep, pa.bool_()))

    return run


PAIR = ["block", "index", "block_y", "index_y"]
PAIR_TYPES = "block long, index int, block_y long, index_y int"


def _with_lines(blocks: DataFrame, pairs: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """A table of the asked lines' sets or wide parities, and ``pairs`` with those of both lines."""
    wanted = pairs.select("block", "index").union(pairs.select("block_y", "index_y"))
    parts = wanted.mapInArrow(_requests, "part int, data binary")

    def either(table: pa.Table) -> pa.Table:
        data = np.bitwise_or.reduce([unpack(x, np.uint8) for x in table.column("data").to_pylist()])
        return pa.table({"part": table.column("part").slice(0, 1), "data": pa.array([pack(data)], pa.binary())})

    asked = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in parts.groupBy("part").applyInArrow(either, "part int, data binary").collect():
        data = unpack(r["data"], np.uint8)
        asked[r["part"] * len(data) : (r["part"] + 1) * len(data)] = data
    # Read and unpacked once for both sides of the pairs.
    mine = cut(blocks.select("block", "sizes", "codes", "words").mapInArrow(
        _of_lines(blocks.sparkSession.sparkContext.broadcast(asked), kind), f"block long, index int, {kind} binary"
    ))
    other = mine.select(F.col("block").alias("block_y"), F.col("index").alias("index_y"), F.col(kind).alias(f"{kind}_y"))
    return mine, pairs.join(mine, ["block", "index"]).join(other, ["block_y", "index_y"]).select(*PAIR, kind, f"{kind}_y")


def _confirmed(blocks: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(block, index) of lines in ``pairs`` that match the other line of a pair.

    Wide parities, a few bytes per line, leave little more than the matches; these are verified
    on the whole sets.
    """
    lines, wide = _with_lines(blocks, pairs, "wide")
    near = cut(wide.mapInArrow(_near(percent), PAIR_TYPES))
    discard(lines)
    lines, sets = _with_lines(blocks, near, "set")
    out = cut(
        sets.select("block", "index", "set", "set_y").mapInArrow(_verify(percent), "block long, index int").distinct()
    )
    discard(near, lines)
    return out


def removed_lines(docs: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line): the lines, counted from 0, that repeat an earlier one."""
    spark = docs.sparkSession
    blocks = cut(
        docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(
            _blocks(min_words), "block long, docs binary, lines binary, sizes binary, codes binary, words binary, "
            "often binary, sig_a binary, sig_b binary"
        )
    )
    counts = _whole(_sums(blocks.select("words", "often").mapInArrow(_sketch, "part int, data binary"), np.int32), 1 << SKETCH_BITS)
    rarity = spark.sparkContext.broadcast(np.minimum(np.log2(np.maximum(counts, 1)) * 6, 255).astype(np.uint8))
    shards = int(counts.sum() // WORDS_PER_SHARD) + 1
    posted = ", ".join(f"{c} binary" for c in POSTING)
    meetings = cut(
        blocks.mapInArrow(_postings(rarity, shards, percent), f"shard int, block long, {posted}")
        .groupBy("shard").applyInArrow(_meet(percent), MEETING_TYPES)
    )
    pairs = meetings.filter("kind = 0").select("block", "index", "block_y", "index_y").distinct()
    matched = _confirmed(blocks, pairs, percent)
    # Lines that none of their first partners has removed meet the whole of their lists.
    lists = meetings.filter("kind > 0")
    still = lists.filter("kind = 2").join(matched, ["block", "index"], "left_anti")
    rest = cut(
        still.alias("x").join(lists.alias("y"), F.col("x.token") == F.col("y.token"))
        .filter((F.col("y.rank") < F.col("x.rank")) & _may_match_columns(percent))
        .select("x.block", "x.index", F.col("y.block").alias("block_y"), F.col("y.index").alias("index_y")).distinct()
    )
    found = [matched] if rest.isEmpty() else [matched, _confirmed(blocks, rest, percent)]

    def seen(local: bool) -> DataFrame:
        return blocks.select("docs", "lines", "sig_a", "sig_b").mapInArrow(
            _signatures(local), "doc long, line int, sig_a long, sig_b long"
        )

    # A set has one row per block here, however many lines repeat it.
    at = F.struct("doc", "line")
    first = F.min(at).over(Window.partitionBy("sig_a", "sig_b"))
    repeats = seen(False).withColumn("first", first).filter(at != F.col("first"))
    # At most the lines of a block in a list.
    chosen = reduce(DataFrame.unionByName, found).groupBy("block").agg(F.collect_set("index").alias("chosen"))
    similar = blocks.select("block", "docs", "lines").join(chosen, "block").mapInArrow(_line_places, "doc long, line int")
    removed = cut(
        repeats.select("doc", "line").union(seen(True).select("doc", "line")).union(similar)
        .select(F.col("doc").alias("doc_id"), "line").distinct()
    )
    discard(blocks, meetings, rest, *found)
    return removed


def _line_places(batches):
    for batch in batches:
        for row in batch.to_pylist():
            index = np.array(row["chosen"], np.int64)
            doc, line = unpack(row["docs"], np.int64)[index], unpack(row["lines"], np.int32)[index]
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(line)], names=["doc", "line"])


def dedup_lines(docs: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated lines, all columns and rows kept."""
    gone = cut(
        removed_lines(docs, percent=percent, min_words=min_words)
        .groupBy("doc_id").agg(F.collect_set("line").alias("lines"))
        .select(F.col("doc_id").alias("_gone_id"), "lines")
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    joined = docs.select(whole, F.col("doc_id").alias("_id")).join(
        gone.hint("shuffle_hash"), F.col("_id") == F.col("_gone_id"), "left"
    )
    text = F.col("doc.text")
    left = let(
        F.split(text, "\n"),
        lambda s: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(s) - 1), F.col("lines")), lambda i: s[i]
        ),
    )
    new = F.when(F.col("lines").isNull() | text.isNull(), text).otherwise(F.array_join(left, "\n"))
    joined = joined.withColumn("new", new)
    out = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("lines").isNull(), F.col("doc.n_chars")).otherwise(F.length("new")).cast(
            docs.schema["n_chars"].dataType
        )
    return joined.select(*[out.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
