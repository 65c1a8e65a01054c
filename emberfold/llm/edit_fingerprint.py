"""Fingerprints whose Hamming distance follows the edit distance of texts.

All texts are walked with the same random bits: at output position j the walk writes the character
it stands on and moves on if the bit of (j, character) is set. Texts that agree for a while fall
into step again soon after an edit, so few edits change few output positions. The bits repeat with
period 256 and characters are hashed to 256 classes, so a walk is a chain of table lookups.

The fingerprint samples four bits at some output positions. Position j is sampled at level L if the
last L bits of its hash are zero; a text uses the lowest level with at most ``SAMPLES`` positions,
and two fingerprints are compared at the higher of their levels, whose positions both have.

``neighbour_report`` puts documents in the order of descending doc_id and compares each with its
successor and with itself under a block edit.

``near_groups`` finds near texts by banding. A band picks the bits of a few positions: the first of
its own order of all positions that a fingerprint holds. Two fingerprints share a band if they agree
there, which happens with the likeness to the power of the band's width, also if their lengths
differ. Members of a bucket are verified against its first one; buckets that then still hold several
groups are compared in tiles, in which every two members are verified unless links join them already.
So of the pairs that share a band no link between different groups is lost.

Defined cases: a null text counts as empty; an empty text has the fingerprint without samples, which
is like another such one (1) and unlike all others (0); repeated doc_ids follow each other by a hash
of the text; a null doc_id comes last, and its row takes the group of its fingerprint, null if no
row of the group has a doc_id; the successor of the last document is the first, of a single one itself;
an empty table gives no rows; other columns are not looked at. A text is walked in pieces: beyond the
text itself its 64-bit output positions are the largest array held.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm import forests
from emberfold.llm.common import cut, discard, mix64, runs, slices
from emberfold.operators.components import connected_components

PERIOD, SAMPLES = 256, 256
# Bands of near_groups, and sampled positions in each: a pair of likeness 0.8 shares one with
# probability 0.95.
BANDS, BAND_WIDTH = 16, 8
# Fingerprints whose length is beyond this share of their level's may be near one of the next level.
NEXT_LEVEL = 0.7
# More positions than any level samples: 256 are expected at most.
POSITIONS = 1024
# Characters, output positions that are worked on at once.
PIECE, REACH = 1 << 16, 1 << 20


@lru_cache(maxsize=1)
def walk_table() -> tuple[bytes, ...]:
    """Per state (output position modulo the period) and class: the state after leaving a character."""
    at = np.arange(PERIOD, dtype=np.uint64)
    bits = (mix64(at[:, None] * np.uint64(257) + at[None, :] + np.uint64(1)) >> np.uint64(17)) & np.uint64(1)
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for j in range(2 * PERIOD - 1, -1, -1):
        row = j % PERIOD
        table[row] = np.where(bits[row] == 1, (row + 1) % PERIOD, table[(row + 1) % PERIOD])
    return tuple(table[s].astype(np.uint8).tobytes() for s in range(PERIOD))


@lru_cache(maxsize=256)
def _sampled(level: int, reach: int) -> np.ndarray:
    mask = np.uint64((1 << level) - 1)
    found = []
    for start in range(0, reach, REACH):
        at = np.arange(start, min(start + REACH, reach), dtype=np.uint64)
        found.append(start + np.flatnonzero(mix64(at + np.uint64(0x1234567)) & mask == 0))
    return np.concatenate(found)


def positions(level: int, length: int) -> np.ndarray:
    """Sampled output positions of a level below ``length``."""
    reach = 1 << max(16, int(length).bit_length())
    spots = _sampled(level, reach)
    return spots[: np.searchsorted(spots, length)]


def classes(text: str) -> np.ndarray:
    out = np.empty(len(text), np.uint8)
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        out[at : at + PIECE] = points * np.uint32(2654435761) >> np.uint32(24)
    return out


def walk(codes: np.ndarray, state: int = 0) -> np.ndarray:
    """Output positions taken up by each character, from a state on."""
    table, first = walk_table(), state
    after = np.empty(len(codes), np.uint8)
    for at in range(0, len(codes), PIECE):
        states = bytes([state := table[state][c] for c in codes[at : at + PIECE].tobytes()])
        after[at : at + PIECE] = np.frombuffer(states, np.uint8)
    before = np.empty_like(after)
    if len(after):
        before[0], before[1:] = first, after[:-1]
    return (after - before - np.uint8(1)).astype(np.uint16) + np.uint16(1)


def fingerprint(*parts: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Level, output length and the sampled four-bit symbols of a text in parts.

    A part is the classes of its characters and the walk's running sum behind each of them.
    """
    parts = [(codes, ends) for codes, ends in parts if len(ends)]
    length = int(parts[-1][1][-1]) if parts else 0
    level = max(0, (-(-length // SAMPLES) - 1).bit_length())
    spots, symbols = positions(level, length), [np.empty(0, np.uint8)]
    for codes, ends in parts:
        to = int(np.searchsorted(spots, ends[-1]))
        symbols.append(codes[np.searchsorted(ends, spots[:to], "right")] & 15)
        spots = spots[to:]
    symbols = np.concatenate(symbols)
    if len(symbols) % 2:
        symbols = np.append(symbols, np.uint8(0))
    return struct.pack("<BI", level, length) + (symbols[::2] << 4 | symbols[1::2]).tobytes()


def _symbols(print_: bytes) -> tuple[int, int, np.ndarray]:
    level, length = struct.unpack("<BI", print_[:5])
    packed = np.frombuffer(print_[5:], np.uint8)
    both = np.stack([packed >> 4, packed & 15], 1).ravel()
    return level, length, both[: len(positions(level, length))]


def likeness(one: bytes, other: bytes) -> float:
    """Share of the common sampled positions at which two fingerprints agree."""
    if one == other:
        return 1.0
    parts = [_symbols(one), _symbols(other)]
    level = max(p[0] for p in parts)
    kept = []
    for own, length, symbols in parts:
        if own < level:
            symbols = symbols[np.isin(positions(own, length), positions(level, length), assume_unique=True)]
        kept.append(symbols)
    short, most = min(map(len, kept)), max(map(len, kept))
    return float((kept[0][:short] == kept[1][:short]).sum()) / most if most else 0.0


class _Document:
    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.codes = doc_id, text, classes(text)
        self.ends = np.cumsum(walk(self.codes), dtype=np.int64)
        self.print = fingerprint((self.codes, self.ends))

    def edited(self, following: _Document) -> tuple[str, bytes]:
        """The text with its last half replaced from the next one's start, and its fingerprint."""
        kept = len(self.text) - len(self.text) // 2
        head = following.codes[: len(self.text) // 2]
        state = int(self.ends[kept - 1]) if kept else 0
        more = state + np.cumsum(walk(head, state % PERIOD), dtype=np.int64)
        text = self.text[:kept] + following.text[: len(self.text) // 2]
        return text, fingerprint((self.codes[:kept], self.ends[:kept]), (head, more))


def _report(document: _Document, following: _Document) -> tuple:
    text, print_ = document.edited(following)
    return (
        document.doc_id, len(document.text), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        document.print, print_, likeness(document.print, print_), likeness(document.print, following.print),
    )


REPORT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _rows(rows: list[tuple], id_type: pa.DataType, extra: dict | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(REPORT)
    types = [id_type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    extra = extra or {}
    arrays += [pa.array([extra.get(n)] * len(rows), t) for n, t in EDGE]
    return pa.RecordBatch.from_arrays(arrays, names=[*REPORT, *(n for n, _ in EDGE)])


EDGE = [("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())]


def _packed(batches):
    """Texts compressed one by one: random words hardly shrink by the codec of the shuffle."""
    packer = zstandard.ZstdCompressor(level=1)
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.binary())
            packed = pa.array([packer.compress(t) for t in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), packed], names=["doc_id", "tie", "packed"]
            )


def _along():
    """Reports along a sorted partition; its first and last documents are kept with their texts."""

    def run(batches):
        part, first, last = TaskContext.get().partitionId(), None, None
        kind, unpacker = None, zstandard.ZstdDecompressor()
        for whole in batches:
            for batch in slices(whole, "packed"):
                kind, rows = batch.schema.field("doc_id").type, []
                for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("packed")):
                    document = _Document(doc_id, unpacker.decompress(packed.as_py()).decode("utf-8", "surrogatepass"))
                    if last is not None:
                        rows.append(_report(last, document))
                    first, last = first or document, document
                yield _rows(rows, kind)
        for edge, document in (("first", first), ("last", last)):
            if document is not None:
                row = (document.doc_id, len(document.text), None, None, None, None, None)
                yield _rows([row], kind, {"part": part, "edge": edge, "text": document.text})

    return run


def _across(batches):
    for batch in batches:
        rows = [
            _report(_Document(i, t), _Document(None, n))
            for i, t, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))
        ]
        yield _rows(rows, batch.schema.field("doc_id").type).select(REPORT)


def neighbour_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike it is to that and the next.

    The rows are dealt out by ranges of doc_id, those of one doc_id by a hash of the text; only the
    two documents at the ends of each range meet again in a second step, by range.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double"
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    walked = cut(
        docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text")
        .mapInArrow(_packed, f"doc_id {kind}, tie long, packed binary").repartitionByRange(*order)
        .sortWithinPartitions(*order, "packed").mapInArrow(_along(), schema + ", part int, edge string, text string")
    )
    # Two rows per range: few, whatever the size of the corpus.
    parts = Window.partitionBy(F.lit(0)).orderBy("part")
    starts = (
        walked.filter("edge = 'first'").select("part", F.col("text").alias("following"))
        .withColumn("before", F.coalesce(F.lag("part").over(parts), F.max("part").over(parts.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))))
    )
    ends = (
        walked.filter("edge = 'last'").select("part", "doc_id", "text")
        .join(starts.select(F.col("before").alias("part"), "following"), "part")
        .select("doc_id", "text", "following").mapInArrow(_across, schema)
    )
    return walked.filter("edge IS NULL").select(*REPORT).unionByName(ends)


@lru_cache(maxsize=1)
def _orders(bands: int) -> np.ndarray:
    """Per band an order of all positions."""
    at = np.arange(bands * POSITIONS, dtype=np.uint64).reshape(bands, POSITIONS)
    return np.argsort(mix64(at + np.uint64(99)), axis=1)


@lru_cache(maxsize=8192)
def _picks(bands: int, samples: int, width: int) -> np.ndarray:
    """Per band the first positions in its order that a fingerprint of so many samples holds."""
    return np.stack([order[order < samples][:width] for order in _orders(bands)])


def _width(samples: int, width: int) -> int:
    """Positions in a band: fewer for short fingerprints, always a power of two then."""
    return min(width, 1 << max(0, (samples // 4).bit_length() - 1))


def at_level(print_: bytes, wanted: int) -> np.ndarray:
    """The symbols of a fingerprint that a level at or above its own samples."""
    own, length, symbols = _symbols(print_)
    if own == wanted:
        return symbols
    return symbols[np.isin(positions(own, length), positions(wanted, length), assume_unique=True)]


def band_keys(print_: bytes, bands: int = BANDS, width: int = BAND_WIDTH) -> np.ndarray:
    """Keys of a fingerprint's bands: level, width, band and the symbols, at most ten of them, as one number.

    They are made at its own level and, if its length comes near the limit, at the next, and for the
    widths of its own number of samples and of a quarter more, as a partner may have.
    """
    level, length = struct.unpack("<BI", print_[:5])
    up = length >= NEXT_LEVEL * (SAMPLES << level)
    keys = [np.empty(0, np.uint64)]
    for at in (level, level + 1) if up else (level,):
        own = at_level(print_, at)
        for w in {_width(len(own), width), _width(len(own) * 5 // 4 + 1, width)} if len(own) else ():
            picks = _picks(bands, len(own), min(w, len(own)))
            packed = np.full(bands, at << 4 | w, np.uint64) << np.uint64(8) | np.arange(bands, dtype=np.uint64)
            for column in own[picks].astype(np.uint64).T:
                packed = packed << np.uint64(4) | column
            keys.append(packed << np.uint64(4 * (10 - picks.shape[1])))
    return np.concatenate(keys)


def _keyed(bands: int, width: int):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                keys = [band_keys(p, bands, width) for p in batch.column("fingerprint").to_pylist()]
                node = np.repeat(batch.column("node").to_numpy(), [len(k) for k in keys])
                key = np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node)], names=["key", "node"])

    return run


def _shared(batches):
    """Members of the keys that several nodes have, with each key's first node; from sorted rows.

    The last row of a batch waits for the next one, to see whether its key goes on.
    """
    held = None  # key, node, first node, whether earlier rows have the key
    names = ["key", "node", "head"]
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = (batch.column(c).to_numpy() for c in ("key", "node"))
        if held is not None:
            key, node = np.append(held[0], key), np.append(held[1], node)
        starts, lengths = runs(key)
        heads, several = node[starts], lengths > 1
        if held is not None:
            heads[0], several[0] = held[2], several[0] or held[3]
        heads, several = np.repeat(heads, lengths), np.repeat(several, lengths)
        held = (key[-1], node[-1], heads[-1], bool(several[-1]))
        keep = several[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep]) for x in (key, node, heads)], names=names)
    if held is not None and held[3]:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in held[:3]], names=names)


def _alike(threshold: float):
    def run(batches):
        for batch in batches:
            scores = [likeness(a, b) for a, b in zip(batch.column("fp_a").to_pylist(), batch.column("fp_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array([s >= threshold for s in scores], pa.bool_()))

    return run


def _level_table(prints: list[bytes], level: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of symbols, symbols filled up with 16) of fingerprints at a level."""
    symbols = [at_level(p, level) for p in prints]
    size = np.array([len(x) for x in symbols])
    table = np.full((len(size), size.max()), 16, np.uint8)
    for row, x in enumerate(symbols):
        table[row, : len(x)] = x
    return size, table


def _tile_links(rows: pa.Table, threshold: float) -> pa.RecordBatch:
    """Links of one tile between groups that are still apart, no more than connect them.

    Two members are compared at the higher of their levels, so the tile is gone through by level.
    """
    node, block = (rows.column(c).to_numpy() for c in ("node", "block"))
    diagonal = bool(rows.column("diagonal")[0].as_py())
    prints = rows.column("fingerprint").to_pylist()
    own = np.array([p[0] for p in prints])
    label = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy().copy()
    left, right = [], []
    for level in np.unique(own):
        known = np.flatnonzero(own <= level)
        size, table = _level_table([prints[i] for i in known], int(level))
        for at, i in enumerate(known[:-1]):
            later = np.arange(at + 1, len(known))
            later = later[label[known[later]] != label[i]]
            if not diagonal:
                later = later[block[known[later]] != block[i]]
            if own[i] < level:
                later = later[own[known[later]] == level]
            most = np.maximum(size[later], size[at])
            fit = np.minimum(size[later], size[at]) >= threshold * most
            later, most = later[fit], most[fit]
            if not len(later):
                continue
            agree = (table[later] == table[at]).sum(axis=1) - (table.shape[1] - most)
            j = known[later[agree / np.maximum(most, 1) >= threshold]]
            if len(j):
                met, first = np.unique(label[j], return_index=True)
                j = j[first]
                label[np.isin(label, met)] = label[i]
                left.append(np.full(len(j), i))
                right.append(j)
    places = [np.concatenate([np.empty(0, np.int64), *x]) for x in (left, right)]
    return pa.RecordBatch.from_arrays([pa.array(node[x]) for x in places], names=["a", "b"])


def _tiles_linked(threshold: float):
    """Links of all tiles, from rows sorted by tile."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            starts, lengths = runs(rows.column("tile").to_numpy())
            for start, length in zip(starts[:-1], lengths[:-1]):
                yield _tile_links(rows.slice(start, length), threshold)
            held = rows.slice(starts[-1])
        if held is not None:
            yield _tile_links(held, threshold)

    return run


def near_groups(
    prints: DataFrame, threshold: float = 0.8, *, bands: int = BANDS, width: int = BAND_WIDTH
) -> DataFrame:
    """(fingerprint, group_id) of the distinct fingerprints of ``prints`` (doc_id, fingerprint).

    ``group_id`` is the smallest doc_id that links of at least ``threshold`` join with it. Equal
    fingerprints are one node. A pair of likeness s shares a band with probability
    1 - (1 - s^width)^bands; ``width`` is at most ten.
    """
    nodes = cut(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    printed = nodes.select("node", "fingerprint")
    members = cut(
        printed.mapInArrow(_keyed(bands, width), "key long, node long")
        .repartition("key").sortWithinPartitions("key", "node").mapInArrow(_shared, "key long, node long, head long")
    )
    pairs = members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = cut(
        pairs.join(printed.toDF("a", "fp_a"), "a").join(printed.toDF("b", "fp_b"), "b")
        .mapInArrow(_alike(threshold), "a long, b long")
    )
    roots = cut(connected_components(printed.select("node"), links, []))
    mixed = forests.mixed_buckets(members.join(roots, "node").select("key", "node", "root"))
    more = cut(
        forests.tile_rows(mixed).join(printed, "node").repartition("tile").sortWithinPartitions("tile")
        .mapInArrow(_tiles_linked(threshold), "a long, b long")
    )
    final = cut(connected_components(printed.select("node"), links.unionByName(more), []))
    discard(members, links, roots, more)
    named = nodes.join(final, "node")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("group_id"))
    return named.join(smallest, "root").select("fingerprint", "group_id")


def fingerprint_report(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``neighbour_report`` with each document's group of near texts."""
    report = cut(neighbour_report(docs))
    return report.join(near_groups(report.select("doc_id", "fingerprint"), threshold), "fingerprint").select(*REPORT, "group_id")
