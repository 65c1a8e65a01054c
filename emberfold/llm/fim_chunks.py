"""Fill-in-middle documents, cut at token counts that are put together from memoised chunks.

A unit is a word with the white space before it, or the white space at the end of a text. Texts are
cut into chunks where a rolling hash over the last bytes hits a fixed value, so that equal passages
make equal chunks wherever they stand. Per worker a cache keeps, by a hash of a chunk, its bytes and
a boundary summary: whether it begins and ends inside a word, its code points, and where words end
within it. A hit counts only if the bytes are the same. The number of units of a text is the sum over
its chunks, plus one for each chunk that closes the word its predecessor left open, plus the last
unit; a cut after k units is looked up in the running sums and then within one chunk.

Whether, where and in which order a document is cut depends on its id alone: h1 to h4 are the first
four groups of eight hex digits of the sha256 of ``seed:doc_id``. The forms are ``plain`` (the text),
``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle) and ``spm`` (suffix, prefix, middle).

Defined cases: a null text counts as empty; an empty text, and one that holds a marker itself, stays
plain; a null doc_id draws like the empty string; rows with an equal doc_id are drawn alike, each
with its own text; a text of white space only is one unit; chunks are at most ``LONGEST`` bytes, so
that memory grows with the longest text only by the text itself; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.llm.common import mix64, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
# Bytes under the rolling hash; chunks of 2^CHUNK_BITS bytes on average; longest chunk.
WINDOW, CHUNK_BITS, LONGEST = 16, 9, 8192
# Bytes hashed at once, text bytes of a slice, chunk bytes that a cache generation may keep.
PIECE, SLICE, KEPT = 1 << 20, 2 << 20, 16 << 20

_SYMBOL = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_BASE = 0x01000193
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def rolling_hits(data: np.ndarray) -> np.ndarray:
    """Positions of the bytes at which the hash of the ``WINDOW`` bytes up to there hits."""
    found = []
    for at in range(0, len(data), PIECE):
        low = max(0, at - WINDOW + 1)
        h = _SYMBOL[data[low : at + PIECE]]
        step = 1
        while step < WINDOW:
            # Hashes of runs of 2 * step bytes from those of step bytes.
            h[step:] = h[step:] + h[:-step] * np.uint32(pow(_BASE, step, 1 << 32))
            step *= 2
        hits = np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + low
        found.append(hits[hits >= at])
    return np.concatenate([*found, np.empty(0, np.int64)])


def chunk_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of the chunks of texts laid end to end; ``ends`` are those of the (non-empty) texts.

    A hit within the first bytes of a text would depend on the text before and does not count.
    """
    hits = rolling_hits(data)
    begins = np.concatenate([[0], ends])
    own = begins[np.searchsorted(ends, hits, "right")]
    cuts = np.unique(np.concatenate([hits[hits - own >= WINDOW - 1] + 1, ends]))
    starts = np.concatenate([[0], cuts[:-1]])
    parts = -(-(cuts - starts) // LONGEST)
    first = np.repeat(starts, parts)
    number = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.minimum(first + (number + 1) * LONGEST, np.repeat(cuts, parts))


def summaries(chunks: list[bytes]) -> list[tuple]:
    """(bytes, begins in a word, ends in a word, code points, ends of words inside) of each chunk.

    A word that reaches the end of the chunk may go on and does not end inside.
    """
    if not chunks:
        return []
    data = np.frombuffer(b"".join(chunks), np.uint8)
    ends = np.cumsum([len(c) for c in chunks])
    starts = np.concatenate([[0], ends[:-1]])
    inside = ~_IS_SPACE[data]
    closes = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    chars = np.add.reduceat((data & 0xC0) != 0x80, starts)
    low, high = np.searchsorted(closes, starts, "right"), np.searchsorted(closes, ends, "left")
    return [
        (c, bool(inside[s]), bool(inside[e - 1]), int(k), (closes[a:b] - s).astype(np.int32))
        for c, s, e, k, a, b in zip(chunks, starts, ends, chars, low, high)
    ]


class ChunkMemo:
    """Summaries by content, in two generations so that it forgets what was not met for long."""

    def __init__(self, limit: int = KEPT):
        self.limit, self.size, self.new, self.old = limit, 0, {}, {}
        self.hits = self.misses = 0

    def of(self, chunks: list[bytes]) -> list[tuple]:
        keys = [xxhash.xxh3_64_intdigest(c) for c in chunks]
        out, missed = [None] * len(chunks), {}
        for i, (key, chunk) in enumerate(zip(keys, chunks)):
            known = self.new.get(key) or self.old.get(key)
            if known is not None and known[0] == chunk:
                out[i] = known
                if key not in self.new:
                    self._keep(key, known)
            else:
                missed.setdefault(chunk, []).append(i)
        for known, places in zip(summaries(list(missed)), missed.values()):
            self._keep(keys[places[0]], known)
            for i in places:
                out[i] = known
        self.hits += len(chunks) - len(missed)
        self.misses += len(missed)
        return out

    def _keep(self, key: int, known: tuple) -> None:
        self.new[key] = known
        self.size += len(known[0]) + 4 * len(known[4]) + 200
        if self.size > self.limit:
            self.old, self.new, self.size = self.new, {}, 0


class UnitCounts:
    """Unit counts of a slice of texts and the places of cuts, from chunk summaries."""

    def __init__(self, data: bytes, offsets: np.ndarray, memo: ChunkMemo):
        self.data, self.offsets = data, offsets
        size = np.diff(offsets)
        ends = chunk_ends(np.frombuffer(data, np.uint8), offsets[1:][size > 0])
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.known = memo.of([data[s:e] for s, e in zip(self.starts, ends)])
        begins = np.array([k[1] for k in self.known], bool)
        open_end = np.array([k[2] for k in self.known], bool)
        first = np.isin(self.starts, offsets[:-1][size > 0])
        # The word left open by the chunk before ends where this chunk begins.
        self.closing = np.concatenate([[False], open_end[:-1]])[: len(begins)] & ~begins & ~first
        done = self.closing + np.array([len(k[4]) for k in self.known], np.int64)
        self.upto = np.concatenate([[0], np.cumsum(done)])
        self.chars = np.concatenate([[0], np.cumsum([k[3] for k in self.known])]).astype(np.int64)
        self.low = np.searchsorted(self.starts, offsets[:-1], "left")
        self.high = np.searchsorted(self.starts, offsets[1:], "left")
        self.units = np.where(size > 0, self.upto[self.high] - self.upto[self.low] + 1, 0)
        self.n_chars = self.chars[self.high] - self.chars[self.low]

    def cut(self, text: int, after: int) -> tuple[int, int]:
        """(byte, code point) of the text at which its first ``after`` units end."""
        if after == 0:
            return 0, 0
        if after == self.units[text]:
            return int(self.offsets[text + 1] - self.offsets[text]), int(self.n_chars[text])
        low = self.low[text]
        goal = self.upto[low] + after
        chunk = int(np.searchsorted(self.upto, goal, "left")) - 1
        place = int(goal - self.upto[chunk]) - 1 - int(self.closing[chunk])
        content, ends = self.known[chunk][0], self.known[chunk][4]
        inside = 0 if place < 0 else int(ends[place])
        head = np.frombuffer(content, np.uint8, inside)
        chars = self.chars[chunk] - self.chars[low] + np.count_nonzero((head & 0xC0) != 0x80)
        return int(self.starts[chunk] - self.offsets[text]) + inside, int(chars)


def _text_bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = texts.buffers()[2]
    return (values[int(offsets[0]) : int(offsets[-1])].to_pybytes() if values else b""), offsets - offsets[0]


def _transform(fim_percent: int, spm_percent: int):
    marks = [PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()]

    def run(batches):
        memo = ChunkMemo()
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                yield one(batch, memo)

    def one(batch, memo):
        texts = batch.column("text")
        data, offsets = _text_bytes(texts)
        counts = UnitCounts(data, offsets, memo)
        h1, h2, h3, h4 = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
        plain = (h3 % 100 >= fim_percent) | (counts.units == 0)
        for mark in (PREFIX, SUFFIX, MIDDLE):
            plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        forms = np.where(plain, "plain", np.where(h4 % 100 < spm_percent, "spm", "psm"))
        a, b = h1 % (counts.units + 1), h2 % (counts.units + 1)
        outputs, heads, middles = [], [], []
        for i, form in enumerate(forms):
            text = data[offsets[i] : offsets[i + 1]]
            if form == "plain":
                outputs.append(text)
                heads.append(None)
                middles.append(None)
                continue
            (x, head), (y, upto) = counts.cut(i, min(a[i], b[i])), counts.cut(i, max(a[i], b[i]))
            prefix, middle, suffix = text[:x], text[x:y], text[y:]
            order = [marks[1], suffix, marks[0], prefix] if form == "spm" else [marks[0], prefix, marks[1], suffix]
            outputs.append(b"".join([*order, marks[2], middle]))
            heads.append(head)
            middles.append(upto - head)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(counts.units, pa.int64()), pa.array(forms.tolist(), pa.string()),
                pa.array(heads, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    return run


def fim_documents(
    docs: DataFrame, *, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        *[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)],
    )
    return drawn.mapInArrow(
        _transform(fim_percent, spm_percent),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; it holds no marker, so the markers found are the form's own."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    # Where prefix, middle and suffix stand among the parts.
    places = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    out = F.when(form == "plain", output)
    for name, own in places.items():
        out = out.when(form == name, F.concat(*[F.get(parts, F.lit(i)) for i in own]))
    return out
