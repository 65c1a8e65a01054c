"""Trigram language model in Elias-Fano tries, and the scores of all documents under it.

Words: A-Z lower-cased runs of other than white space, then one end token per text. Counts come
from the training documents. p1 is the base estimate (c + 0.1) / (N + 0.1 (V + 1)); p2 and p3 are
interpolated with absolute discounting: p(w | h) = max(c(hw) - D, 0) / c(h) + D T(h) / c(h) p(w | h'),
where T(h) is the number of distinct words after h and h' is h without its first word.

The model is spread over shards by the middle word of a trigram, so a shard holds all that its
trigrams need: the words after the middle word, and for each first word the words after both. A very
frequent middle word is spread by its first word as well. The pairs of such a word and the next are
counted over all blocks first, and a block sends p2 along with its trigrams, so p2 is that of the
whole corpus in every shard. Within a shard the levels are Elias-Fano sequences in a memory-mapped
file: words after a context are numbered relative to the shorter context's successors, which the
context's own successors are a subset of; the pointers to successors are monotone; probabilities are
quantised in logarithm, rounded down so that they never add up to more than one. A lookup is a
search for the successor of a key in a monotone sequence.

Texts are read once, into blocks of word codes. Blocks ask the vocabulary shards for the counts and
numbers of their distinct words, then send each document's distinct trigrams to the model shards,
which answer with sums per document. All of this is packed arrays, a few rows per block and shard;
the number of shards grows with the corpus, so the work of one does not.

Defined cases: a null or empty text is the end token alone; repeated rows are scored each, and
trained on each; without training documents every probability is that of an unknown word; a null
doc_id counts as the text "null" when documents are held out, and comes back as null; an empty
table gives no rows; other columns are not looked at. doc_id is an integer.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.llm.common import hash_words, mix64, pack, runs, slices, unpack, words_of
from emberfold.session import cut_lineage

DISCOUNT = 0.75
BLOCK_BYTES, WORDS_PER_SHARD, TRIGRAMS_PER_SHARD = 8 << 20, 1_000_000, 1_500_000
# Steps per factor of ten of stored probabilities, and per factor of two of shipped counts.
LOG_STEPS, COUNT_STEPS = 2048, 8
# A middle word with more than this share of a shard's trigrams is spread by its first word.
HOT_SHARE = 0.125
NO_ID = np.iinfo(np.int64).min


class EliasFano:
    """A strictly rising sequence as low bits, in whole bytes, and a unary bit vector of high bits."""

    def __init__(self, low: np.ndarray, bits: np.ndarray, shift: int, size: int):
        self.low, self.bits, self.shift, self.size = np.asarray(low), bits, shift, size
        # Select directory: the zero that ends each run of equal high parts, less the zeros before.
        zeros = np.flatnonzero(np.unpackbits(bits, bitorder="little") == 0)
        self.ends = (zeros - np.arange(len(zeros))).astype(np.int32 if len(zeros) < 1 << 30 else np.int64)

    @staticmethod
    def encode(values: np.ndarray) -> tuple[list[np.ndarray], tuple[int, int]]:
        """Arrays and shape of the sequence of ``values``, sorted non-negative integers."""
        values = values.astype(np.int64)
        top, shift = (int(values[-1]) if len(values) else 0), 0
        while shift < 56 and (top >> shift) > 4 * max(len(values), 1):
            shift += 8
        kind = [np.uint8, np.uint8, np.uint16, np.uint32, np.uint32, np.int64, np.int64, np.int64][shift // 8]
        low = (values & ((1 << shift) - 1)).astype(kind) if shift else np.empty(0, kind)
        high = values >> shift
        bits = np.zeros(len(values) + (top >> shift) + 1, np.uint8)
        bits[high + np.arange(len(values))] = 1
        return [low, np.packbits(bits, bitorder="little")], (shift, len(values))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or -1: the first element not below the key, if it is the key."""
        if not self.size:
            return np.full(len(keys), -1)
        high = keys >> self.shift
        beyond = high >= len(self.ends)
        high = np.where(beyond, 0, high)
        left = np.where(high > 0, self.ends[high - 1], 0).astype(np.int64)
        end = np.minimum(self.ends[high].astype(np.int64), self.size)
        if not self.shift:
            return np.where((left < end) & ~beyond, left, -1)
        want, right = keys & ((1 << self.shift) - 1), end
        rows = np.flatnonzero(left < right)
        while len(rows):
            middle = (left[rows] + right[rows]) >> 1
            less = self.low[middle] < want[rows]
            left[rows] = np.where(less, middle + 1, left[rows])
            right = right.copy() if right is end else right
            right[rows] = np.where(less, right[rows], middle)
            rows = rows[left[rows] < right[rows]]
        found = (left < end) & (self.low[np.minimum(left, self.size - 1)] == want) & ~beyond
        return np.where(found, left, -1)


def _log_code(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(-np.log10(np.maximum(p, 1e-300)) * LOG_STEPS), 65535).astype(np.uint16)


def _log_of(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * (-1.0 / LOG_STEPS)


class TrigramTrie:
    """Three levels: middle words; words after each; first words and, for each, words after both.

    Keys of the upper levels are (middle word's place, word number); ``width`` bits hold a number.
    """

    def __init__(self, arrays: list[np.ndarray], shapes: list[tuple[int, int]], width: int, widest: int):
        self.pairs, self.contexts, self.triples = (
            EliasFano(*arrays[2 * i : 2 * i + 2], *shapes[i]) for i in range(3)
        )
        self.middles, self.starts, self.after_mass, self.pair_log, self.context_mass, self.log = map(np.asarray, arrays[6:])
        self.width, self.widest = width, widest

    @staticmethod
    def build(first, middle, last, count, base, given=None) -> tuple[list[np.ndarray], list[tuple[int, int]], int, int]:
        """Levels from training trigrams of word numbers; ``base`` is p1 of each last word.

        ``given`` holds the codes of p2 where trigrams elsewhere count for it too, 0 where not.
        """
        middles = np.unique(middle)
        width = int(max(first.max(initial=0), last.max(initial=0))).bit_length() + 1
        place = np.searchsorted(middles, middle)

        def tally(keys, weights):
            order = np.argsort(keys)
            at, length = runs(keys[order])
            total = np.add.reduceat(weights[order], at) if len(at) else np.empty(0, np.int64)
            own = np.empty(len(keys), np.int64)
            own[order] = np.repeat(np.arange(len(at)), length)
            return keys[order][at], total, order[at], own

        pair_key, pair_count, sample, pair = tally(place << width | last, count)
        mid = pair_key >> width
        starts = np.searchsorted(mid, np.arange(len(middles) + 1))
        kinds = np.diff(starts)
        after = np.bincount(mid, weights=pair_count, minlength=len(middles))
        mass = DISCOUNT * kinds / np.maximum(after, 1)
        p2 = (pair_count - DISCOUNT) / after[mid] + mass[mid] * base[sample]
        if given is not None:
            p2 = np.where(given[sample] > 0, 10.0 ** _log_of(given[sample]), p2)
        context_key, seen, _, context = tally(place << width | first, count)
        # A word after a context is numbered among the words after the middle word.
        widest = int(kinds.max(initial=0))
        triple_key, triple_count, sample, _ = tally(context * widest + pair - starts[place], count)
        own = triple_key // max(widest, 1)
        context_mass = DISCOUNT * np.bincount(own, minlength=len(context_key)) / np.maximum(seen, 1)
        p3 = (triple_count - DISCOUNT) / seen[own] + context_mass[own] * p2[pair[sample]]
        levels = [EliasFano.encode(k) for k in (pair_key, context_key, triple_key)]
        arrays = [part for level, _ in levels for part in level]
        arrays += [middles, starts, _log_code(mass), _log_code(p2), _log_code(context_mass), _log_code(p3)]
        return arrays, [shape for _, shape in levels], width, widest

    @classmethod
    def mapped(cls, arrays: list[np.ndarray], *shape) -> TrigramTrie:
        """The levels in a memory-mapped file, which is gone when the trie is."""
        with tempfile.TemporaryFile() as file:
            places = []
            for array in arrays:
                file.write(b"\0" * (-file.tell() % 8))
                places.append((file.tell(), len(array), array.dtype))
                file.write(np.ascontiguousarray(array).tobytes())
            file.write(b"\0" * 8)
            file.flush()
            data = np.memmap(file, np.uint8, "r")
        return cls([data[at : at + n * kind.itemsize].view(kind) for at, n, kind in places], *shape)

    def score(self, first, middle, last, base_log, given=None) -> np.ndarray:
        """log10 p(last | first middle); ``base_log`` is log10 p1 of the last words, ``given`` as in ``build``."""
        given = np.zeros(len(first), np.uint16) if given is None else given
        if not self.pairs.size:
            return np.where(given > 0, _log_of(given), base_log)
        place = np.minimum(np.searchsorted(self.middles, middle), len(self.middles) - 1)
        known = self.middles[place] == middle
        # Numbers too wide for the keys belong to words that no training trigram has.
        top = 1 << self.width
        pair = np.where(known & (last < top), self.pairs.find(place << self.width | np.minimum(last, top - 1)), -1)
        context = np.where(known & (first < top), self.contexts.find(place << self.width | np.minimum(first, top - 1)), -1)
        has, deep = pair >= 0, context >= 0
        out = base_log + np.where(known, _log_of(self.after_mass[place]), 0)
        out[has] = _log_of(self.pair_log[pair[has]])
        out = np.where(given > 0, _log_of(given), out)
        both = np.flatnonzero(has & deep)
        rank = pair[both] - self.starts[place[both]]
        triple = self.triples.find(context[both] * self.widest + rank)
        out[deep] += _log_of(self.context_mass[context[deep]])
        whole = triple >= 0
        out[both[whole]] = _log_of(self.log[triple[whole]])
        return out


BLOCK = ["block", "docs", "held", "sizes", "codes", "words", "often", "order"]


def _steps(rising: np.ndarray) -> np.ndarray:
    """First value and differences of a sorted array, which pack better; a running sum undoes it."""
    return np.diff(rising, prepend=rising.dtype.type(0))


def _blocks(batches):
    """Documents of a slice as codes of its words, the end token being the word without letters."""
    part, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text", BLOCK_BYTES):
            counts, codes, words = words_of(batch.column("text"))
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(np.uint8)
            sizes = counts + 1
            ends = np.cumsum(sizes) - 1
            own = np.full(int(sizes.sum()), len(words), np.int64)
            inner = np.ones(len(own), bool)
            inner[ends] = False
            own[inner] = codes
            often = np.bincount(own, minlength=len(words) + 1)
            by_count = np.argsort(-often, kind="stable")
            place = np.empty(len(by_count), np.int64)
            place[by_count] = np.arange(len(by_count))
            own = place[own]
            hashes = hash_words([*words, ""])[by_count]
            train = np.repeat(held == 0, sizes)
            order = np.argsort(hashes)
            often = np.bincount(own[train], minlength=len(hashes)).astype(np.int64)
            doc = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number]),
                    *[pa.array([pack(x)]) for x in (
                        doc.astype(np.int64), held, sizes.astype(np.int64), own.astype(np.uint32),
                        _steps(hashes[order]), often[order], order.astype(np.uint32),
                    )],
                ],
                names=BLOCK,
            )
            number += 1


def _asked(shards: int):
    """The distinct words of each block, in the order of their hashes, cut by vocabulary shard."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, often = np.cumsum(unpack(row["words"], np.uint64), dtype=np.uint64), unpack(row["often"], np.int64)
                cuts = np.searchsorted(words, _cut_points(shards))
                edges = [0, *cuts, len(words)]
                rows = [(s, row["block"], pack(_steps(words[a:b])), pack(often[a:b])) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["shard", "block", "words", "often"],
                )

    return run


def _cut_points(shards: int) -> np.ndarray:
    return np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)


def _counted(shards: int, often_above: float):
    """Corpus counts and numbers of the words that blocks asked for; frequent words get small numbers.

    The words that count more than ``often_above`` are listed in the shard's first row.
    """

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        asked = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in table.column("words").to_pylist()]
        often = np.concatenate([unpack(x, np.int64) for x in table.column("often").to_pylist()])
        words, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, weights=often, minlength=len(words)).astype(np.int64)
        number = np.empty(len(words), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(words)) * shards + shard + 1
        ends = np.cumsum([len(a) for a in asked])[:-1]
        answers = [(pack(total[p]), pack(number[p])) for p in np.split(place, ends)]
        rows = len(answers)
        hot = np.flatnonzero(total > often_above)
        listed = {n: pa.array([pack(x[hot])] + [None] * (rows - 1), pa.binary()) for n, x in zip(HOT, (words, number, total))}
        return pa.table({
            "shard": table.column("shard"), "block": table.column("block"),
            "totals": pa.array([a[0] for a in answers], pa.binary()), "numbers": pa.array([a[1] for a in answers], pa.binary()),
            "tokens": pa.array([int(total.sum())] + [0] * (rows - 1), pa.int64()),
            "kinds": pa.array([int((total > 0).sum())] + [0] * (rows - 1), pa.int64()),
            **listed,
        })

    return run


HOT = ["hot_words", "hot_numbers", "hot_totals"]


def _hot_of(answers: DataFrame) -> list[np.ndarray]:
    """Hashes, numbers and counts of the frequent words, by number; a fixed share of the corpus each, so few."""
    rows = answers.filter("hot_words IS NOT NULL").select(*HOT).collect()
    parts = [np.concatenate([np.empty(0, k), *(unpack(r[n], k) for r in rows)]) for n, k in zip(HOT, (np.uint64, np.int64, np.int64))]
    order = np.argsort(parts[1])
    return [x[order] for x in parts]


def _pairs_of(rank: np.ndarray, place: np.ndarray, codes: np.ndarray, sizes: np.ndarray, edges: np.ndarray, hot: int):
    """Spots of a block after a frequent word, and their (shard, frequent word, last word) as one number.

    ``rank`` is a code's place among the frequent words or -1, ``place`` its place among the block's
    hashes, ``edges`` the ends of the pair shards among these.
    """
    before = np.roll(rank[codes], 1)
    before[np.cumsum(sizes) - sizes] = -1
    spots = np.flatnonzero(before >= 0)
    last = place[codes[spots]]
    return spots, (np.searchsorted(edges, last, "right") * hot + before[spots]) * len(rank) + last


def _inverse(order: np.ndarray) -> np.ndarray:
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place


def _key_shift(hot: int) -> np.uint64:
    """Bits of the last word's hash in a pair's key; the others hold the frequent word's place."""
    return np.uint64(64 - max(1, hot.bit_length()))


def _pairs_asked(hot_words: np.ndarray, shards: int):
    """Distinct pairs of a frequent word and the next in each block, with their training counts, by pair shard."""

    def run(batches):
        kinds, shift = len(hot_words), _key_shift(len(hot_words))
        for batch in batches:
            for row in batch.to_pylist():
                words, order = np.cumsum(unpack(row["words"], np.uint64), dtype=np.uint64), unpack(row["order"], np.uint32)
                codes, sizes = unpack(row["codes"], np.uint32), unpack(row["sizes"], np.int64)
                at = np.minimum(np.searchsorted(words, hot_words), len(words) - 1)
                found = np.flatnonzero(words[at] == hot_words)
                rank = np.full(len(words), -1)
                rank[order[at[found]]] = found
                edges = np.append(np.searchsorted(words, _cut_points(shards)), len(words))
                spots, pair = _pairs_of(rank, _inverse(order), codes, sizes, edges, kinds)
                train = np.repeat(unpack(row["held"], np.uint8) == 0, sizes)[spots]
                pair, own = np.unique(pair, return_inverse=True)
                often = np.bincount(own, weights=train, minlength=len(pair)).astype(np.int64)
                shard, last = pair // len(words) // kinds, pair % len(words)
                key = (pair // len(words) % kinds).astype(np.uint64) << shift | words[last] >> (np.uint64(64) - shift)
                for a, n in zip(*runs(shard)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(shard[a])], pa.int32()), pa.array([row["block"]]), pa.array([int(edges[shard[a]])]),
                            pa.array([pack(_steps(key[a : a + n]))]), pa.array([pack(often[a : a + n])]),
                        ],
                        names=["shard", "block", "upto", "keys", "often"],
                    )

    return run


def _pairs_counted(hot: int):
    """Corpus counts of the pairs that blocks asked for, and how many words follow each frequent word."""

    def run(table: pa.Table) -> pa.Table:
        asked = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in table.column("keys").to_pylist()]
        often = np.concatenate([unpack(x, np.int64) for x in table.column("often").to_pylist()])
        keys, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, weights=often, minlength=len(keys)).astype(np.int64)
        after = np.bincount((keys[total > 0] >> _key_shift(hot)).astype(np.int64), minlength=hot)
        ends = np.cumsum([len(a) for a in asked])[:-1]
        return pa.table({
            "shard": table.column("shard"), "block": table.column("block"), "upto": table.column("upto"),
            "totals": pa.array([pack(total[p]) for p in np.split(place, ends)], pa.binary()),
            "after": pa.array([pack(after)] + [None] * (table.num_rows - 1), pa.binary()),
        })

    return run


def _pair_codes(row: dict, answers: pa.Table, number, codes, sizes, base, hot) -> np.ndarray:
    """Per spot of a block the code of p2 in the whole corpus, where the middle word is spread; else 0."""
    numbers, totals, after = hot
    out = np.zeros(len(codes), np.uint16)
    if not answers.num_rows:
        return out
    answers = answers.sort_by("shard")
    count = np.concatenate([unpack(x, np.int64) for x in answers.column("totals").to_pylist()])
    order = unpack(row["order"], np.uint32)
    rank = np.minimum(np.searchsorted(numbers, number), len(numbers) - 1)
    rank = np.where(numbers[rank] == number, rank, -1)
    spots, pair = _pairs_of(rank, _inverse(order), codes, sizes, answers.column("upto").to_numpy(), len(numbers))
    pair, own = np.unique(pair, return_inverse=True)
    of, p1 = pair // len(order) % len(numbers), 10.0 ** base[order[pair % len(order)]]
    p2 = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * after[of] * p1) / totals[of]
    out[spots] = np.maximum(_log_code(p2), 1)[own]
    return out


def _pair_numbers(middle: np.ndarray, last: np.ndarray) -> np.ndarray:
    return middle << 40 | last


TRIGRAM = ["first", "middle", "last", "code", "times", "doc", "pair"]
SENT = ["shard", "block", *TRIGRAM, "held", "docs", "sizes", "known", "base"]


def _count_code(count: np.ndarray) -> np.ndarray:
    steps = np.floor(np.log2(np.maximum(count, 1)) * COUNT_STEPS + 1e-9) + 1
    return np.where(count > 0, np.minimum(steps, 255), 0).astype(np.uint8)


def _base_of_codes(tokens: int, kinds: int) -> np.ndarray:
    """log10 p1 of each count code."""
    counts = np.where(np.arange(256) > 0, 2.0 ** ((np.arange(256) - 1) / COUNT_STEPS), 0.0)
    return np.log10((counts + 0.1) / (tokens + 0.1 * (kinds + 1)))


def _sent(tokens: int, kinds: int, shards: int, hot: tuple[np.ndarray, ...]):
    """Trigrams of a block by model shard, and what the block knows of its documents itself.

    ``hot`` are the numbers of the words to spread, their counts, and how many words follow each.
    """

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        of_pairs = pc.is_valid(answers.column("upto"))
        pairs, answers = answers.filter(of_pairs), answers.filter(pc.invert(of_pairs))
        order = np.argsort(answers.column("shard").to_numpy())
        totals, numbers = (
            np.concatenate([unpack(answers.column(c)[int(i)].as_py(), np.int64) for i in order]) for c in ("totals", "numbers")
        )
        place = unpack(row["order"], np.uint32)
        total, number = np.empty_like(totals), np.empty_like(numbers)
        total[place], number[place] = totals, numbers
        codes, sizes = unpack(row["codes"], np.uint32), unpack(row["sizes"], np.int64)
        starts = np.cumsum(sizes) - sizes
        logs = np.log10((total + 0.1) / (tokens + 0.1 * (kinds + 1)))
        base = np.add.reduceat(logs[codes], starts)
        known = np.add.reduceat((total > 0).astype(np.int64)[codes], starts)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        last = number[codes]
        at = np.arange(len(codes)) - np.repeat(starts, sizes)
        middle, first = np.where(at >= 1, np.roll(last, 1), 0), np.where(at >= 2, np.roll(last, 2), 0)
        pair = _pair_codes(row, pairs, number, codes, sizes, logs, hot)
        # The first words of documents have one context, which lies in one shard.
        spread = (pair > 0) | (at < 1)
        # Equal trigrams of a document travel once.
        key = mix64(mix64(mix64(mix64(first) + middle.astype(np.uint64)) + last.astype(np.uint64)) + doc.astype(np.uint64))
        order = np.argsort(key)
        at_key, lengths = runs(key[order])
        index = order[at_key]
        times = np.empty(len(codes), np.int32)
        times[index] = lengths
        spread = np.where(spread, (mix64(first) % np.uint64(shards)).astype(np.int64), 0)
        shard = ((mix64(middle) % np.uint64(shards)).astype(np.int64) + spread) % shards
        index = np.sort(shard[index] << 36 | index) & ((1 << 36) - 1)
        del key, order, at_key, spread, at
        code = _count_code(total)
        cuts, lengths = runs(shard[index])
        out = {n: [] for n in SENT}
        for c, n in zip(cuts, lengths):
            i = index[c : c + n]
            mine = doc[i]
            # Count codes once for each distinct last word, in the order of the words' numbers.
            _, some = np.unique(last[i], return_index=True)
            # Likewise p2 of spread middle words, once for each distinct pair.
            with_pair = i[pair[i] > 0]
            _, few = np.unique(_pair_numbers(middle[with_pair], last[with_pair]), return_index=True)
            values = (
                first[i], middle[i], last[i], code[codes[i[some]]], times[i], mine.astype(np.int32), pair[with_pair[few]],
            )
            for name, value in zip(TRIGRAM, values):
                out[name].append(pack(value))
            out["shard"].append(int(shard[i[0]]))
        rows = len(cuts)
        out["held"] = [row["held"]] * rows + [row["held"]]
        for name in TRIGRAM:
            out[name].append(None)
        out["shard"].append(row["block"] % shards)
        for name, value in (("docs", row["docs"]), ("sizes", row["sizes"]), ("known", pack(known)), ("base", pack(base))):
            out[name] = [None] * rows + [value]
        out["block"] = [row["block"]] * (rows + 1)
        return pa.table({n: pa.array(out[n], SENT_TYPES.get(n, pa.binary())) for n in SENT})

    return run


SENT_TYPES = {"shard": pa.int32(), "block": pa.int64()}


def _scored(tokens: int, kinds: int, hot_numbers: np.ndarray):
    """One model shard: build its trie from the training trigrams, answer with sums per document."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        out = [{"block": r["block"], **{n: r[n] for n in ("held", "docs", "sizes", "known", "base")}} for r in rows if r["docs"] is not None]
        rows = [r for r in rows if r["docs"] is None]
        if rows:
            base = _base_of_codes(tokens, kinds)
            kinds_of = {"first": np.int64, "middle": np.int64, "last": np.int64, "code": np.uint8, "times": np.int32, "doc": np.int32, "pair": np.uint16}
            parts = {n: [unpack(r.pop(n), k) for r in rows] for n, k in kinds_of.items()}
            parts["code"] = [c[np.unique(x, return_inverse=True)[1]] for c, x in zip(parts["code"], parts["last"])]
            given = np.concatenate([_given(hot_numbers, *x) for x in zip(parts["middle"], parts["last"], parts.pop("pair"))])
            held = np.concatenate([unpack(r["held"], np.uint8)[d] for r, d in zip(rows, parts["doc"])])
            sizes = [len(x) for x in parts["doc"]]
            doc = np.concatenate(parts.pop("doc"))
            # Neighbours in this order share their words, which keeps lookups close together.
            order = np.argsort(np.concatenate(parts["middle"]))
            first, middle, last, code, times = (np.concatenate(parts.pop(n))[order] for n in TRIGRAM[:5])
            given, train = given[order], held[order] == 0
            trie = TrigramTrie.mapped(*TrigramTrie.build(
                first[train], middle[train], last[train], times[train].astype(np.int64), 10.0 ** base[code[train]],
                given[train],
            ))
            logs = np.empty(len(first))
            for at in range(0, len(first), 1 << 18):
                s = slice(at, at + (1 << 18))
                logs[order[s]] = trie.score(first[s], middle[s], last[s], base[code[s]], given[s]) * times[s]
            ends = np.cumsum(sizes)[:-1]
            for r, own, value in zip(rows, np.split(doc, ends), np.split(logs, ends)):
                used, place = np.unique(own, return_inverse=True)
                out.append({"block": r["block"], "doc": pack(used), "sum": pack(np.bincount(place, weights=value).astype(np.float32))})
        return pa.Table.from_pylist(out, schema=ANSWER)

    return run


def _given(hot_numbers: np.ndarray, middle: np.ndarray, last: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Per trigram the code of p2 that came along, or 0."""
    out = np.zeros(len(middle), np.uint16)
    if len(codes):
        spots = np.flatnonzero(np.isin(middle, hot_numbers))
        out[spots] = codes[np.unique(_pair_numbers(middle[spots], last[spots]), return_inverse=True)[1]]
    return out


ANSWER = pa.schema([("block", pa.int64())] + [(n, pa.binary()) for n in ("doc", "sum", "held", "docs", "sizes", "known", "base")])


def _gathered(tokens: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["docs"] is not None)
        docs, sizes = unpack(own["docs"], np.int64), unpack(own["sizes"], np.int64)
        score = np.zeros(len(docs))
        # In a fixed order, so that a repeated task gives the same sums.
        for r in sorted((r for r in rows if r["docs"] is None), key=lambda r: (r["doc"], r["sum"])):
            np.add.at(score, unpack(r["doc"], np.int32), unpack(r["sum"], np.float32).astype(np.float64))
        return pa.table({
            "doc_id": pa.array(docs, mask=docs == NO_ID), "held_out": pa.array(unpack(own["held"], np.uint8) > 0),
            "n_tokens": sizes, "n_known": unpack(own["known"], np.int64), "train_tokens": np.full(len(docs), tokens),
            "base_score": unpack(own["base"], np.float64), "score": score,
        })

    return run


def held_out_by_id(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 10 == 0


def score_documents(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held = held_out_by_id(F.col("doc_id")) if held_out is None else held_out
    kinds_of = "block long, docs binary, held binary, sizes binary, codes binary, words binary, often binary, `order` binary"
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held"))
    blocks = cut_lineage(named.mapInArrow(_blocks, kinds_of))
    # Shards in proportion to the corpus: by the bytes of the codes, about two for a token.
    size = blocks.agg(F.sum(F.octet_length("words")).alias("w"), F.sum(F.octet_length("codes")).alias("c")).collect()[0]
    vocabulary, shards = int((size["w"] or 0) // (8 * WORDS_PER_SHARD)) + 1, int((size["c"] or 0) // (2 * TRIGRAMS_PER_SHARD)) + 1
    answers = cut_lineage(
        blocks.select("block", "words", "often")
        .mapInArrow(_asked(vocabulary), "shard int, block long, words binary, often binary")
        .groupBy("shard").applyInArrow(
            _counted(vocabulary, HOT_SHARE * TRIGRAMS_PER_SHARD if shards > 1 else math.inf),
            "shard int, block long, totals binary, numbers binary, tokens long, kinds long, " + ", ".join(f"{n} binary" for n in HOT))
    )
    sums = answers.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()[0]
    tokens, kinds = int(sums["tokens"] or 0), int(sums["kinds"] or 0)
    hot_words, hot_numbers, hot_totals = _hot_of(answers)
    replies = answers.select("shard", "block", "totals", "numbers", F.lit(None).cast("long").alias("upto"))
    after = np.zeros(len(hot_words), np.int64)
    if len(hot_words):
        pairs = cut_lineage(
            blocks.select("block", "held", "sizes", "codes", "words", "order")
            .mapInArrow(_pairs_asked(hot_words, shards), "shard int, block long, upto long, keys binary, often binary")
            .groupBy("shard").applyInArrow(
                _pairs_counted(len(hot_words)), "shard int, block long, upto long, totals binary, after binary")
        )
        for r in pairs.filter("after IS NOT NULL").select("after").toLocalIterator():
            after += unpack(r["after"], np.int64)
        replies = replies.unionByName(
            pairs.select("shard", "block", "totals", F.lit(None).cast("binary").alias("numbers"), "upto"))
    hot = (hot_numbers, hot_totals, after)
    sent = (
        blocks.select("block", "docs", "held", "sizes", "codes", "order").groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(_sent(tokens, kinds, shards, hot), "shard int, block long, " + ", ".join(f"{n} binary" for n in SENT[2:]))
    )
    scored = sent.groupBy("shard").applyInArrow(
        _scored(tokens, kinds, hot_numbers), ", ".join(f"{f.name} {'long' if f.name == 'block' else 'binary'}" for f in ANSWER)
    )
    return scored.groupBy("block").applyInArrow(
        _gathered(tokens),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
