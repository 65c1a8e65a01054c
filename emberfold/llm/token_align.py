"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

A batch of texts is encoded by both tokenizers into two Arrow lists. Flattening gives the ids and,
by parent indices, their documents; the byte lengths of the ids, summed up within each document,
give the byte at which every token ends. The ends that both sides have are found by an Acero hash
join on the key (document, end); they cut the tokens into groups, and each pairs the two tokens that
end there. ``Table.group_by`` counts the pairs of each document; Spark merges these counts into
those of the corpus and brings them back to the documents.

Of two tokens that end at the same byte one's bytes are the end of the other's. So the pairs that can
occur number at most the bytes of both vocabularies plus their entries, whatever the corpus; that
bound is what allows the merged counts to be broadcast.

Defined cases: a text that is null, empty, or not given back by one of the tokenizers (for instance
with U+2581, which reads as a space) has no tokens, zero counts and an empty ``groups``; strings of
special tokens are plain text; every row counts, also repeated ones and those with a null doc_id; an
empty table gives no rows; other columns are not looked at. A text is held whole in its task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.common import cut, slices
from emberfold.llm.tokens import ChunkEncoder

# Text bytes of a slice; bytes of merged counts up to which they are broadcast, and of one of them.
SLICE, BROADCAST_BYTES, COUNT_BYTES = 4 << 20, 128 << 20, 64
# Document rows of a slice are packed above the bits of an end within a document.
END_BITS = 36


class PlainEncoder(ChunkEncoder):
    """Ids of a byte-level vocabulary to which the strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special, self.marks = {}, None


class PieceEncoder:
    """Ids of a piece model, encoding each distinct word of a slice once.

    Pieces hold spaces only at their front, so no merge reaches from a word over the space behind it
    and a text has the ids of its words, each with its space. The encoder sets a space before a word
    by itself. Texts with two spaces in a row are encoded whole.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.bytes = [self._bytes(i) for i in ids]
        self.apart = all("▁" not in self.model.id_to_piece(i).lstrip("▁") for i in ids)

    def _bytes(self, i: int) -> bytes:
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def _encoded(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Ids of each text, and whether they give back its bytes behind a space."""
        found = self.model.encode(texts, out_type=int, num_threads=1) if texts else []
        own = self.bytes
        same = [b"".join([own[i] for i in ids]) == b" " + t.encode() for ids, t in zip(found, texts)]
        return found, np.array(same, bool)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids per text, all ids in order, whether the ids give back the text)."""
        parts = pc.split_pattern(texts, " ")
        counts = np.diff(parts.offsets.to_numpy()).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        row = np.repeat(np.arange(len(counts)), counts)
        odd = np.unique(row[pc.equal(words, "").to_numpy(zero_copy_only=False)[code]]) if self.apart else np.arange(len(counts))
        keep = ~np.isin(row, odd)
        row, code = row[keep], code[keep]
        used, code = np.unique(code, return_inverse=True)
        whole = texts.take(pa.array(odd)).to_pylist()
        found, same = self._encoded(words.take(pa.array(used)).to_pylist() + whole)
        row = np.concatenate([row, odd])
        code = np.concatenate([code, len(used) + np.arange(len(odd))])
        order = np.argsort(row, kind="stable")
        row, code = row[order], code[order]
        size = np.array([len(f) for f in found], np.int64)
        flat = np.fromiter((i for f in found for i in f), np.int64, int(size.sum()))
        lengths = size[code]
        total = np.bincount(row, weights=lengths, minlength=len(counts)).astype(np.int64)
        shift = (np.cumsum(size) - size)[code] - (np.cumsum(lengths) - lengths)
        ids = flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]
        true = np.bincount(row, weights=~same[code], minlength=len(counts)) == 0
        return total, ids, true


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PlainEncoder(path_a), PieceEncoder(path_b)
        self.width_a = pa.array(self.a.width)
        self.width_b = pa.array([len(x) for x in self.b.bytes], pa.int64())
        self.n_a, self.n_b = len(self.width_a), len(self.width_b)
        numbers = [pa.array(range(n)).cast(pa.string()) for n in (self.n_a, self.n_b)]
        self.written = pa.concat_arrays(
            [pc.binary_join_element_wise(x, mark, "") for x, marks in zip(numbers, ([",", "|"], [",", ";", ""])) for mark in marks]
        )
        # Pairs of tokens of which one's bytes end the other's; a byte can also be a piece of its own.
        self.most_pairs = sum(pc.sum(w).as_py() + len(w) for w in (self.width_a, self.width_b))

    def rows(self, texts: pa.Array) -> dict:
        """Columns of the alignment of each text."""
        texts = pc.fill_null(texts, "")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        count_a, ids_a = self.a.encode(pc.binary_join_element_wise(" ", texts, ""))
        count_b, ids_b, true = self.b.encode(texts)
        row_a, row_b = (np.repeat(np.arange(len(texts)), c) for c in (count_a, count_b))
        true &= (size > 1) & (np.bincount(row_a, weights=self.a.width[ids_a], minlength=len(texts)) == size)
        side_a = self._side(np.where(true, count_a, 0), ids_a[true[row_a]], self.width_a, "a")
        side_b = self._side(np.where(true, count_b, 0), ids_b[true[row_b]], self.width_b, "b")
        met = side_a.join(side_b, "key", join_type="inner", use_threads=False).sort_by("a_at")
        met = met.append_column("row", pc.shift_right(met["key"], END_BITS))
        met = met.append_column("pair", pc.add(pc.multiply(met["a"], self.n_b), met["b"]))
        n_links = np.bincount(met["row"].to_numpy(), minlength=len(texts))
        tally = met.group_by(["row", "pair"], use_threads=False).aggregate([("a_at", "count")]).sort_by("row")
        edges = np.concatenate([[0], np.cumsum(np.bincount(tally["row"].to_numpy(), minlength=len(texts)))])
        offsets = pa.array(edges, pa.int32())
        return {
            "n_a": pa.array(np.where(true, count_a, 0)), "n_b": pa.array(np.where(true, count_b, 0)),
            "n_groups": pa.array(n_links, pa.int64()), "n_links": pa.array(n_links, pa.int64()),
            "groups": self._groups(side_a, side_b, met, np.where(true, count_a + count_b, 0)),
            "pairs": pa.ListArray.from_arrays(offsets, tally["pair"].combine_chunks()),
            "times": pa.ListArray.from_arrays(offsets, tally["a_at_count"].combine_chunks().cast(pa.int32())),
        }

    @staticmethod
    def _side(counts: np.ndarray, ids: np.ndarray, width: pa.Array, name: str) -> pa.Table:
        """(key, id, place) of every token, the key being its document and the byte it ends at."""
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
        lists = pa.LargeListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
        parent, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
        running = pc.cumulative_sum(width.take(flat))
        before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(offsets[:-1])
        ends = pc.subtract(running, before.take(parent))
        key = pc.add(pc.shift_left(parent.cast(pa.int64()), END_BITS), ends)
        return pa.table({"key": key, name: flat, f"{name}_at": pa.array(np.arange(len(flat)))})

    def _groups(self, side_a: pa.Table, side_b: pa.Table, met: pa.Table, counts: np.ndarray) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` for each text: the tokens of its groups in order."""
        last_a, last_b = met["a_at"].to_numpy(), met["b_at"].to_numpy()
        ids_a, ids_b = side_a["a"].to_numpy(), side_b["b"].to_numpy()
        ends_a, ends_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        ends_a[last_a], ends_b[last_b] = True, True
        # Tokens of the other side that stand before: those of earlier groups, and for b its group's a.
        before_a = np.concatenate([[0], last_b + 1])[np.cumsum(ends_a) - ends_a]
        before_b = (last_a + 1)[np.cumsum(ends_b) - ends_b]
        edges = np.concatenate([[0], np.cumsum(counts)])
        mark = np.zeros(len(ids_a) + len(ids_b), np.int64)
        at_b = np.arange(len(ids_b)) + before_b
        mark[np.arange(len(ids_a)) + before_a] = ids_a + self.n_a * ends_a
        mark[at_b] = 2 * self.n_a + ids_b + self.n_b * ends_b
        finals = edges[1:][counts > 0] - 1
        mark[finals] += self.n_b
        text = self.written.cast(pa.large_string()).take(pa.array(mark))
        if not len(mark):
            return pa.array([""] * len(counts), pa.large_string())
        upto = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(upto[edges].tobytes()), text.buffers()[2])


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per process and pair of files."""
    return Aligner(path_a, path_b)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every row of ``docs``.

    ``groups`` lists the ids of both sides group by group; ``pairs`` holds the distinct linked pairs,
    as a * (size of vocabulary b) + b, and ``times`` how often each occurs in the text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                columns = {"doc_id": batch.column("doc_id"), **aligner(path_a, path_b).rows(batch.column("text"))}
                columns["groups"] = columns["groups"].cast(pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {schema}")


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best) over all rows: how often a pair is linked, and the most of its b id."""
    counts = (
        aligned.select(F.inline(F.arrays_zip("pairs", "times")))
        .groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    )
    best = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("count").alias("best"))
    return counts.withColumn("b", F.col("pair") % n_b).join(best, "b").drop("b")


def link_report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    both = aligner(path_a, path_b)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = cut(
        align(docs, path_a, path_b).withColumn("groups_sha256", digest).drop("groups")
        .withColumn("row", F.monotonically_increasing_id())
    )
    counts = cut(pair_counts(rows, both.n_b))
    if both.most_pairs * COUNT_BYTES <= BROADCAST_BYTES:
        counts = F.broadcast(counts)
    sums = (
        rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("count") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
