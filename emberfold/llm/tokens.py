"""Token ids of whole texts through a public byte-level tokenizer, encoding each distinct chunk once.

The tokenizer's pattern never joins a word to what stands before its white space, so a text has the
same ids as its chunks, where a chunk is a run of other characters with the one white-space
character before it, and any further white space before that is a chunk of its own. Distinct chunks
of a slice of texts are encoded together, as one string.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

CHUNK = re.compile(r"\s+(?=\s\S)|\s?\S+|\s+")
# The pattern by which byte-level vocabularies of this kind cut texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = r"\s\x1c-\x1f\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Ids of texts, equal to those of ``tokenizers`` with the same file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        symbols, vocab = byte_symbols(), data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ranks = {bytes(symbols[c] for c in word): i for word, i in vocab.items() if word not in self.special}
        merged = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        order = [vocab[a + b] for a, b in merged]
        if order != sorted(order):
            raise ValueError("the ids of this vocabulary are not in the order of its merges")
        self.coder = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for word, i in ranks.items():
            self.width[i] = len(word)
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def _one(self, chunk: str) -> list[int]:
        parts = self.marks.split(chunk) if self.marks else [chunk]
        return [i for p in parts for i in ([self.special[p]] if p in self.special else self.coder.encode_ordinary(p))]

    def _ids(self, chunks: pa.Array, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per chunk, ids in order); ``joined`` tells which may be encoded as one string."""
        size = np.zeros(len(chunks), np.int64)
        together = chunks.filter(pa.array(joined))
        flat = self.coder.encode_to_numpy("".join(together.to_pylist()), disallowed_special=())
        ends = np.cumsum(pc.binary_length(together).to_numpy(zero_copy_only=False).astype(np.int64))
        upto = np.searchsorted(np.cumsum(self.width[flat]), ends, "right")
        size[joined] = np.diff(upto, prepend=0)
        alone = [self._one(c.as_py()) for c in chunks.filter(pa.array(~joined))]
        size[~joined] = [len(x) for x in alone]
        out = np.empty(int(size.sum()), np.uint32)
        mask = np.repeat(joined, size)
        out[mask] = flat
        out[~mask] = [i for x in alone for i in x]
        return size, out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids in order); a null text has none."""
        texts = pc.fill_null(texts, "")
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = parts.flatten().dictionary_encode()
        names = coded.dictionary
        code = coded.indices.to_numpy().astype(np.int64)
        counts = np.diff(parts.offsets.to_numpy()).astype(np.int64)
        first = np.zeros(len(code), bool)
        first[np.cumsum(counts) - counts] = True
        # A part is plain if it is one run without white space, maybe after a newline.
        line = pc.starts_with(names, "\n").to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(names, f"^\\n?[^{BLANK}]+$").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(counts)), counts)
        odd = np.unique(row[~plain[code] | (line[code] & first)])
        key = code * 2 + (~first & ~line[code])
        if len(odd):
            keep = ~np.isin(row, odd)
            key, row = key[keep], row[keep]
        mark = np.zeros(2 * len(names), bool)
        mark[key] = True
        used = np.flatnonzero(mark)
        key = (np.cumsum(mark) - 1)[key]
        spaces = pc.if_else(pa.array((used & 1).astype(bool)), " ", "")
        chunks = pc.binary_join_element_wise(spaces, names.take(pa.array(used >> 1)), "")
        if len(odd):
            found = [CHUNK.findall(texts[int(r)].as_py()) for r in odd]
            extra = sorted({c for f in found for c in f})
            place = {c: len(chunks) + i for i, c in enumerate(extra)}
            chunks = pa.concat_arrays([chunks, pa.array(extra, chunks.type)])
            key = np.concatenate([key, np.fromiter((place[c] for f in found for c in f), np.int64)])
            row = np.concatenate([row, np.repeat(odd, [len(f) for f in found])])
            order = np.argsort(row, kind="stable")
            key, row = key[order], row[order]
        joined = pc.match_substring_regex(chunks, f"^[ \\n][^{BLANK}]+$").to_numpy(zero_copy_only=False)
        for word in self.special:
            joined = joined & ~pc.match_substring(chunks, word).to_numpy(zero_copy_only=False)
        size, flat = self._ids(chunks, joined)
        begin, lengths = (np.cumsum(size) - size)[key], size[key]
        total = np.bincount(row, weights=lengths, minlength=len(counts)).astype(np.int64)
        shift = begin - (np.cumsum(lengths) - lengths)
        return total, flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One per worker process and file."""
    return ChunkEncoder(path)
