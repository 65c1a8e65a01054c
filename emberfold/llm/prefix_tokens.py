"""Exact token counts of texts and of all their prefixes by dynamic programming.

In a byte-pair vocabulary the encoding of a prefix of a word, less its last token, is the encoding
of a shorter prefix, and a token may follow another exactly if the two together are encoded as
these two. So one pass over a word finds the last token of each of its prefixes from those before,
and the count of a prefix is one more than the count of what its last token leaves. A cut inside a
word makes the rest of it a word of its own, which ends in a word-end token; both chains are kept.
Words are independent of each other, so the counts of a text's prefixes are running sums over its
words, and each distinct word of a worker's texts is worked out once. The distinct words of a slice
are stepped through together, a position at a time, on arrays (``SuffixTable``): an automaton over
the vocabulary gives the longest token that ends there and each next shorter one. Words beyond Latin
letters and very long ones go one by one. Where a cut may change how the rest is normalised (a letter
and the marks after it) or split, only that spot is worked out again.

``prefix_counts`` stores the steps from each prefix to the next, one byte per code point and
compressed; ``tokens_at`` and ``cut_at_budget`` answer from that column alone.

Defined cases: a null or empty text has no tokens and one prefix; special strings inside texts are
one token, as the library treats them; repeated rows give repeated rows; very long texts take memory
in proportion to their length, a letter with very many marks takes time by their square and more than
32,767 tokens of difference between two neighbouring prefixes end the job; other columns pass through
``prefix_counts``, but for ones named as those that it adds, which it replaces.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberfold.llm.common import pack, slices, split_words, unpack
from emberfold.llm.tokens import byte_symbols

# Distinct words and token pairs a worker remembers.
REMEMBERED = 150_000
# Text bytes that are worked on at once.
PIECE_BYTES = 2 << 20
END = "</w>"
# Bytes of a word that is stepped through together with others; slots of the table of known pairs.
TOGETHER, KNOWN_PAIRS = 64, 1 << 21
# The pattern of such vocabularies, for lower-cased ASCII; letters before this
# character keep their place when lower-cased.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
LATIN_END = "\u0250"
# What follows an apostrophe in pieces of their own, whole or after its first letter.
SHORT_ENDS, LONG_ENDS = set("stmd"), {"re", "ve", "ll"}


def _joins(c: str) -> bool:
    """Whether a character may change how those before it are normalised."""
    if c.isascii():
        return False
    return unicodedata.category(c)[0] == "M" or unicodedata.category(c) == "Cn" or unicodedata.combining(c) > 0 or (
        "\u1160" <= c <= "\u11ff" or "\U00016d60" <= c <= "\U00016d6f")


class _Scan:
    """Tokens of a normalised run that grows by a character at a time and can be cut back.

    The pieces before the last are settled; of the last one, the steps of ``PrefixCounter._chains``.
    """

    def __init__(self, counter: PrefixCounter):
        self.counter = counter
        self.settled, self.kind, self.waiting = 0, "", None
        self.symbols, self.last, self.count = [], [""], [0]

    def tokens(self) -> int:
        return self.settled + (self.counter._end(self.symbols, self.last, self.count) if self.symbols else 0)

    def mark(self) -> tuple:
        return self.settled, self.kind, self.waiting, self.symbols, self.last, self.count, len(self.symbols)

    def back(self, mark: tuple) -> None:
        self.settled, self.kind, self.waiting, self.symbols, self.last, self.count, size = mark
        del self.symbols[size:], self.last[size + 1 :], self.count[size + 1 :]

    def _start(self, kind: str) -> None:
        self.settled, self.kind = self.tokens(), kind
        self.symbols, self.last, self.count = [], [""], [0]

    def add(self, c: str) -> None:
        kind, waiting, self.waiting = self.counter._class(c), self.waiting, None
        if kind == "S":
            return self._start("")
        if waiting and waiting[0] + c in LONG_ENDS:
            # The apostrophe and the letter after it were pieces of their own until now.
            self.settled, self.kind, self.symbols, self.last, self.count = waiting[1], "C", [], [""], [0]
            c = f"'{waiting[0]}{c}"
        elif kind == "L" and self.kind == "O" and self.symbols == ["'"]:
            if c in SHORT_ENDS:
                self.kind = "C"
            else:
                self.waiting = (c, self.settled) if c in "rvl" else None
                self._start("L")
        elif kind != self.kind or kind == "N":
            self._start(kind)
        for byte in c.encode():
            self.symbols.append(self.counter.shown[byte])
            self.counter._extend(self.symbols, self.last, self.count)


class SuffixTable:
    """Last-token steps of many byte-level words at once.

    Tokens are numbers, those that end a word apart from the others. ``goto`` leads from the longest
    vocabulary prefix that a word's part ends in to the next by one byte; ``longest`` holds per such
    state the longest token that the part ends in, ``shorter`` per token the next one down.
    """

    def __init__(self, counter: PrefixCounter):
        bytes_of = byte_symbols()
        names = list(counter.vocab)
        number = {t: i for i, t in enumerate(names)}
        self.none = len(names)
        self.made = np.full((3, self.none + 1), -1, np.int64)
        for token, (one, two, rank) in counter.made.items():
            self.made[:, number[token]] = number[one], number[two], rank
        pairs = sorted((number[a] * (self.none + 1) + number[b], r) for (a, b), r in counter.rank.items())
        self.pairs, self.ranks = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
        self.known = np.full(KNOWN_PAIRS, -1, np.int64)

        raw: dict[bytes, list[int]] = {b"": [-1, -1]}
        for i, token in enumerate(names):
            body = token.removesuffix(END)
            if body and all(c in bytes_of for c in body) and counter._may_follow("", token):
                text = bytes(bytes_of[c] for c in body)
                for n in range(1, len(text)):
                    raw.setdefault(text[:n], [-1, -1])
                raw.setdefault(text, [-1, -1])[body != token] = i
        nodes = sorted(raw, key=len)
        place = {t: i for i, t in enumerate(nodes)}
        size = np.array([len(t) for t in nodes])
        parent = np.array([place[t[:-1]] for t in nodes])
        byte = np.array([t[-1] if t else 0 for t in nodes])
        own = np.array([raw[t] for t in nodes], np.int64)
        self.goto = np.zeros((len(nodes), 256), np.int32)
        self.longest = np.full((2, len(nodes)), -1, np.int64)
        self.shorter = np.full(self.none + 1, -1, np.int64)
        self.size = np.zeros(self.none + 1, np.int64)
        for depth in range(1, int(size[-1]) + 1):
            at = np.flatnonzero(size == depth)
            back = self.goto[parent[at], byte[at]].astype(np.int64) if depth > 1 else np.zeros(len(at), np.int64)
            self.goto[parent[at], byte[at]] = at
            self.goto[at] = self.goto[back]
            for kind in (0, 1):
                here, below = own[at, kind], self.longest[kind, back]
                self.longest[kind, at] = np.where(here >= 0, here, below)
                self.shorter[here[here >= 0]] = below[here >= 0]
                self.size[here[here >= 0]] = depth

    def _apart(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``PrefixCounter._stay_apart`` of many pairs."""
        out, rows = np.zeros(len(before), bool), np.arange(len(before))
        limit = np.full(len(before), 1 << 60)
        while len(rows):
            key = before * (self.none + 1) + token
            found = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            merged = (self.pairs[found] == key) & (self.ranks[found] < limit)
            one, two = self.made[2, before], self.made[2, token]
            left = one > two
            single = ~left & (two < 0)
            out[rows[single & ~merged]] = True
            open_ = ~merged & ~single
            before, limit, token = (
                np.where(left, self.made[1, before], before)[open_], np.where(left, one, two + 1)[open_],
                np.where(left, token, self.made[0, token])[open_],
            )
            rows = rows[open_]
        return out

    def _fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether tokens may follow others, by the table of known pairs where they are in it."""
        key = before * (self.none + 1) + token
        slot = (key * 0x9E3779B1 >> 7) % KNOWN_PAIRS
        seen = self.known[slot]
        out = (seen & 1).astype(bool)
        new = np.flatnonzero(seen >> 1 != key)
        if len(new):
            first = before[new] == self.none
            out[new[first]] = True
            new = new[~first]
            keys, back = np.unique(key[new], return_inverse=True)
            one, two = keys // (self.none + 1), keys % (self.none + 1)
            apart = self._apart(one, two)
            out[new] = apart[back]
            self.known[(keys * 0x9E3779B1 >> 7) % KNOWN_PAIRS] = keys * 2 + apart
        return out

    def _last(self, kind: int, state: np.ndarray, at: int, base: np.ndarray, last: np.ndarray) -> tuple:
        """(token, where it begins) of the encodings of all parts that end at position ``at``."""
        token = self.longest[kind, state]
        rows = np.arange(len(state))
        while len(rows):
            tried = token[rows]
            if (tried < 0).any():
                raise ValueError("no encoding of a word")
            ok = self._fits(last[base[rows] + at - self.size[tried]], tried)
            rows = rows[~ok]
            token[rows] = self.shorter[token[rows]]
        return token, base + at - self.size[token]

    def prefixes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of every byte prefix of the words, one after the other, and where each begins)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.concatenate([[0], np.cumsum(size)])
        text = np.frombuffer(b"".join(words), np.uint8)
        order = np.argsort(-size, kind="stable")
        # A word's steps lie behind each other, led by the empty prefix.
        base, spot = (start[:-1] + np.arange(len(words)))[order], start[:-1][order]
        last = np.full(len(text) + len(words), self.none, np.int64)
        count, ended = np.zeros(len(last), np.int64), np.zeros(len(text), np.int64)
        state = np.zeros(len(words), np.int64)
        longest_first = size[order]
        for at in range(1, int(longest_first[0]) + 1 if len(words) else 0):
            n = int(np.searchsorted(-longest_first, -at, "right"))
            here = base[:n]
            state = self.goto[state[:n], text[spot[:n] + at - 1]].astype(np.int64)
            token, begin = self._last(0, state, at, here, last)
            last[here + at], count[here + at] = token, count[begin] + 1
            _, begin = self._last(1, state, at, here, last)
            ended[spot[:n] + at - 1] = count[begin] + 1
        return ended, start


class PrefixCounter:
    """Counts for one tokenizer file with lower-cased words that end in a word-end token."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model.get("end_of_word_suffix") != END or model.get("continuing_subword_prefix"):
            raise ValueError("a vocabulary with word-end tokens is needed")
        self.special = [t["content"].lower() for t in data["added_tokens"]]
        if any(t[k] for t in data["added_tokens"] for k in ("normalized", "single_word", "lstrip", "rstrip")):
            raise ValueError("special strings must stand for themselves wherever they are")
        longest_first = sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)
        self.special_at = re.compile("|".join(map(re.escape, longest_first)) or "(?!)")
        self.vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.made: dict[str, tuple[str, str, int]] = {}
        for i, (a, b) in enumerate(pairs):
            self.made.setdefault(a + b, (a, b, i))
        if len(self.made) < len(pairs) or any(x in self.made and self.made[x][2] > i for a, b, i in self.made.values() for x in (a, b)):
            raise ValueError("a vocabulary is needed whose tokens are each made once, of tokens made before")
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.word_steps: dict[str, bytes] = {}
        self.piece_prefixes: dict[str, list[int]] = {}
        self.kinds: dict[str, str] = {}
        self.normal: dict[str, str] = {}
        self.shown = {b: c for c, b in byte_symbols().items()}
        self.table = SuffixTable(self)
        self.piece_steps: dict[str, bytes] = {}
        kinds: dict[str, list[str]] = {"L": [], "N": [], "O": []}
        upper = []
        for c in map(chr, range(33, ord(LATIN_END))):
            low = self._normal(c)
            if low == c and self._class(c) in kinds and not _joins(c):
                kinds[self._class(c)].append(re.escape(c))
            elif len(low) == 1 and low == c.lower() < LATIN_END and self._normal(low) == low and self._class(low) in kinds:
                upper.append(re.escape(c))
        own = {k: f"[{''.join(v)}]" for k, v in kinds.items()}
        self.latin = re.compile(f"[{''.join(sum(kinds.values(), upper))}]+")
        self.latin_pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{own['L']}+|{own['N']}|{own['O']}+")

    def _encode(self, symbols: list[str]) -> list[str]:
        """Byte-pair encoding of a few symbols, by the merge of lowest rank first."""
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 60))
            pair = (symbols[best], symbols[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _may_follow(self, before: str, token: str) -> bool:
        key = (before, token)
        known = self.fits.get(key)
        if known is None:
            if before:
                known = self._may_follow("", token) and self._stay_apart(before, token)
            elif token in self.made:
                one, two, rank = self.made[token]
                known = self._may_follow("", one) and self._may_follow("", two) and self._stay_apart(one, two, rank)
            else:
                known = len(token.removesuffix(END)) == 1
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            self.fits[key] = known
        return known

    def _stay_apart(self, before: str, token: str, limit: int = 1 << 60) -> bool:
        """Whether no merge of rank below ``limit`` crosses from one token to the other while the two are made.

        The later made of the two is taken apart until the symbols at the border are single; a
        merge of these that comes before the ones taken back would have been done instead.
        """
        none = (None, None, -1)
        while True:
            if self.rank.get((before, token), limit) < limit:
                return False
            one, two = self.made.get(before, none), self.made.get(token, none)
            if one[2] > two[2]:
                before, limit = one[1], one[2]
            elif two[2] >= 0:
                # Of equal merges the left one is done first.
                token, limit = two[0], two[2] + 1
            else:
                return True

    def _chains(self, piece: str, every: bool) -> list[int]:
        """Tokens of the prefixes of one byte-level word: of all of them, or of the last alone."""
        vocab, fits, longest, size = self.vocab, self.fits, self.longest, len(piece)
        last, count, ended = [""], [0], [0]
        for end in range(1, size + 1):
            if end < size or every:
                for start in range(max(0, end - longest), end):
                    token = piece[start:end]
                    if token in vocab:
                        ok = fits.get((last[start], token))
                        if ok if ok is not None else self._may_follow(last[start], token):
                            last.append(token)
                            count.append(count[start] + 1)
                            break
                else:
                    raise ValueError(f"no encoding of {piece!r}")
            if end == size or every:
                for start in range(max(0, end - longest), end):
                    token = piece[start:end] + END
                    if token in vocab:
                        ok = fits.get((last[start], token))
                        if ok if ok is not None else self._may_follow(last[start], token):
                            ended.append(count[start] + 1)
                            break
                else:
                    raise ValueError(f"no encoding of {piece!r}")
        return ended

    def _follow(self, symbols: list[str], last: list[str], end: str) -> tuple[int, str]:
        """Where the last token of ``symbols`` begins, and the token."""
        size = len(symbols)
        tail = "".join(symbols[-self.longest :])
        for start in range(size - len(tail), size):
            token = tail[start - size + len(tail) :] + end
            if token in self.vocab:
                ok = self.fits.get((last[start], token))
                if ok if ok is not None else self._may_follow(last[start], token):
                    return start, token
        raise ValueError(f"no encoding of {tail!r}")

    def _extend(self, symbols: list[str], last: list[str], count: list[int]) -> None:
        start, token = self._follow(symbols, last, "")
        last.append(token)
        count.append(count[start] + 1)

    def _end(self, symbols: list[str], last: list[str], count: list[int]) -> int:
        return count[self._follow(symbols, last, END)[0]] + 1

    def _class(self, c: str) -> str:
        """Letter, Number, Other or Space, as the library's pattern sees a character."""
        known = self.kinds.get(c)
        if known is None:
            split = self.library.pre_tokenizer.pre_tokenize_str
            after = split("a" + c)
            if len(after) == 1:
                known = "L" if len(after[0][0]) > 1 else "S"
            else:
                known = "N" if len(split(c + c)) == 2 else "O"
            self.kinds[c] = known
        return known

    def _normal(self, c: str) -> str:
        known = self.normal.get(c)
        if known is None:
            known = self.normal[c] = self.library.normalizer.normalize_str(c)
        return known

    def _piece_prefixes(self, piece: str) -> list[int]:
        """Tokens of the prefixes of an ASCII piece."""
        known = self.piece_prefixes.get(piece)
        if known is None:
            known = self._chains(piece, True)[1:]
            if piece[0] == "'" and piece[1:].isalpha():
                parts = [ASCII_PIECES.findall(piece[:i]) for i in range(1, len(piece))]
                known[:-1] = [sum(self._chains(x, False)[-1] for x in p) for p in parts]
            self.piece_prefixes[piece] = known
        return known

    def _plain_prefixes(self, word: str) -> list[int]:
        """Tokens of the prefixes of a run in which special strings do not count."""
        out, before = [], 0
        if word.isascii() and word.isprintable():
            for piece in ASCII_PIECES.findall(word.lower()):
                out += [before + n for n in self._piece_prefixes(piece)]
                before = out[-1]
            return out
        scan, at = _Scan(self), 0
        while at < len(word):
            to = at + 1
            while to < len(word) and _joins(word[to]):
                to += 1
            mark, shown = scan.mark(), ""
            for end in range(at + 1, to + 1):
                now = self._normal(word[at]) if end == at + 1 else self.library.normalizer.normalize_str(word[at:end])
                if not now.startswith(shown):
                    scan.back(mark)
                    shown = ""
                for c in now[len(shown) :]:
                    scan.add(c)
                shown = now
                out.append(scan.tokens())
            at = to
        return out

    def _pieces(self, word: str) -> list[str]:
        """Byte-level words of a run, as the library's normaliser and pattern give them."""
        if word.isascii() and word.isprintable():
            return ASCII_PIECES.findall(word.lower())
        low = word.lower()
        if low.isalpha() and max(word) < LATIN_END and unicodedata.is_normalized("NFC", word):
            return ["".join(map(self.shown.__getitem__, low.encode()))]
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))]

    def _is_special(self, word: str) -> bool:
        return "<|" in word and any(s in word.lower() for s in self.special)

    def tokens(self, word: str) -> int:
        """Tokens of a run of characters other than white space."""
        if self._is_special(word):
            return len(self.library.encode(word, add_special_tokens=False).ids)
        total, known = 0, self.pieces
        for piece in self._pieces(word):
            count = known.get(piece)
            if count is None:
                count = known[piece] = self._chains(piece, False)[-1]
            total += count
        return total

    def prefixes(self, word: str) -> list[int]:
        """Tokens of the prefixes of 1, 2, ... code points of such a run."""
        if word.isascii() and word.isalpha():
            return self._chains(word.lower(), True)[1:]
        out, before, at = [], 0, 0
        # A special string is ordinary text up to its last character, and settles what is before it.
        for found in self.special_at.finditer(word):
            own = self._plain_prefixes(word[at : found.end() - 1])
            out += [before + n for n in own]
            head = found.start() - at
            before, at = before + (own[head - 1] if head else 0) + 1, found.end()
            out.append(before)
        return out + [before + n for n in self._plain_prefixes(word[at:])]

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Steps of lower-cased Latin pieces, at the ends of their characters."""
        new = [p for p in pieces if p not in self.piece_steps]
        # What is cut in two before its last character, and what would be stepped through all alone.
        apart = [p for p in new if p[0] == "'" and p[1:].isalpha() or len(p) * 2 > TOGETHER]
        for p in apart:
            self.piece_steps[p] = _step_bytes(self._plain_prefixes(p))
        apart = set(apart)
        new = [p for p in new if p not in apart]
        for some in range(0, len(new), 1 << 14):
            words = new[some : some + (1 << 14)]
            raw = [p.encode() for p in words]
            counts, start = self.table.prefixes(raw)
            text = np.frombuffer(b"".join(raw), np.uint8)
            ends = np.append((text[1:] & 0xC0) != 0x80, True)[: len(text)]
            counts, start = counts[ends], np.concatenate([[0], np.cumsum(ends)])[start]
            step = np.diff(counts, prepend=0)
            step[start[:-1]] = counts[start[:-1]]
            data, start = _narrow(step).tobytes(), (start * 2).tolist()
            self.piece_steps.update(zip(words, (data[a:b] for a, b in zip(start, start[1:]))))

    def steps(self, words: list[str]) -> list[bytes]:
        """Per word the tokens of each prefix less those of the prefix before it, two bytes each."""
        known = self.word_steps
        if len(known) > REMEMBERED:
            known = self.word_steps = {w: known[w] for w in words if w in known}
            self.piece_prefixes = {}
        if len(self.piece_steps) > REMEMBERED:
            self.piece_steps = {}
        split = {}
        for w in words:
            if w not in known:
                if self.latin.fullmatch(w) and not self.special_at.search(w):
                    low = w.lower()
                    split[w] = [low] if low.isalpha() else self.latin_pieces.findall(low)
                else:
                    known[w] = _step_bytes(self.prefixes(w))
        self._learn_pieces({p for parts in split.values() for p in parts})
        own = self.piece_steps
        for w, parts in split.items():
            known[w] = own[parts[0]] if len(parts) == 1 else b"".join([own[p] for p in parts])
        return [known[w] for w in words]

    def counts(self, words: list[str]) -> np.ndarray:
        known = self.words
        if len(known) > REMEMBERED:
            known = self.words = {w: known[w] for w in words if w in known}
            self.pieces = {}
        for w in words:
            if w not in known:
                known[w] = self.tokens(w)
        return np.fromiter((known[w] for w in words), np.int64, len(words))


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One per worker process and file."""
    return PrefixCounter(path)


def _narrow(step: np.ndarray) -> np.ndarray:
    out = step.astype(np.int16)
    if (out != step).any():
        raise OverflowError("a prefix has over 32,767 tokens more or less than the one before")
    return out


def _step_bytes(counts: list[int]) -> bytes:
    return _narrow(np.diff(np.array(counts, np.int64), prepend=0)).tobytes()


def _spread(text: str, steps: np.ndarray) -> np.ndarray:
    """Steps of a text's words at their places, 0 for the white space between them."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points), np.int16)
    out[(points != 32) & (points - np.uint32(9) > 4)] = steps
    return out


def _steps(counter: PrefixCounter, text: str) -> np.ndarray:
    """Tokens of each prefix less those of the prefix before it, for 1, 2, ... code points."""
    _, codes, words = split_words(pa.array([text], pa.string()))
    own = counter.steps(words)
    return _spread(text, np.frombuffer(b"".join([own[c] for c in codes.tolist()]), np.int16))


def _counted(path: str, store: bool, names: list[str]):
    def run(batches):
        counter = prefix_counter(path)
        for whole in batches:
            for batch in slices(whole, "text", PIECE_BYTES):
                text = pc.fill_null(batch.column("text"), "")
                per_row, codes, words = split_words(text)
                edges = np.concatenate([[0], np.cumsum(per_row)])
                size = pc.binary_length(text).cast(pa.int64())
                if store:
                    own, codes, total, stored = counter.steps(words), codes.tolist(), [], []
                    for t, a, b in zip(text.to_pylist(), edges, edges[1:]):
                        steps = np.frombuffer(b"".join([own[c] for c in codes[a:b]]), np.int16)
                        total.append(int(steps.sum(dtype=np.int64)))
                        stored.append(pack(_spread(t, steps)))
                    extra = [size, pa.array(total, pa.int64()), pa.array(stored, pa.binary())]
                else:
                    sums = np.concatenate([[0], np.cumsum(counter.counts(words)[codes])])
                    extra = [size, pa.array(sums[edges[1:]] - sums[edges[:-1]])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names)
            pa.default_memory_pool().release_unused()

    return run


def _with(schema: StructType, name: str, kind: str) -> StructType:
    return StructType(list(schema.fields)).add(name, kind)


def prefix_counts(docs: DataFrame, tokenizer_path: str, *, store: bool = True) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and, if stored, ``prefix_steps`` of the column ``text``."""
    added = ["n_bytes", "n_tokens"] + ["prefix_steps"] * store
    kept = docs.drop(*added)
    schema = _with(_with(kept.schema, "n_bytes", "long"), "n_tokens", "long")
    if store:
        schema = _with(schema, "prefix_steps", "binary")
    return kept.mapInArrow(_counted(tokenizer_path, store, schema.names), schema)


def tokens_at(counted: DataFrame, n_chars: int) -> DataFrame:
    """``counted`` with ``tokens_at``: the tokens of the first ``n_chars`` code points."""

    def run(batches):
        for batch in batches:
            sums = [int(unpack(x, np.int16)[:n_chars].sum()) for x in batch.column("prefix_steps").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=names)

    schema = _with(counted.schema, "tokens_at", "long")
    names = schema.names
    return counted.mapInArrow(run, schema)


def cut_at_budget(counted: DataFrame, budget: int) -> DataFrame:
    """``counted`` with ``fits_chars``: the longest prefix, in code points, of at most ``budget`` tokens."""

    def run(batches):
        for batch in batches:
            most = []
            for x in batch.column("prefix_steps").to_pylist():
                good = np.flatnonzero(np.cumsum(unpack(x, np.int16)) <= budget)
                most.append(int(good[-1]) + 1 if len(good) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(most, pa.int64())], names=names)

    schema = _with(counted.schema, "fits_chars", "long")
    names = schema.names
    return counted.mapInArrow(run, schema)


def over_limit(limit: int) -> Column:
    return F.col("n_tokens") > limit
