import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from emberfold.llm import token_align as ta
from emberfold.llm.tokens import byte_symbols

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.symbols = byte_symbols()

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text, num_threads=1)
        a = [(i, bytes(self.symbols[c] for c in self.a.id_to_token(i))) for i in ids_a]
        b = [(i, self.bytes_b(i)) for i in ids_b]
        whole = (" " + text).encode()
        return (a, b) if whole == b"".join(x for _, x in a) == b"".join(x for _, x in b) else ([], [])

    def groups(self, a, b):
        out, ends = [], []
        for side in (a, b):
            at = 0
            ends.append({(at := at + len(x)): n for n, (_, x) in enumerate(side)})
        last_a = last_b = 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            x, y = ends[0][end] + 1, ends[1][end] + 1
            out.append(([i for i, _ in a[last_a:x]], [i for i, _ in b[last_b:y]]))
            last_a, last_b = x, y
        return out


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


@pytest.fixture(scope="module")
def brute():
    return Brute()


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a▁b", "<s> </s><unk><0x0A>", "<|endoftext|> x <|endoftext|>", "\x00 b", "é é ﬁ ①",
    "\t\n\r\n x y 　 z", "漢字かな 한국어 \U0001F600\U0001F1E9\U0001F1EA", "x" * 3000, " " * 500 + "end", "it's we'll 12345 !!! ...",
]


def test_report_equals_brute_force(spark, brute, docs, corpus):
    rows = [(r[0], r[1]) for r in corpus] + [(910000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None)]
    counts, found = Counter(), []
    for doc_id, text in rows:
        a, b = brute.tokens(text)
        groups = brute.groups(a, b)
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    want = [
        (d, a, b, len(g), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(written(g).encode()).hexdigest() if a else "")
        for d, a, b, g, links in found
    ]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    got = [tuple(r) for r in ta.link_report(df, A, B).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(counts) <= ta.aligner(A, B).most_pairs


def test_encoders_and_groups_on_random_texts(brute):
    rng = random.Random(3)
    alphabet = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "▁", "<s>", "'s", "1", "\U0001F600", "́", "-"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(1500)]
    rows = ta.aligner(A, B).rows(pa.array(texts))
    for i, text in enumerate(texts):
        a, b = brute.tokens(text)
        assert (rows["n_a"][i].as_py(), rows["n_b"][i].as_py()) == (len(a), len(b)), text
        groups = brute.groups(a, b)
        assert rows["groups"][i].as_py() == written(groups)
        pairs = Counter(x[-1] * 32000 + y[-1] for x, y in groups)
        assert dict(zip(rows["pairs"][i].as_py(), rows["times"][i].as_py())) == pairs


def test_real_groups_and_empty_table(docs, no_docs, brute, corpus):
    texts = {r[0]: r[1] for r in corpus}
    for r in ta.align(docs, A, B).filter("doc_id < 20").collect():
        assert r.groups == written(brute.groups(*brute.tokens(texts[r.doc_id])))
    assert ta.link_report(no_docs, A, B).count() == 0
