import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emberfold.llm import best_fit_packing as bp
from emberfold.llm.tokens import ChunkEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return ChunkEncoder(PATH)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list("ab'sé漢 \n\t.,12\r 　<|>")) | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=6))
def test_chunked_ids_equal_the_library(library, encoder, texts):
    counts, flat = encoder.encode(pa.array([*texts, None, "<|endoftext|> a<|endoftext|>"]))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in [*texts, None, "<|endoftext|> a<|endoftext|>"]]
    assert counts.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_uses_each_length_once_and_fills_well(lengths):
    plan = bp.plan_bins(Counter(lengths), 40)
    used = Counter()
    for content, times in plan:
        assert sum(content) <= 40 and times > 0
        for n in content:
            used[n] += times
    assert used == Counter(lengths)
    bins = sum(times for _, times in plan)
    assert -(-sum(lengths) // 40) <= bins <= -(-sum(lengths) * 11 // 360) + 2 or bins <= 2 * -(-sum(lengths) // 40)


def test_two_pieces_replace_the_smallest():
    # Greedy takes 6, 3 and leaves 1; 2 + 2 fill the gap that the 3 leaves.
    assert ([6, 2, 2], 1) in bp.plan_bins({6: 1, 3: 1, 2: 2}, 10)


def check(rows, corpus, library, capacity):
    want = []
    for doc_id, text, *_ in corpus:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in rows)


def test_pieces_and_places(docs, corpus, library):
    rows = bp.pack_documents(docs, PATH).collect()
    bins, total = check(rows, corpus, library, 1024)
    assert bins <= -(-total // 1024) + 3


def test_sequences_hold_the_ids(docs, corpus, library):
    packed = bp.pack_documents(docs.filter("doc_id < 40"), PATH, capacity=64, keep_ids=True)
    rows = packed.collect()
    check(rows, [c for c in corpus if c[0] < 40], library, 64)
    ids = {r.sequence_id: r.ids for r in bp.sequences(packed).collect()}
    for r in rows:
        assert ids[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_no_rows(no_docs):
    assert bp.pack_documents(no_docs, PATH).count() == 0
