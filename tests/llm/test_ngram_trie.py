import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberfold.llm import ngram_trie as nt

from .conftest import words


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 1 << 40), max_size=300), st.lists(st.integers(0, 1 << 40), max_size=60))
def test_elias_fano_finds_exactly_its_elements(values, others):
    rising = np.array(sorted(values), np.int64)
    arrays, shape = nt.EliasFano.encode(rising)
    sequence = nt.EliasFano(*arrays, *shape)
    keys = np.array([*rising, *others, 0, 1 << 41], np.int64)
    place = {int(v): i for i, v in enumerate(rising)}
    assert sequence.find(keys).tolist() == [place.get(int(k), -1) for k in keys]


def test_dense_and_clustered_sequences():
    for rising in (np.arange(5000), np.concatenate([np.arange(3000), 10**9 + np.arange(0, 9000, 3)])):
        arrays, shape = nt.EliasFano.encode(rising)
        found = nt.EliasFano(*arrays, *shape).find(rising)
        assert (found == np.arange(len(rising))).all()


def test_packing_round_trip():
    for kind in (np.uint8, np.int32, np.int64, np.float32):
        x = (np.random.default_rng(1).random(1000) * 100).astype(kind)
        assert (nt.unpack(nt.pack(x), kind) == x).all()
    assert len(nt.unpack(nt.pack(np.empty(0, np.int64)), np.int64)) == 0


def reference(corpus):
    texts = [(i, [*words(t), ""], zlib.crc32(str(i).encode()) % 10 == 0) for i, t, *_ in corpus]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for _, x, held in texts:
        if not held:
            y = ["\0", "\0", *x]
            for k in range(len(x)):
                c1[x[k]] += 1
                c2[tuple(y[k + 1 : k + 3])] += 1
                c3[tuple(y[k : k + 3])] += 1
    total, kinds = sum(c1.values()), len(c1)
    n2, t2, n3, t3 = Counter(), Counter(), Counter(), Counter()
    for (b, _), n in c2.items():
        n2[b] += n
        t2[b] += 1
    for (a, b, _), n in c3.items():
        n3[a, b] += n
        t3[a, b] += 1

    def base(w):
        return (c1[w] + 0.1) / (total + 0.1 * (kinds + 1))

    def p(a, b, w):
        q = base(w)
        if n2[b]:
            q = (max(c2[b, w] - nt.DISCOUNT, 0) + nt.DISCOUNT * t2[b] * q) / n2[b]
        if n3[a, b]:
            q = (max(c3[a, b, w] - nt.DISCOUNT, 0) + nt.DISCOUNT * t3[a, b] * q) / n3[a, b]
        return q

    out = []
    for i, x, held in texts:
        y = ["\0", "\0", *x]
        out.append((
            i, held, len(x), sum(w in c1 for w in x), total, sum(math.log10(base(w)) for w in x),
            sum(math.log10(p(*y[k : k + 3])) for k in range(len(x))),
        ))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_brute_force_within_the_quantisation(docs, corpus, monkeypatch, small):
    if small:  # many blocks and shards
        monkeypatch.setattr(nt, "BLOCK_BYTES", 1 << 16)
        monkeypatch.setattr(nt, "WORDS_PER_SHARD", 5000)
        monkeypatch.setattr(nt, "TRIGRAMS_PER_SHARD", 50_000)
        monkeypatch.setattr(nt, "HOT_SHARE", 1.0)
    got = sorted(tuple(r) for r in nt.score_documents(docs).collect())
    want = sorted(reference(corpus))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert abs(g[6] - w[6]) <= 0.05 * g[2] and g[6] <= w[6] + 1e-3 * g[2]


def test_spread_middle_words_keep_probabilities_proper(docs, corpus, monkeypatch):
    monkeypatch.setattr(nt, "TRIGRAMS_PER_SHARD", 20_000)
    monkeypatch.setattr(nt, "HOT_SHARE", 0.001)
    rows = nt.score_documents(docs).collect()
    held = [r for r in rows if r.held_out and r.n_tokens > 20]
    assert len(rows) == len(corpus) and all(r.score < 0 for r in rows)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_spread_middle_words_score_like_brute_force(docs, corpus, monkeypatch):
    """p2 of a word whose trigrams lie in many shards is that of the whole corpus."""
    monkeypatch.setattr(nt, "TRIGRAMS_PER_SHARD", 20_000)
    monkeypatch.setattr(nt, "HOT_SHARE", 0.001)
    got, want = sorted(tuple(r) for r in nt.score_documents(docs).collect()), sorted(reference(corpus))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[6] - w[6]) <= 0.05 * g[2] and g[6] <= w[6] + 1e-3 * g[2]


def test_a_trie_is_a_distribution():
    rng = np.random.default_rng(3)
    triples = np.unique(rng.integers(0, 12, (150, 3)), axis=0)
    count = rng.integers(1, 9, len(triples))
    base = np.full(13, 1 / 13)
    trie = nt.TrigramTrie.mapped(*nt.TrigramTrie.build(*triples.T, count, base[triples[:, 2]]))
    for a in range(13):
        for b in range(13):
            last = np.arange(13)
            logs = trie.score(np.full(13, a), np.full(13, b), last, np.log10(base))
            assert 0.98 < (10**logs).sum() <= 1 + 1e-9


def test_no_rows_and_no_training(spark, no_docs, docs):
    assert nt.score_documents(no_docs).count() == 0
    rows = nt.score_documents(docs.filter("doc_id > 900000"), held_out=F.lit(True)).collect()
    assert len(rows) == 13 and {r.train_tokens for r in rows} == {0} and {r.n_known for r in rows} == {0}
    null = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id BIGINT, text STRING")
    assert [r.doc_id for r in nt.score_documents(null).collect()] == [None, None]
