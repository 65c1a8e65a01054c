import random
from collections import Counter

import numpy as np
import pytest

from emberfold.llm import jaccard_join as jj

from .conftest import words


def brute(rows, width, percent):
    sets, by_doc = {}, {}
    for i, (doc_id, text) in enumerate(rows):
        w = words(text)
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
        by_doc.setdefault(doc_id, []).append(i)
    parent = {d: d for d in by_doc}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    index = {}
    for i, s in sets.items():
        seen = Counter(k for x in s for k in index.get(x, ()))
        for k, n in seen.items():
            if 100 * n >= percent * (len(s) + len(sets[k]) - n):
                low, high = sorted((find(rows[i][0]), find(rows[k][0])))
                parent[high] = low
        for x in s:
            index.setdefault(x, []).append(i)
    return sorted((d, len(sets[i]), find(d)) for i, (d, _) in enumerate(rows))


def edited(rng, base, rate):
    return " ".join(rng.choice("uvwxyz") + str(rng.random()) if rng.random() < rate else w for w in base.split())


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs, corpus, width, percent):
    got = sorted(tuple(r) for r in jj.similar_components(docs, width=width, percent=percent).collect())
    assert got == brute([c[:2] for c in corpus], width, percent)


@pytest.mark.parametrize("hubs", [False, True])
def test_borderline_groups_and_chains(spark, monkeypatch, hubs):
    """Near copies around the threshold, exact copies, chains, and texts that share a passage."""
    monkeypatch.setattr(jj, "HUBS", hubs)
    monkeypatch.setattr(jj.forests, "TILE", 4096 if hubs else 8)
    rng = random.Random(5)
    rows, number = [], iter(range(10_000))
    passage = " ".join(f"p{i}" for i in range(60))
    for size in (2, 9, 10, 11, 14, 30, 120, 400):
        base = " ".join(f"s{size}w{i}" for i in range(size))
        for _ in range(25):
            rows.append((next(number), edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03]))))
        step = base
        for _ in range(8):
            step = edited(rng, step, 0.01)
            rows.append((next(number), step))
    rows += [(next(number), passage + " " + " ".join(f"o{j}x{i}" for i in range(50))) for j in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert sorted(tuple(r) for r in jj.similar_components(df).collect()) == brute(rows, 3, 90)


def test_every_similar_pair_shares_a_bought_key():
    rng = np.random.default_rng(2)
    for size in (1, 5, 10, 25, 100, 500):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            drop = rng.integers(0, jj.differences(2 * len(x), 90) + 1)
            y = np.sort(rng.permutation(x)[: len(x) - drop])
            if 100 * len(y) < 90 * len(x):
                continue
            keys, codes, owner = jj._entries([x, y], 90)
            of = [{(int(k), int(c) >> 1) for k, c, o in zip(keys, codes, owner) if o == i} for i in (0, 1)]
            assert of[0] & of[1]


def test_one_of_each_and_no_rows(docs, corpus, no_docs):
    kept = jj.one_of_each(docs, width=5, percent=80)
    assert kept.columns == docs.columns
    want = Counter(d for d, _, c in brute([c[:2] for c in corpus], 5, 80) if d == c)
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert jj.similar_components(no_docs).count() == 0 and jj.one_of_each(no_docs).count() == 0


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (1, text), (1, text), (2, "other words of few"), (3, None), (2, text)]
    got = jj.similar_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 18, 0), (1, 18, 1), (1, 18, 1), (2, 2, 1), (2, 18, 1), (3, 0, 3),
    ]


def test_later_rounds_go_over_joined_roots_only(spark, monkeypatch):
    """Many near copies: their links are gone over once, later links between the roots that they join."""
    sizes = []
    real = jj.forests.connected_components
    monkeypatch.setattr(jj.forests, "connected_components", lambda n, e, g: sizes.append(e.count()) or real(n, e, g))
    rng = random.Random(8)
    base = " ".join(f"w{i}" for i in range(120))
    rows = [(i, edited(rng, base, 0.005)) for i in range(150)]
    got = jj.similar_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 90)
    assert len(sizes) >= 1 and sum(sizes[1:]) < sizes[0]
