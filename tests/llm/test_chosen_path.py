import random

import numpy as np
import pytest

from emberfold.llm import chosen_path as cp

from .test_jaccard_join import brute, edited


def wanted(rows, width=5, percent=85):
    return sorted(((d, n, c, d == c) for d, n, c in brute(rows, width, percent)), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in cp.similar_components(df, **options).collect()), key=str)


def borderline(rng):
    """Near copies around the threshold, exact copies, chains, and texts that share a passage."""
    rows, number = [], iter(range(10_000))
    passage = " ".join(f"p{i}" for i in range(60))
    for size in (2, 6, 11, 14, 30, 120, 400):
        base = " ".join(f"s{size}w{i}" for i in range(size))
        for _ in range(25):
            rows.append((next(number), edited(rng, base, rng.choice([0, 0.005, 0.01, 0.015, 0.02]))))
        step = base
        for _ in range(8):
            step = edited(rng, step, 0.01)
            rows.append((next(number), step))
    rows += [(next(number), passage + " " + " ".join(f"o{j}x{i}" for i in range(50))) for j in range(40)]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(docs, corpus):
    assert found(docs) == wanted([c[:2] for c in corpus])


@pytest.mark.parametrize("small", [False, True])
def test_borderline_groups_and_chains(spark, monkeypatch, small):
    """The same groups whether nodes are compared as they are or dealt on and cut into tiles."""
    if small:
        monkeypatch.setattr(cp, "LEAF", 3)
        monkeypatch.setattr(cp.forests, "TILE", 4)
        monkeypatch.setattr(cp, "LEVELS", 3)
        monkeypatch.setattr(cp, "HUBS", 1)
        monkeypatch.setattr(cp, "BROADCAST_ROWS", 0)
    rows = borderline(random.Random(6))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert found(df) == wanted(rows)


def test_values_agree_as_sets_do():
    rng = np.random.default_rng(1)
    near, least = [], cp.least_agreement(85)
    for _ in range(400):
        x = np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64))
        y = np.concatenate([x[24:], rng.integers(0, 1 << 62, 24).astype(np.uint64)])
        a, b = cp.minwise([x, np.sort(y)])
        near.append(np.count_nonzero(a == b))
    assert abs(np.mean(near) / cp.VALUES - 276 / 324) < 0.01 and min(near) >= least
    assert (cp.minwise([np.empty(0, np.uint64), x])[0] == 0).all()


def test_recall_of_trees_at_the_threshold(spark, monkeypatch):
    """Pairs just above the threshold, in nodes that are dealt on, and without help from hubs."""
    monkeypatch.setattr(cp, "LEAF", 2)
    monkeypatch.setattr(cp._Join, "through_hubs", lambda self, members: spark.createDataFrame([], "a long, b long"))
    rng, rows = random.Random(8), []
    common = " ".join(f"c{i}" for i in range(300))
    for i in range(150):
        own = [f"p{i}x{j}" for j in range(290)]
        rows.append((2 * i, " ".join(own) + " " + common))
        own[:40] = [f"q{i}x{j}" for j in range(40)]
        rows.append((2 * i + 1, " ".join(own) + " " + common))
    got = {r.doc_id: r.component_id for r in cp.similar_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got == {d: d - d % 2 for d in got}


def test_null_repeated_and_no_rows(spark, no_docs):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (1, text), (1, text), (2, "other words of few"), (3, None), (2, text), (4, " \n"), (5, text + " more")]
    got = cp.similar_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 16, 0, True), (1, 16, 1, True), (1, 16, 1, True), (2, 1, 1, False), (2, 16, 1, False), (3, 0, 3, True),
        (4, 0, 4, True), (5, 17, 1, False),
    ]
    assert cp.similar_components(no_docs).count() == 0
    assert cp.trees_for(85, 0.999999) == 8
