from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from emberfold.llm import source_schedule as ss

from .conftest import WORD


def fill(sizes):
    """Targets by filling sources up in rounds."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("block", [64, 7])
def test_targets_and_taken(docs, corpus, block):
    rows = ss.mix_report(docs, block_words=block).collect()
    size = Counter()
    for _, t, _, s in corpus:
        size[s] += len(WORD.findall(t or ""))
    want, source = fill(size), {c[0]: c[3] for c in corpus}
    taken = Counter()
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((c[0], len(WORD.findall(c[1] or ""))) for c in corpus)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == size[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert sum(want.values()) == pytest.approx(sum(size.values()))
    for s in size:
        assert abs(taken[s] - want[s]) <= block / 2 + 1
    again = ss.mix_report(docs.repartition(5), block_words=block).collect()
    assert sorted((r.doc_id, r.taken, r.first_slot or 0) for r in rows) == sorted((r.doc_id, r.taken, r.first_slot or 0) for r in again)


@pytest.mark.parametrize("block", [64, 7])
def test_first_slots_spread_the_sources_evenly(docs, corpus, block):
    """Read by slot, any part of the mix holds the sources by their share of the words."""
    rows = ss.mix_report(docs, block_words=block).collect()
    assert all((r.first_slot is None) == (r.taken == 0) for r in rows)
    source = {c[0]: c[3] for c in corpus}
    by_slot = sorted((r for r in rows if r.taken), key=lambda r: r.first_slot)
    last = max(r.first_slot for r in by_slot)
    share, target = {}, {source[r.doc_id]: r.target for r in rows}
    for r in by_slot:
        share.setdefault(source[r.doc_id], []).append(r.first_slot)
    total = sum(target.values())
    assert last < total / block + len(target) + 1
    for name, slots in share.items():
        # Every source of some blocks begins about one of its own gaps after the start.
        due = target[name] / block
        if due >= 8:
            assert slots[0] <= 12 * total / target[name]
    kept = ss.mixed_documents(docs, block_words=block, slot="at")
    assert kept.columns == [*docs.columns, "at"]
    first = {}
    for r in kept.collect():
        first[r.doc_id] = min(r["at"], first.get(r.doc_id, r["at"]))
    want = {}
    for r in by_slot:
        want[r.doc_id] = min(r.first_slot, want.get(r.doc_id, r.first_slot))
    assert first == want


def test_targets_with_scarce_sources(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, "d": 0, "e": 500, None: 3}
    df = spark.createDataFrame(list(sizes.items()), "source STRING, size BIGINT")
    got = {r.source: r.target for r in ss.source_targets(df).collect()}
    assert got == {s: pytest.approx(t) for s, t in fill(sizes).items()}


def test_schedule_is_even_and_complete(spark):
    due = {1: 500, 2: 200, 3: 1, 4: 0, 5: 299}
    rows = ss.schedule(spark.createDataFrame(list(due.items()), "place INT, due BIGINT")).collect()
    ranks = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.slot):
        ranks[r.place].append(r["rank"])
    assert {p: sorted(x) for p, x in ranks.items()} == {p: list(range(n)) for p, n in due.items() if n}
    assert sorted(r.slot for r in rows) == list(range(1000))
    # Any prefix of the mix holds the sources in proportion, but for the discrepancy.
    for upto in (100, 400, 800):
        part = Counter(r.place for r in rows if r.slot < upto)
        assert all(abs(part[p] - upto * n / 1000) <= 12 for p, n in due.items())


def test_mixed_documents(docs, no_docs):
    out = ss.mixed_documents(docs)
    assert out.columns == docs.columns
    text = {(r.doc_id, r.text) for r in docs.collect()}
    size = defaultdict(int)
    for r in out.collect():
        size[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
        assert (r.doc_id, r.text) in text or any(d == r.doc_id and t and r.text in t for d, t in text)
    want = Counter()
    for r in ss.mix_report(docs).collect():
        want[r.doc_id] += r.taken
    assert {d: n for d, n in want.items() if n} == dict(size)
    assert ss.mixed_documents(no_docs).count() == 0 and ss.mix_report(no_docs).count() == 0


def test_nothing_but_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id BIGINT, text STRING, source STRING")
    assert [(r.size, r.target, r.taken) for r in ss.mix_report(df).collect()] == [(0, 0.0, 0)] * 2
    assert ss.mixed_documents(df).count() == 0
    assert ss._mirrored(F.lit(6)) is not None
