import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from emberfold.llm import line_simjoin as ls
from emberfold.llm.common import pack

from .conftest import words


def brute(rows, percent=80, fewest=1):
    """Texts without the lines that an earlier line matches."""
    lines = {}
    for doc_id, text in rows:
        if doc_id is not None:
            for no, line in enumerate((text or "").split("\n")):
                own = frozenset(words(line))
                if len(own) >= fewest:
                    lines.setdefault((doc_id, no), set()).add(own)
    gone, index, sets = set(), {}, {}
    for place in sorted(lines):
        for own in lines[place]:
            shared = Counter(k for w in own for k in index.get(w, ()))
            if any(100 * n >= percent * (len(own) + len(sets[k]) - n) for k, n in shared.items()):
                gone.add(place)
        for own in lines[place]:
            if own not in sets.values():
                sets[len(sets)] = own
                for w in own:
                    index.setdefault(w, []).append(len(sets) - 1)
    out = []
    for doc_id, text in rows:
        if text is not None:
            text = "\n".join(x for no, x in enumerate(text.split("\n")) if (doc_id, no) not in gone)
        out.append((doc_id, text))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))


@pytest.mark.parametrize("hubs", [256, 1])
def test_corpus_equals_brute_force(docs, corpus, monkeypatch, hubs):
    monkeypatch.setattr(ls, "HUBS", hubs)
    monkeypatch.setattr(ls, "PARTNERS", 4 if hubs > 99 else 1)
    monkeypatch.setattr(ls, "WORDS_PER_SHARD", 20_000)
    monkeypatch.setattr(ls, "BLOCK_BYTES", 1 << 17)
    out = ls.dedup_lines(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert order((r.doc_id, r.text) for r in rows) == order(brute([c[:2] for c in corpus]))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


@pytest.mark.parametrize("hubs", [256, 2])
def test_near_lines_around_the_threshold(spark, monkeypatch, hubs):
    monkeypatch.setattr(ls, "HUBS", hubs)
    monkeypatch.setattr(ls, "PARTNERS", 4 if hubs > 99 else 1)
    rng = random.Random(9)
    rows = []
    for size in (4, 5, 6, 10, 20, 60):
        base = [f"w{size}x{i}" for i in range(size)]
        for _ in range(60):
            line = [w if rng.random() > 0.08 else f"new{rng.randint(0, 30)}" for w in base]
            rng.shuffle(line)
            rows.append(" ".join(line).title())
    rng.shuffle(rows)
    texts = [(i // 2, "\n".join(rows[i * 3 : i * 3 + 3])) for i in range(len(rows) // 3)] + [(None, rows[0]), (5, None)]
    df = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(3)
    assert order(map(tuple, ls.dedup_lines(df).collect())) == order(brute(texts))


def test_no_rows_and_short_lines(spark, no_docs):
    assert ls.dedup_lines(no_docs).count() == 0
    rows = [(1, "a b\n\nc"), (2, "a b\n \nC c"), (3, "All rights reserved.\nall RIGHTS reserved."), (4, "x y z v w"), (5, "x y z v"), (6, " ")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert sorted(map(tuple, ls.dedup_lines(df).collect())) == [
        (1, "a b\n\nc"), (2, " "), (3, "All rights reserved."), (4, "x y z v w"), (5, ""), (6, " "),
    ] == brute(rows)
    longer = ls.dedup_lines(df, min_words=3).collect()
    assert sorted(map(tuple, longer))[1] == (2, "a b\n \nC c") and sorted(map(tuple, longer)) == brute(rows, fewest=3)


def test_only_chosen_lines_of_a_block_are_listed():
    """Lines removed by a pair are looked up in their block; the others are not listed at all."""
    docs, lines = np.repeat(np.arange(5), 4), np.tile(np.arange(4, dtype=np.int32), 5)
    row = {"block": 0, "docs": pack(docs), "lines": pack(lines), "chosen": [7, 2]}
    out = pa.Table.from_batches(ls._line_places([pa.RecordBatch.from_pylist([row])]))
    assert out.to_pylist() == [{"doc": 1, "line": 3}, {"doc": 0, "line": 2}]


def test_order_of_tokens_is_stable():
    keys = np.random.default_rng(1).integers(0, 50, 1000).astype(np.uint64) << np.uint64(30)
    assert (ls._sorted_order(keys) == np.argsort(keys, kind="stable")).all()
    assert len(ls._sorted_order(keys[:0])) == 0


@pytest.mark.parametrize("low", [0, -(1 << 62)])
def test_orders_and_parities_equal_the_plain_forms(low):
    """Ids far apart do not fit into one number with their places; signatures may begin alike."""
    rng = np.random.default_rng(4)
    doc = rng.integers(0, 40, 3000) + np.where(rng.random(3000) < 0.5, low, -low // 2)
    line = rng.integers(0, 30, 3000).astype(np.int32)
    assert (ls._place_order(doc, line) == np.lexsort((line, doc))).all()
    for a in (rng.integers(0, 9, 3000), rng.integers(0, 9, 3000) << 50):
        a, b = a.astype(np.uint64), rng.integers(0, 2 if low else 1, 3000).astype(np.uint64)
        order, new = ls._by_set(doc, line, a, b)
        want = np.lexsort((line, doc, b, a))
        assert (order == want).all() and new.sum() == len(set(zip(a.tolist(), b.tolist())))
    assert len(ls._place_order(doc[:0], line[:0])) == 0
    sets = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in rng.integers(1, 30, 5000)]
    got = ls._wide_parities(np.concatenate(sets), np.array([len(s) for s in sets]))
    for s, data in zip(sets, got):
        spots = np.bincount((ls.mix64(s ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - ls.WIDE_BITS)).astype(int), minlength=1 << ls.WIDE_BITS)
        assert data == len(s).to_bytes(4, "little") + np.packbits(spots & 1).tobytes()
