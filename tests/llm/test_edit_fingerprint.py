import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from emberfold.llm import edit_fingerprint as ef


def mutate(rng, text, rate):
    return "".join(rng.choice("abcdefgh") if rng.random() < rate else c for c in text)


def slow_walk(text):
    """The embedding, step by step: the symbol written at every output position."""
    table, codes, state, out = ef.walk_table(), ef.classes(text).tolist(), 0, []
    for c in codes:
        steps = (table[state][c] - state - 1) % ef.PERIOD + 1
        out += [c & 15] * steps
        state = table[state][c]
    return out


def test_walk_and_sampling_equal_the_slow_form():
    for text in ("", "a", "abc" * 50, "The quick brown fox. " * 200, "漢字 é" * 99):
        codes = ef.classes(text)
        ends = np.cumsum(ef.walk(codes), dtype=np.int64)
        out = slow_walk(text)
        level, length, symbols = ef._symbols(ef.fingerprint((codes, ends)))
        assert length == len(out) and len(out) <= ef.SAMPLES * 2**level
        assert symbols.tolist() == [out[p] for p in ef.positions(level, length)]


def test_likeness_falls_with_edits():
    rng = random.Random(4)
    texts = ["".join(rng.choice("etaoin shrdlu") for _ in range(rng.randint(400, 4000))) for _ in range(40)]
    near = [np.mean([ef.likeness(ef._Document(0, t).print, ef._Document(0, mutate(rng, t, r)).print) for t in texts]) for r in (0, 0.003, 0.02, 0.1, 1)]
    assert near[0] == 1.0 and near == sorted(near, reverse=True) and near[1] > 0.8 and near[-1] < 0.3
    empty, some = ef._Document(0, "").print, ef._Document(0, "abc").print
    assert ef.likeness(empty, empty) == 1.0 and ef.likeness(empty, some) == ef.likeness(some, empty) == 0.0
    one, long = ef._Document(0, texts[0]).print, ef._Document(0, texts[0] * 9).print
    assert ef.likeness(one, long) == ef.likeness(long, one) < 0.3


def test_report_equals_brute_force(docs, corpus):
    order = sorted(((d, t or "") for d, t, *_ in corpus), key=lambda r: (-r[0], r[1]))
    want = []
    for (d, t), (_, following) in zip(order, order[1:] + order[:1]):
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        prints = [ef._Document(0, x).print for x in (t, edited, following)]
        want.append((
            d, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1],
            ef.likeness(prints[0], prints[1]), ef.likeness(prints[0], prints[2]),
        ))
    for parts in (1, 7):
        docs.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
        got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in ef.neighbour_report(docs).collect()]
        assert sorted(got) == sorted(want)
    docs.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_single_and_no_rows(spark, no_docs):
    assert ef.neighbour_report(no_docs).count() == 0
    [row] = ef.neighbour_report(spark.createDataFrame([(None, "abcd")], "doc_id BIGINT, text STRING")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0


def groups(spark, prints):
    """Group of every doc_id of a dict of fingerprints."""
    df = spark.createDataFrame(list(prints.items()), "doc_id BIGINT, fingerprint BINARY")
    found = {bytes(r.fingerprint): r.group_id for r in ef.near_groups(df).collect()}
    return {d: found[p] for d, p in prints.items()}


def test_near_groups_recall(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("etaoin shrdlu") for _ in range(1500)) for _ in range(30)]
    prints = {i * 10 + k: ef._Document(0, t if k == 1 else mutate(rng, t, 0.001 * k)).print for i, t in enumerate(base) for k in range(4)}
    out = groups(spark, prints)
    alike = [(d, d - d % 10) for d in prints if d % 10 and ef.likeness(prints[d], prints[d - d % 10]) >= 0.8]
    assert all(g // 10 == d // 10 for d, g in out.items())
    assert sum(out[a] == out[b] for a, b in alike) >= 0.9 * len(alike)
    assert all(out[i * 10 + 1] == out[i * 10] for i in range(30))


def edit(rng, text, rate):
    """Letters replaced, put in and left out."""
    out = []
    for c in text:
        what = rng.random() / rate
        out.append(c if what >= 1 else rng.choice(("", rng.choice("abcdefgh"), c + rng.choice("abcdefgh"))))
    return "".join(out)


def test_recall_in_every_band_of_likeness(spark):
    """Pairs of two, of all lengths, by their likeness: also those just at the threshold are found."""
    rng = random.Random(21)
    prints, like = {}, {}
    for i in range(1600):
        text = "".join(rng.choice("etaoin shrdlu") for _ in range(rng.choice((60, 150, 400, 1000, 3000))))
        one, other = ef._Document(0, text).print, ef._Document(0, edit(rng, text, rng.uniform(0.5, 9) / len(text))).print
        prints |= {2 * i: one, 2 * i + 1: other}
        like[i] = ef.likeness(one, other)
    out = groups(spark, prints)
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 0.95), (0.95, 1.01)):
        pairs = [i for i, s in like.items() if low <= s < high]
        assert len(pairs) >= 60
        assert sum(out[2 * i] == out[2 * i + 1] for i in pairs) >= 0.9 * len(pairs), (low, len(pairs))
    assert all(out[2 * i + 1] in (2 * i, 2 * i + 1) or like[i] > 0 for i in like)


def test_links_between_others_than_the_first_of_a_bucket(spark):
    """All pairs that share a band are verified, whoever is the bucket's first: groups by brute force."""
    rng = random.Random(5)
    base = ["".join(rng.choice("etaoin shrdlu") for _ in range(300)) for _ in range(8)]
    prints = {d: ef._Document(0, edit(rng, base[d % 8], rng.uniform(0, 0.05))).print for d in range(240)}
    out = groups(spark, prints)
    keys = {d: set(ef.band_keys(p).tolist()) for d, p in prints.items()}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in prints:
        for b in range(a):
            if keys[a] & keys[b] and ef.likeness(prints[a], prints[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert out == {d: find(d) for d in prints} and 8 < len(set(out.values())) < 240


def test_tiles_find_what_the_first_member_hides():
    """One tile: two groups beside a first member that is unlike both."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("etaoin shrdlu") for _ in range(500)) for _ in range(3)]
    prints = [ef._Document(0, t).print for t in (texts[0], texts[1], texts[1] + "x", texts[2], "y" + texts[2][1:], "")]
    n = len(prints)
    rows = pa.table({
        "node": pa.array(range(n), pa.int64()), "block": pa.array([0] * n, pa.int32()), "diagonal": [True] * n,
        "root": pa.array(range(n), pa.int64()), "fingerprint": pa.array(prints, pa.binary()),
    })
    want = {(i, j) for j in range(n) for i in range(j) if ef.likeness(prints[i], prints[j]) >= 0.8}
    got = ef._tile_links(rows, 0.8).to_pydict()
    assert set(zip(got["a"], got["b"])) == want and want


def test_report_with_groups(docs, corpus):
    """Every row of the edge cases has a group; repeated and empty texts share theirs."""
    rows = ef.fingerprint_report(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(c[0] for c in corpus)
    group = {r.doc_id: r.group_id for r in rows}
    assert group[900001] == group[900002] == 900001 and all(g <= d for d, g in group.items())
    prints = {r.doc_id: bytes(r.fingerprint) for r in rows}
    for d, g in group.items():
        assert group[g] == g and (d == g or any(ef.likeness(prints[d], prints[x]) >= 0.8 for x in group if x != d and group[x] == g))


def test_groups_without_doc_ids(spark, no_docs):
    one, other = ef._Document(0, "some text " * 9).print, ef._Document(0, "quite another").print
    df = spark.createDataFrame([(None, one), (7, one), (None, other)], "doc_id BIGINT, fingerprint BINARY")
    assert {bytes(r.fingerprint): r.group_id for r in ef.near_groups(df).collect()} == {one: 7, other: None}
    assert ef.fingerprint_report(no_docs).count() == 0


def test_very_long_text():
    """Memory beyond the arrays that are kept follows the pieces, not the output length."""
    text = "lorem ipsum dolor sit amet " * 80_000
    tracemalloc.start()
    document = ef._Document(0, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak <= 24 * len(text) + (80 << 20)
    level, length, symbols = ef._symbols(document.print)
    assert length > len(text) and abs(len(symbols) - length / 2**level) < 100 and ef.likeness(document.print, document.print) == 1
