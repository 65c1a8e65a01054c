import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberfold.llm import fim_chunks as fc

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[5]))


def test_documents_equal_brute_force(docs, corpus):
    got = [tuple(r) for r in fc.fim_documents(docs).collect()]
    assert order(got) == order([brute(r[0], r[1]) for r in corpus])


def test_markers_nulls_and_round_trip(spark, no_docs):
    texts = [None, "", " ", "\n\n", "a", "a ", "<P> x y", "x <S>", "<<M> z", "< P> <", "a<", "S> b <S <", "é è \v b", "<P", "\x00 b"]
    rows = [(i, t) for i in range(40) for t in texts] + [(None, "no id at all"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    out = fc.fim_documents(df)
    assert order([tuple(r) for r in out.collect()]) == order([brute(*r) for r in rows])
    back = out.select("doc_id", fc.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(str, back.collect())) == sorted(map(str, spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id BIGINT, text STRING").collect()))
    assert fc.fim_documents(no_docs).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 9])
def test_cuts_at_every_unit(monkeypatch, bits):
    """Counts and cuts from chunks of any size, also when all chunks fall on one cache key."""
    monkeypatch.setattr(fc, "CHUNK_BITS", bits)
    monkeypatch.setattr(fc, "PIECE", 37)
    monkeypatch.setattr(fc, "LONGEST", 5 if bits == 3 else 8192)
    monkeypatch.setattr(fc.xxhash, "xxh3_64_intdigest", lambda c: 0 if bits == 1 else hash(c))
    rng = random.Random(bits)
    texts = ["".join(rng.choice("ab é漢  \n\t") for _ in range(rng.randrange(0, 120))) for _ in range(60)] * 2
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    memo = fc.ChunkMemo(2000)
    counts = fc.UnitCounts(b"".join(raw), offsets, memo)
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        assert counts.units[i] == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert counts.cut(i, k) == (len(head.encode()), len(head))
    assert memo.hits > 0


def test_chunks_follow_content():
    """A passage inside another text gives the same chunks but for those at its ends."""
    rng = np.random.default_rng(4)
    passage, before = rng.integers(97, 123, 40_000, np.uint8), rng.integers(97, 123, 777, np.uint8)

    def chunks(data):
        ends = fc.chunk_ends(data, np.array([len(data)]))
        return {data[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)}

    alone = chunks(passage)
    assert len(alone) > 40 and len(alone - chunks(np.concatenate([before, passage]))) <= 1
