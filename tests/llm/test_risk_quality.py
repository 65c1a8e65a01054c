import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberfold.llm import risk_quality as rq
from emberfold.llm.common import table

from .conftest import SF, WORD


def counts(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force(docs, corpus):
    out = docs.select("doc_id", "text", rq.measures(F.col("text")).alias("m")).collect()
    assert len(out) == len(corpus)
    for r in out:
        m = r.m
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == counts(r.text), r.doc_id


@pytest.mark.parametrize(("n", "alpha", "level"), [(1, 0.02, 0.05), (200, 0.02, 0.0125), (5000, 0.02, 0.01), (100, 0.5, 0.3)])
def test_binomial_limit(spark, n, alpha, level):
    got = spark.range(1).select(rq._most_allowed(F.lit(n).cast("long"), alpha, F.lit(level))).collect()[0][0]
    cdf, want = 0.0, -1
    for k in range(n + 1):
        cdf += math.comb(n, k) * alpha**k * (1 - alpha) ** (n - k)
        if cdf > level:
            break
        want = k
    assert got == want


def scored(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, stratum STRING, score DOUBLE")


def test_cutoffs_hold_the_risk_per_stratum(spark):
    rows = [(i, "a", 0.1 if i % 100 else 3.9) for i in range(3000)] + [(i + 5000, "a", 9.0) for i in range(100)]
    rows += [(i + 10_000, "b", 0.1 if i % 10 else 9.0) for i in range(1000)] + [(i + 20_000, "b", 9.0) for i in range(100)]
    rows += [(i + 30_000, s, 0.2) for i, s in enumerate("cd" * 150)] + [(40_000 + i, "cd"[i % 2], 5.0) for i in range(20)]
    rows += [(i + 60_000, s, 0.2) for i, s in enumerate("fg" * 300)] + [(45_000 + i, "fg"[i % 2], 5.0) for i in range(20)]
    rows += [(50_000, None, 1.0), (50_001, "e", 7.0)]
    labels = spark.createDataFrame(
        [(r[0], 0 if (5000 <= r[0] < 10_000 or 20_000 <= r[0] < 30_000 or 40_000 <= r[0] < 60_000) else 1) for r in rows if r[0] != 50_001]
        + [(0, 0), (0, 1), (99_999, 1), (None, 1), (7, None)], "doc_id BIGINT, quality INT",
    )
    cut = {r.stratum: r.cutoff for r in rq.choose_cutoffs(scored(spark, rows), labels).collect()}
    # b loses a tenth of its good documents at any cutoff below 9; the others' junk goes.
    assert "b" not in cut and "e" not in cut
    # c and d have 150 good labels each, too few to certify anything alone; f and g have 300.
    assert "c" not in cut and "d" not in cut
    assert 3.9 <= cut["a"] < 9 and 0.2 <= cut["f"] < 5 and 0.2 <= cut["g"] < 5


def test_small_strata_reject_nothing(spark):
    """A stratum is certified by its own labels alone: ten good labels allow no rejection."""
    rows = [(i, "abcde"[i % 5], 0.1) for i in range(1500)] + [(2000 + i, "abcde"[i % 5], 8.0) for i in range(50)]
    rows += [(3000 + i, "z", 8.0) for i in range(10)] + [(3100, "z", 9.0)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 2000 or 3000 <= r[0] < 3100)) for r in rows], "doc_id BIGINT, quality INT")
    found = {r.stratum: r.cutoff for r in rq.choose_cutoffs(scored(spark, rows), labels).collect()}
    assert sorted(found) == list("abcde") and all(0.1 <= c < 8 for c in found.values())
    # Fewer than log(delta / strata) / log(1 - alpha) good labels certify nothing.
    few = labels.filter("doc_id < 1000 OR doc_id >= 2000")
    assert rq.choose_cutoffs(scored(spark, rows), few).count() == 0


def test_report_and_filter_agree(docs, corpus, no_docs, spark):
    labels = table(spark, SF, "labels")
    report = rq.quality_report(docs, labels)
    kept = rq.keep_good(docs, labels)
    assert kept.columns == docs.columns and report.count() == len(corpus)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in report.filter("kept").collect())
    for r in report.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert rq.keep_good(no_docs, labels).count() == 0
    only_base = rq.quality_report(docs, labels.limit(0))
    assert only_base.filter("kept = base_failed").count() == 0


def test_plan_is_native(docs, spark):
    plan = rq.keep_good(docs, table(spark, SF, "labels"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
