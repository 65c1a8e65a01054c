from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from emberfold.llm import oracles, queries
from emberfold.llm.common import table
from emberfold.session import cut_lineage

from .conftest import SF, WORD
from .test_best_fit_packing import check
from .test_jaccard_join import brute as groups
from .test_line_simjoin import brute as deduped
from .test_line_simjoin import order


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept, and the whole as ``run`` gives it."""
    docs, kept = table(spark, SF, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
        kept[name] = docs
    quality, lines, one, mixed, packed = kept.values()
    assert all(df.columns == columns for df in (quality, lines, one, mixed))

    report = queries.LLM_QUERIES["op7_risk_quality"](spark, SF)
    assert {r.doc_id for r in quality.collect()} == {r.doc_id for r in report.filter("kept").collect()}
    before = [(r.doc_id, r.text) for r in quality.collect()]
    assert order((r.doc_id, r.text) for r in lines.collect()) == order(deduped(before))
    before = [(r.doc_id, r.text) for r in lines.collect()]
    want = {d for d, _, c in groups(before, 5, 80) if d == c}
    assert sorted(r.doc_id for r in one.collect()) == sorted(want)
    sizes, taken = Counter(), Counter()
    for r in one.collect():
        sizes[r.source] += len(WORD.findall(r.text))
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text))
    assert abs(sum(taken.values()) - sum(sizes.values())) <= 40 * len(sizes)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packed.collect()
    texts = [(r.doc_id, r.text) for r in mixed.collect()]
    check(rows, texts, library, 1024)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(packed.columns).drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, packed.drop("sequence_id", "offset").collect())
    )


def test_registered():
    names = set(queries.LLM_QUERIES)
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))
    assert set(oracles.LLM_SQL) <= names
    assert names | {"pipeline"} <= set(entry.queries()) and set(oracles.LLM_SQL) <= set(entry.oracle_sql())
