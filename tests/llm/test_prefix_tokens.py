import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emberfold.llm import prefix_tokens as pt
from emberfold.llm import queries

from .conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = pt.PrefixCounter(PATH)


def count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("abcdeths'ERΣéÉ漢ﬁ 1.,!\n\t|<>　̈")) | st.characters(exclude_categories=["Cs"]), max_size=25))
def test_every_prefix_equals_the_library(text):
    got = np.cumsum(pt._steps(COUNTER, text)).tolist()
    assert got == [count(text[:i]) for i in range(1, len(text) + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text("etaoinshrdlucmfwypvbgkjqxz", min_size=1, max_size=24))
def test_words_by_both_chains(word):
    assert COUNTER.tokens(word) == count(word)
    assert COUNTER._chains(word, True)[1:] == [count(word[:i]) for i in range(1, len(word) + 1)]


def test_counts_of_documents(docs, corpus, no_docs):
    out = pt.prefix_counts(docs, PATH, store=False).collect()
    want = sorted((d, len((t or "").encode()), count(t or "")) for d, t, *_ in corpus)
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == want
    assert pt.prefix_counts(no_docs, PATH).count() == 0
    assert set(docs.columns) < set(pt.prefix_counts(docs, PATH).columns)


@pytest.mark.parametrize("budget", [0, 1, 50])
def test_budgets_without_encoding_again(docs, budget):
    counted = pt.prefix_counts(docs.filter("doc_id < 12 OR (doc_id > 900000 AND doc_id < 900009)").select("doc_id", "text"), PATH)
    for r in pt.tokens_at(pt.cut_at_budget(counted, budget), 120).collect():
        text = r.text or ""
        assert r.tokens_at == count(text[:120])
        assert count(text[: r.fits_chars]) <= budget
        assert r.fits_chars == len(text) or all(count(text[:i]) > budget for i in range(r.fits_chars + 1, min(len(text), r.fits_chars + 9) + 1))


def test_registered_query_stores_every_prefix(spark):
    out = queries.LLM_QUERIES["op8_prefix_tokens"](spark, SF)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        sums, text = np.cumsum(pt.unpack(r.prefix_steps, np.int16)), texts[r.doc_id]
        assert len(sums) == len(text) and r.over_limit == (r.n_tokens > 2048)
        assert r.n_tokens == (sums[-1] if len(sums) else 0) == count(text)
        assert r.fits_chars == max([0, *(np.flatnonzero(sums <= 2048) + 1)])
        assert all(sums[i - 1] == count(text[:i]) for i in range(1, len(text) + 1, 1 + len(text) // 3))


SPECIAL = "<|endoftext|>"


@pytest.mark.parametrize("word", [
    "\u00e91," * 3000, "a'" * 4000 + "re", "\u6f22\u5b57" * 3000, f"x{SPECIAL}" * 500, f"{SPECIAL[:-1]}\u00e9" * 300, "e\u0301x\u0301" * 2000,
    "\u1100\u1161\u11a8" * 1500, "I'LL'v'ves\u0130'\u017f\u212b\u3000\u3000'r\u00e9'l\u0301l", "a\u0323\u0307\u030a\u0323\u0344b",
])
def test_long_mixed_words_are_not_encoded_anew(word, monkeypatch):
    """No prefix is counted from its start, and all counts are those of the library."""
    monkeypatch.setattr(pt.PrefixCounter, "tokens", lambda *_: pytest.fail("encoded anew"))
    got = pt.PrefixCounter(PATH).prefixes(word)
    assert len(got) == len(word)
    for i in {*range(1, min(len(word), 60)), *range(60, len(word), 1 + len(word) // 40), len(word)}:
        assert got[i - 1] == count(word[:i]), i


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("'stmdrevlREVLS1\u00e9e\u0301\u0323\u0307\u1100\u1161\u11a8\uac00\u0130\u03a3\u212b\u0958\u09c7\u09be\u3000\xa0\x1c!<|>") ), max_size=14), st.booleans())
def test_marks_apostrophes_and_special_strings(text, special):
    text = text.replace("<", SPECIAL) if special else text
    assert np.cumsum(pt._steps(COUNTER, text)).tolist() == [count(text[:i]) for i in range(1, len(text) + 1)]


def test_pairs_of_tokens_stay_apart_as_in_their_encoding():
    rng = np.random.default_rng(5)
    tokens = sorted(t for t in COUNTER.vocab if not t.startswith("<|") and COUNTER._may_follow("", t))
    inner = [t for t in tokens if not t.endswith(pt.END)]
    some = set(inner[::9])
    pairs = [(inner[a], tokens[b]) for a, b in zip(rng.integers(0, len(inner), 4000), rng.integers(0, len(tokens), 4000))]
    pairs += [(a, a) for a in inner[::40]] + [(a, b) for a, b in COUNTER.rank if a in some and b in COUNTER.vocab and COUNTER._may_follow("", b)]
    for a, b in pairs:
        body = b.removesuffix(pt.END)
        assert COUNTER._stay_apart(a, b) == (COUNTER._encode([*a, *body[:-1], body[-1] + b[len(body) :]]) == [a, b]), (a, b)
    for t in tokens[::7] + [t for t in COUNTER.vocab if not COUNTER._may_follow("", t)][:500]:
        body = t.removesuffix(pt.END)
        assert COUNTER._may_follow("", t) == (COUNTER._encode([*body[:-1], body[-1] + t[len(body) :]]) == [t]), t
