import os

import pytest

from snapdelta.llm import token_counts as tc

pytestmark = pytest.mark.skipif(not os.path.exists(tc.VOCABULARY), reason="no vocabulary file")
TEXTS = [None, "", "a", "a", "Hello there, it's 2024!", "  a  b\n\n c" * 50, "éü𝒳 naïve", "x" * 5000, " " * 700, "word " * 3000]


@pytest.fixture(scope="module")
def vocabulary():
    return tc.read_vocabulary()


def test_suffix_sums_match_brute_force(documents, vocabulary):
    encode = tc.encoder(vocabulary).encode_ordinary
    lengths = [len(encode(t)) if t else 0 for t in TEXTS]
    histogram = tc.length_histogram(documents(TEXTS), vocabulary)
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r.n_docs == lengths.count(n)
        assert r.docs_at_least == sum(x >= n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_total == sum(min(x, n) for x in lengths)
        assert r.share_up_to == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    limits = [0, 1, 7, 100, 10**6]
    assert tc.truncated_totals(histogram, limits) == {k: sum(min(x, k) for x in lengths) for k in limits}
    middle = sorted(lengths)[4]
    assert tc.quantiles(histogram, [0.5, 1.0]) == {0.5: middle, 1.0: max(lengths)}


def test_parts_encode_to_what_the_whole_does(vocabulary, monkeypatch):
    encode = tc.encoder(vocabulary).encode_ordinary
    monkeypatch.setattr(tc, "PART", 7)
    for text in filter(None, [*TEXTS, "a  b c\n d\t e 1 f !x y's z", "it 's 12 ab  cd é f"]):
        assert [t for p in tc.parts(text) for t in encode(p)] == encode(text)


def test_plain_pattern(vocabulary):
    public = pytest.importorskip("public_tokenizers")
    import tiktoken

    own = tc.encoder(vocabulary)
    plain = tiktoken.Encoding("plain", pat_str=public.PATTERN, mergeable_ranks=own._mergeable_ranks, special_tokens={})
    for text in filter(None, [*TEXTS, "I'll we've \n\n\n x   ", "\t\t tab 'S"]):
        assert own.encode_ordinary(text) == plain.encode_ordinary(text)


def test_odd_tables(documents, vocabulary):
    docs = documents(["a b", "a b"], n_tokens=["x", "y"])
    assert [r.n_docs for r in tc.length_histogram(docs, vocabulary).collect()] == [2]
    assert tc.length_histogram(docs.limit(0), vocabulary).collect() == []
    assert tc.truncated_totals(tc.length_histogram(docs.limit(0), vocabulary), [5]) == {5: 0}
