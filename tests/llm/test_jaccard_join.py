import random
import re

import pytest
from pyspark.sql import functions as F

from snapdelta.llm.jaccard_join import jaccard_groups, one_per_group


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def corpus(seed, vocabulary):
    """Bases with chains of edits, exact copies, subsets, one passage in many texts, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.random() ** 3 * vocabulary)}"
    passage = [f"p{i}" for i in range(25)]
    texts = [None, "", " \n", "one", "One", "one two", "one two three", "one two three"]
    for _ in range(8):
        base = [word() for _ in range(rng.choice([4, 12, 40, 120]))]
        for _ in range(rng.randint(1, 14)):
            texts.append(" ".join(base))
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                base = list(base)
                base[rng.randrange(len(base))] = rng.choice([word(), f"u{rng.random()}"])
    for _ in range(20):
        own = [word() for _ in range(rng.randint(1, 30))]
        texts.append(" ".join(own + passage if rng.random() < 0.5 else passage + own))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "vocabulary", "k", "percent"), [(1, 5000, 3, 90), (2, 30, 3, 90), (3, 8, 2, 80), (4, 5000, 5, 80), (5, 300, 3, 70)])
def test_components_match_brute_force(documents, seed, vocabulary, k, percent):
    texts = corpus(seed, vocabulary)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(documents(texts), k, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, k, percent)


def test_large_group_of_near_copies(documents):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(140)]
    texts = []
    for i in range(250):
        words = list(base)
        for j in range(rng.randint(0, 6)):
            words[rng.randrange(140)] = f"x{i}-{j}"
        texts.append(" ".join(words))
    for k, percent in ((3, 90), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(documents(texts), k, percent).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, k, percent)


def test_one_of_each_group_stays(documents):
    texts = corpus(11, 400)
    docs = documents(texts, lang=["x"] * len(texts))
    docs = docs.unionByName(docs.where("doc_id % 5 = 0"))
    out = one_per_group(docs, 5, 80)
    assert out.columns == docs.columns
    groups = brute(texts, 5, 80)
    want = [i for i, (n, root) in enumerate(groups) if n and root == i] + [i for i, (n, _) in enumerate(groups) if not n for _ in range(1 + (i % 5 == 0))]
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_odd_tables(documents):
    docs = documents(["a b c d", "a b c d", None], component_id=["x"] * 3, _row=["y"] * 3)
    out = jaccard_groups(docs, 3, 90).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == [(0, 2, 0), (1, 2, 0), (2, 0, 2)]
    assert jaccard_groups(docs.limit(0)).count() == 0 and one_per_group(documents([]) if False else docs.drop("_row").limit(0)).count() == 0
    nulls = jaccard_groups(docs.withColumn("doc_id", F.when(F.col("doc_id") == 1, 1)), 3, 90).collect()
    assert sorted((r.component_id is None, r.n_shingles) for r in nulls) == [(False, 2), (False, 2), (True, 0)]


def test_copies_go_whatever_other_columns_there_are(documents):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base), " ".join(base[:-1]), "a text of its own", None]
    docs = documents(texts, component_id=list("abcde"), _x_id=list("vwxyz"), _row=list("fghij"))
    out = one_per_group(docs, 5, 80)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.component_id, r["_x_id"], r["_row"]) for r in out.collect()) == [(0, "a", "v", "f"), (3, "d", "y", "i"), (4, "e", "z", "j")]
    back = docs.drop("component_id").join(jaccard_groups(docs, 5, 80).select("doc_id", "component_id"), "doc_id")
    assert sorted(r.doc_id for r in one_per_group(back, 5, 80).collect()) == [0, 3, 4]
