import random
import re

import pytest
from pyspark.sql import functions as F

from snapdelta.llm.decontaminate import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        size = min(window, len(x))
        for j in range(len(x) - size + 1 if size else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == x[j : j + size]:
                    hit |= set(range(i, i + size))
                    found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "The", "é𝒳", "x9", "of"])
    items = [(i, rng.choice([" ", ", ", "\n"]).join(word() for _ in range(rng.choice([10, 11, 25, 60])))) for i in range(12)]
    items += [(20, "short item"), (21, "a, b. the of a b the"), (22, None), (23, "..."), (24, items[0][1]), (0, items[1][1]), (100, items[2][1].upper())]
    texts = [None, "", "...", items[0][1], "it is a Short--Item."]
    for _ in range(60):
        part = words(rng.choice(items)[1])
        at = rng.randrange(max(1, len(part)))
        inside = part[at : at + rng.choice([5, 9, 10, 12, 30])]
        texts.append(" ".join([*(word() for _ in range(rng.randint(0, 30))), *inside, *(f"u{rng.random()}" for _ in range(rng.randint(0, 3))), *inside[:9]]))
    return texts, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hits_match_brute_force(spark, documents, seed):
    texts, items = corpus(seed)
    for bench in (items, items[:12]):
        got = contamination(documents(texts), spark.createDataFrame(bench, "item_id long, text string")).collect()
        for r in got:
            assert (r.n_words, r.n_hit, r["items"]) == brute(texts[r.doc_id], bench), texts[r.doc_id]
            assert r.contaminated == (r.n_hit > 0)
        assert len(got) == len(texts)


def test_long_text(spark, documents):
    item = " ".join(f"q{i}" for i in range(30))
    text = " ".join(f"w{i}" for i in range(300_000)) + " " + item + " " + "z" * 2_000_000
    got = contamination(documents([text]), spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert (got.n_words, got.n_hit, got["items"]) == (300_031, 30, ["1"])


def test_odd_tables(spark, documents):
    bench = spark.createDataFrame([(1, " ".join("abcdefghijkl"))], "item_id long, text string")
    docs = documents([" ".join("abcdefghijkl"), "x", None], items=["x"] * 3)
    docs = docs.unionByName(docs)
    out = contamination(docs, bench)
    assert out.count() == 6 and sorted(r.n_hit for r in out.collect()) == [0, 0, 0, 0, 12, 12]
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).collect()) == [1, 1, 2, 2]
    assert drop_contaminated(docs, bench).columns == docs.columns
    assert contamination(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in contamination(docs, bench.limit(0)).collect()} == {0}
    null_id = bench.withColumn("item_id", F.lit(None).cast("long"))
    assert sorted((r.n_hit, r["items"]) for r in contamination(docs, null_id).collect())[-1] == (12, [])


def test_contaminated_rows_go_whatever_other_columns_there_are(spark, documents):
    bench = spark.createDataFrame([(1, " ".join("abcdefghijkl"))], "item_id long, text string")
    docs = documents([" ".join("abcdefghijkl"), "x", None], component_id=["p", "q", "r"], _x_id=["s", "t", "u"], _row=["v", "w", "x"])
    out = drop_contaminated(docs, bench)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.component_id, r["_x_id"], r["_row"]) for r in out.collect()) == [(1, "q", "t", "w"), (2, "r", "u", "x")]
