import re

from snapdelta.llm.quality_rules import quality_rules


def brute(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text) if x]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t ", "one", "a b c", "a b c a b c", "a a a a a", "x\x0by\x1cz\x85w", "l1 x\nl1 x\n \n \nl2", "é𝒳 <b>&amp;</b> ## né",
    "a b c d a b c e f a b", "word " * 300, " ".join(f"the w{i}" for i in range(60)), " ".join(str(i % 7) for i in range(2000)),
]


def test_counts_match_brute_force(documents):
    rows = quality_rules(documents(TEXTS)).select("doc_id", "quality.*").collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_each_rule_names_what_it_fails(documents):
    plain = " ".join(f"the wo{i} of" for i in range(40))
    texts = [plain, plain + " #|" * 60, plain + " x!!" * 120, " ".join(f"zq{i}" for i in range(80)), None, "short text", "the same line of words\n" * 30]
    failed = {r.doc_id: set(r.failed) for r in quality_rules(documents(texts)).select("doc_id", "quality.failed").collect()}
    assert failed[0] == set()
    assert "symbols" in failed[1] and "shouting" in failed[2] and failed[3] == {"stop_words"}
    assert {"length"} <= failed[4] and "length" in failed[5]
    assert {"repeated_lines", "repeated_words"} <= failed[6]


def test_odd_tables(documents, spark):
    clash = documents(["a b", "a b"], quality=["q", "q"], _w=["x", "x"])
    out = quality_rules(clash)
    assert [r.quality.n_words for r in out.collect()] == [2, 2]
    assert quality_rules(clash.limit(0)).count() == 0
