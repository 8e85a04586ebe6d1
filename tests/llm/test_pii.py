import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from snapdelta.llm.pii import IDENTIFIER, KINDS, personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def holds(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    return {"email": True, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if holds(k, m[0])] for k, p in PLAIN.items()}


TEXTS = [
    None, "", "plain words only", "a@b.c", "x a@b@c.d_e@f.g. é𝒳 q%w@z-1.co.uk,", "a@b.c._x@d.e@f.g", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.0255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4337166598464399x", "+1 (632) 555-4827 +49.30.12345678- +1 2 +123456789012345678",
    "+1 (578) 555-6437 4918187128635271 10.0.0.1 me@mail.example.com", "1" * 500 + ".2.3.4", "a." * 400 + "@b.c", "9" * 19 + " " + "4" * 16,
]


@pytest.mark.parametrize("seed", [1, 2])
def test_fixed_spans_match_plain_patterns(documents, seed):
    rng = random.Random(seed)
    pieces = ["a", "@", ".", "1", "22", "+", "-", " ", "(", ")", "b-c", "é", "𝒳", "4111111111111111", "255", "_", "%", "\n"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    for r in personal_data(documents(texts)).collect():
        want = brute(texts[r.doc_id])
        assert {k: [(s.start, s.end) for s in r[k]] for k in KINDS} == want, texts[r.doc_id]


def test_contexts_find_what_patterns_miss(documents):
    seeds = [f"please write to me at user{i}@mail{i}.example.com for more" for i in range(12)]
    unseen = ["please write to me at user77(at)mail88.example99 for more", "some 1234567 other words", "version 2.0.1234567 is out"]
    rows = {r.doc_id: r for r in personal_data(documents(seeds + unseen)).collect()}
    found = rows[12].context
    assert [(s.start, s.end, s.kind) for s in found] == [(22, 22 + len("user77(at)mail88.example99"), "email")]
    assert rows[13].context == [] and rows[14].context == []
    assert all(len(rows[i].email) == 1 and not rows[i].context for i in range(12))


def test_odd_tables(documents, spark):
    doubled = documents(["mail a@b.c", "mail a@b.c"], email=["x", "y"], lang=["en", None])
    out = personal_data(doubled.unionByName(doubled))
    assert out.count() == 4 and set(out.columns) == {"doc_id", "lang", *KINDS, "context"}
    assert [len(r.email) for r in out.collect()] == [1] * 4
    assert personal_data(doubled.limit(0)).count() == 0
    null_id = doubled.withColumn("doc_id", F.lit(None).cast("long"))
    assert personal_data(null_id).count() == 2


def test_many_spans_in_one_text(documents):
    text = " ".join(f"u{i}@h.example" for i in range(3000))
    (row,) = personal_data(documents([text])).collect()
    assert [(s.start, s.end) for s in row.email] == brute(text)["email"]


def seed_of(value):
    if re.search(PLAIN["email"], value):
        return "email"
    if re.search(PLAIN["ip"], value):
        return "ip"
    if "+" in value and re.search(PLAIN["phone"], value):
        return "phone"
    number = re.search(PLAIN["card"], value)
    return "card" if number and holds("card", number[0]) else None


def fits(kind, value):
    n, letters = len(re.sub("[^0-9]", "", value)), re.search("[A-Za-z]", value)
    return {
        "email": "@" in value or bool(letters and re.search(r"[.(\[{]", value) and n >= 6),
        "ip": bool(re.fullmatch(r"[^0-9A-Za-z]*[0-9]+(?:[^0-9A-Za-z]+[0-9]+){3}[^0-9A-Za-z]*", value)) and n >= 6,
        "card": not letters and 12 <= n <= 19,
        "phone": not letters and 6 <= n <= 15,
    }[kind]


def brute_contexts(texts, rounds=3):
    """Places of believed values by text, from dictionaries."""
    places, edges = [], defaultdict(set)
    for i, text in enumerate(texts):
        found = list(re.finditer(IDENTIFIER, text))
        for j, m in enumerate(found):
            before = text[found[j - 1].end() if j else 0 : m.start()][-80:].lower()
            after = text[m.end() : found[j + 1].start() if j + 1 < len(found) else len(text)][:80].lower()
            value = re.sub(r"[.,;:!?)\"']+$", "", m[0])
            left, right = before.split(), after.split()
            first, second = (left[-1:] or [""])[0], (left[-2:-1] or [""])[0]
            following = (right[:1] or [""])[0]
            places.append((i, m.start(), m.start() + len(value), value))
            if value and first:
                edges[f"L {second} {first}"].add(value)
                if following:
                    edges[f"M {first} _ {following}"].add(value)
    seeds = {(v, seed_of(v)): 1.0 for vs in edges.values() for v in vs if seed_of(v)}
    belief = dict(seeds)
    for _ in range(rounds):
        doubt = defaultdict(float)
        for values in edges.values():
            for kind in KINDS:
                held = [belief[v, kind] for v in values if belief.get((v, kind), 0) >= 0.8]
                if len(held) >= 2:
                    for v in values:
                        if not seed_of(v):
                            doubt[v, kind] += math.log(1 - sum(held) / (len(values) + 1))
        belief = seeds | {k: 1 - math.exp(x) for k, x in doubt.items()}
    best = {}
    for (value, kind), b in belief.items():
        if b >= 0.8 and not seed_of(value) and fits(kind, value):
            best[value] = max(best.get(value, (0, "")), (b, kind))
    out = defaultdict(set)
    for i, start, end, value in places:
        if value in best:
            out[i].add((start, end, best[value][1]))
    return out


def learned_texts(seed):
    """Sentences whose frames are typical of a kind, some frames shared by kinds; values that the fixed patterns miss among seeds."""
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    values = {
        "email": lambda: f"u{number(3)}@h{number(2)}.example", "ip": lambda: f"10.{rng.randint(0, 255)}.0.{rng.randint(0, 255)}",
        "phone": lambda: f"+49 30 {number(8)}", "card": lambda: "4111 1111 1111 1111",
    }
    missed = {
        "email": lambda: f"u{number(3)}(at)h{number(4)}.example", "ip": lambda: f"10_{rng.randint(10, 255)}_10_{rng.randint(10, 255)}",
        "phone": lambda: f"030-{number(7)}", "card": lambda: f"{number(4)}/{number(4)}/{number(4)}/{number(4)}",
    }
    frames = {
        "email": ["please write to {} for more", "his mail is {} since"], "ip": ["the host at {} was down", "ping from {} failed"],
        "phone": ["you may call {} at night", "write to {} for more"], "card": ["charged to card {} on", "pay with {} only"],
    }
    out = []
    for _ in range(260):
        kind = rng.choice(KINDS)
        value = (missed if rng.random() < 0.2 else values)[kind]()
        out.append(rng.choice(frames[kind]).format(value) + rng.choice(["", f" {number(7)}", ", " + number(3) + " times", "\nand 555-0001-77 too"]))
    return [*out, "555-0001-77 starts", "his mail is 555-0001-77 since", "555-0001-77 555-0001-78", ""]


@pytest.mark.parametrize("seed", [3, 4])
def test_learned_spans_match_brute_force(documents, seed):
    texts = learned_texts(seed)
    want = brute_contexts(texts)
    got = {r.doc_id: {(s.start, s.end, s.kind) for s in r.context} for r in personal_data(documents(texts)).collect()}
    assert {i: x for i, x in got.items() if x} == dict(want)
    assert len({kind for spans in want.values() for _, _, kind in spans}) >= 3
    assert all(kind != "email" for i in range(260, 264) for _, _, kind in got[i])
