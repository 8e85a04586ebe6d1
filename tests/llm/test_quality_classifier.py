import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdelta.llm import quality_classifier as qc


def made(n, seed):
    """Texts that are good but for, in the bad ones, a passage of symbols somewhere."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([20, 150, 400]))]
        bad = rng.random() < 0.4
        if bad:
            at = rng.randrange(len(words))
            words[at : at + 40] = [w + rng.choice(["###", "|", "%%"]) for w in words[at : at + 40]]
        out.append((i, " ".join(words), int(not bad)))
    return out


def test_held_out_accuracy(spark):
    rows = made(700, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    model = qc.train(docs, labels)
    out = {r.doc_id: r for r in qc.score_texts(docs, model).withColumn("held", qc.held_out(F.col("doc_id"))).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {r[0] for r in held} == {i for i, r in out.items() if r.held} and len(held) > 80
    assert sum((out[i].score >= 0.5) == bool(q) for i, _, q in held) >= 0.97 * len(held)
    again = qc.train(docs.repartition(5), labels.repartition(3))
    assert all(np.array_equal(a, b) for a, b in zip(model, again))


def test_attention_finds_the_passage():
    rows = made(500, 2)
    model = qc.fit([qc.encode(t.encode()) for _, t, _ in rows], np.array([float(q) for *_, q in rows]))
    bag = qc.encode((" ".join(["plain"] * 64 * 5 + ["bad###"] * 64 + ["words"] * 64 * 4)).encode())
    x = np.clip((bag - model.mean) / model.scale, -6, 6)
    weight = qc._forward(model, x, np.array([0]), np.zeros(len(bag), int))[2]
    assert len(bag) == 10 and weight.sum() == pytest.approx(1) and weight.argmax() == 5


def test_encoding_covers_the_whole_text(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("aZ9#é𝒳.\n") for _ in range(rng.randint(1, 12))) for _ in range(3000)).encode()
    whole = qc.encode(text)
    assert len(whole) == -(-len(text.split()) // qc.PASSAGE)
    monkeypatch.setattr(qc, "PIECE", 1000)
    assert np.allclose(qc.encode(text), whole)
    assert qc.encode(None).shape == qc.encode(b" \n").shape == (1, qc.WIDTH)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "a b", "x"), (2, "a b", "x"), (None, "c", None)], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert qc.train(docs, none) is None
    assert [r.score for r in qc.score_texts(docs, None).collect()] == [0.5] * 5
    one_class = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, quality int")
    assert qc.train(docs, one_class) is None
    model = qc.fit([qc.encode(t.encode()) for _, t, _ in made(60, 3)], np.array([float(q) for *_, q in made(60, 3)]))
    out = qc.score_texts(docs, model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    twice = [r.score for r in out if r.text == "a b"]
    assert twice[0] == twice[1]
    assert qc.score_texts(docs.limit(0), model).count() == 0


def test_one_row_of_an_id_with_all_its_passages(spark, monkeypatch):
    monkeypatch.setattr(qc, "fit", lambda bags, marks: (bags, marks.tolist()))
    rows = [r for r in made(40, 5) if zlib.crc32(str(r[0]).encode()) % 5]
    long = " ".join(f"w{i}" for i in range(qc.PASSAGE * 100 - 1))
    hot, other = rows[0][0], rows[1][0]
    docs = [r[:2] for r in rows[2:]] + [(hot, long)] * 30 + [(other, f"text {i}") for i in range(30)]
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)], "doc_id long, quality int")
    bags, marks = qc.train(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), labels)
    assert len(bags) == len(marks) == len(rows)
    assert max(map(len, bags)) == 100 and np.allclose(bags[0], qc.encode(long.encode()))
    # The bound counts passages too, and ends at whole texts.
    monkeypatch.setattr(qc, "SAMPLE_PASSAGES", 1)
    few, _ = qc.train(spark.createDataFrame(docs, "doc_id long, text string"), labels, per_class=8)
    assert 2 <= len(few) <= 16 and {b.tobytes() for b in few} <= {b.tobytes() for b in bags}
