import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from snapdelta.llm.mixing import BLOCK, apportion, mix_sources, source_targets


def brute_targets(sizes, weights=(3, 1, 2)):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        if not free:
            return {s: 2.0 * sizes[s] for s in order}
        level = (budget - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in free)
        more = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: float(2 * sizes[s] if s in full else weight[s] * level) for s in order}
        full |= more


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_brute_force(spark, seed):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(rng.randint(1, 12))] + ["é", "Z", None]
    rows = [(rng.choice(names), rng.randint(0, 10 ** rng.randint(0, 4))) for _ in range(200)]
    sizes = {}
    for s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("seed", range(4))
def test_seats_go_by_highest_quotients(spark, seed):
    rng = random.Random(seed)
    votes = [float(rng.choice([0, 5, 5, 10, rng.randint(1, 1000)])) for _ in range(15)]
    seats = rng.choice([1, 7, 40, 333])
    got = apportion(spark.createDataFrame(list(enumerate(votes)), "cell long, v double"), "v", seats, F.col("cell")).collect()
    quotients = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) if v for k in range(seats)))[:seats]
    want = [sum(i == c for _, i in quotients) for c in range(15)]
    assert [r.seats for r in sorted(got, key=lambda r: r.cell)] == want


def mix(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return docs, mix_sources(docs, **options)


@pytest.mark.parametrize("options", [{}, {"shard_words": 500, "shard_rows": 10}, {"block": 1}])
def test_taken_words_come_near_targets(spark, options):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), " ".join(["w"] * rng.choice([0, 1, 5, 60, 700]))) for i in range(400)]
    docs, mixed = mix(spark, rows, **options)
    got = mixed.collect()
    assert len(got) == 400
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert r.size == rows[r.doc_id][2].count("w") and 0 <= r.taken <= 2 * r.size
        for of, n in ((sizes, r.size), (taken, r.taken)):
            of[r.source] = of.get(r.source, 0) + n
        target[r.source] = r.target
    assert target == pytest.approx(brute_targets(sizes))
    shards = {s: max(1, -(-n // options.get("shard_words", 1 << 20)), -(-400 // options.get("shard_rows", 20000))) for s, n in sizes.items()}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= (shards[s] + 1) * 2 * options.get("block", BLOCK)
    again = mix_sources(docs.repartition(7).orderBy(F.rand(3)), **options).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_picks_equal_blocks_in_seeded_order(spark):
    """One shard, one source among two: the picked words are whole blocks of the seeded line, checked word by word."""
    rows = [(i, "a" if i < 60 else "b", " ".join(["w"] * (i % 13))) for i in range(120)]
    _, mixed = mix(spark, rows)
    by = {s: sum(r.taken for r in mixed.collect() if r.source == s) for s in "ab"}
    sizes = {s: sum(r.size for r in mixed.collect() if r.source == s) for s in "ab"}
    assert all(by[s] % BLOCK in (0, sizes[s] % BLOCK, 2 * sizes[s] % BLOCK) for s in "ab")


def test_odd_tables(spark):
    schema = "doc_id long, source string, text string, size int, taken string"
    rows = [(1, "a", None, 5, "x"), (None, None, "", 5, "x"), (1, "a", "b c", 5, "x"), (1, "a", "b c", 5, "x")]
    out = mix_sources(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert sorted(r.size for r in out.collect()) == [0, 0, 2, 2]
    assert mix_sources(spark.createDataFrame([], schema)).collect() == []
    empty = mix_sources(spark.createDataFrame([(1, "a", None, 1, "x"), (2, None, " ", 1, "y")], schema)).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0)] * 2
