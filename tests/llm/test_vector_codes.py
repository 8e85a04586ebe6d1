import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from snapdelta.llm import vector_codes as m


@pytest.mark.parametrize("rows, positions, entries, width, spread", [(1, 2, 1, 3, 5), (17, 3, 5, 4, 3), (700, 4, 64, 4, 30), (300, 2, 63, 1, 2), (90, 1, 64, 2, 0), (500, 1, 64, 3, 100000000)])
def test_assignment_equals_every_distance(rows, positions, entries, width, spread):
    rng = np.random.default_rng(rows)
    points = np.floor(rng.normal(size=(rows, positions, width)) * spread).astype(np.int64)
    books = np.floor(rng.normal(size=(positions, entries, width)) * spread).astype(np.int64)
    nearest = ((points[:, :, None, :] - books[None]) ** 2).sum(3).argmin(2)
    counts, sums, codes = m.assign(points, books, codes=True)
    want_counts, want_sums = np.zeros_like(counts), np.zeros_like(sums)
    for i in range(positions):
        np.add.at(want_counts[i], nearest[:, i], 1)
        np.add.at(want_sums[i], nearest[:, i], points[:, i])
    assert (codes == nearest).all() and (counts == want_counts).all() and (sums == want_sums).all()


def test_far_apart_groups_are_assigned_without_a_leaf(monkeypatch):
    """Parts near one entry each are assigned as whole nodes, by their cached sums."""
    rng = np.random.default_rng(0)
    books = (np.arange(8)[None, :, None] * 1000 + np.zeros((1, 8, 2))).astype(np.int64)
    points = (rng.integers(0, 8, (2048, 1, 1)).repeat(2, 2) * 1000 + rng.integers(-9, 9, (2048, 1, 2))).astype(np.int64)
    at = []
    monkeypatch.setattr(m, "_leaves", lambda parts, books, p, *rest, old=m._leaves: (at.extend(p), old(parts, books, p, *rest)))
    counts = m.assign(points, books)[0]
    assert counts.sum() == 2048 and len(at) < 2048 / m.LEAF


def coded(rows, parts, entries, rounds):
    """Plain Lloyd rounds over (vec_id, vector, label)."""
    fine = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not fine:
        return []
    length = len(fine[0][1])
    width = -(-length // parts)
    fine = [(i, q + [0] * (width * parts - length), label) for i, q, label in fine if len(q) == length]
    cut = lambda q: [q[p * width : p * width + width] for p in range(parts)]
    books = [[cut(q)[p] for _, q, _ in fine[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min(range(len(book)), key=lambda e: (far(part, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, q, _ in fine:
                held[nearest(cut(q)[p], books[p])].append(cut(q)[p])
            for e, some in held.items():
                books[p][e] = [sum(x) // len(some) for x in zip(*some)]
    out, total = [], defaultdict(int)
    for i, q, label in fine:
        codes = [nearest(part, books[p]) for p, part in enumerate(cut(q))]
        error = sum(far(part, books[p][e]) for p, (part, e) in enumerate(zip(cut(q), codes)))
        total[label] += error
        out.append((i, "".join(f"{e:02x}" for e in codes), error, label))
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in out), key=repr)


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def got(df, **k):
    return sorted((tuple(r) for r in m.vector_codes(df, **k).select(*COLUMNS).collect()), key=repr)


def test_codes_equal_plain_rounds_over_odd_rows(spark):
    """Nulls, ties, repeats, other lengths, extremes, clashing names; a length that parts do not divide."""
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=10) / 8], int(rng.integers(0, 3))) for i in range(150)]
    rows += [(3, rows[3][1], None), (3, rows[3][1], None), (None, rows[5][1], 1), (7, [0.0] * 10, 1), (800, None, 1), (801, [], 1), (802, [None] * 10, 1)]
    rows += [(803, [float("nan")] * 10, 1), (804, [float("inf")] * 10, 2), (805, [0.1] * 4, 2), (806, [-0.0] * 10, 0), (807, [300.25] * 10, 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, code string, _integers string").repartition(3)
    single = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v else v, label) for i, v, label in rows]
    assert got(df, parts=4, entries=16) == coded(single, 4, 16, 2)
    assert "_integers" in m.vector_codes(df, parts=4, entries=16).columns


def test_no_rows_no_label_few_rows(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert got(spark.createDataFrame([], schema)) == []
    assert got(spark.createDataFrame([(1, None, 1), (2, [None], 1)], schema)) == []
    few = [(1, [0.5] * 16, 1), (2, [0.25] * 16, 2)]
    assert got(spark.createDataFrame(few, schema)) == coded(few, 16, 64, 2)
    plain = m.vector_codes(spark.createDataFrame(few, schema).drop("label")).collect()
    assert {r["label_error"] for r in plain} == {0}
