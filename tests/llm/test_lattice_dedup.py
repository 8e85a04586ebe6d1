import itertools

import numpy as np
import pytest

from snapdelta.llm import lattice_dedup as m

SCHEMA = "vec_id long, embedding array<double>, component_id string, _h1 string, cell long"


def brute(rows, least=0.95):
    """(vec_id, n_links, component_id) of all pairs."""
    units = [None] * len(rows)
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            units[i] = x / np.linalg.norm(x)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    groups = {}
    for i, (n, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(n)
    name = {r: min(ids, key=lambda n: (n is None, n or 0)) for r, ids in groups.items()}
    return [(n, links[i], name[find(i)]) for i, (n, _) in enumerate(rows)]


def run(spark, rows, **k):
    df = spark.createDataFrame([(*r, "c", "h", 1) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in m.lattice_groups(df, **k).select("vec_id", "n_links", "component_id").collect()), key=repr)


def around(rng, dim, groups, spread, most):
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        rows += [(len(rows) + i, (centre + rng.normal(size=dim) * spread / np.sqrt(dim)).tolist()) for i in range(int(rng.integers(1, most)))]
    return rows


def test_nearest_point_of_e8():
    """Against every short vector around: none is nearer, and all points are of the lattice."""
    x = np.random.default_rng(0).normal(size=(300, 8)) * 3
    near = m.nearest_e8(x)
    steps = m.e8_neighbours()
    assert len(steps) == 240 and np.allclose((steps**2).sum(1), 2)
    doubled = 2 * near
    assert (doubled == np.rint(doubled)).all() and (near.sum(1) % 2 == 0).all() and ((doubled % 2).sum(1) % 8 == 0).all()
    mine = ((x - near) ** 2).sum(1)
    assert (((x[:, None] - near[:, None] - steps) ** 2).sum(2) >= mine[:, None] - 1e-12).all() and (mine <= 1 + 1e-12).all()


@pytest.mark.parametrize("dim, cosine, least", [(64, 0.95, 0.9), (64, 0.97, 0.97), (16, 0.95, 0.9), (256, 0.95, 0.9)])
def test_pairs_at_the_threshold_meet_in_a_cell(dim, cosine, least):
    rng = np.random.default_rng(1)
    x = m.unit_vectors(rng.normal(size=(3000, dim)))
    z = rng.normal(size=x.shape)
    z = m.unit_vectors(z - (z * x).sum(1)[:, None] * x)
    y = cosine * x + np.sqrt(1 - cosine**2) * z
    met = np.zeros(len(x), bool)
    for t in range(m.TABLES):
        a, b = (m.cells(v, t, m.BLOCKS, m.WIDTH, m.PROBES) for v in (x, y))
        met |= (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)
    assert met.mean() >= least


def test_groups_equal_all_pairs(spark):
    """Tight groups, equal vectors, null and repeated ids, vectors that can't link, other lengths, clashing names."""
    rng = np.random.default_rng(5)
    rows = around(rng, 24, 30, 0.14, 25)
    rows += [(None, rows[0][1]), (None, rows[0][1]), (5, rows[0][1]), (7000, None), (7001, [0.0] * 24), (7002, []), (7003, [1.0, None]), (7004, [float("nan")] + [1.0] * 23)]
    rows += [(7005, [1e300] * 24), (7006, [2e300] * 24), (7007, [1.0, 2.0]), (7008, [1.0, 2.01]), (None, None), (7009, [1e-320] * 24), (7010, [-0.0, 1.0, 2.0]), (7011, [0.0, 1.0, 2.0])]
    want = sorted(brute(rows), key=repr)
    assert run(spark, rows) == want and sum(r[1] for r in want) > 2000
    kept = m.lattice_groups(spark.createDataFrame([(*r, "c", "h", 1) for r in rows], SCHEMA))
    assert set(kept.columns) == {"vec_id", "cell", "n_links", "component_id", "kept"}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in kept.collect())


def test_wide_groups_compare_members_by_blocks(spark, monkeypatch):
    """Groups that one centre does not cover: links at 0.8 across units, small blocks and few votes; recall 0.9, none too many."""
    monkeypatch.setattr(m, "SIDE", 4)
    monkeypatch.setattr(m, "VOTES", 3)
    rows = around(np.random.default_rng(6), 24, 12, 0.45, 60)
    got, want = run(spark, rows, cosine=0.8), sorted(brute(rows, 0.8), key=repr)
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(got, want))
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want) > 1000


def test_recall_on_mixed_distances(spark):
    rows = around(np.random.default_rng(7), 64, 40, 0.2, 40)
    got, want = run(spark, rows), sorted(brute(rows), key=repr)
    assert all(a[1] <= b[1] for a, b in zip(got, want))
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want) > 1000


def test_empty_table(spark):
    assert m.lattice_groups(spark.createDataFrame([], SCHEMA)).collect() == []
