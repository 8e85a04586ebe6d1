import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from snapdelta.llm import prefix_trie as m

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string"


def trie(rows):
    """All prefixes of all rebuilt conversations, by dictionaries."""
    said = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            said[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in said.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        n = len(members[k])
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((n - 1) * len(k[-1][1]) if k else 0)
        ends = hashlib.sha256(",".join(str(c) for c in sorted(members[k]) if len(whole[c]) == len(k)).encode()).hexdigest()
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, n, len(kids[k]), leaves[k], saved[k], ends))
    return sorted(out, key=repr)


def got(df, **k):
    return sorted((tuple(r) for r in m.prefix_trie(df, **k).select(*m.RESULTS).collect()), key=repr)


def odd_rows():
    rng = random.Random(3)
    ids = [None, 0, 1, 2, 3, 100, 101, 102, 150, 199, 250, -5, -100, 305, 405]
    rows = [(rng.choice(ids), rng.choice([None, 1, 2, 2, 3]), rng.choice([None, "u", "a"]), rng.choice([None, "", "é𝒳", "x"]), 1, "z") for _ in range(250)]
    rows += [(c, t, "u", f"same {t}", 1, "z") for c in range(5000, 5040) for t in range(4)]  # a group of equal conversations
    return rows + [(8100, t, "u", f"turn {t}", 1, "z") for t in range(40)] + [(8101, 1, "u", "x", 1, "z")]


def test_nodes_equal_brute_force(spark):
    """Nulls, ties, repeated rows, absent block heads, equal conversations, clashing columns."""
    rows = odd_rows()
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == trie(rows)


@pytest.mark.parametrize("counters", [64, 1 << 12])
def test_a_full_sketch_and_short_runs_change_nothing(spark, monkeypatch, counters):
    """Long conversations by runs, digests by packs, a sketch that proves next to nothing."""
    for name, value in (("SEGMENT", 64), ("RUN", 3), ("PACK", 2)):
        monkeypatch.setattr(m, name, value)
    rows = odd_rows()
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), most_counters=counters) == trie(rows)


def test_sketch_proves_only_what_is_single(spark):
    rows = odd_rows()
    paths = m.kept(m.prefixes(spark.createDataFrame(rows, SCHEMA)), "test")
    seen = m.screened(paths, m.sketch(paths, paths.count())).collect()
    times = defaultdict(int)
    for r in seen:
        times[r["depth"], r["k1"], r["k2"]] += 1
    proved = [r for r in seen if r["single"]]
    assert all(times[r["depth"], r["k1"], r["k2"]] == 1 for r in proved)
    single = sum(1 for r in seen if r["depth"] and times[r["depth"], r["k1"], r["k2"]] == 1)
    assert len(proved) > 0.9 * single > 0


def test_empty_table_and_names_of_nodes(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    nodes = m.prefix_trie(spark.createDataFrame([(3, t, "u", "hi", 0, "") for t in range(8)], SCHEMA)).collect()
    assert len({r["node"] for r in nodes}) == len(nodes) and [r["parent"] for r in nodes if r["depth"] == 0] == [None]
    assert {r["parent"] for r in nodes} - {None} <= {r["node"] for r in nodes}
