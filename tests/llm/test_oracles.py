"""The registered SQL against the queries, on small tables with what the given ones lack: links, nulls, repeats, short items."""

import random

import duckdb
import pytest

from snapdelta.llm import registry
from snapdelta.llm.oracles import oracle_sql

LINK = '<link rel="canonical" href="{}">'
REFRESH = '<meta content="0; URL={}" http-equiv="Refresh">'
RANDOM = random.Random(9)
VECTORS = [[RANDOM.gauss(0, 0.2) for _ in range(32)] for _ in range(90)]
TABLES = {
    "pages": (
        "page_id bigint, url string, html string",
        [
            (1, "http://a.com/1", LINK.format("https://evil.net/x")), (2, "http://b.com/2", '<META http-equiv=refresh content="0; url=http://a.com/1?q">'),
            (3, "http://c.com/3", LINK.format("//d.com/4")), (4, "http://e.com/5", LINK.format("http://evil.net/y")),
            (5, "http://ok.org/fr/7", LINK.format("http://e.com/5#z")), (6, None, LINK.format("http://evil.net/y")), (7, "HTTP://M.Example.NET/en/?x", None),
            (7, "http://g.com", LINK.format("/rel")), (8, "http://g.com/rel", LINK.format("http://z.net/")), (9, "no url", ""),
            (10, "http://h.com/a/b/c.html?x=/y", LINK.format("../d/./e") + REFRESH.format("other") + LINK.format("mailto:x@evil.net")),
            (11, "http://h.com/a/d/e", REFRESH.format("//evil.net/z")), (12, "http://h.com/a/b/other", LINK.format("?q") + LINK.format("#top")),
            (13, "http://i.com/1", "<!-- " + LINK.format("http://evil.net/") + " --><script>" + LINK.format("http://evil.net/") + "</SCRIPT >" + LINK.format("/2")),
            (14, "http://i.com/2", "<base target=x href='http://j.com/k/'>" + LINK.format("3") + LINK.format("../..")),
            (15, "http://j.com/k/3", '<link href=http://evil.net/ rel="alternate\tCanonical  x">'), (16, "http://j.com", ""),
            (17, "http://k.com", LINK.format("http://evil.net/").replace("canonical", "canonicals") + "<link data-rel=canonical href=http://evil.net/>"),
            (18, "http://l.com/", "<!-- open " + LINK.format("http://evil.net/")), (19, "http://m.com/", "<link rel=canonical data-href=http://n.com/ href=http://evil.net/>"),
            (20, "http://o.com/p&q/", "<base href='r/'>" + LINK.format("../../p&amp;q/s")), (21, "http://o.com/p&q/s", LINK.format("http://evil.net/..")),
            (22, "http://s.org/fr/", LINK.format("http://t.com/")), (23, "http://t.com", LINK.format("http://u.com/") + LINK.format("http://evil.net/")), (24, "http://u.com/", None),
        ],
    ),
    "documents": (
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
        [
            (i, t, "en", "s", 0)
            for i, t in enumerate(
                [None, "", "One", "one", "a b", "a b c", "a b c a b c a b c", "x #*$ y\n \nx #*$ y\nx #*$ y", "w " * 60, " ".join(f"w{i}" for i in range(60)),
                 " ".join(f"w{i}" for i in range(61)), "Short--Item, k1 k2 k3 k4 k5 k6 k7 K8 k9 k10 k11 end", "é𝒳 a\x0bb\x1cc the of and", "k1 k2 k3"]
            )
        ]
        + [(4, "a b", "en", None, 0)],
    ),
    "benchmark": ("item_id bigint, text string", [(1, "short item"), (2, " ".join(f"k{i}" for i in range(1, 13))), (3, None), (None, "end"), (10, "k2 k3")]),
    "embeddings": (
        "vec_id bigint, embedding array<float>, label int",
        [(i, VECTORS[i], i % 3) for i in range(90)]
        + [(i + 200, [x + (0.02 if j == i else 0.0) for j, x in enumerate(VECTORS[i])], None) for i in range(20)]
        + [(None, [0.5] * 32, None), (300, None, 1), (301, [None] * 32, 1), (302, [float("inf")] * 32, 1), (0, [0.0] * 32, 2)],
    ),
    "conversations": (
        "conv_id bigint, turn bigint, role string, text string",
        [(c, t, "user" if t % 2 else None, None if c == 7 else f"turn {t} {c % 3}") for c in [*range(0, 30), *range(100, 130), 205, 4012] for t in range(c % 9)]
        + [(100, None, "a", "first"), (5, 2, "b", "tie"), (5, 2, "b", "tie"), (None, 1, "x", "y"), (3000, 1, "é", "𝒳")],
    ),
}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, tmp_path, name):
    duck = duckdb.connect()
    for table, (schema, rows) in TABLES.items():
        path = f"{tmp_path}/{table}.parquet"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        duck.execute(f"create view {table} as select * from '{path}/*.parquet'")
    got = registry.queries()[name](spark, str(tmp_path))
    want = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    left, right = [tuple(r) for r in got.select(*columns).collect()], want.fetchall()
    assert sorted(left, key=repr) == sorted(right, key=repr) and left
