import uuid

import pytest

from snapdelta.llm import common
from snapdelta.llm.graph import components
from snapdelta.llm.url_filters import url_filter


def pages(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")


def canonical(to):
    return f'<head><LINK href="{to}" rel=canonical></head>'


def test_parts_and_rules(spark):
    urls = [
        ("https://M.Example.NET/en/1?x#y", "m.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("http://badexample.com/de/1", "badexample.com", "/de/1", None, "allow"),
        ("a://b.example.com/de/1", "b.example.com", "/de/1", "example.com/de/", "block"),
        ("x://y.org/fr/://z", "y.org", "/fr/://z", "org/fr/", "allow"),
        ("http://x.net", "x.net", "", None, "allow"),
        ("http://x.net?/a", "x.net", "", None, "allow"),
        ("nothing", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://\u212a.NET/", "\u212a.net", "/", "net/", "block"),
    ]
    got = url_filter(pages(spark, [(u[0], None) for u in urls])).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == urls


def test_aliases_follow_links(spark):
    rows = [
        ("http://a.com/1", canonical("https://evil.net/x")),
        ("http://b.com/2", '<meta http-equiv="refresh" content="0; url=http://a.com/1?utm=1">'),
        ("http://c.com/3", canonical("//d.com/4")),
        ("http://d.com/4", ""),
        ("http://e.com/5", canonical("http://evil.net/y")),
        ("http://f.com/6", canonical("http://e.com/5")),
        ("http://ok.org/fr/7", canonical("http://e.com/5")),
        ("http://g.com/8", canonical("/9")),
        ("http://g.com/9", canonical("http://z.net/")),
        ("http://evil.net/y", None),
    ]
    got = {r.page_id: r.verdict for r in url_filter(pages(spark, rows)).collect()}
    # 4, 5, 6 share a group with an explicitly allowed address; 9 keeps its own rule.
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "block"}


def test_odd_tables(spark):
    twice = pages(spark, [("http://a.net/", None)]).selectExpr("*", "'x' as host", "1 as verdict")
    out = url_filter(twice.unionByName(twice))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"] and out.count() == 2
    assert url_filter(twice.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(i, (i * 7) % 50) for i in range(60)], [(2, 1), (1, 2), (None, 3)]])
def test_components(spark, edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(x, root(x)) for x in parent}
    assert len(got) == len(parent)


def test_every_link_is_an_edge(spark):
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        ("http://a.com/1", refresh.format("http://b.com/plain") + canonical("http://evil.net/x")),
        ("http://b.com/plain", ""),
        ("http://c.com/d/e/1.html?x=/y", canonical("page.html")),
        ("http://c.com/d/e/page.html", refresh.format("../up.html") + refresh.format("http://f.com/")),
        ("http://c.com/d/up.html", canonical("?id=1") + canonical("http://evil.net/z")),
        ("http://f.com", canonical("mailto:x@evil.net")),
        ("http://g.com", canonical("a/./b/../c")),
        ("http://g.com/a/c", canonical("/../q/..")),
        ("http://g.com/", canonical("http://evil.net/")),
        ("http://h.com/go", canonical("/to?u=http://evil.net/")),
        ("http://h.com/i", canonical("#top") + canonical("http://h.com/go")),
        (None, canonical("page.html") + canonical("http://evil.net/")),
    ]
    got = {r.page_id: r.verdict for r in url_filter(pages(spark, rows)).collect()}
    assert got == dict.fromkeys(range(9), "block") | dict.fromkeys((9, 10, 11), "allow")


def test_only_visible_links_count(spark):
    evil = "http://evil.net/"
    rows = [
        ("http://a.com/1", f"<!-- {canonical(evil)} -->"),
        ("http://a.com/2", f"<script>'{canonical(evil)}'</script><style>{canonical(evil)}</style>"),
        ("http://a.com/3", f"<!-- never closed {canonical(evil)}"),
        ("http://a.com/4", f"<!-- a --> {canonical(evil)} <!-- b -->"),
        ("http://a.com/5", f'<link rel="alternate canonical" href="{evil}">'),
        ("http://a.com/6", f'<link rel="alternate" title="canonical" href="{evil}">'),
        ("http://a.com/7", f'<base href="{evil}x/"><link rel=canonical href="7">'),
        ("http://a.com/8", '<base href="/b/">' + canonical("4") + canonical("../4")),
        ("http://a.com/9", "<link " + "x" * 200_000 + " rel=canonical" + "<!--" * 20_000),
    ]
    got = {r.page_id: r.verdict for r in url_filter(pages(spark, rows)).collect()}
    assert got == {0: "allow", 1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "block", 8: "allow"}


def test_no_tables_are_left(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _, purpose: f"{tmp_path}/{purpose}-{uuid.uuid4().hex}")
    rows = [("http://a.com/1", canonical("http://evil.net/")), ("http://b.com/1", canonical("http://a.com/1"))]
    out = url_filter(pages(spark, rows))
    assert sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()) == ["url-blocked", "url-pages"]
    assert {r.verdict for r in out.collect()} == {"block"}
    with common.scratch(spark):
        assert url_filter(pages(spark, rows)).count() == 2
    assert len(list(tmp_path.iterdir())) == 2
    with pytest.raises(ValueError), common.scratch(spark):
        common.kept(out, "lost")
        raise ValueError
    assert len(list(tmp_path.iterdir())) == 2
