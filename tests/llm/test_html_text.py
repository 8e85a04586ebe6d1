import html
import random
import re

from snapdelta.llm.html_text import blocks, extract_text, main_text, path_ratios

SPACES = re.compile(r"\s+")

PAGE = (
    '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar">'
    "<nav><ul><li><a href=/x>Home</a></li></ul></nav><!-- ad --><div class='ad'>Buy now.</div>"
    "<article><h1>Head &lt;1&gt;</h1><p><b>First</b>\n\n text&nbsp;here.<br><p>Second, &#233;&#x1D4B3; one<p>"
    "<div class='comments'><p>Great post!</p></div><form><input><label>Mail</label></form></article>"
    "<aside>More</aside><footer>&copy; site</footer></body></html>"
)


def test_article_without_the_rest():
    assert main_text(PAGE) == "Head <1> First text here. Second, é𝒳 one"


def test_ratios_decide_without_an_article():
    body = "".join(f"<p>{'Long and plain sentence, with stops. ' * 6}</p>" for _ in range(4))
    page = f"<body><table><tr><td>x</td><td>y</td></tr></table><div><section>{body}</section></div><div><span>tiny</span></div></body>"
    assert main_text(page) == " ".join(["Long and plain sentence, with stops. " * 6] * 4).replace("  ", " ").strip()


def test_generated_pages_round_trip():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé𝒳&<>\"'") for _ in range(rng.randint(1, 8)))
    for _ in range(200):
        blocks = [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 8))]
        inner = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<div><p><b>{}</b></p></div>"]).format(html.escape(b)) for b in blocks)
        page = f"<html><body><nav><p>{word()}</p></nav><article>{inner}</article><footer><p>{word()}</p></footer></body></html>"
        assert main_text(page) == " ".join(blocks)


def test_broken_and_hostile_pages_end():
    for page in ("<p " * 50_000, "<" * 100_000, "<!--" * 50_000, "<a href=\"" * 50_000, "<p>x" * 50_000, "</p>" * 50_000, "&amp" * 50_000, "<div>" * 3000 + "x", "<div>x" * 20_000, "<b>x" * 20_000, "<math>x" * 20_000):
        main_text(page)
    assert main_text("<article><p>cut of") == "cut of"
    assert main_text("<article>a<script>never closed") == "a"


def test_odd_tables(spark):
    rows = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 2), (3, "u", PAGE, 3), (3, "u", PAGE, 3)], "page_id long, url string, html string, n_chars int")
    out = extract_text(rows)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id, r.text, r.n_chars) for r in out.collect())
    assert got[:2] == [(1, "", 0), (2, "", 0)] and got[2] == got[3] == (3, main_text(PAGE), len(main_text(PAGE)))
    assert extract_text(rows.limit(0)).count() == 0


LONG = "Long and plain sentence, with stops and words. " * 8


def test_ratios_decide_beside_articles():
    teasers = "".join(f"<article><h3>t{i}</h3></article>" for i in range(4))
    body = "".join(f"<p>{LONG}</p>" for _ in range(3))
    want = " ".join([LONG.strip()] * 3)
    assert main_text(f"<body><nav><p>Home</p></nav><div>{body}</div>{teasers}<footer><p>end</p></footer></body>") == want
    # Each article has a ratio of its own, within main too.
    assert main_text(f"<body><main><article>{body}</article>{teasers}</main></body>") == want


def test_marked_parts_are_weighed():
    body = "".join(f"<p>{LONG}</p>" for _ in range(3))
    want = " ".join([LONG.strip()] * 3)
    assert main_text(f"<body><form><ul><li>Home</li><li>News</li></ul><div>{body}</div></form></body>") == want
    assert main_text(f"<body><div>{body}</div><div class=comments><p>{LONG * 4}</p></div></body>") == want


SHORT = "<h2>Head</h2><ul><li>one</li><li>two</li></ul>"


def test_headings_lists_and_cells_stay_with_their_text():
    """No article element: short blocks within the element that holds the content, or between content in the body, are content."""
    para, text = f"<p>{LONG}</p>", LONG.strip()
    cells = "<table><tr><th>a</th><td>3</td></tr></table>"
    want = f"{text} Head one two {text} a 3"
    assert main_text(f"<body><nav><a>Home</a></nav><div>{para}{SHORT}{para}{cells}</div><div><span>tiny</span></div></body>") == want
    assert main_text(f"<body><h1>Title</h1>{para}{SHORT}{para}<div><span>tiny</span></div></body>") == f"Title {text} Head one two {text}"
    # A block of links between two parts of the content is none.
    assert main_text(f"<body><div>{para}</div><div class=nav>{SHORT}</div><div>{para}</div></body>") == f"{text} {text}"
    assert main_text(f"<body><div>{para}<p>so</p>{para}</div></body>") == f"{text} so {text}"


def test_formulas_and_objects_stay_in_their_line():
    page = "<article><p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> and <svg><text>9</text></svg>, <object>fallback</object>.</p></article>"
    assert main_text(page) == "Energy E=m and 9, fallback."
    assert main_text("<article><p>a <math><mi>b") == "a b"


def test_class_names_that_may_be_topics_do_not_cost_a_paragraph():
    text = LONG.strip()
    for mark in ("class='related-work'", "class='share'", "id='form-of-life'", "class='newsletter-history'"):
        assert main_text(f"<article><p>{LONG}</p><div {mark}><p>{LONG}</p></div><p>{LONG}</p></article>") == f"{text} {text} {text}"
    for mark in ("class='ad'", "class='cookie-notice'", "id='comments'", "role=navigation", "class='x site-footer'"):
        assert main_text(f"<article><p>{LONG}</p><div {mark}><p>{LONG}</p></div></article>") == text
    assert main_text(f"<article><p>{LONG}</p></article><div class=share><a>Tweet</a></div><div class=related><ul><li>More</li></ul></div>") == text


def test_ratios_change_pages_without_marks():
    """Left out, the ratios would keep what they drop: on pages without a class, an article or a telling element."""
    rng = random.Random(8)
    changed = 0
    for _ in range(60):
        body = "".join(f"<p>{'Plain words, and a stop. ' * rng.randint(8, 20)}</p>" for _ in range(rng.randint(2, 6)))
        links = "".join(f"<div><a>{'l' * rng.randint(2, 9)}</a></div>" for _ in range(rng.randint(3, 9)))
        got = main_text(f"<body><div><div>{links}</div></div><div><section>{body}</section></div><div><div>{links}</div></div></body>")
        assert got == SPACES.sub(" ", re.sub("<[^>]*>", " ", body)).strip()
        changed += "ll" in links
    assert changed


def test_ratios_equal_a_plain_computation():
    """Path ratios from a page's blocks, written out by hand: means per path, smoothed with both neighbours, fused, weighed."""
    page = f"<body><nav><a>Home, now</a></nav><div><p>{LONG}</p><p>Short. One.</p></div><div class=share><p>Tell it!</p></div></body>"
    found = blocks(page)
    ratios, least = path_ratios(found)
    paths = list(dict.fromkeys((p, o, a) for p, _, o, a, _ in found))
    assert [p[0] for p in paths] == [("body", "nav"), ("body", "div", "p"), ("body", "div", "p")] and [p[1] for p in paths] == [2, 0, 1]
    size, stops = [9, (len(LONG.strip()) + 11) / 2, 8], [1, (16 + 2) / 2, 1]
    around = lambda v: [0.8 * v[0] + 0.1 * v[1], 0.8 * v[1] + 0.1 * (v[0] + v[2]), 0.8 * v[2] + 0.1 * v[1]]
    weight = [0.001, 1.0, 0.3]
    want = [w * a * (1 + b) for w, a, b in zip(weight, around(size), around(stops))]
    assert all(abs(ratios[p] - w) < 1e-9 for p, w in zip(paths, want)) and abs(least - 0.2 * sum(want) / sum(weight)) < 1e-9
