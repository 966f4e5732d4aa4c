"""Url rules and main text of pages."""

import html
import re
import time

import duckdb
import numpy as np
import pytest

from limnos.llm import pages, queries, urls
from tests.llm.conftest import SF

URLS = [None, "", "no scheme", "http://Sub.Example.NET/en/1", "http://example.net/de/", "http://net", "http://net/", "http://planet/x", "http://a.example.com/de/x?y#z", "https://x.org/fr/", "https://x.org/frx",
        "https://x.org?/fr/", "ftp://EXAMPLE.com/de", "x://y://example.net/en/", "http://casino-bonus.example/free-spins", "http://ünï.net/é" * 3, "http://h.net/" + "p" * 100_000]


def test_rules(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)], "page_id bigint, url string, host string, path string")
    for r in urls.judged(df).collect():
        u = URLS[r.page_id] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + p), h + p, v) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == max(fit)[1:] if fit else r.rule is None and r.verdict in ("allow", "block")
    assert urls.judged(df.where("1 = 0")).count() == 0
    assert urls.allowed(df).columns == df.columns


def test_model_judges_unseen_hosts():
    model = urls.train()
    blocked = lambda host, path: urls.blocked_probability(model.weights, host, path) >= model.block
    labelled = urls.labelled_urls()
    assert sum(blocked(*urls.split_url(u)) == bool(y) for u, y in labelled) / len(labelled) >= 0.98
    known = {urls.split_url(u)[0] for u, _ in labelled}
    planted = ["spam-farm.example.org", "www.cheap-pills.example.com", "www.casino-win.example.org", "m.free-bets.example.com", "m.adult-x.example.net"]
    assert not known & set(planted)
    for host in planted:
        assert all(blocked(host, path) for path in ("/", "/en/825", "/article/7", "/de/1.html", "/fr/9/", ""))
    fresh = [f"{a}{b}{c}.example.{d}" for a in ("kel", "dor", "mir", "nan") for b in ("wo", "be", "li") for c in ("ster", "ham", "ra", "mont") for d in ("org", "com", "net")]
    ordinary = [h for h in fresh if h not in known]
    assert sum(blocked(h, f"/en/{k}") for k, h in enumerate(ordinary)) / len(ordinary) <= 0.02


def test_allowed_keeps_what_is_judged_allowed(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    want = sorted(r.page_id for r in urls.judged(df).collect() if r.verdict == "allow")
    assert sorted(r.page_id for r in urls.allowed(df).collect()) == want


def test_descent_reaches_the_least_loss():
    """The weights against plain descent on the same loss, with all features as columns."""
    labelled = urls.labelled_urls()[::60]
    rows = [urls.features(*urls.split_url(u)) for u, _ in labelled]
    x = np.zeros((len(rows), 2 * urls.BUCKETS))
    for row, (own, values) in zip(x, rows):
        row[own] = values
    y, weights, bias = np.array([y for _, y in labelled], float), np.zeros(x.shape[1]), 0.0

    def loss(w, c):
        z = x @ w + c
        return float(np.mean(np.logaddexp(0, z) - y * z) + urls.RIDGE / 2 * w @ w)

    for _ in range(2000):
        error = (1 / (1 + np.exp(-(x @ weights + bias))) - y) / len(y)
        weights, bias = weights - urls.RATE * (x.T @ error + urls.RIDGE * weights), bias - urls.RATE * error.sum()
    found = urls.fit(labelled)
    assert loss(found[:-1], found[-1]) <= loss(weights, bias) + 1e-3


def plain_text(source):
    """The article of a given page, by its known form."""
    inside = source.split("<article>", 1)[1].split("</article>")[0]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", inside)]
    return " ".join(b for b in blocks if b)


def test_given_pages(spark):
    rows = duckdb.connect().sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    want = {i: plain_text(h) for i, h in rows}
    got = queries.op7_html_text(spark, SF).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="top"><h1>Site</h1></header>
<div id="nav"><a href=/>Home</a></div><div class="wrap"><div class="sidebar">Side</div><div class="post-body post-%d"><h2>Head
 line</h2><p>One&nbsp;two &lt;b&gt; <b>bo</b>ld<p>Three <a href="x">link</a><script>var x = "<p>no</p>";</script><!-- <p>no</p> -->
<ul><li>a<li>b</ul><form>no</form><div class="ad-box">no</div><div class="comments"><p>reader</p></div><p>%s</p></div></div><footer>&copy; no</footer></body></html>"""
TEXT = "Head line One two <b> bold Three link a b"


def test_other_layouts(spark):
    long = "long text here " * 40
    sources = [(1, "http://h.example/1", PAGE % (1, long)), (2, "http://h.example/2", PAGE % (2, "")), (3, None, None), (4, "http://h.example/3", ""), (5, "http://z.example", "plain text only"),
               (6, "http://y.example", "<p>a <p>b</p"), (7, "http://y.example", "<div>" * 3000 + "deep" + "<"), (2, "http://h.example/2", PAGE % (2, ""))]
    df = spark.createDataFrame([(*s, "t") for s in sources], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in pages.extracted(df).collect()}
    assert got[1] == f"{TEXT} {long.strip()}" and got[2] == TEXT
    assert got[3] == got[4] == "" and got[5] == "plain text only" and got[6] == "a b" and got[7].startswith("deep")
    assert pages.extracted(df).count() == len(sources) and pages.extracted(df.where("1 = 0")).count() == 0


@pytest.mark.parametrize("wanted", [None, "body>div.none"])
def test_fallback_to_the_own_best_path(wanted):
    assert pages.text_on(pages.read_blocks("<body><article><p>text of it</p></article><div>x</div></body>"), wanted) == "text of it"


STORY = "a long story of the village and its river " * 20


@pytest.mark.parametrize("source, want", [
    (f"<body><div class='content has-sidebar'><p>{STORY}</p><div class='sidebar'>links here</div></div></body>", STORY.strip()),
    (f"<body><article class='post header-image'><p>{STORY}</p></article></body>", STORY.strip()),
    (f"<body><div id='comments'><p>{STORY}</p></div></body>", STORY.strip()),
    (f"<body><article><h2 id='legal-status'>Status</h2><p>{STORY}</p><h2 id='related'>Work</h2><p>end</p></article></body>", f"Status {STORY.strip()} Work end"),
    (f"<body><article><p>start <svg class='i'/> <math a='/>'/>{STORY}</p></article></body>", f"start {STORY.strip()}"),
    (f"<body><article><p>start <svg a='/>'><text>no</text></svg>{STORY}</p></article></body>", f"start {STORY.strip()}"),
    (f"<body><article><p class=\"a\"\">start</p><p title=5'>{STORY}</p></article></body>", f"start {STORY.strip()}"),
])
def test_names_and_marks_do_not_lose_the_article(source, want):
    assert pages.text_on(pages.read_blocks(source), None) == want


SHORT = "<p>One sentence here.</p><p>Another one.</p>"
SHORT_TEXT = "One sentence here. Another one."
LONG = "<p>A reader says a lot about it.</p>" * 5


@pytest.mark.parametrize("source, want", [
    (f"<body><article><h1>T</h1>{SHORT}</article><section id='comments'>{LONG}</section></body>", f"T {SHORT_TEXT}"),
    (f"<body><article><h1>T</h1>{SHORT}<section id='comments'>{LONG}</section></article></body>", f"T {SHORT_TEXT}"),
    (f"<body><div class='text'><h1>T</h1>{SHORT}</div><div class='advert'>{LONG}</div><div class='cookie-notice'>{LONG}</div></body>", f"T {SHORT_TEXT}"),
    (f"<body><form id='aspnetForm'><nav><a href=x>m</a></nav><div class='text'><h1>T</h1>{SHORT}</div><div class='footer'>foot</div></form></body>", f"T {SHORT_TEXT}"),
    (f"<body>Loading<form><div class='text'>{SHORT}</div></form></body>", SHORT_TEXT),
    (f"<body><nav><a href=x>m</a><article><h1>T</h1>{SHORT}</article></body>", f"T {SHORT_TEXT}"),
    (f"<html><head><title>no</title><body><article><header class='entry-header'><h1>T</h1></header>{SHORT}</article></body>", f"T {SHORT_TEXT}"),
    (f"<html><head><meta a=b><p>One sentence here.</p><p>Another one.</p>", SHORT_TEXT),
    (f"<body><article><h1>T</h1>{SHORT}<div hidden>{LONG}</div><aside>{LONG}</aside></article><form>{LONG}</form></body>", f"T {SHORT_TEXT}"),
    ("<body><nav><a href=x>m</a></nav><footer>foot</footer></body>", "foot"),
])
def test_what_stands_outside_decides(source, want):
    assert pages.text_on(pages.read_blocks(source), None) == want


def test_teasers_of_the_same_class():
    teaser = "<div class='post'><h3><a href=y>More</a></h3><p>short</p></div><div class='post'><a href=z>Links only</a></div>"
    source = f"<body><div class='post'><h1>T</h1>{SHORT}</div>{teaser}<div class='post'>{SHORT}</div></body>"
    assert pages.text_on(pages.read_blocks(source), "body>div.post") == f"T {SHORT_TEXT} {SHORT_TEXT}"


@pytest.mark.parametrize("source", ["<div>x y z", "<p><div><h1>x", "<nav>x y z", "<b>x</i>", "<form><p>x y", "<div class='comments'>x"])
def test_deep_nesting_is_linear(source):
    began = time.process_time()
    pages.text_on(pages.read_blocks(source * 10_000), None)
    assert time.process_time() - began < 5


def test_salted_paths_agree(spark):
    rows = [(i, f"http://{'hot' if i % 3 else i}.example/{i}", f"<body><div class='c{i % 2}'><p>text {i}</p></div></body>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    hosted = df.selectExpr("*", "parse_url(url, 'HOST') host")
    winners = pages.host_paths(df).selectExpr("host of_host", "path")
    both = [sorted(map(tuple, pages.with_paths(hosted, winners, salted).collect())) for salted in (False, True)]
    assert both[0] == both[1] and len(both[0]) == 60
