"""HTML extraction against plain readings of known pages."""

import html as html_lib
import random
import re

from vigia.llm import html_templates as ht
from vigia.llm.queries import op4_html_extraction

MID = "/root/testdata/sf0.01"


def plain(page):
    """The given pages have one article of headings and paragraphs."""
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html_lib.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:h1|p|br)>", inner)]
    return " ".join(b for b in blocks if b)


def test_query_on_given_pages(spark):
    got = op4_html_extraction(spark, MID).collect()
    pages = spark.read.parquet(f"{MID}/pages.parquet").collect()
    assert sorted((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got) == sorted(
        (p["page_id"], p["url"], plain(p["html"]), len(plain(p["html"]))) for p in pages)


def made_page(rng, k, article=True):
    words = ["alpha", "beta", "gamma", "caf&eacute;", "A&amp;B", "x&nbsp;y", "&#8364;5", "1 &lt; 2"]
    def line():
        return " ".join(rng.choice(words) for _ in range(rng.randrange(3, 12)))
    body, truth = "", []
    for _ in range(rng.randrange(1, 6)):
        a, b = line(), line()
        body += rng.choice([f"<p>{a} <em>{b}</em></p>", f"<p class=lead>{a}\n  <a href='#'>{b}</a>", f"<div>{a}<br/>{b}</div>",
                            f"<ul><li>{a}<li>{b}</ul>", f"<blockquote>{a} {b}</blockquote>"])
        truth.append(html_lib.unescape(f"{a} {b}"))
    body += "<aside>see also</aside><div class='ad-slot'>buy now</div><script>if (a < b) {'</p>'}</script>"
    body += "<section id=comments><article class=comment><p>first!</p></article></section><form><p>mail</p></form>"
    main = f"<article>{body}</article>" if article else f"<div id=content>{body}</div>"
    page = (f"<!doctype html><html><head><title>t{k}</title><style>p {{}}</style></head><body class='menu-open'>"
            f"<header><h1>Site</h1></header><nav><ul><li><a href=/>home</a></li></ul></nav><div class='cookie notice'>We use</div>"
            f"<!-- <article>no</article> --><div class='page with-sidebar'>{main if article else ''}</div>{'' if article else main}"
            f"<div role=complementary>side</div><footer>&copy; me</footer></body></html>")
    return page, " ".join(" ".join(t.split()) for t in truth)


def test_made_pages_and_edge_cases(spark, tmpdir_path):
    rng = random.Random(3)
    rows, truth = [], {}
    for k in range(60):
        host = ["big.example", "SMALL.example", "one.example"][0 if k < 40 else 1 if k < 58 else 2]
        page, text = made_page(rng, k, article=k % 2 == 0 or host == "big.example")
        rows.append((k, f"https://{host}/p/{k}", page))
        truth[k] = text
    rows += [(100, None, None), (101, "not a url", ""), (102, "http://x/", "plain &amp; simple <b"), (103, None, "<p>a<p>b"),
             (0, rows[0][1], rows[0][2]), (None, rows[1][1], rows[1][2]), (104, "http://y/", "<div>" * 5000 + "deep"),
             (105, "http://y/", "</p></div>x<!-- open"), (106, "http://y/", "word " * 200_000)]
    truth |= {100: "", 101: "", 102: "plain & simple", 103: "a b", None: truth[1], 104: "deep", 105: "x",
              106: ("word " * 200_000).strip()}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as text", "2 as page")
    df.repartition(3).write.parquet(f"{tmpdir_path}/pages.parquet")
    got = op4_html_extraction(spark, tmpdir_path).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == truth[r["page_id"]] and r["n_chars"] == len(r["text"]), r["page_id"]
    assert ht.extract(spark.read.parquet(f"{tmpdir_path}/pages.parquet").limit(0)).count() == 0


def test_classes_group_equal_vectors(spark):
    pages = [(f"http://h/{k}", "<html><body><nav>m</nav>" + "<p>x</p>" * k + "<footer>f</footer></body></html>") for k in range(1, 7)]
    found = ht.token_classes(spark.createDataFrame(pages, "url string, html string")).collect()
    classes = {}
    for r in found:
        classes.setdefault(r["class"], set()).add(r["token"])
    assert {"s/html/body/nav", "e/html/body/nav", "s/html/body/footer"} <= next(c for c in classes.values() if "s/html" in c)
    assert {frozenset(c) for c in classes.values()} == {
        frozenset(t for r in found for t in [r["token"]] if "/p" not in t), frozenset({"s/html/body/p", "e/html/body/p"})}


def test_self_closed_and_unclosed_elements_keep_what_follows():
    def text(inner):
        return ht.extract_text(f"<html><body><article><p>one</p>{inner}</article><div>out</div></body></html>", None)

    assert text("<svg width='1' /><p>two</p>") == text("<math/><p>two</p>") == text("<svg><path d=''/></svg><p>two</p>") == "one two"
    assert text("<svg><path d=''><p>two</p>") == "one two"
    for name in ("button", "select", "object"):
        assert text(f"<div><{name}>x<b>y</b></div><p>two</p>") == "one two"
        assert text(f"<p><{name}>x</p><p>two</p>") == "one two"
    assert text("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then</p>") == "one if x=2 then"
    assert text("<button>a<button>b</button><p>two</p>") == "one two"
    assert text("<p>tw<svg><path/></svg>o</p>") == "one two"


def test_titles_as_ids_inside_an_article():
    page = ("<article><h2 id='related-work'>Related work</h2><section id='social-impact'><p>a</p></section>"
            "<section id=comments><p>b</p></section><section class='comment-list'><p>c</p></section>"
            "<div id='share-buttons'>d</div><div class='ad-slot'>e</div></article>")
    assert ht.extract_text(page, None) == "Related work a"


def test_repeated_text_in_neutral_elements_is_template(spark):
    def page(k):
        return (f"<html><body><div class=c7>Start Contact</div><div class=c1><p>story {k}</p><p>{'same ' if k % 2 else 'other '}</p></div>"
                f"<div class=c7>We use biscuits</div><div class=c7>Buy now</div></body></html>")

    rows = [(f"http://divs/{k}", page(k)) for k in range(8)] + [(f"http://copies/{k}", page(1)) for k in range(8)]
    rows += [(f"http://few/{k}", page(k)) for k in range(2)]
    rows += [(f"http://alone/{k}", "<html><body><div>only this</div>" + "<i></i>" * k + "</body></html>") for k in range(4)]
    got = {r["url"]: r["text"] for r in ht.extract(spark.createDataFrame(rows, "url string, html string")).collect()}
    for k in range(8):
        assert got[f"http://divs/{k}"] == f"story {k} {'same' if k % 2 else 'other'}"
        assert got[f"http://copies/{k}"] == "Start Contact story 1 same We use biscuits Buy now"  # one distinct page tells nothing
    assert got["http://few/0"] == "Start Contact story 0 other We use biscuits Buy now"
    assert {got[f"http://alone/{k}"] for k in range(4)} == {"only this"}


def test_pieces_out_of_order_stay():
    assert ht.in_order([]) == [] and ht.in_order([3, 0, 1, 1, 2]) == [1, 2, 3, 4]
    pieces = [t for t in ht.tokens("<p>c</p><p>a</p><p>x</p><p>b</p>") if t.kind == "text"]
    a, b, c = (ht._key(pieces[k]) for k in (1, 3, 0))
    assert ht.extract_text("<p>c</p><p>a</p><p>x</p><p>b</p>", None, {a: (1, 0), b: (1, 1), c: (1, 2)}) == "c x"


def test_furniture_at_any_depth():
    for depth in (10, 505, 520, 5000):
        page = "<div>" * depth + "<nav>MENU TEXT</nav><p>article text</p><aside>ADVERT</aside>" + "</div>" * depth
        assert ht.extract_text(page, None) == "article text"
    # Unclosed and stray tags at depth take no longer than their number.
    assert ht.extract_text("<div>" * 30_000 + "</span></li>" * 30_000 + "<svg><foreignObject>" + "<div>" * 20_000 + "x", None) == ""
    assert ht.extract_text("<b>" * 20_000 + "<li>x</li>" * 5_000, None).startswith("x x")


def test_what_all_articles_say_stays(spark):
    rows = [(i, f"http://h/{i}", f"<body><div>Same line</div><article><p>Page {'abcdefghijkl'[i] * 9}.</p><p>Conclusion</p></article></body>")
            for i in range(12)]
    got = {r["page_id"]: r["text"] for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Page {'abcdefghijkl'[i] * 9}. Conclusion" for i in range(12)}
    # A page that lies in one form keeps its article.
    assert ht.extract_text("<form><nav>menu</nav><main><p>text</p></main><input></form>", None) == "text"
