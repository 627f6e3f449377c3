import html
import random
import re

from llm_helpers import table

from martwright.llm import html_extract as H

WEIGHTS = H.fit_weights({("word", "p", False): (900, 3), ("word", "div", False): (5, 60), ("word", "li", True): (1, 200),
                         ("tag", "p", False): (300, 3), ("tag", "div", False): (9, 90), ("tag", "li", False): (4, 90)})


def simple_article(page):
    """The text between <article> and </article>, for the test tables' pages."""
    body = page.split("<article>", 1)[1].split("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def test_article_of_every_page(spark):
    got = H.op1_html_extract(spark, "/root/testdata/sf0.001").collect()
    want = {i: (u, simple_article(h)) for i, u, h in table("pages", columns="page_id, url, html")}
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_page_parts_are_left_out():
    page = """<html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body class="has-sidebar">
    <header><p>Site of the year</p></header><div id="main-nav"><a href="/">Home</a></div>
    <div class="cookieNotice">We use cookies here.</div>
    <div class="post"><h1>Real &eacute;title</h1><p>First <a href="x">link</a> &lt;b&gt; &amp;nbsp;.</p>
    <div class="ad-box">Buy now!</div><p>Second
      para<br>goes&nbsp;on.</p><form><label>Name</label><input></form><ul><li>one</li><li>two</li></ul><p>End.</p></div>
    <aside>More</aside><section id="comments"><article class="comment"><p>Great post, I read it all</p></article></section>
    <p hidden>secret</p><div style="display: none">gone</div></body><footer>&copy; us</footer></html>"""
    assert H.extract(page, WEIGHTS) == "Real étitle\nFirst link <b> &nbsp;.\nSecond para goes on.\none\ntwo\nEnd."


def test_odd_markup():
    for page, want in ((None, ""), ("", ""), ("<div></div>", ""), ("a & b &lt;", "a & b <"), ("<p>a<p>b", "a\nb"),
                       ("x < y", "x < y"), ("<p>a<div clas", "a"), ("<p>a</b></i></p>b", "a\nb"),
                       ("<!-- <p>no</p> --><p>yes", "yes"), ("<p>a<!-- open", "a"), ("<script>x<p>y", ""),
                       ('<p title="a>b">t</p>', "t"), ("<P>Up</P>", "Up"), ("<p>a\xa0 b</p>", "a b"),
                       ("<p><b>Title<br><p>Text</p>", "Title\nText"), ("<p>un<b>bro</b>ken</p>", "unbroken")):
        assert H.extract(page, WEIGHTS) == want, page


def test_region_has_the_largest_sum():
    rng = random.Random(1)
    for _ in range(300):
        x = [rng.choice([-2, -1, 1, 3]) for _ in range(rng.randrange(0, 9))]
        a, b = H.best_region(x)
        sums = [sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)]
        assert sum(x[a:b]) == max([0, *sums])


def test_words_are_positive_and_tags_negative():
    assert all(v >= 0 for v in WEIGHTS.words.values()) and all(v < 0 for v in WEIGHTS.tags.values())


def test_rows(spark):
    rows = [(1, "u", "<article><p>x y</p></article>"), (1, "u", "<article><p>x y</p></article>"), (2, None, None),
            (None, "v", "<p>" + "long " * 200_000 + "</p>"), (3, "w", "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, H.extract_pages(df).collect()), key=repr)
    assert [(r[0], r[1], r[3]) for r in got] == sorted(
        [(1, "u", 3), (1, "u", 3), (2, None, 0), (None, "v", 999_999), (3, "w", 0)], key=repr)
    assert H.extract_pages(df.limit(0)).collect() == []


def test_articles_that_are_only_teasers():
    story = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(5)]
    cards = "".join(f'<article class="card"><h3><a href="{i}">Other story {i}</a></h3><p>Short teaser {i}</p></article>' for i in range(6))
    for p in ("p", "div"):
        body = "".join(f"<{p}>{x}</{p}>" for x in story)
        for page in (f"<div>{body}</div><div>{cards}</div>", f"<div>{cards}</div><div>{body}</div>"):
            assert H.extract(page, WEIGHTS) == "\n".join(story), page
    # one marked story with less text around it stays the region
    page = f"<div>Some words here</div><article><p>{story[0]}</p></article><p>More of that site</p>"
    assert H.extract(page, WEIGHTS) == story[0]


def test_wrappers_named_like_page_parts():
    story = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(3)]
    body = "".join(f"<p>{x}</p>" for x in story)
    aside = '<div class="sidebar"><p>Read more of this</p></div><form><label>Mail</label></form>'
    for wrap in ('<div class="page sidebar-right">{}</div>', '<div class="elementor-widget-container">{}</div>',
                 '<div id="header-search">{}</div>', '<form id="aspnetForm">{}</form>',
                 '<form><div class="share widget">{}</div></form>'):
        for inner in (body, f"<article>{body}</article>", f"<article><div class='widget'>{body}</div></article>"):
            page = "<a href='#c'>Skip to content</a>" + wrap.format(inner + aside)
            assert H.extract(page, WEIGHTS) == "\n".join(story), page
    # parts with less text than the rest, and comments, stay out
    for part in ("<aside>{}</aside>", '<div class="promo">{}</div>', "<article class='comment'>{}</article>"):
        assert H.extract(f"<div>{body}</div>{part.format('<p>' + story[0] + '</p>')}", WEIGHTS) == "\n".join(story)


def test_text_of_tags_in_an_article():
    page = ("<header><p>Site</p></header><article><header class='entry-header'><h1>The title</h1></header><p>We have "
            "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> here</p><p><label>A label</label>"
            "</p><noscript>No script</noscript></article>")
    assert H.extract(page, WEIGHTS) == "The title\nWe have x=1 here\nA label\nNo script"
