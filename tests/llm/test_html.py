"""Wrapper induction on invented pages and on the smallest page table."""

import functools
import html
import random
import re

from starloom.llm import html_wrapper as hw
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one(page, others=()):
    wrapper = None
    for p in (page, *others):
        wrapper = hw.fold_pages(wrapper, p)
    hw.decide(wrapper, 1 + len(others))
    return hw.extract(wrapper, page)


def test_table(spark):
    rows = {r.page_id: r for r in QUERIES["op1_html_wrapper"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        inner = re.sub(r"<[^>]*(>|$)", "", re.sub(r"</?(?:p|h1)>", "\x00", inner.replace("<br>", " ")))
        blocks = (" ".join(html.unescape(b).split()) for b in inner.split("\x00"))
        want = "\n".join(b for b in blocks if b)
        assert (rows[r.page_id].text, rows[r.page_id].n_chars) == (want, len(want))


def test_furniture_goes():
    page = """<html><body><header><a href=x>Site</a></header><nav>m</nav>
      <div class="cookie-notice">We use cookies</div><main><article class="post">
      <header class="entry-header"><h1>T &amp; U</h1><span>By me</span></header>
      <p>One<p>Two <a href=q>link</a>&nbsp;x<ul><li>a<li>b</ul><form><label>mail</label></form>
      <div class="share">tweet</div><aside>side</aside><section id="comments"><p>nice</p></section>
      </article></main><div class="sidebar"><p>zz</p></div><footer>f</footer><p"""
    assert one(page) == "T & U\nOne\nTwo link x\na\nb"


def test_frames_and_joined_words():
    page = """<form id=aspnet><div class="siteheader">Top</div><main><h1>Title</h1>
      <article><p>Body</p><form><p>ask</p></form></article><div class="related">more</div></main>
      <div id="leftsidebar">links</div><div class="cookiebar">ok?</div></form>"""
    assert one(page) == "Title\nBody"
    assert one("<div class=pageheader>x</div><div class=postbody><div class=textheader><h2>H</h2>by me"
               "</div><p>t</p><div role=alert>!</div></div><p>rest</p>") == "H\nt"


def test_wrapper_is_a_union_free_expression():
    pages = ["<div><h1>A</h1><p>x</p><p>y</p></div>", "<div><h1>A</h1><h2>s</h2><p>z</p></div>",
             "<div><h1>B</h1><dl><dt>k<dd>v<dt>k2<dd>v2</dl><p>z</p></div>"]
    wrapper = None
    for p in pages:
        wrapper = hw.fold_pages(wrapper, p)
    assert "".join(x.expression() for x in wrapper) == (
        "<div><h1>#</h1>(<h2>\"s\"</h2>)?(<dl>(<dt>#</dt><dd>#</dd>)+</dl>)?(<p>#</p>)+</div>")


def test_without_marked_region_fixed_texts_are_template():
    page = ("<div id=top><p>Our site</p></div><div id=mid><p>story {0} goes on</p></div>"
            "<div id=end><p>Bye</p></div>")
    assert one(page.format(1), [page.format(k) for k in range(2, 6)]) == "story 1 goes on"


def test_broken_pages():
    for page, text in [("", ""), ("plain  text", "plain text"), ("<div>" * 3000 + "x", "x"),
                       ("<p class=\"a>b\" x='>'>q < 3 &lt; 4</p><a title=\"", "q < 3 < 4"),
                       ("a<script>x</b>", "a"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
                       ("<p>" + "w " * 50_000, ("w " * 50_000).strip()), ("<!-- x", ""), ("a<!-- x --b", "a")]:
        assert one(page) == text


def test_every_text_falls_on_a_slot():
    """Parts alone on some pages and in repeated groups on others, in any order."""
    forms = ["hp", "hfp", "hpf", "hfpfp", "hpfpf", "hfqfq", "hqp", "hfpqfpq"]
    tags = {"h": "<h1>h{0}</h1>", "p": "<p>p{0}</p>", "f": "<figure><p>f{0}</p></figure>",
            "q": "<blockquote><p>q{0}</p></blockquote>"}

    def page(form):
        parts = "".join(tags[c].format(i) for i, c in enumerate(form))
        return f"<nav>m</nav><article>{parts}</article>"

    def text(form):
        return "\n".join(f"{c}{i}" for i, c in enumerate(form))
    rng = random.Random(3)
    orders = [forms[:4]] + [rng.sample(forms, rng.randint(2, len(forms))) for _ in range(60)]
    for order in orders:
        wrapper = None
        for form in order:
            wrapper = hw.fold_pages(wrapper, page(form))
        halves = [hw.load(hw.dump(w, 1))[0] for w in (
            functools.reduce(hw.fold_pages, map(page, part), None)
            for part in (order[:len(order) // 2], order[len(order) // 2:])) if w is not None]
        for w in (wrapper, functools.reduce(hw.align, halves)):
            hw.decide(w, len(order))
            assert [hw.extract(w, page(f)) for f in order] == [text(f) for f in order], order


def test_slugs_in_the_article_are_no_furniture():
    ids = ["discussion", "related-work", "social-impact", "search", "legal", "hidden-markov-models",
           "downloads", "threads", "navigation-and-search", "http-header"]
    parts = "".join(f'<h2 id="{i}"><a href="#{i}">{i}</a></h2><section id="{i}"><p>on {i}</p></section>'
                    f'<div class="section" id="{i}"><p>of {i}</p></div>' for i in ids)
    parts += '<p class="roads">r</p><div id="leads">l</div><div id="legal-basis"><p>b</p></div>'
    want = "\n".join(f"{i}\non {i}\nof {i}" for i in ids) + "\nr\nl\nb"
    assert one(f'<article id="hidden-markov-models">{parts}</article>') == want
    assert one(f'<main>{parts}<article class="related">x</article></main>') == want


def test_furniture_in_the_article_goes():
    page = ('<article><p>t{0}</p><div class="social share">s{0}</div><div class="comment-list">c{0}</div>'
            '<div id="related-posts"><a href=x>r{0}</a></div><p class="ads">a{0}</p>'
            '<div class="legal-note">same</div><div class="related">q{0}</div><h2 class="related">R</h2>'
            '<section id="comments"><p>n{0}</p></section><div hidden>h{0}</div>'
            '<article id="comment-{0}">c{0}</article></article>')
    assert one(page.format(1), [page.format(k) for k in range(2, 6)]) == "t1"


def test_text_after_a_closed_deep_nest():
    for tag in ("div", "blockquote", "ul"):
        for n in (50, 70, 3000):
            page = (f"<div class=page><article><p>before</p>{f'<{tag}>' * n}deep<p>in</p>{f'</{tag}>' * n}"
                    f"<p>after</p></article><p>out</p></div>")
            assert one(page) == "before\ndeep\nin\nafter"
    table = "<table><tr><td>"
    page = f"<div><article>{table * 40}x{'</table>' * 40}<p>after</p></article><p>out</p></div>"
    assert one(page) == "x\nafter"


def test_long_class_lists_keep_their_marks():
    long = " ".join(f"aa{chr(97 + i)}-{'bcdefghijk'[:3 + i % 5]}{chr(97 + i)}{j}" for j, i in enumerate(range(26)))
    page = (f'<div role="navigation" class="{long}">m</div><div class="{long} sidebar">s</div>'
            f'<div role="main" class="{long}"><p>t</p><div class="{long} zz related">r</div>'
            f'<div class="{long} zzz"><p>u</p></div></div><div class="{long}">x</div>')
    assert one(page) == "t\nu"
    assert one(f'<div class="{long} story"><p>t</p></div><div class="{long}">x</div>') == "t"
    # a word that the cut made into another one
    for n in range(100, 125):
        word = "b" * (n - 8) + "-navy"
        assert one(f'<div class="{word}"><p>t</p></div>') == "t"
    assert hw._key("div", f'class="{long}"') != hw._key("div", f'class="{long} zzz"')
    assert len(hw._key("div", f'class="{long}"')) < hw.LONGEST_KEY
