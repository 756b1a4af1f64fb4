import html
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import main_text as module
from tagpulse.llm.main_text import extract, main_text, markup
from tagpulse.llm.queries import QUERIES, table

PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header><h1>Site</h1><a href=/>Home</a></header><div id="cookie-banner">We use cookies, as all do.</div>
<div class="wrap"><div class="menu"><ul><li><a href=/a>first</a><li><a href=/b>second</a></ul></div>
<div class="post"><h2>A heading</h2><p>The first paragraph has <i>some</i>thing, and more text, in it.<p>Ok.
<div class="advert">Buy now! Cheap, very cheap, and good.</div><ul><li>One item, in the list.<li>Two <a href=/c>linked</a> items.</ul>
<p>The second &amp; last&nbsp;paragraph,
   which is longer than the first, by far.</p><form><label>Your name, please</label><button>Send</button></form></div>
<aside class="sidebar"><p>Related stuff here, with text. Much more text, of a long kind, that goes on and on.</p></aside>
<div id="comments"><p>I think, this is bad. Really, it is, I have to say, and say again.</p></div></div><footer>(c) someone</footer></body></html>"""


def test_page():
    assert main_text(PAGE) == (
        "A heading The first paragraph has something, and more text, in it. Ok. One item, in the list. Two linked items. "
        "The second & last paragraph, which is longer than the first, by far.")


def test_names_say_what_is_in_an_element():
    body = "".join(f"<p>Paragraph {k} has words, commas, and a full stop.</p>" for k in range(4))
    text = " ".join(f"Paragraph {k} has words, commas, and a full stop." for k in range(4))
    beside = "<div class='{}'><p>Some other words, much longer than any paragraph there is, go here and on and on, and on.</p></div>"
    for layout in ("<div class='layout has-sidebar'>{}</div>", "<div id=main-content>{}</div>", "<main>{}</main>", "<table><tr><td>{}</table>"):
        for name in ("sidebar", "site-footer", "cookieNotice", "ad ad-top", "reader-comments", "navbar"):
            assert main_text("<body>" + layout.format(body) + beside.format(name) + "</body>") == text
            assert main_text("<body>" + beside.format(name) + layout.format(body) + "</body>") == text
            assert main_text("<body>" + layout.format(body + beside.format(name)) + "</body>") == text
    head = "<article><header class='post-header'><h1>A title</h1><p>By someone</p></header>" + body + "</article>"
    assert main_text("<header><h1>Site</h1></header>" + head) == "A title " + text
    assert main_text("<article><div class=entry-header><h1>A title</h1></div>" + body + "</article>") == "A title " + text


def paragraphs(count, first=0):
    texts = [f"Paragraph {k} has words, commas, and a full stop." for k in range(first, first + count)]
    return "".join(f"<p>{t}</p>" for t in texts), " ".join(texts)


def test_all_of_the_article_stays():
    (body, text), (lead, lead_text), (end, end_text) = paragraphs(12), paragraphs(1, 50), paragraphs(1, 60)
    whole = f"A title {lead_text} {text} {end_text}"
    for nested in ("<div class=entry-content>{}</div>", "<section>{}</section>", "<blockquote>{}</blockquote>", "<table><tr><td>{}</td></tr></table>", "<ul><li>{}</li></ul>"):
        page = f"<h1>A title</h1>{lead}{nested.format(body)}{end}"
        for around in ("<article>{}</article>", "<main>{}</main>", "<div role=main>{}</div>", "<div class=post>{}</div>", "{}"):
            html_page = "<body><nav>Home</nav>" + around.format(page) + "<footer>(c) someone</footer></body>"
            assert main_text(html_page) == whole, (nested, around)


def test_names_made_from_headings_bar_nothing():
    body, text = paragraphs(6)
    more, more_text = paragraphs(2, 50)
    for part in ("<section id=discussion>{}</section>", "<div class=alert>{}</div>", "<div id=notices>{}</div>", "<div class=section id=related-work>{}</div>"):
        assert main_text("<article>" + body + part.format("<h2 id=search-and-replace>A heading</h2>" + more) + "</article>") == f"{text} A heading {more_text}"
    assert main_text("<article>" + body + "<h2 id=related-work>A heading</h2><p id=notices>A short one, here.</p></article>") == text + " A heading A short one, here."
    assert main_text("<body><div class=post>" + body + "<section id=discussion><h2 id=comments>A heading</h2>" + more + "</section></div>") == f"{text} A heading {more_text}"


def test_lists_of_links_in_an_article_stay():
    body, text = paragraphs(6)
    links = "<h2>References</h2><ol><li><a href=/a>First work</a><li><a href=/b>Second work</a></ol>"
    for around in ("<article>{}</article>", "<main><div>{}</div></main>", "<div class=post>{}</div>"):
        menu = "<ul class=menu><li><a href=/c>Home</a></ul>"
        assert main_text("<body>" + menu + around.format(body + links) + menu) == text + " References First work Second work"
    (body, text), far = paragraphs(12), "<div class=bio><p>Words on the one who wrote all this, with commas, and full stops. And more.</p></div>"
    page = "<div id=page><ul><li><a href=/c>Home</a></ul><div class=post>" + body + "</div>" + far + "</div>"
    assert main_text(page) == text + " Words on the one who wrote all this, with commas, and full stops. And more."


def test_what_is_beside_the_text_goes():
    body, text = paragraphs(8)
    prose = "<p>I think, this is bad. Really, it is, I have to say, and say again.</p>" * 3
    beside = [
        f"<section id=comments>{prose}</section>", f"<section id='comments'><h3>3 readers say</h3>{prose}</section>", f"<div id=comment-list>{prose}</div>",
        f"<div id=comments-area>{prose}</div>", f"<section class=replies>{prose}</section>", f"<ol class=commentlist><li>{prose}</ol>", f"<section id=sidebar>{prose}</section>",
        f"<div class=comment-respond>{prose}</div>", "<div class=cookie-note>We use them, as all do.</div>"]
    inside = ["<div class=alert>Please update your browser.</div>", "<div class=notice><p>By reading on, you agree to this, that, and more.</p></div>",
              "<div class=discussion><p>I think, this is bad.</p></div>",
              "<div class=related><h3>Related articles</h3><ul><li><a href=/a>One thing</a><li><a href=/b>Another</a></ul></div>"]
    for layout in ("<article>{}{}</article>", "<main>{}{}</main>", "<article>{}</article>{}", "<main><article>{}</article>{}</main>"):
        for extra in beside + (inside if "}{}<" in layout else []):
            assert main_text("<body>" + layout.format(body, extra) + "</body>") == text, (layout, extra)
            half, rest = body[:len(body) // 2], body[len(body) // 2:]
            cut = half.rfind("</p>") + 4
            if "}{}<" in layout:
                assert main_text("<body>" + layout.format(half[:cut] + extra + half[cut:], rest) + "</body>") == text, (layout, extra)
    for extra in beside:
        assert main_text("<body><div class=post>" + body + "</div>" + extra + "</body>") == text, extra


def test_names_that_headings_give_stay():
    body, text = paragraphs(8)
    more, more_text = paragraphs(2, 40)
    for part, head in ((f"<section id=comments><h2>Comments</h2>{more}</section>", "Comments"), (f"<div id=reply-by-comments><h2>Reply <i>by</i> comments</h2>{more}</div>", "Reply by comments"),
                       (f"<div class=notice><h3>Note</h3>{more}</div>", "Note"), (f"<section id=related-work><h2>Related work</h2>{more}</section>", "Related work")):
        assert main_text(f"<article>{body}{part}</article>") == f"{text} {head} {more_text}"


def test_teasers_go_and_equal_articles_stay():
    body, text = paragraphs(14)
    more, more_text = paragraphs(14, 40)
    teaser = "<article><h3><a href=/x>Another one</a></h3><p>A line, of it.</p></article>"
    assert main_text(f"<main><h1>Title</h1><article>{body}</article>{teaser}{teaser}</main>") == "Title " + text
    assert main_text(f"<main><article>{body}</article><article>{more}</article></main>") == f"{text} {more_text}"


def test_paths_decide(monkeypatch):
    body, text = paragraphs(10)
    loose = "<div class=grid>" + "".join(f"<div class=cell><span>Item {k}</span></div>" for k in range(30)) + "</div>"
    page = f"<body><div class=page><div class=text>{body}</div>{loose}</div></body>"
    assert main_text(page) == text
    monkeypatch.setattr(module, "content_elements", lambda page, nodes, strictness: np.ones(len(nodes), bool))
    assert main_text(page) != text


@pytest.mark.parametrize("part", ["<a ", "<!--", "<a b='", "<a b=c d=\"", "<?", "<![CDATA[", "</", "<p", "<script>", "<div>", "<", "&", "<b>", "</p>", "<a href=", "<x/", "<b>x", "<h2 id=comments>x<i>y"])
def test_unfinished_markup_takes_time_in_proportion(part):
    start = time.perf_counter()
    main_text("<article><p>Some text, here.</p></article>" + part * (240_000 // len(part)))
    assert time.perf_counter() - start < 12
    assert main_text("<article><p>Some text, here.</p></article><!-- " + part * 3).startswith("Some text, here.")


def test_markup():
    found = list(markup("a<B Class='x y' id=z hidden data-v=\"1>2\">&amp;<br/>c</b ><!-- <i> --><!DOCTYPE x><script>if (a<b) '</p>'</script>1 < 2<i"))
    assert found == [("text", "a", None), ("start", "b", {"class": "x y", "id": "z", "hidden": "", "data-v": "1>2"}), ("text", "&", None), ("start", "br", {}),
                     ("text", "c", None), ("end", "b", None), ("start", "script", {}), ("end", "script", None), ("text", "1 ", None), ("text", "<", None), ("text", " 2", None)]


def test_odd_pages():
    assert main_text("") == ""
    assert main_text("plain  text\nonly") == "plain text only"
    assert main_text("<p>a<br>b</p>c") == "a b c"
    assert main_text("<script>x</script><style>y</style><nav>z</nav>") == ""
    assert main_text("<article><p>open <b>bold") == "open bold"
    assert main_text("</p></div>stray &lt;ends&gt; &#x41;&eacute;") == "stray <ends> Aé"
    deep = "<div>" * 3000 + "deep text, here." + "</div>" * 3000
    assert main_text(deep) == "deep text, here."
    long = "<article>" + "<p>Some words, and more.</p>" * 5000 + "</article>"
    assert main_text(long) == " ".join(["Some words, and more."] * 5000)


def test_articles_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, folder, "pages").collect()}
    rows = QUERIES["op3_html_extraction"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        plain = html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|br|h1)>", " ", article)))
        assert (r.text, r.n_chars) == (" ".join(plain.split()), len(" ".join(plain.split())))


def test_rows_are_kept(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>😀é</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("text", "n_chars", "path")})
    out = extract(df).collect()
    assert [(r.page_id, r.url) for r in out] == [r[:2] for r in rows]
    assert [r.n_chars for r in out] == [len(main_text(PAGE))] * 2 + [0, 0, 2]
    assert extract(df.limit(0)).collect() == []
