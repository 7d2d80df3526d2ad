"""Main text of pages: the given pages against their article, and odd markup."""

import html
import re

import pyarrow.parquet as pq

import pytest

from tempora.llm import pages as G
from tests_data import SF01


def test_given_pages(spark):
    raw = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF01}/pages.parquet").to_pylist()}
    out = {r["page_id"]: r for r in G.op10_pages(spark, SF01).collect()}
    assert set(out) == set(raw)
    for i, page in raw.items():
        article = page[page.index("<article>"):].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|<br>|</?h1>", article)]
        assert out[i]["text"] == "\n".join(x for x in parts if x) and out[i]["n_chars"] == len(out[i]["text"])


STORY = "<p>A story with a fairly long sentence, and some more, to be read.</p><p>Short.</p><p>It goes on &amp; on, word after word, line after line.</p>"
TEXT = "A story with a fairly long sentence, and some more, to be read.\nShort.\nIt goes on & on, word after word, line after line."


def test_boilerplate():
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body><header><h1>Site name, home of sites.</h1></header>
      <nav><ul><li><a href=/a>Home</a><li><a href="/b">News, sports, weather</a></ul></nav><div class="cookie-notice">We use cookies, you agree, ok.</div>
      <main><article><h2>Head  line</h2>{STORY}<aside>Related, and more, things.</aside><div class="ads">Buy, buy, buy.</div>
      <form><p>Sign up, now, here.</p></form><script>if (a < b) document.write("<p>no</p>")</script></article>
      <section id="comments"><p>Nice story, I liked it, very much, thanks, all of you!</p></section></main>
      <div class='side sidebar'>Links, links</div><footer><p>About, terms.</p></footer></body></html>"""
    assert G.main_text(page) == "Head line\n" + TEXT


def test_without_article_element():
    page = f"<body><div class=menu><a>One</a> <a>Two</a></div><div class=x><div class=content>{STORY}</div></div><div id=footer>Words, words.</div>"
    assert G.main_text(page) == TEXT


def test_odd_markup():
    assert G.main_text(None) == "" and G.main_text("") == "" and G.main_text("<p></p>") == ""
    assert G.main_text("no tags &lt;here&gt;") == "no tags <here>"
    assert G.main_text("<article><p>one<p>two<br>three<b>bold</b> end<ul><li>x<li>y</ul>") == "one\ntwo\nthreebold end\nx\ny"
    assert G.main_text("<article><p>a\n b c</p><!-- not <p>this</p> --><p>&copy; &#x41;&eacute;</p>") == "a b c\n© Aé"
    assert G.main_text("<article><p title=\"a > b\">x</p><script>unclosed") == "x"
    assert G.main_text("<article><p>cut off <a href=\"x") == "cut off"
    deep = "<div>" * 3000 + "deep words, here" + "</div>" * 3000
    assert G.main_text(deep) == "deep words, here"
    assert len(G.main_text("<article><p>" + "word " * 300_000)) == 1_499_999


def test_table(spark):
    rows = [(1, "u", f"<article>{STORY}</article>", "t"), (2, None, None, "t"), (None, "v", "", "t"), (1, "u", f"<article>{STORY}</article>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = G.extract(df).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in out) == sorted([("1", TEXT, len(TEXT))] * 2 + [("2", "", 0), ("None", "", 0)])
    assert G.extract(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        G.extract(df, keep=("page_id", "text"))
    assert {r["url"] for r in G.extract(df.selectExpr("page_id as `html 2`", "url as html", "html as url"), "url", ("html 2", "html")).selectExpr("html as url").collect()} == {"u", "v", None}


def test_whole_article():
    """Small parts of an article stay: a last section, a headline beside it, further article elements."""
    long = "".join(f"<p>Sentence {i} of a story, fairly long, with commas, to be read.</p>" for i in range(10))
    last = "<p>The end of this story, fairly long, with commas, to be read.</p>"
    end = "The end of this story, fairly long, with commas, to be read."
    want = [f"Sentence {i} of a story, fairly long, with commas, to be read." for i in range(10)] + [end]
    menu = "<div class=menu><a>One</a> <a>Two</a></div>"
    assert G.main_text(f"<body>{menu}<div class=post><section>{long}</section><section>{last}</section></div>").split("\n") == want
    assert G.main_text(f"<body>{menu}<div><h1>Head line</h1><div class=body>{long}{last}</div></div>").split("\n") == ["Head line"] + want
    assert G.main_text(f"<body>{menu}<article>{long}</article><div>x</div><article>{last}</article>").split("\n") == want


def test_marks_around_the_article():
    """Words like sidebar on a wrapper or on the article's header leave the article as it is."""
    menu, note = "<div class=menu><a>One</a> <a>Two</a></div>", "<div class='cookie-notice'>We use cookies, you agree.</div>"
    for name in ("content has-sidebar", "post with-comments", "no-sidebar", "page_sidebar_left", "sidebar"):
        assert G.main_text(f'<body>{menu}<div class="{name}">{STORY}{note}</div>') == TEXT, name
        assert G.main_text(f'<body>{menu}<div class="{name}"><article>{STORY}{note}</article></div>{note}') == TEXT, name
    assert G.main_text(f'<article class="post has-sidebar">{STORY}</article>') == TEXT
    assert G.main_text(f'<article><header class="entry-header"><h1>Head line</h1><p>By me</p></header>{STORY}</article>') == "Head line\n" + TEXT
    comment = "<article class=comment><p>Nice story, I liked it, very much, thanks, all of you!</p></article>"
    assert G.main_text(f"<body><article>{STORY}</article><section id=comments>{comment * 3}</section>") == TEXT
    assert G.main_text(f"<body><div class=x>{STORY}</div><section class=comments>{comment * 5}</section>") == TEXT


def test_readers_are_never_the_article():
    comment = "<p>Nice story, I liked it, very much, thanks, all of you!</p>"
    assert G.main_text(f"<body><div class=x><p>One story, in one sentence.</p></div><div id=comments>{comment * 12}</div>") == "One story, in one sentence."
    assert G.main_text(f"<body><article>{STORY}<section class='comment-list'>{comment * 2}</section><ol class=commentlist>{comment * 9}</ol></article>").startswith(TEXT)
    assert G.main_text(f"<body><article>{STORY}</article><div class='discussion'>{comment * 20}</div>") == TEXT


def test_words_of_names_inside_the_story():
    """A name that holds a mark among other words doesn't remove running text of an article."""
    parts = ['<p class="related-work">Related work, as others have done it, is long.</p>', '<div class="share-price">The share price rose, then fell, and rose.</div>',
             '<h2 id="social-history">Social history</h2>']
    page = f"<body><article><p>A first sentence, of some length, to begin.</p>{''.join(parts)}<p>A last sentence, of some length, to end.</p></article>"
    assert G.main_text(page).split("\n") == ["A first sentence, of some length, to begin.", "Related work, as others have done it, is long.",
                                             "The share price rose, then fell, and rose.", "Social history", "A last sentence, of some length, to end."]
    assert G.main_text(f'<article>{STORY}<div class="related-posts"><ul><li>One</li><li>Two</li></ul></div><div class="share-buttons">Tweet</div></article>') == TEXT


def test_site_headline():
    assert G.main_text(f"<body><div><h1>Site of sites</h1></div><article><h2>Head line</h2>{STORY}</article>") == "Head line\n" + TEXT


def test_ratios_decide(monkeypatch):
    """Without an article element the paths' ratios choose: constant ones give another text."""
    page = f"<body><div class=x><div>One</div><div>Two</div><div>Three</div></div><div class=y>{STORY * 3}</div><div class=z><span>Four</span></div>"
    right = G.main_text(page)
    assert right == "\n".join([TEXT] * 3)
    monkeypatch.setattr(G, "_fused", lambda found: __import__("numpy").ones(len(found)))
    assert G.main_text(page) != right
