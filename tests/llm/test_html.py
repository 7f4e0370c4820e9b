"""Main text extraction: what stays, what goes, blocks and white space."""

import html as stdlib
import re

import pytest

from streamops.llm import html
from tests.conftest import SF001
from tests.llm.fixtures import rows_of

PARA = ("The council met on Tuesday evening, and after a long debate, with many speakers, it voted for the plan, "
        "which will change the old market square, its trees, and the streets around it.")


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


ARTICLE = f"<article><h1>Head &amp; line</h1><p>{PARA}</p><p>Short one.</p><ul><li>first</li><li>second</li></ul></article>"
WANT = f"Head & line\n\n{PARA}\n\nShort one.\n\nfirst\n\nsecond"

NOISE = [
    "<nav><ul><li><a href=/>Home</a></li></ul></nav>", "<header><h1>Site</h1><p>slogan, words, words</p></header>",
    "<footer><p>&copy; 2024, all rights, reserved</p></footer>", "<aside><p>side, bar, text</p></aside>",
    "<div class='sidebar'><p>more, side, text</p></div>", "<div class='ad'>buy, this, now</div>",
    "<div id='cookie-notice'>We use cookies, sorry, yes</div>", "<form><label>Name</label><input><button>Go</button></form>",
    "<script>var t='</p><p>no';</script>", "<style>p{color:red}</style>", "<noscript>enable it</noscript>",
    f"<section id=comments><h2>Comments</h2><article class=comment><p>{PARA} I think, you know.</p></article></section>",
    "<div role=navigation>a, b</div>", "<div style='display:none'>hidden, text</div>", "<template><p>t</p></template>",
    "<ul class=share-buttons><li><a>Tweet</a></li></ul>", "<div class='newsletter-signup'>Join, us</div>", "<!-- <p>no</p> -->",
    "<div class='related-posts'><a href=1>one</a><a href=2>two</a></div>", "<svg><text>x</text></svg>",
    "<select><option>a<option>b</select>", "<p class='copyright'>x, y, z</p>", "<dialog open>hi, there</dialog>",
]


@pytest.mark.parametrize("noise", NOISE)
def test_noise_goes_wherever_it_stands(noise):
    for body in (noise + ARTICLE, ARTICLE + noise, f"<div>{noise}<main>{ARTICLE}</main>{noise}</div>"):
        assert html.main_text(page(body)) == WANT
    inside = ARTICLE.replace("<p>Short", noise + "<p>Short")
    if not noise.startswith("<header"):                # an article's own header belongs to it
        assert html.main_text(page(inside)) == WANT


def test_an_article_without_article_element():
    body = (f"<div id=menu><a href=1>a</a><a href=2>b</a></div><div class=content><h2>Head</h2><p>{PARA}</p><p>{PARA}</p>"
            "<p>Tail.</p></div><div id=footer>contact, imprint</div>")
    assert html.main_text(page(body)) == f"Head\n\n{PARA}\n\n{PARA}\n\nTail."
    split = f"<div class=main><div><p>{PARA}</p></div><div><p>{PARA}</p></div></div><div><a href=1>x</a> <a href=2>y</a></div>"
    assert html.main_text(page(split)) == f"{PARA}\n\n{PARA}"


def test_lists_of_links_inside_the_article_go():
    menu = "<ul><li><a href=1>Other story</a></li><li><a href=2>And one more</a></li></ul>"
    assert html.main_text(page(ARTICLE.replace("<p>Short", menu + "<p>Short"))) == WANT


def test_broken_markup():
    assert html.main_text("<article><p>one<p>two<div>three</div>four") == "one\n\ntwo\n\nthree\n\nfour"
    assert html.main_text("<article><p><b>one<br>two\n three<p>four</article>") == "one two three\n\nfour"
    assert html.main_text("<article>a < b <c d") == "a < b <c d"
    assert html.main_text("<article><p title='a>b'>x</p></span></div></article>") == "x"
    assert html.main_text("<p>a<script>never closed") == "a"
    assert html.main_text("<p>plain</p") == "plain"
    assert html.main_text("just text") == "just text"
    assert html.main_text("<table><tr><td>a<td>b<tr><td>c</table>") == "a b\n\nc"


def test_characters():
    assert html.main_text("<p>&lt;b&gt; &eacute;&#233;&#xE9; &amp;amp; &nope; x&nbsp;\t y</p>") == "<b> ééé &amp; &nope; x y"
    assert html.main_text("<p>wo<b>r</b>d w<i>o</i></p>") == "word wo"


@pytest.mark.parametrize("empty", [None, "", " ", "<p></p>", "<script>x</script>", "<!-- x", "<", "<html></html>"])
def test_no_text(empty):
    assert html.main_text(empty) in ("", "<")


def test_deep_and_long_pages():
    assert html.main_text("<div>" * 60_000 + "deep") == "deep"
    assert html.main_text("<p>x" * 60_000).count("x") == 60_000
    assert html.main_text("<a href=\"" * 20_000) is not None
    assert html.main_text("<" * 100_000) is not None


def test_the_table(spark):
    got = {r["page_id"]: r for r in rows_of(html.extract(spark.read.parquet(f"{SF001}/pages.parquet")))}
    for r in spark.read.parquet(f"{SF001}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", r["html"], re.S)[1]
        parts = (" ".join(stdlib.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
        want = "\n\n".join(x for x in parts if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
        assert got[r["page_id"]]["url"] == r["url"]


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", page(ARTICLE), "x"), (1, "u", page(ARTICLE), "x"), (None, None, None, None), (2, "v", "", "")],
                               "page_id long, url string, html string, text string")
    got = rows_of(html.extract(df))
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got) == sorted(
        [("1", WANT, len(WANT))] * 2 + [("None", "", 0), ("2", "", 0)])
    assert html.extract(df.limit(0)).count() == 0


STORY = ["The bridge over the river was closed on Monday, after engineers found cracks in two of its piers.",
         "Repairs will take until the spring, the council said, and buses will cross further north until then.",
         "Shops near the square fear for their trade, since most of their customers come over the bridge."]
SIDE = ('<div class="sidebar"><p>Most read this week: ten places to visit, and why they matter to our readers.</p></div>'
        '<form class="newsletter"><p>Sign up for our letter, it is free and comes every morning.</p></form>')
WRAPPERS = ['<form id="aspnet"><div>{}</div>{}</form>', '<div id="content" class="post has-sidebar">{}{}</div>',
            '<div class="entry no-sidebar">{}</div>{}', '<div class="story share-enabled">{}</div>{}',
            '<div class="layout no-sidebar"><article>{}</article></div>{}', '<div class="hidden-gem-post">{}</div>{}']


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_a_doubtful_name_around_the_article_does_not_lose_it(wrapper):
    story = "".join(f"<p>{p}</p>" for p in STORY)
    page = f"<html><body><nav><a href=/>Home</a></nav>{wrapper.format(story, SIDE)}<footer>About us</footer></body></html>"
    assert html.main_text(page) == "\n\n".join(STORY)


def test_a_doubtful_element_with_less_than_most_of_the_text_stays_out():
    story = "".join(f"<p>{p}</p>" for p in STORY)
    box = "<div class='related-content'><article><p>Another story, of which the first lines are shown here.</p></article></div>"
    assert html.main_text(f"<body><div>{story}</div>{box}</body>") == "\n\n".join(STORY)
    assert html.main_text("<body><div class='promo'><p>Only an advert, nothing else, on this page.</p></div></body>") == ""


def test_articles_side_by_side_and_paragraphs_of_main_are_kept():
    one, two = "".join(f"<p>{p}</p>" for p in STORY), "".join(f"<p>{p} Or so, it seems, on the whole.</p>" for p in STORY)
    both = "\n\n".join(STORY + [f"{p} Or so, it seems, on the whole." for p in STORY])
    card = "<article><p>Next: the market.</p></article>"
    assert html.main_text(f"<body><article>{one}</article><article>{two}</article>{SIDE}{card}</body>") == both
    tail = "<p>This story was first told, in other words, in the paper of Tuesday.</p>"
    assert html.main_text(f"<body><main><article>{one}</article>{tail}{card}<p>Share it</p><p><a href=x>{PARA}</a></p></main></body>"
                          ) == "\n\n".join(STORY + [tail[3:-4]])
