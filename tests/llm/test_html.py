import random

import pytest

from pointlake.llm import html_wrappers as H

SCHEMA = "page_id long, url string, html string, host string, template string"


def _extract(spark, pages):
    df = spark.createDataFrame([(i, u, h, "h", "t") for i, (u, h) in enumerate(pages)], SCHEMA)
    return {r.page_id: r.text for r in H.extract(df).collect()}


def _page(body, nav="<nav><a href=/a>Home</a></nav>", foot="<footer>Imprint</footer>"):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{nav}{body}{foot}</body></html>"


def test_article_without_the_rest():
    body = """<header class="site-header">Banner</header><aside>side</aside><div id="cookie-notice">We use cookies</div>
      <article class="post"><header><h1>The  title</h1><span class=byline>x</span></header><p>One &amp; two
      &copy; <b>three</b></p><div class="ad">Buy</div><p>Four<p>Five<form><input><button>Send</button></form>
      <!-- <p>hidden</p> --><style>p{}</style><ul><li>six<li>seven</ul><div class="share-buttons">Share</div>
      <section id="comments"><article class="comment">first!</article></section></article>"""
    assert H.main_text(_page(body), None) == "The title\nOne & two © three\nFour\nFive\nsix\nseven"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>a<br>b</p>", "a b"), ("<p>cut off <b", "cut off"),
    ("<article><p>x &am", "x &am"), ("<article><p>x</article", "x"), ("<p class='a>b'>q</p>", "q"), ("a < b and c > d", "a < b and c > d"),
    ("<td>1<td>2", "1\n2"), ("<p>&lt;b&gt;&#8364;&nbsp;x</p>", "<b>€ x"), ("<script>never closed <p>x</p>", ""), ("<div hidden>x</div>y", "y"),
    ("</p></div>z", "z"), ("<P>Up</P><DIV>Per</DIV>", "Up\nPer"), ("<p>a<span class=ad>buy</span>b</p>", "ab"),
])
def test_odd_markup(page, text):
    assert H.main_text(page, None) == text


def test_template_text_of_a_host_is_dropped(spark):
    rnd = random.Random(1)
    words = lambda n: " ".join(f"w{rnd.randrange(999)}" for _ in range(n))
    plain, want = [], []
    for i in range(12):
        ps = [words(30) for _ in range(rnd.randint(1, 4))]
        extra = "<table><tr><td>extra</td></tr></table>" if i % 4 == 0 else ""
        plain.append(("http://plain.org/x", f"<div><div><a href=1>{words(1)}</a> <a href=2>{words(1)}</a></div></div><div><div>All rights of this site</div>"
                      f"<div>{''.join(f'<p>{p}</p>' for p in ps)}</div>{extra}</div><div>Made by nobody in particular</div>"))
        want.append("\n".join(ps))
    got = _extract(spark, plain)
    for i, text in enumerate(want):
        assert got[i] == text


def test_copies_of_one_page_are_not_template(spark):
    page = _page("<article><h1>T</h1><p>same text on every page</p></article>")
    got = _extract(spark, [("http://copies.org/1", page)] * 9 + [(None, page), ("no host", None)])
    assert all(got[i] == "T\nsame text on every page" for i in range(10)) and got[10] == ""


def test_alignment_gives_optional_and_repeated_groups():
    pages = ["<h1>A</h1><p>x</p><p>y</p>", "<h1>B</h1><p>z</p><table><td>t</td></table>", "<h1>C</h1><div>fixed</div><p>u</p>"]
    whole = None
    for p in pages:
        own = H.page_wrapper(H.blocks(p))
        whole = H.align(whole, own) if whole else own
    said = H.expression(whole)
    assert "<h1> #TEXT </h1>" in said and "(<p> #TEXT </p>)+" in said and "(<table[1]>" in said and said.count("?") == 2
    assert whole[H.PAGES] == 3


def test_folding_order_does_not_change_the_template():
    rnd = random.Random(2)
    pages = [f"<div class=menu>m</div><div><p>{rnd.random()}</p>{'<b>k</b>' * (i % 2)}<ul><li>{rnd.random()}</ul></div><i>end</i>" for i in range(9)]
    said = []
    for _ in range(4):
        rnd.shuffle(pages)
        parts = [H.page_wrapper(H.blocks(p)) for p in pages]
        while len(parts) > 1:
            parts.append(H.align(parts.pop(rnd.randrange(len(parts))), parts.pop(rnd.randrange(len(parts)))))
        t = H.template(parts[0])
        said.append((sorted(t["fixed"]), sorted(t["menus"]), t["root"]))
    assert all(x == said[0] for x in said)


def test_whole_table_against_its_own_markup(spark, sf):
    import html
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in H.op2(spark, sf).collect():
        inner = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_deep_and_long_pages(spark):
    deep = "<div>" * 5000 + "core" + "</div>" * 5000 + "<p>end"
    long = "".join(f"<p class=c{i}>{'word ' * 50}{i}</p>" for i in range(4000))
    got = _extract(spark, [("http://d.org/1", deep), ("http://d.org/2", long), ("http://d.org/3", deep)])
    assert got[0] == got[2] == "core\nend" and len(got[1].splitlines()) == 4000


def test_empty_table(spark):
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("page,text", [
    ("<main><p>Intro</p><div class='entry'>Body</div><p>End</p></main>", "Intro\nBody\nEnd"),
    ("<div><p class='lead'>A</p><p class='text'>B is longer</p></div>", "A\nB is longer"),
    ("<div class='content no-sidebar'><p>x</p></div>", "x"), ("<div class='main-content has-sidebar'><p>x</p></div>", "x"),
    ("<div class='story share-enabled'><p>x</p></div>", "x"),
    ("<div class='story'><p>first a long text</p><article>quoted</article><p>end</p></div>", "first a long text\nquoted\nend"),
    ("<div class='content'>long text</div><div class='comment-content'>c</div><div class='widget widget_text'>d</div>", "long text"),
    ("<p>a whole article of many words</p><div class='text'>b</div>", "a whole article of many words\nb"),
])
def test_names_of_inner_blocks_do_not_erase_the_rest(page, text):
    assert H.main_text(page, None) == text


def test_region_named_to_drop_that_holds_the_text_of_the_host_stays(spark):
    pages = [("http://n.org/1", f"<div class='banner-page'><p>{f'w{i} ' * 40}</p></div><div class='sidebar'>s{i}</div>") for i in range(6)]
    got = _extract(spark, pages)
    assert all(got[i] == " ".join([f"w{i}"] * 40) for i in range(6))


def test_equal_text_inside_the_article_is_kept(spark):
    rnd = random.Random(3)
    words = lambda n: " ".join(f"w{rnd.randrange(999)}" for _ in range(n))
    pages, want = [], []
    for i in range(12):
        one, two = words(30), words(30)
        host, start, end = (("a", "<article>", "</article>"), ("b", "<div><div>", "</div></div>"))[i % 2]
        pages.append((f"http://{host}.org/{i}", f"<div>The site</div>{start}<h1>Daily briefing</h1><p>{one}</p><h2>Abstract</h2><p>{two}</p>{end}"
                                                "<div>All rights of this site</div>"))
        want.append(f"Daily briefing\n{one}\nAbstract\n{two}")
    got = _extract(spark, pages)
    assert [got[i] for i in range(12)] == want
