import pytest

from kpiflow.llm import html as H
from kpiflow.llm.html import main_text

LONG = "The cat is on the mat and it was a long day for all of the animals in the house, that is to say the end of the story."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain  text", "plain text"),
        (page("<nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>one<br>two</p><p>three &lt;x&gt;</article><footer>f</footer>"), "A & B\none two\nthree <x>"),
        (page(f"<header>Site</header><h2>Title</h2><p>{LONG}<p>Short one.<aside>Side</aside><div class='cookie-notice'>We use cookies</div>"), f"Title\n{LONG}\nShort one."),
        (page(f"<p>{LONG}</p><form><p>Name</p></form><div id=comments><p>{LONG}</p></div>"), LONG),
        (page(f"<ul><li><a href=1>One</a><li><a href=2>Two</a></ul><p>{LONG}</p>"), LONG),
        (page(f"<main><p>{LONG}</p><div class=ad>Buy</div><p>In.</p></main><p>out</p>"), f"{LONG}\nIn."),
        (page(f"<article><p>{LONG}</p><section class='reader-comments'><article><p>me too</p></article></section></article>"), LONG),
        (page(f"<article><!-- note --><p>a<!-- x --> b</p><script>x<p>y</script><p><b>bold<br><p>{LONG}"), f"a b\nbold\n{LONG}"),
        ("<p title=\"x>broken", "broken"), ("<p>a<script>var x = 1;", "a"), ("a < b", "a < b"), ("<p>a</div></p></b>b", "a\nb"),
    ],
)
def test_pages(html, text):
    assert main_text(html) == text


def test_long_and_hostile_pages_stay_linear():
    assert main_text("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>").count("\n") == 4999
    assert main_text("<div>" * 50_000 + "x" + "</p>" * 50_000) == "x"
    main_text("<" * 100_000), main_text('<a "' * 20_000)


def test_two_passes():
    found = H.classify(H.blocks(page(f"<p>{LONG}</p><p>Ok.</p><p>{'zzz qqq xxx ' * 30}</p><p>Bad.</p>")))
    assert [b.label for b in found] == ["text", "text", "boilerplate", "boilerplate"]


def test_table(spark):
    rows = [(1, "u", page(f"<p>é😀 {LONG}</p>"), "x"), (None, None, None, "y"), (2, None, "", "z"), (2, None, "", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = H.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 4
    assert {r.page_id: (r.text, r.n_chars) for r in got.collect()}[1] == (f"é😀 {LONG}", len(LONG) + 3)
    assert H.extract(pages.limit(0)).count() == 0


BODY = f"{LONG} {LONG}"
CARD = "<article><h3><a href=x>Another story</a></h3><p>Read more of it.</p></article>"


@pytest.mark.parametrize(
    "html, text",
    [
        (page(f"{CARD * 3}<div><h1>Title</h1><p>{BODY}</p><p>{BODY}</p></div>"), f"Title\n{BODY}\n{BODY}"),  # the body beside teaser cards
        (page(f"<main>{CARD}</main><div><p>{BODY}</p></div>{CARD}"), BODY),
        (page(f"<article><h1><a href=x>Title</a></h1><p>{BODY}</p><p>See: <a href=y>this and that of the same kind</a></p></article>"), f"Title\n{BODY}"),
        (page(f"<article><p>{BODY}</p><p>{BODY}</p><p>Ok.</p></article><div>out</div><div>{BODY}</div>"), f"{BODY}\n{BODY}\nOk.\n{BODY}"),
    ],
)
def test_article_is_one_feature(html, text):
    kept = main_text(html).split("\n")
    assert [t for t in kept if t not in ("Another story", "Read more of it.")] == text.split("\n")
    assert "Another story" not in kept


RUSSIAN = " ".join(f"Кошка номер {i} сидела на крыше и смотрела, как вечер гаснет за рекой {i * i}." for i in range(4))
CHINESE = "".join(f"第{i}只猫坐在屋顶上,看着夜色慢慢落在河的另一边。" for i in range(12))
POLISH = "Kot siedział wczoraj cicho przy oknie, patrząc jak deszcz pada nad miastem, podczas gdy dzieci wracały szkolnym autobusem ku domom, śmiejąc się głośno przez całą długą drogę."


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'class="overflow-hidden"', 'aria-hidden="false"', 'class="has-sidebar"', 'class="no-sidebar"', 'class="page with-header"',
                                   "class=header", 'class="sidebar-layout"', 'id="menu-open"', 'data-x="hidden"'])
def test_wrappers_keep_the_page(attrs):
    assert main_text(page(f"<div {attrs}><article><h1>T</h1><p>{LONG}</p></article></div><p>x</p>")).startswith(f"T\n{LONG}")
    assert LONG in main_text(page(f"<div {attrs}><p>{LONG}</p></div>"))


@pytest.mark.parametrize("attrs", ["hidden", 'aria-hidden="true"', 'style="color:red; display : none"', 'class="page-sidebar"', 'class="sidebar-left x"', 'id="ad-300x250"', "class=share-buttons", 'class="site_footer"'])
def test_containers_that_drop(attrs):
    assert main_text(page(f"<p>{BODY}</p><p>{BODY}</p><div {attrs}><p>{LONG}</p></div>")) == f"{BODY}\n{BODY}"


def test_an_advert_longer_than_the_article_goes():
    assert main_text(page("<div class=ad>Buy this and that and more of it now.</div><article><h1>T</h1><p>x</p></article>")) == "T\nx"


def test_comments_may_outweigh_the_article():
    assert main_text(page(f"<p>{BODY}</p><div class=comments>{f'<p>{BODY}</p>' * 20}</div>")) == BODY


@pytest.mark.parametrize("text", [RUSSIAN, CHINESE, POLISH])
def test_other_languages(text):
    menu = "<ul>" + "<li><a href=x>Link</a></li>" * 3 + "</ul>"
    assert main_text(page(f"{menu}<p>{text}</p>{menu}")) == text
    assert main_text(page(f"{menu}<p>{text}</p><p>{LONG}</p><p>{text} 2</p>{menu}")) == f"{text}\n{LONG}\n{text} 2"


def test_many_named_elements_stay_linear():
    main_text("<p>" + "<span class=ad> " * 30_000), main_text("<div class=ad>" * 30_000 + "x")
