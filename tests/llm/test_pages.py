import pytest

from shiftloom.llm import pages

LONG = "some words that go on for long enough to be the main text of a page and more"


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        (f"<p>{LONG}", LONG),
        (f"<article><h1>A  B</h1><p>x<b>y</b>z<br>w &lt;i&gt;&amp;amp;</article><footer>{LONG}</footer>", "A B\n\nxyz w <i>&amp;"),
        (f"<nav><ul><li><a href='/'>Home</a></ul></nav><article><p>{LONG}</p></article>", LONG),
        (f"<article><p>One.</p><aside>{LONG}</aside><p>Two.</p></article>", "One.\n\nTwo."),
        (f"<article><p>{LONG}</p><div class='comments'><p>{LONG} too</p></div></article>", LONG),
        (f"<div id='cookie-notice'>{LONG}</div><article>Text</article>", "Text"),
        (f"<form><label>{LONG}</label></form><main><p>Text</p></main>", "Text"),
        (f"<script>var a='<p>{LONG}</p>'</script><style>p{{}}</style><article>T</article>", "T"),
        ("<article>a<!-- <p>no</p> -->b</article>", "ab"),
        ('<article title="a>b">T</article>', "T"),
        (f"<article>5 < 6 and a<b</article><p hidden>{LONG}</p>", "5 < 6 and a"),
        ("<article><p>cut &am", "cut &am"),
        (f"<ul><li><a>One</a><li><a>Two</a></ul><p>{LONG}</p><p>{LONG} again</p>", f"{LONG}\n\n{LONG} again"),
        ("<html><head><title>T</title></head><body><article>\n a \t b \n</article></body>", "a b"),
    ],
)
def test_main_text(page, text):
    assert pages.main_text(page) == text


def test_tree_knows_its_table():
    for page in pages.LABELLED:
        rows = pages.described([b[:3] for b in page])
        assert [pages.chosen(pages.tree(), r) for r in rows] == [b[3] for b in page]


def test_deep_and_broken_markup_ends():
    assert pages.main_text("<div>" * 50_000 + "</x>" * 50_000 + LONG) == LONG
    assert pages.main_text("<a \"" * 5_000 + "<article>T") is not None


def test_query_over_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>", "x"), (1, None, None, "x"), (None, "u", "<article>é</article>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0), r.url or "", r.text, r.n_chars) for r in pages.extracted(df).collect())
    assert got == [(0, "u", "é", 1), (1, "", "", 0), (1, "u", LONG, len(LONG))]
    assert pages.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "element,inside",
    [
        ('<svg class="i"/>', ""),
        ("<svg class=i/>", ""),
        ("<svg>", ""),
        ("<svg><title>t</title><svg>u</svg>v</svg>", ""),
        ("<svg><!-- <svg> --><text>t</text></svg>", ""),
        ("<svg-icon></svg-icon>", ""),
        ("<title-card>t</title-card>", "t\n\n"),
        ("<template-x></template-x>", ""),
        ("<object-view></object-view>", ""),
        ("<math/>", ""),
        ("<object data=x>", ""),
        ("<noscript>", ""),
        ("<template><p>t</p></template>", ""),
        ("<script>'<p>t</p>'</script >", ""),
    ],
)
def test_text_after_elements_without_text(element, inside):
    assert pages.main_text(f"<article><p>one</p>{element}<p>two</p></article>") == f"one\n\n{inside}two"


def test_many_elements_without_end():
    assert pages.main_text("<article>" + "<svg><p>x</p>" * 20_000).count("x") == 20_000


@pytest.mark.parametrize(
    "wrapper",
    ["div class='layout has-sidebar'", "div class=no-sidebar", "div class=with-comments", "div class=sticky-header",
     "div class=elementor-widget-container", "div id=sidebar", "form id=aspnetForm", "div role=form"],
)
def test_wrappers_named_as_furniture(wrapper):
    end, menu, talk = f"</{wrapper.split()[0]}>", "<nav><a>Home</a></nav><div class=menu>x y z</div>", f"<div class=comments>{LONG} no</div>"
    for tag in ("article", "main", "div class=post-content"):
        page = f"<{wrapper}>{menu}<{tag}><p>{LONG}</p>{talk}</{tag.split()[0]}>{talk}{end}<footer>{LONG}</footer>"
        assert pages.main_text(page) == LONG
    assert pages.main_text(f"<{wrapper}>{menu}<p>{LONG}</p><p>{LONG} again</p>{talk}{end}") == f"{LONG}\n\n{LONG} again"


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "comment-list", "cookie-notice", "ad-300x250", "widget_area", "post-comments"])
def test_furniture_by_whole_names(name):
    assert pages.main_text(f"<article>Text</article><div class='x {name}'><p>{LONG} {LONG}</p></div>") == "Text"


def test_comments_that_are_articles():
    talk = f"<div class=comments><article class='comment-body'><p>{LONG} {LONG}</p></article></div>"
    assert pages.main_text(f"<main><p>{LONG}</p>{talk}</main>") == LONG


def test_short_lines_and_notices_without_article_markup():
    menu = "<ul><li><a>Home</a><li><a>News today</a></ul>"
    talk = "".join(f"<p><a>Some One</a></p><p>{LONG.rsplit(' ', k)[0]}</p><p><a>Reply</a></p>" for k in (4, 6))
    lines = ["A heading", f"{LONG} {LONG}", "Why so?", f"{LONG} at once", "Because it is.", LONG, "Yes.", f"{LONG} {LONG} again"]
    text = "".join(f"<p>{line}</p>" for line in lines)
    page = f"<div>We use what your browser keeps on this page</div>{menu}{text}{talk}"
    assert pages.main_text(page) == "\n\n".join(lines)
    assert pages.main_text(f"<article><h1>A b</h1><p><a>By me</a></p><p>{LONG}</p><p>C d</p></article>{menu}") == f"A b\n\nBy me\n\n{LONG}\n\nC d"
