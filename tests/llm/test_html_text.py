"""HTML extraction on pages with known articles, and densities against a plain recursion."""

import math
import random
import time

from riskbook.llm import html_text as h
from riskbook.llm.common import read_table

LONG = "This sentence is one of many that an article would have, and it has no links at all in it. "


def _page(body, head="<title>t</title><style>p{}</style><script>var a='<p>no</p>'</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_boilerplate_goes_whatever_its_mark():
    boxes = (
        '<nav><ul><li><a href="/">Home</a></li></ul></nav><header>Site</header>',
        '<div class="sidebar">Side {x}</div><div id="cookie-notice">We use cookies {x}</div>',
        '<aside>Aside {x}</aside><form><input> Sign up {x}</form><div class="ad banner">Buy {x}</div>',
        '<section class="comments"><p>Reader says {x}{x}{x}</p></section><footer>&copy; me</footer>',
        '<div role="navigation">Menu {x}</div><!-- <p>hidden</p> --><noscript>turn on {x}</noscript>',
    )
    article = f"<article><h1>Title &amp; more</h1><p>{LONG}</p><p>Two&nbsp;words \n here</p></article>"
    expected = f"Title & more\n{LONG.strip()}\nTwo words here"
    for box in boxes:
        box = box.replace("{x}", LONG)
        assert h.main_text(_page(box + article)) == expected
        assert h.main_text(_page(article + box)) == expected
        assert h.main_text(_page(article.replace("</article>", box + "</article>"))) == expected


def test_density_finds_an_unnamed_article():
    links = "".join(f'<li><a href="/{i}">Some link text {i}</a></li>' for i in range(30))
    page = _page(f"<div><ul>{links}</ul></div><div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></div>")
    assert h.main_text(page) == "\n".join([LONG.strip()] * 3)


def _numbered(pattern, n, start=0):
    texts = [f"Paragraph {i} of the text. {LONG * 4}".strip() for i in range(start, start + n)]
    return "".join(pattern.format(t) for t in texts), texts


def test_sections_nested_and_several_articles_are_kept_whole():
    for outer in (
        "<section><div>{}</div></section>", "<section><h2>Part</h2><div>{}</div></section>",
        "<div><section>{}</section></div>", "<div><div><section>{}</section></div></div>", "<article>{}</article>",
        "<article><h2>Part</h2><div>{}</div></article>",
    ):
        for around in ("{}", "<main>{}</main>", "<div><div>{}</div></div>"):
            parts = [_numbered("<p>{}</p>", 8 - k, 10 * k) for k in range(3)]
            page = _page(around.format("".join(outer.format(markup) for markup, _ in parts)))
            heading = ["Part"] if "h2" in outer else []
            expected = [text for _, texts in parts for text in heading + texts]
            assert h.main_text(page) == "\n".join(expected), (outer, around)


def test_dense_text_at_another_depth_is_kept_and_links_are_not():
    (core, first), (far, last) = _numbered("<p>{}</p>", 8), _numbered("<p>{}</p>", 1, 50)
    links = "<div><ul>" + "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(30)) + "</ul></div>"
    page = _page(f"{links}<div><div><div>{core}</div></div><div><div><div>{far}</div></div></div></div>{links}")
    assert h.main_text(page) == "\n".join(first + last)
    assert h.main_text(_page(f"<main><article>{core}</article></main><div>{far}</div>")) == "\n".join(first)


def test_names_of_wrappers_and_blocks_that_are_no_boilerplate():
    markup, texts = _numbered("<p>{}</p>", 8)
    for article in (markup, f"<article>{markup}</article>", f"<main>{markup}</main>"):
        for mark in (
            'class="layout has-sidebar"', 'class="no-sidebar"', 'class="with-menu"', 'class="ad-free"', 'class="x sidebar"',
            'id="page-with-comments"', 'id="sidebar"', 'class="layout--sidebar"', 'class="page-widget"', 'class="no_ads"',
        ):
            assert h.main_text(_page(f"<div {mark}>{article}</div>")) == "\n".join(texts), mark
    for name in ("share-price", "legal-notice", "market-share", "section-header", "header-image", "menu-card", "ad-free"):
        block = f'<div class="{name}">Block. {LONG * 4}</div>'
        assert h.main_text(_page(f"<article>{markup}{block}</article>")) == "\n".join([*texts, f"Block. {LONG * 4}".strip()]), name
    widgets = "".join(f'<div class="page-widget">{LONG}</div>' for _ in range(4))
    assert h.main_text(_page(widgets)) == "\n".join([LONG.strip()] * 4)


def test_headers_inside_articles_keep_their_headings_whatever_their_class():
    markup, texts = _numbered("<p>{}</p>", 8)
    for opening, closing in (
        ('<header class="entry-header">', "</header>"), ('<header class="header">', "</header>"), ('<header id="site-header">', "</header>"),
        ('<div class="article-header">', "</div>"), ('<div class="header">', "</div>"), ('<div class="entry_header">', "</div>"),
    ):
        page = _page(f"<article>{opening}<h1>The title</h1>{closing}{markup}</article>")
        assert h.main_text(page) == "\n".join(["The title", *texts]), opening
    page = _page(f'<div><div class="article-header"><h1>The title</h1></div>{markup}</div>')
    assert h.main_text(page) == "\n".join(["The title", *texts])


def test_boilerplate_by_name_still_goes():
    markup, texts = _numbered("<p>{}</p>", 8)
    for name in ("sidebar", "page-sidebar", "cookie-notice", "site-header", "top_ad", "post-share related", "main-menu", "sidebar--left", "comments"):
        for around in ("<article>{}</article>{}", "<article>{}{}</article>", "<div>{}{}</div>"):
            if name == "site-header" and around.endswith("{}</article>"):
                continue  # headers inside articles stay
            page = _page(around.format(markup, f'<div class="x {name}"><p>{LONG * 4}</p></div>'))
            assert h.main_text(page) == "\n".join(texts), name
    reply = f'<div id="comments">{markup * 3}</div>'
    assert h.main_text(_page(f"<article>{markup}</article>{reply}")) == "\n".join(texts)


def test_only_exact_attributes_count():
    for attributes in (
        'title="the hidden cost"', "data-title='A hidden valley'", 'data-hidden="false"', 'data-id="share-3"', 'data-id=sidebar',
        'data-role="navigation"', "title='class=\"ad\"'", 'title = "x" data-x = \'id="ad"\'', 'aria-hidden="false"', 'title=a/hidden',
        'xclass="ad"', '"hidden"',
    ):
        assert h.main_text(f"<article><p>One</p><div {attributes}>Two</div></article>") == "One\nTwo", attributes
    for attributes in (
        "hidden", 'x="1"hidden', "hidden=''", "HIDDEN", "a=1 hidden", "aria-hidden = 'true'", 'title="a" role=navigation', "disabled class=ad",
        "x/hidden", 'title="" class = "x ad"',
    ):
        assert h.main_text(f"<article><p>One</p><div {attributes}>Two</div></article>") == "One", attributes


def test_unclosed_and_cut_pages():
    assert h.main_text("<article><p>One<p><b>Two<br>and<p>Three &am") == "One\nTwo and\nThree &am"
    assert h.main_text(f"<body><article><p>{LONG}<p>Last <a hre") == f"{LONG.strip()}\nLast"
    assert h.main_text("<ul><li>a<li>b</ul>") == "a\nb"
    assert h.main_text('<article title="a > b"><p>x</p></article>') == "x"


def test_nothing_to_find():
    for page in (None, "", "<html></html>", "<script>1</script>", "<", "<!-- open"):
        assert h.main_text(page) in ("", "<")


def test_long_page_is_read_whole():
    body = "".join(f"<p>Paragraph number {i} of the page, with some words.</p>" for i in range(20_000))
    assert h.main_text(f"<article>{body}</article>").count("\n") == 19_999


def test_every_page_once(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    found = h.extract_text(pages.selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    assert sorted(r.page_id for r in found) == sorted(r.page_id for r in pages.select("page_id").collect())
    assert all(r.n_chars == len(r.text) and r.text for r in found)


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", "<p>a</p>"), (1, "u", "<p>a</p>")]
    found = h.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in found) == ["", "", "a", "a"]
    assert h.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


COMPOUNDS = (
    "comments-area", "comment-list", "comment-section", "commentlist", "comment-body", "comments-wrapper", "sidebar-left",
    "sidebar-right", "left-sidebar", "related-posts", "related-articles", "share-buttons", "social-links", "ad-container",
    "ads-wrapper", "ad-slot-2", "footer-links", "cookie-bar", "newsletter-box", "newsletter-signup", "widget-area", "nav-links",
    "nav-menu", "promo-box", "promo_block", "popup-inner", "sponsored-content", "breadcrumb-list", "pagination-wrap", "notice-bar",
)


def test_compound_names_of_boilerplate():
    markup, texts = _numbered("<p>{}</p>", 8)
    for name in COMPOUNDS:
        for around in ("<article>{}</article>{}", "<article>{}{}</article>", "<div>{}{}</div>"):
            page = _page(around.format(markup, f'<div class="x {name}"><p>{LONG * 4}</p></div>'))
            assert h.main_text(page) == "\n".join(texts), (name, around)


def test_compound_names_around_the_page_keep_it():
    markup, texts = _numbered("<p>{}</p>", 8)
    for name in ("sidebar-left", "sidebar-right", "widget-container", "ad-free-content", "no-sidebar-left", "social-section"):
        for article in (markup, f"<article>{markup}</article>"):
            assert h.main_text(_page(f'<div class="{name}">{article}</div>')) == "\n".join(texts), name


def test_comments_go_even_where_they_are_longer():
    markup, texts = _numbered("<p>{}</p>", 4)
    replies, _ = _numbered("<div><p>{}</p></div>", 30, 100)
    for name in ("comments", "comments-area", "comment-list", "disqus"):
        for page in (f'<div>{markup}</div><div class="{name}">{replies}</div>', f'<div>{markup}<section id="{name}">{replies}</section></div>'):
            assert h.main_text(_page(page)) == "\n".join(texts), name


def test_form_around_the_page_keeps_its_article():
    markup, texts = _numbered("<p>{}</p>", 8)
    for article in (markup, f"<article>{markup}</article>", f"<main><div>{markup}</div></main>"):
        page = f'<form action="/x"><input type="hidden" value="1"><nav>Menu</nav><div>{article}</div></form>'
        assert h.main_text(_page(page)) == "\n".join(texts)
    page = f"<div>{markup}</div><form><p>Sign up for our letter. {LONG}</p><input></form>"
    assert h.main_text(_page(page)) == "\n".join(texts)


def test_unclosed_and_stray_tags_take_linear_time():
    for body in ("<b>x" * 50_000, "</div>" * 50_000, "<p>x</b></i>" * 25_000, "<div>x" * 50_000, "<li><div><b>x" * 20_000, "<article>" + "<b>x</header>" * 30_000):
        start = time.perf_counter()
        h.main_text(f"<body><p>{LONG}</p>{body}</body>")
        assert time.perf_counter() - start < 5


def _plain_densities(tree):
    """Characters, tags and links of every subtree counted anew from the top, and the density by its formula."""

    def count(i, linked):
        linked = linked or tree.tags[i] == "a"
        chars = sum(len("".join(x.split())) for x in tree.items[i] if isinstance(x, str))
        total = [chars, 0, chars if linked else 0, int(tree.tags[i] == "a")]
        for child in (x for x in tree.items[i] if not isinstance(x, str)):
            below = count(child, linked)
            total = [total[0] + below[0], total[1] + below[1] + 1, total[2] + below[2], total[3] + below[3]]
        if tree.tags[i] == "a":
            total[3] = total[1] + 1
        return total

    chars, _, links, _ = count(0, False)
    found = []
    for i in range(len(tree.tags)):
        c, t, lc, lt = count(i, False)
        base = math.log(c * lc / max(1, c - lc) + links / max(1, chars) * c + math.e)
        found.append(c / max(1, t) * math.log(1 + c / max(1, lc) * max(1, t) / max(1, lt)) / math.log(1 + base) if c else 0.0)
    return found, [sum(found[x] for x in items if not isinstance(x, str)) for items in tree.items]


def test_densities_are_those_of_a_plain_recursion():
    chance = random.Random(6)
    for _ in range(60):
        tree = h.Tree()
        for _ in range(chance.randint(1, 40)):
            number = tree.add(chance.choice(["div", "p", "section", "a", "span"]), chance.randrange(len(tree.tags)))
            if chance.random() < 0.7:
                tree.items[number].append("word " * chance.randint(1, 30))
        density, sums = _plain_densities(tree)
        found = h.densities(tree)
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(found[0], density))
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(found[1], sums))
