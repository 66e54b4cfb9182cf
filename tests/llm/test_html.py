import pytest

from cantora.llm import html_text

RUN = "It is the tale of a man and of the sea that he was on for all of his life. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p", ""), ("<p>a</p><", "a\n<"), ("just words", "just words"),
    ("<p>a<b>b</b>c &lt;x&gt; &nbsp;y&#33;</p>", "abc <x> y!"),
    ("<article><h1>T</h1><p><b>One.<br><p>Two\n\n  three</article><footer>foo", "T\nOne.\nTwo three"),
    ("<script>var t='</p>';<p>no</script><style>p{}</style><!-- <p>no --><p>yes</p>", "yes"),
    (f"<nav><p>{RUN * 3}</p></nav><p>{RUN * 3}</p>", (RUN * 3).strip()),
    (f"<div class='user-comments'><p>{RUN * 3}</p></div><article><p>{RUN}</p><p>Short end.</p></article>", RUN.strip() + "\nShort end."),
    (f"<article><p>{RUN}</p><aside>note</aside><ul><li><a href=x>Link one</a></li><li><a>two</a></li></ul><p>End.</p></article>", RUN.strip() + "\nEnd."),
    (f"<form><p>{RUN}</p></form><div id=cookie-notice>{RUN}</div><main><header><h1>Title</h1></header><p>{RUN}</p></main>", "Title\n" + RUN.strip()),
    (f"<div>{RUN * 2}</div><div>Menu item</div>" + "<div><a href=x>one link here</a></div>" * 3, (RUN * 2).strip() + "\nMenu item"),
    ("<p title='a > b'>x</p>", "x"), ("<article><p>a</p></div></section><p>b</p></article><p>out</p>", "a\nb"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_query(frame, spark):
    pages = frame(
        [(1, "http://a.b/", "<p>" + "à la mer " * 30_000, 1), (1, None, None, 1), (None, "u", "<nav>x</nav>", 1)],
        "page_id long, url string, html string, text int")
    got = {(r["page_id"], r["url"]): (len(r["text"]), r["n_chars"]) for r in html_text.extract(pages).collect()}
    assert got == {(1, "http://a.b/"): (269_999, 269_999), (1, None): (0, 0), (None, "u"): (0, 0)}
    assert html_text.extract(pages.limit(0)).count() == 0


def test_long_malformed_page_is_linear():
    import time

    start = time.perf_counter()
    html_text.main_text("<a href=\"" * 20_000)
    html_text.main_text("<" * 200_000)
    assert time.perf_counter() - start < 20


PROSE = [
    "Granite forms where magma cools slowly below ground, giving crystals time to grow. Quartz, feldspar, mica and "
    "hornblende together give most granites their speckled look, from pale grey or pink to nearly black stone.",
    "Between 1850 and 1900, steam engines replaced horses on farms across northern Europe. Threshing machines moved "
    "between villages every autumn, hired by several families who shared both costs and labour during harvest.",
]
POLISH = (
    "Granit powstaje tam, gdzie magma powoli stygnie pod ziemią, dzięki czemu kryształy mają czas urosnąć. Kwarc, skaleń "
    "oraz łyszczyki nadają większości granitów nakrapiany wygląd, od jasnoszarego lub różowego po niemal czarny."
)
LINKS = "<div><a href=x>one link here</a></div>" * 3
PARTS = "Bolt M4, washer M4, nut M4, bolt M5, washer M5, nut M5, bracket left, bracket right, hinge, screw M3."


@pytest.mark.parametrize("page, text", [
    (f"{LINKS}<div>{PROSE[0]}</div>{LINKS}", PROSE[0]),
    (f"{LINKS}<div>{PROSE[1]}</div><div>{PROSE[0]}</div><footer>foo</footer>", PROSE[1] + "\n" + PROSE[0]),
    (f"{LINKS}<div>{POLISH}</div>{LINKS}", POLISH),
    (f"<nav>x</nav><div>{PROSE[0]}</div><div>{PARTS}</div><footer>{RUN * 2}</footer>", PROSE[0] + "\n" + PARTS),
    # the article is a teaser card, the body lies outside it
    (f"<div><h1>Title</h1><p>{RUN * 3}</p><p>{PROSE[0]}</p></div><article><a href=x>Read this next</a></article>",
     f"Title\n{(RUN * 3).strip()}\n{PROSE[0]}"),
    (f"<p>{RUN * 3}</p><article><p>A card.</p></article><p>{PROSE[0]}</p>", f"{(RUN * 3).strip()}\nA card.\n{PROSE[0]}"),
    # running text before the article stays, short text and lists outside it do not
    (f"<p>{RUN}</p><footer>x</footer><article><p>{RUN * 3}</p></article>", f"{RUN.strip()}\n{(RUN * 3).strip()}"),
    (f"<div>{PARTS}</div><article><p>{RUN * 3}</p><p>{PARTS}</p></article><p>out</p>", f"{(RUN * 3).strip()}\n{PARTS}"),
])
def test_densities_decide(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("head, part", [
    ('<h2 id="related-work">', "Related work"), ('<h2 id="social-history">', "Social history"), ('<p id="notice-period">', RUN.strip()),
    ('<div class="article-header"><h1>', "Title"), ('<section class="related-work"><p>', (RUN * 2).strip()),
    ('<section id="market-share"><p>', (RUN * 2).strip()), ('<div class="comment-on-method">', (RUN * 2).strip()),
    ('<div class="page no-sidebar">', (RUN * 2).strip()),
])
def test_names_of_parts_of_an_article(head, part):
    tags = [t[1:].split()[0].rstrip(">") for t in head.split(">") if t]
    inner = head + part + "".join(f"</{t}>" for t in reversed(tags)) + f"<p>{RUN * 3}</p>"
    text = part + "\n" + (RUN * 3).strip()
    assert html_text.main_text(f"<nav>x</nav><article>{inner}</article>") == text
    assert html_text.main_text(f"<nav>x</nav><div>{inner}</div>") == text


@pytest.mark.parametrize("junk", [
    f'<div class="ad">{RUN}</div>', '<p class="ad">Buy now</p>', f'<section class="comments"><p>{RUN * 3}</p></section>',
    '<div class="share">Share: <a href=x>on one site</a> <a href=y>on another one</a></div>',
])
def test_junk_inside_the_article(junk):
    assert html_text.main_text(f"<article><p>{RUN * 2}</p>{junk}<p>{RUN}</p></article>") == (RUN * 2).strip() + "\n" + RUN.strip()


@pytest.mark.parametrize("junk", [
    f'<div class="user-comments">{RUN * 3}</div>', f'<div id="cookie-notice">{RUN * 2}</div>', '<div class="share-buttons">Share this</div>',
    f'<div class="sidebar">{RUN * 2}</div>', '<div class="related-posts">More: <a href=x>One long title of a post</a></div>',
])
def test_junk_of_pages_without_article(junk):
    assert html_text.main_text(f"<div><p>{RUN * 2}</p>{junk}<p>{RUN * 2}</p></div>") == "\n".join([(RUN * 2).strip()] * 2)


def test_text_of_formulas():
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>x = {1}</annotation></math>"
    assert html_text.main_text(f"<article><p>{RUN}Here {formula} holds.</p></article>") == RUN + "Here x=1 holds."


@pytest.mark.parametrize("open_tag", [
    '<div class="reader-comments">', '<ol class="comment-list">', '<ol class="commentlist">', '<div id="comments">', '<section class="comments-area">',
    '<div class="notice">', '<div class="sidebar">', '<div class="newsletter">', '<div class="promo">', '<div class="ad-slot">',
    '<article class="related">', '<article class="post comment">',
])
def test_named_parts_of_the_article_go(open_tag):
    tag = open_tag[1:].split()[0]
    page = f"<article><p>{RUN * 3}</p>{open_tag}<p>{RUN}</p></{tag}><p>{RUN * 2}</p></article>"
    assert html_text.main_text(page) == f"{(RUN * 3).strip()}\n{(RUN * 2).strip()}"


@pytest.mark.parametrize("open_tag", [
    '<div class="notice">', '<div class="sidebar">', '<article class="related">', '<div class="comment-on-method">', '<div class="has-comments">',
    '<div class="adaptation">', '<section class="commentary">',
])
def test_names_that_hold_the_article_stay(open_tag):
    tag = open_tag[1:].split()[0]
    assert html_text.main_text(f"<article>{open_tag}<p>{RUN * 3}</p></{tag}><p>{RUN}</p></article>") == f"{(RUN * 3).strip()}\n{RUN.strip()}"


@pytest.mark.parametrize("inner", [
    "<button>Share this</button>", '<span class="ad">Buy <b>now</b></span>', "<select><option>one</option></select>", '<em class="ad"><a href=x>Buy</a></em>',
])
def test_inline_controls_and_adverts_leave_the_paragraph_whole(inner):
    start, end = RUN.strip(), (RUN * 2).strip()
    assert html_text.main_text(f"<article><p>{start} {inner} {end}</p><p>{end}</p></article>") == f"{start} {end}\n{end}"
    unclosed = f"<article><p>{start} <span class='ad'>Buy</p><p>{end}</p></article>"
    assert html_text.main_text(unclosed) == f"{start}\n{end}"


def test_linked_headings_and_paragraphs_stay():
    page = f"<article><h1><a href=x>Title</a></h1><p>{RUN * 2}</p><p>Source: <a href=y>the book itself</a></p><ul><li><a href=z>menu</a></li></ul></article>"
    assert html_text.main_text(page) == f"Title\n{(RUN * 2).strip()}\nSource: the book itself"
