import random

from cantora.llm import components, url_filter


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in parent}


def test_components_equal_union_find(frame):
    rng = random.Random(7)
    shapes = {
        "path": [(i, i + 1) for i in range(60)], "star": [(1000, 1000 - i) for i in range(1, 80)], "none": [],
        "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(5, None), (7, 7), (400, 400)],
    }
    for pairs in shapes.values():
        got = components.connected_components(frame(pairs, "a long, b long")).collect()
        assert {r["node"]: r["component"] for r in got} == brute(pairs) and len(got) == len(brute(pairs))


def link(target):
    return f'<html><head><LINK rel="canonical" href="{target}"></head><p>x'


def test_verdicts(frame):
    pages = frame([
        (1, "http://A.Net/x?q#f", None), (2, "https://a.example.net/en/1", ""), (3, "http://b.example.com/de/1", ""),
        (4, "http://x.org/fr/1", ""), (5, None, link("http://a.net/x")), (6, "no scheme", ""), (7, "http://net", ""),
        (8, "http://planet/de/", ""),
        # aliases of a blocked page, in a chain and by a redirect; the last is only a target
        (10, "http://m.x.org/1", link("http://x.org/1")), (11, "http://x.org/1", link("https://bad.net/1")),
        (12, "http://y.org/2", "<meta http-equiv=refresh content='0; url=//x.org/1'>"),
        # a group with an allowed page
        (20, "http://z.org/1", link("http://bad.net/2")), (21, "http://w.org/1", link("http://bad.net/2")),
        (22, "http://w.org/1", link("http://q.org/fr/2")), (23, "http://w.org/9", link("/1")), (None, "http://w.org/9", None),
    ], "page_id long, url string, html string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.redirect_filter(pages).collect()}
    assert got == {
        (1, "a.net", "/x", "net/", "block"), (2, "a.example.net", "/en/1", "example.net/en/", "allow"),
        (3, "b.example.com", "/de/1", "example.com/de/", "block"), (4, "x.org", "/fr/1", "org/fr/", "allow"),
        (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "net", "", None, "allow"), (8, "planet", "/de/", None, "allow"),
        (10, "m.x.org", "/1", None, "block"), (11, "x.org", "/1", None, "block"), (12, "y.org", "/2", None, "block"),
        (20, "z.org", "/1", None, "allow"), (21, "w.org", "/1", None, "allow"), (22, "w.org", "/1", None, "allow"),
        (23, "w.org", "/9", None, "allow"), (None, "w.org", "/9", None, "allow"),
    }


def test_given_redirects_and_empty(frame):
    pages = frame([(1, "http://x.org/1", "", 1)], "page_id long, url string, html string, rule int")
    moved = frame([("http://x.org/1", "http://bad.net/")], "source string, target string")
    assert url_filter.redirect_filter(pages, redirects=moved).first()["verdict"] == "block"
    assert url_filter.redirect_filter(pages.limit(0)).count() == 0


def test_no_python_on_the_main_path(frame):
    pages = frame([(1, "http://x.org/1", link("http://bad.net/"))], "page_id long, url string, html string")
    plan = url_filter.redirect_filter(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_relative_targets(frame):
    page = "http://X.org/a/b/page.html?q=1#f"
    expected = {
        "index.html": "x.org/a/b/index.html", "./c": "x.org/a/b/c", "../c": "x.org/a/c", "../../../c": "x.org/c", "..": "x.org/a/",
        ".": "x.org/a/b/", "?id=2&amp;n=3": "x.org/a/b/page.html?id=2&n=3", "#top": "x.org/a/b/page.html?q=1", "/r/../s": "x.org/s",
        "//Y.org/z": "y.org/z", "https://y.org/../z?u=../v": "y.org/z?u=../v", "login?next=http://z.org/": "x.org/a/b/login?next=http://z.org/",
        "c/d//..;p/e...": "x.org/a/b/c/d//..;p/e...", "http:g": "x.org/a/b/g",
    }
    pages = frame([(i, page, link(t)) for i, t in enumerate(expected)] + [
        (90, page, link("mailto:a@b.org")), (91, page, "<link rel=canonical href=''><meta http-equiv=refresh content=5>"),
        (92, "no scheme", link("x")),
    ], "page_id long, url string, html string")
    edges = url_filter.page_links(pages).collect()
    assert {r["a"] for r in edges} == {"x.org/a/b/page.html?q=1"} and {r["b"] for r in edges} == set(expected.values())
    rooted = frame([
        (1, "http://x.org", link("index.html")), (2, "http://w.org", link("?id=2")),
        (3, "http://v.org/a/b", '<base target=_top><base href="../c/"><meta http-equiv="refresh" content="0; url=new.html">'),
    ], "page_id long, url string, html string")
    got = {(r["a"], r["b"]) for r in url_filter.page_links(rooted).collect()}
    assert got == {("x.org", "x.org/index.html"), ("w.org", "w.org?id=2"), ("v.org/a/b", "v.org/c/new.html")}


def test_relative_aliases_share_verdicts(frame):
    # x.org/s/hub, whose own link leads to a blocked page, is named by every form; w.org/s/ok leads to an allowed one
    pages = frame([
        (1, "http://x.org/s/hub", link("http://bad.net/1")), (2, "http://x.org/s/t", link("hub")), (3, "http://x.org/s/u/t", link("../hub")),
        (4, "http://x.org/s/u/t?x", "<meta http-equiv=refresh content='0; url=../t'>"), (5, "http://x.org/s/t?id=2", link("t")),
        (6, "http://x.org/s/t?id=3", link("?id=2")), (7, "http://x.org/s/v/../w", link("hub")), (8, "http://x.org/s/w", ""),
        (9, "http://x.org/other", link("hub")),
        (20, "http://w.org/s/a", link("http://bad.net/2")), (21, "http://w.org/s/a", link("ok")), (22, "http://w.org/s/ok", link("http://q.org/fr/2")),
    ], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.redirect_filter(pages).collect()}
    assert got == {**{i: "block" for i in range(1, 9)}, 9: "allow", 20: "allow", 21: "allow", 22: "allow"}
    moved = frame([("http://x.org/a/1", "../b")], "source string, target string")
    one = frame([(1, "http://x.org/a/1", link("http://bad.net/")), (2, "http://x.org/b", "")], "page_id long, url string, html string")
    assert {r["verdict"] for r in url_filter.redirect_filter(one, redirects=moved).collect()} == {"block"}


def test_only_real_tags_make_edges(frame):
    bad = "http://bad.net/1"
    html = {
        1: f"<!-- {link(bad)} -->", 2: f"<script>var a = '{link(bad)}';</script>", 3: f"<script>/* <!-- */</script>{link(bad)}",
        4: f"<style>{link(bad)}", 5: f"<title>{link(bad)}</title>", 6: f"<!-- <script> -->{link(bad)}", 7: f"<scripted>{link(bad)}",
        8: f"<link rel=canonical title='a > b' href = {bad} >", 9: "<link rel='canonical' href='http://bad.net/a b'>",
        10: "<meta content='0;URL=\"http://bad.net/a b\"' http-equiv=refresh>", 11: "<link rel='not-canonical' href=http://bad.net/>",
        12: "<link rel='alternate canonical' href=' http://bad.net/x '>", 13: "<!--" * 50_000 + link(bad), 14: "<link " * 50_000,
    }
    pages = frame([(i, f"http://x.org/{i}", h) for i, h in html.items()], "page_id long, url string, html string")
    got = {int(r["a"].rpartition("/")[2]): r["b"] for r in url_filter.page_links(pages).collect()}
    assert got == {3: "bad.net/1", 6: "bad.net/1", 7: "bad.net/1", 8: "bad.net/1", 9: "bad.net/a b", 10: "bad.net/a b", 12: "bad.net/x"}
