import html
import re

from ledgerlake.llm import wrappers
from ledgerlake.llm.wrappers import Wrapper, fold, main_text


def texts(spark, pages):
    df = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, host string")
    rows = wrappers.extract(df).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def test_fold_and_merge():
    assert fold(list("abababc")) == [("rep", ("a", "b")), "c"]
    one, two, three = (Wrapper.of_page(p) for p in ("<div><p>x</p></div>", "<div><h2>t</h2><p>x</p><p>y</p></div>", "<div><p>q</p></div>"))
    whole = one.merge(two).merge(three)
    assert whole.expression() == "<div>(<h2>#</h2>)?(<p>#</p>)+</div>" and whole.pages == 3
    assert Wrapper.from_json(whole.to_json()).expression() == whole.expression()


def test_article_without_the_rest(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav><header>Top</header>
    <div class="cookie-notice">We use cookies</div><aside>Side</aside><article><h1>A &amp; B</h1><div class="ad"><p>Buy</p></div><p>One
    <b>two</b>&nbsp;three<br>four<p>Five <i>six</i>!</p><form><input><p>Name</p></form><script>if (a < b) "</p>"</script><!-- c <p>no</p> -->
    <ul><li>x</li><li>y</li></ul><section id='comments'><p>I disagree</p></section></article><footer>&copy; foot</footer></body></html>"""
    want = "A & B\nOne two three four\nFive six!\nx\ny"
    assert texts(spark, [("http://a.org/1", page), ("http://a.org/2", page.replace("Five", "Seven")), (None, None), ("x", "")]) == {
        0: want, 1: want.replace("Five", "Seven"), 2: "", 3: ""}


def test_pages_without_semantic_tags(spark):
    def page(k, more=""):
        return f"<div class=top>Same words on top</div><div class=body><h2>Title {k}</h2><p>Long varying text number {k} {'word ' * k}</p>{more}</div><div class=foot>Same words below</div>"
    got = texts(spark, [(f"http://b.org/{k}", page(k, "<p>extra</p>" if k % 2 else "")) for k in range(1, 6)])
    assert got[0] == "Title 1\nLong varying text number 1 word\nextra" and got[1] == "Title 2\nLong varying text number 2 word word"


def test_text_that_starts_alike_varies(spark):
    """A container's text is compared whole: neither a long common opening nor several common nodes hide what follows."""
    opening = "The same opening words of every page on this host, which are far longer than a prefix of 64 letters, "

    def page(k):
        lead = "".join(f"<p>Common lead-in paragraph number {i}, with the very same sixty-four and more letters on all pages</p>" for i in range(5))
        return f"<div class=count>{k} views</div><div class=body>{lead if k % 2 else ''}<p>{opening}then number {k} goes on</p></div><div class=foot>Same words below</div>"
    for odd in (0, 1):
        got = texts(spark, [(f"http://c{odd}.org/{k}", page(2 * k + odd)) for k in range(1, 4)])
        assert all(f"then number {2 * k + 1 + odd + 1} goes on" in got[k] for k in range(3))
        assert all("Same words below" not in t for t in got.values())


def test_pages_unlike_their_host(spark):
    """Another template, class words on the page's own elements, numbered ids and mixed containers lose no text."""
    def page(body, more=""):
        return f"<html><body{more}><div class=top>Same words on top</div>{body}</body></html>"
    got = texts(spark, [(f"http://d.org/{k}", p) for k, p in enumerate([
        page("<article class=story><p>First story</p></article>"),
        page("<article class=story><p>Second story</p></article>", " class='has-sidebar'"),
        page("<article class='post comments-open'><p>Third story</p><article class=comment><p>I disagree</p></article></article>"),
        page("<main class='content footer-on'><p>Fourth story</p></main>"),
        page("<div class=old><p>Fifth story</p></div>"),
        page("<div class=old><p>Sixth story</p></div>"),
        page("<article class=story></article><div class=old><p>Seventh story</p></div>")])])
    assert got == {k: f"{w} story" for k, w in enumerate("First Second Third Fourth Fifth Sixth Seventh".split())}
    got = texts(spark, [(f"http://e.org/{k}", page(f"<div id='post-{k}17'><p>Paragraph {k}</p><ul><li>{f'many listed words {k} ' * 20}</li></ul>"
                                                   f"<blockquote>{k} said</blockquote></div>")) for k in range(4)])
    assert got == {k: f"Paragraph {k}\n{' '.join([f'many listed words {k}'] * 20)}\n{k} said" for k in range(4)}


def test_aligned_slots_that_do_not_vary(spark):
    """The wrapper's slots decide: the same line goes where it is constant and stays where it varies."""
    def page(k):
        more = "".join(f"<p>Paragraph {k} {i}, of some length</p>" for i in range(k % 3))
        odd = "<h2>Share this story</h2>" if k == 3 else f"<h2>Heading {k}</h2>"
        return (f"<article><h1>Story {k}</h1>{odd}<p>Text {k} with <b>bold</b> words in it</p>{more}<p>Share this story</p>"
                f"<div>Reprints need leave.</div><ul><li>point {k}</li></ul></article>")
    got = texts(spark, [(f"http://f.org/{k}", page(k)) for k in range(12)] + [("http://g.org/1", page(1))] * 5)
    for k in range(12):
        head = "Share this story" if k == 3 else f"Heading {k}"
        body = [f"Text {k} with bold words in it", *(f"Paragraph {k} {i}, of some length" for i in range(k % 3))]
        assert got[k] == "\n".join([f"Story {k}", head, *body, f"point {k}"])
    assert {got[k] for k in range(12, 17)} == {main_text(page(1), [""])}  # copies of one page: nothing varies


def test_line_counts_are_bounded():
    """A line of every page keeps nearly all its pages while thousands of others pass."""
    whole = None
    for k in range(600):
        one = Wrapper.from_json(Wrapper.of_page(f"<article><p>Share</p>{''.join(f'<p>{k} {i}</p>' for i in range(5))}</article>").to_json())
        whole = one if whole is None else whole.merge(one)
    widest, counts = max((x for x in whole.lines if x), key=lambda x: len(x[1]))
    assert widest == 6 and len(counts) <= 2 * 16 * 6 and max(counts.values()) >= 600 * 15 / 16
    assert sum(map(len, (v for _, v in __import__("json").loads(whole.guide())[1]))) == 1


def test_broken_markup():
    assert main_text("<article><p>a<b>b</article>c", ["/article"]) == "ab"
    assert main_text("<article>x <a title='q>r'>s</a> < t <script>never closed", ["/article"]) == "x s < t"
    assert main_text("<p>1 &am; &amp 2", [""]) == "1 &am; & 2"
    assert main_text("<article>" + "<p>w</p>" * 20000, ["/article"]).count("\n") == 19999


def brute(page):
    """The test tables' pages: the article's blocks, by simple cuts."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", body))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_whole_table(spark):
    from ledgerlake.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    want = {r["page_id"]: brute(r["html"]) for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    assert {r["page_id"]: r["text"] for r in QUERIES["op2_wrappers"](spark, d).collect()} == want


def test_classes_that_tell_what_an_element_holds(spark):
    from ledgerlake.llm import wrappers
    pages = [(1, "http://a/1", '<body><div class="page has-sidebar"><article><p>One two.</p></article></div></body>'),
             (2, "http://b/1", '<body><div id="content" class="no-comments"><p>Three four.</p></div></body>'),
             (3, "http://c/1", '<body><article><p>Five.</p><div class="sidebar">menu</div><div class="is-wide"><p>Six.</p></div></article></body>')]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "One two.", 2: "Three four.", 3: "Five.\nSix."}
