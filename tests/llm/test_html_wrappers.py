"""Wrappers: alignment into slots, repeats and options; main text of whole pages; odd markup."""

import html
import random
import re

from ledgerlake.llm import html_wrappers as H
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL

SHELL = (
    "<html><body><header>Top</header><nav><a>one</a><a>two</a></nav>{}"
    "<div class='sidebar'>side</div><form><input name=q>find</form><footer>foot</footer></body></html>"
)


def text_of(pages):
    w = None
    for p in pages:
        x = H.wrapper(H.parse(p))
        w = x if w is None else H.merge(w, x)
    return [H.page_text(p, H.regions(w)) for p in pages], H.pattern(w)


def test_alignment_infers_slots_repeats_and_options():
    pages = [
        "<div><h1>A</h1><p>x</p><p>y</p><i>same</i></div>",
        "<div><h1>B</h1><p>z</p><i>same</i><b>new</b></div>",
    ]
    assert text_of(pages)[1] == "<div><h1>#text</h1>(<p>#text</p>)+<i>#same</i>(<b>#same</b>)?</div>"
    pairs = "<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>"
    assert text_of([pairs])[1] == "<dl>(<dt>#text</dt><dd>#text</dd>)+</dl>"


def test_partial_wrappers_merge_like_pages():
    rnd = random.Random(3)
    pages = [
        "<div>" + "<h2>t</h2>" * rnd.randint(0, 1) + "".join(f"<p>{rnd.random()}</p>" for _ in range(rnd.randint(1, 4))) + "</div>"
        for _ in range(12)
    ]
    parts = [H.wrapper(H.parse(p)) for p in pages]
    whole = parts[0]
    for w in parts[1:]:
        whole = H.merge(whole, w)
    left, right = parts[0], parts[6]
    for w in parts[1:6]:
        left = H.merge(left, w)
    for w in parts[7:]:
        right = H.merge(right, w)
    assert H.pattern(H.merge(left, right)) == H.pattern(whole)


def test_main_text_without_an_article_element():
    body = "<div id=c1 class=content><p>First &amp; <b>fore</b>most\n word</p><ul><li>it&eacute;m</li></ul>{}</div>"
    pages = [SHELL.format(body.format(f"<p>{'long text ' * 9}{k}</p><div class=comments>no</div>")) for k in range(4)]
    texts, _ = text_of(pages)
    assert texts[2] == "First & foremost word itém " + "long text " * 9 + "2"


def test_articles_leave_out_what_stands_beside():
    page = SHELL.format(
        "<article><h1>Head</h1><p>One<br>two&nbsp;three<div class='ad-box'>buy</div><p>four</p>"
        "<section class=comments>me</section><script>var t='</p>'</script></article>"
    )
    assert H.page_text(page, None) == "Head One two three four"


def test_odd_markup():
    cases = {
        "": "", "plain": "plain", "<p>a<p>b": "a b", "a < b": "a < b", "<!-- open": "", "<script>x": "", "</p>x": "x",
        "<p title='a>b'>c</p>": "c", "<p title=\"x>y</p>": "y", "<b>a<p>b</b>c": "a bc", "&#65;&lt;p&gt;": "A<p>",
        "<ul><li>a<li>b</ul>": "a b", "<table><tr><td>a<td>b<tr><td>c</table>": "a b c",
    }
    assert {k: H.page_text(k, None) for k in cases} == cases
    assert H.page_text("<div>" * 5000 + "deep" + "</div>" * 5000, None) == "deep"
    for hard in ("<" * 200_000, "<a '" * 50_000, "<!--" * 50_000, "<p>x" * 20_000):
        H.page_text(hard, None)


def test_text_after_deep_nests_stays():
    for n in (50, 95, 98, 99, 100, 150, 3000):
        nest = "<div>" * n + "deep<div>one</div>two<form>no<div>no</div></form><p>three" + "</div>" * n
        page = SHELL.format(f"<article><p>before</p>{nest}<p>after</p></article>")
        assert H.page_text(page, None) == "before deep one two three after", n
        # the nest's closing tags do not close the div around the article
        around = SHELL.format(f"<div id=page><article><p>before</p>{nest}<p>after</p></article></div>")
        assert H.page_text(around, None) == "before deep one two three after", n
        inline = SHELL.format(f"<article>{'<b>' * n}a<p>b</p><nav>no<nav>no</nav>no</nav>c<p>d</p></article>")
        assert H.page_text(inline, None) == "a b c d", n
    for hard in ("<u><div>" + "<b>" * 50_000 + "</u>" * 50_000, "<h1>x" * 50_000, "<form>x" * 50_000):
        H.page_text(hard, None)


def brute(page):
    """These pages keep their text in one article element."""
    art = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not art:
        return None
    plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", art[1]))
    return " ".join(html.unescape(plain).split())


def test_query_on_all_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = QUERIES["op3_wrapper_text"](spark, SF_SMALL).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    wrong = [r["page_id"] for r in rows if brute(pages[r["page_id"]]) not in (None, r["text"])]
    assert wrong == []


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, None, "x"), (None, "http://a.org/1", "", "x"), (2, "nonsense", "<p>hi</p>", None), (2, "nonsense", "<p>hi</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in H.extract(pages).collect())
    assert out == [("1", "", 0), ("2", "hi", 2), ("2", "hi", 2), ("None", "", 0)]
    assert H.extract(pages.limit(0)).count() == 0
