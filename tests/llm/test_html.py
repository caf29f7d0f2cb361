import html as references
import re

import pytest

from corpusloom.llm import html
from corpusloom.llm.queries import op2_html_text
from tests.llm.conftest import ROWS

CASES = {
    "<html><body><nav><a>Menu</a></nav><article><h1>T &amp; U</h1><p>One  <b>two</b>\n three&nbsp;x"
    "<p>Next</article><footer>f</footer>": "T & U\nOne two three x\nNext",
    "<body><header>Top</header><main><p>Body</p><aside>Side</aside><form><p>Your name</p></form></main>": "Body",
    "<div class='content'><p>Text</p><div class=\"ad banner\">Buy</div></div><div id=comments>Nice!</div>": "Text",
    "<article><p>A</p><section class='comments'><article class='comment'><p>C</p></article></section></article>": "A",
    "<p>a<script>var t='</p>';</script>b<style>p{}</style>c<!-- no -->d": "abcd",
    "<p>x &lt;tag&gt; &#233; &#x41; &am; a < b": "x <tag> é A &am; a < b",
    "<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>": "one\ntwo\nc1\nc2",
    "<p>line<br>break<img src=x>more<span>!</span></p>": "line\nbreakmore!",
    "<body class='has-sidebar menu'><p>kept</p></body>": "kept",
    "<div class='cookie-notice'>We use cookies</div><div class='download heading'>kept</div>": "kept",
    "<p title='a>b'>attr</p><p>un<b>closed</p><p>end": "attr\nunclosed\nend",
    "no markup at all": "no markup at all",
    "<div class='content with-sidebar'><p>kept</p></div>": "kept",
    "<div id='page' class='no-sidebar'><article>kept</article></div>": "kept",
    "<section class='related-work'><p>kept</p></section>": "kept",
    "<div class='post-header-fixed'><main>kept</main></div>": "kept",
    "<div class='comments-off'><p>kept</p></div><div data-id='share'>too</div>": "kept\ntoo",
    "<div class='header'><article><p>kept</p></article></div>": "kept",
    "<form><div class='sidebar'>s</div><p>a long enough story</p></form>": "a long enough story",
    "<div class='site-footer'>gone</div><p>kept for its length</p>": "kept for its length",
    "<p>Short</p><div class='comments'><p>a very long comment of a reader</p></div>": "Short",
    "<div class='sidebar'>all there is</div>": "all there is",
    "": "", "<html></html>": "", " \n ": "", "<": "<", "<p": "", "<!--": "",
}


@pytest.mark.parametrize("source", CASES)
def test_texts_of_one_page(source):
    assert "\n".join(html.Page(source).texts()) == CASES[source]


def pages(n, body):
    return [(k, f"http://site.example.org/{k}", body(k)) for k in range(n)]


SCHEMA = "page_id bigint, url string, html string"


def test_template_is_deduced_without_names(spark):
    """No element says what it is: what every page of the host repeats goes."""
    rows = pages(
        12,
        lambda k: f"<div><div>Home News Contact</div><div><p>Story {k} tells</p><p>more of {k}</p></div>"
        "<div>Read our house rules</div></div>",
    )
    got = html.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r.page_id: r.text for r in got} == {k: f"Story {k} tells\nmore of {k}" for k in range(12)}


def texts_of(spark, rows, **options):
    done = html.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    return {r.page_id: r.text for r in done.collect()}


def test_three_layouts_on_one_host(spark):
    """Each layout stands on a third of the pages; without the template all of it stays."""
    rows = pages(
        60,
        lambda k: f"<div>Menu of layout {k % 3}</div><div><p>Story {k}</p><p>more of {k}</p></div>"
        f"<div>Imprint of layout {k % 3}</div>",
    )
    assert texts_of(spark, rows) == {k: f"Story {k}\nmore of {k}" for k in range(60)}
    assert "Menu of layout 1" in texts_of(spark, rows, support=2.0)[1]


def test_a_quoted_sentence_stays(spark):
    quote = "<p>To be or not to be.</p>"
    rows = pages(20, lambda k: f"<div>Top</div><div><p>Story {k}</p>{quote * (k % 2)}<p>end {k}</p></div>")
    text = texts_of(spark, rows)
    assert text[3] == "Story 3\nTo be or not to be.\nend 3" and text[4] == "Story 4\nend 4"


def test_nothing_inside_a_marked_article_is_template(spark):
    rows = pages(12, lambda k: f"<div>Top</div><article><p>Same words</p><p>Same end</p><p>{k}</p></article>")
    assert texts_of(spark, rows)[7] == "Same words\nSame end\n7"


def test_cost_is_linear_in_the_page():
    import time

    begin = time.process_time()
    html.Page("<span>" * 20_000 + "x</b>" * 20_000)
    html.Page("<div>" * 20_000 + "<p>y</i>" * 20_000)
    assert time.process_time() - begin < 3


def test_small_hosts_and_copied_articles_lose_nothing(spark):
    few = pages(4, lambda k: f"<div>Same words</div><p>Story {k}</p>")
    copies = [(100 + k, f"https://other.example.org/{k}", "<p>One story</p><p>copied</p>") for k in range(30)]
    copies += [(200 + k, f"https://other.example.org/x{k}", f"<p>Own {k}</p>") for k in range(3)]
    got = html.main_text(spark.createDataFrame(few + copies, SCHEMA))
    text = {r.page_id: r.text for r in got.collect()}
    assert text[0] == "Same words\nStory 0" and text[110] == "One story\ncopied" and text[201] == "Own 1"


def test_template_keeps_its_order(spark):
    """An article that quotes the template's words in another place keeps them."""
    rows = pages(10, lambda k: f"<p>Begin</p><p>Story {k}</p><p>End</p>")
    rows.append((50, "http://site.example.org/z", "<p>Begin</p><p>Story z</p><p>Begin</p><p>End</p>"))
    text = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert text[3] == "Story 3" and text[50] == "Story z\nBegin"


def test_classes_are_nested(spark):
    def body(k):
        box = "<div class='box'><p class='x'>Offer</p><p class='y'>Now</p></div>" if k % 3 else ""
        return f"<div class='a'>Top</div>{box}<p>Story {k}</p><div class='z'>Bottom</div>"

    found = html.templates(spark.createDataFrame(pages(30, body), SCHEMA)).collect()
    classes = html.nest(found[0].template)
    assert sorted(n for _, _, n, _ in classes) == [20, 30]
    outer = next(name for name, _, n, _ in classes if n == 30)
    assert next(parent for _, parent, n, _ in classes if n == 20) == outer


def test_query_equals_the_marked_articles(spark, sf):
    rows = op2_html_text(spark, sf).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        article = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", article)
        blocks = [" ".join(references.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text)


def test_odd_rows(odd):
    got = html.main_text(odd.drop("url", "html"), url="source", source="text", column="main")
    assert got.count() == len(ROWS)
    assert {r.doc_id: r.main for r in got.collect()}[2] == ""
    assert html.main_text(odd.limit(0), url="source", source="text", column="main").count() == 0
    assert odd.select(html.host_of(odd.url)).first()[0] == ""
