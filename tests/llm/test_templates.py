from __future__ import annotations

import re
from html import unescape

import pytest

from tidemark.llm import templates
from tidemark.llm.templates import Page

SCHEMA = "page_id int, url string, html string, host string, text string, subtrees string"


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"),
    ("<article><h1>T &amp; t</h1><p>one<br>two <b>thr</b>ee&nbsp;x</p></article>", "T & t\n\none two three x"),
    ("<nav>n</nav><main><p>m</p></main><footer>f</footer>", "m"),
    ("<body><header>h</header><article><header><h1>H</h1></header>t</article></body>", "H\n\nt"),
    ("<script>var a='</p><article>no</article>';</script><article>yes</article>", "yes"),
    ("<article>a<!-- <p>no</p> -->b<div class=\"ad\">ad</div><form><input>q</form>c</article>", "ab\n\nc"),
    ("<article><ul><li>x<li>y</ul><div class='reader comments'>z</div></article>", "x\n\ny"),
    ("<article><table><tr><td>a<td>b<tr><th>c</table></article>", "a b\n\nc"),
    ("<article>a < b and c > d &lt;p&gt;</article>", "a < b and c > d <p>"),
    ("<article><p title='a>b'>quoted</p><p title='open>rest</article>", "quoted\n\nrest"),
    ("</div></p><article>stray</b></i></article></article>", "stray"),
    ("<article>one</article><aside>no</aside><article>two</article>", "one\n\ntwo"),
    ("<div id='cookie-notice'>c</div><div hidden>h</div><div role='navigation'>r</div><p>kept</p>", "kept"),
    ("<article>cut off <b", "cut off <b"), ("<style>p{}</style><svg><text>x</text></svg>z", "z"),
    ("<article><p>" + "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_page_texts(html, text):
    assert Page(html).text() == text


def test_all_pages_of_the_tables_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in templates.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        plain = [" ".join(unescape(re.sub(r"<(?:br|/?b)>", lambda m: " " * (m[0] == "<br>"), b)).split()) for b in blocks]
        assert got[r.page_id].text == "\n\n".join(b for b in plain if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_recurring_subtrees_go_copies_do_not_count(spark):
    box = "<div><span>read more of this host</span></div>"
    rows = [(i, f"http://Host.example:80/{i}", f"<div>own text {i}</div>{box}") for i in range(12)]
    rows += [(100 + i, f"https://copy.example/{i}", f"<p>all the same</p>{box}") for i in range(30)]
    rows += [(200 + i, f"http://u@few.example/{i}", f"<p>{i}</p>{box}") for i in range(4)]
    shared = "<p>a passage that many articles of this host quote</p>"
    rows += [(300 + i, f"//art.example/{i}", f"<article><p>article {i}</p>{shared if i % 2 else ''}</article>") for i in range(30)]
    rows += [(400, None, None), (401, "", ""), (401, "", ""), (402, "no url", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA).repartition(4)
    got = {r.page_id: r.text for r in templates.extract(pages).collect()}
    assert templates.extract(pages).count() == len(rows)
    assert all(got[i] == f"own text {i}" for i in range(12))
    assert all(got[100 + i] == "all the same\n\nread more of this host" for i in range(30))
    assert all(got[200 + i] == f"{i}\n\nread more of this host" for i in range(4))
    assert got[301] == "article 1\n\na passage that many articles of this host quote"
    assert got[400] == got[401] == "" and got[402] == "x"
    assert templates.extract(pages.limit(0)).collect() == []


def test_names_inside_the_article_have_to_be_whole_words():
    inner = '<p class="share-price">It rose.</p><section id="related-work"><p>Others did.</p></section>'
    page = f'<article><div class="notice-period">Three months.</div>{inner}<div class="share">Tweet</div></article>'
    assert Page(page).text() == "Three months.\n\nIt rose.\n\nOthers did."
    assert Page('<body><div class="share-buttons">Tweet</div><p>Text.</p></body>').text() == "Text."


def test_short_articles_beside_the_main_one_are_cards():
    page = "<article><h2>Card</h2></article><main><article><p>The whole story.</p></article></main><article>Another</article>"
    assert Page(page).text() == "The whole story."
    nested = "<article><p>A story.</p><article>quoted inside</article></article>"
    assert Page(nested).text() == "A story.\n\nquoted inside"
