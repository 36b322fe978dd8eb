import pytest

from flowmart.llm import consensus_html as ch

ODD = """<html><head><title>x</title><style>p{}</style></head><body class="has-sidebar nav-fixed">
<header class=site-header><h1>Site</h1><nav>a b c</nav></header>
<div id=page><div class="cookie-notice">We use cookies</div><div class="post-12 entry"><h1>Title &amp; more</h1>
<p>First par<b>agraph</b> with, commas.<p>Second&nbsp;one<br>line<div class="ad-slot">BUY</div>
<p>Third <a href=x>link</a> text.<form><input>Subscribe</form><script>var t="</p><p>no</p>";</script><!-- <p>hidden</p> -->
<ul><li>item one<li>item two</ul><table><tr><td>cell<td>other</table>
<section class=comments><article class=comment><p>I disagree</article></section></div>
<aside>side</aside></div><footer>foot</footer></body></html>"""
TEXT = "Title & more First paragraph with, commas. Second one line Third link text. item one item two cell other"


def own(page):
    return ch.main_text(page, ch.best_container(ch.container_scores(page)))


def test_clutter_goes_and_the_article_stays():
    assert own(ODD) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("plain text  only", "plain text only"), ("<p>a<p>b", "a b"), ("<p>a &lt;b&gt; &#233;&eacute;", "a <b> éé"),
        ("<div>x</div", "x"), ("<body><p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<script>only code", ""),
        ("<p>un<i>believ</i>able", "unbelievable"), ("<p>a</div></section>b", "a b"), ("<nav>menu</nav>", ""),
        ("<p title='a>b'>x</p>", "x"), ("<p title=\"broken>x</p>", "x"), ("<P CLASS=A>Up</P>", "Up"), ("<![CDATA[c]]>d", "cd"),
        ("<div hidden>h</div><div>s</div>", "s"), ("<div role=navigation>n</div><p>s", "s"),
    ],
)
def test_odd_markup(page, text):
    assert own(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "end" + "</div>" * 20_000
    assert own(deep) == "end"
    mixed = "<div><section>" * 3000 + "end"
    assert max(map(len, ch.container_scores(mixed))) < 2 * ch._PATH
    assert own("<p>" + "word " * 300_000) == ("word " * 300_000).strip()


def table(spark, rows):
    full = [(i, u, h, "x", "y", "z") for i, u, h in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, host string, _winner string, path string")


def test_a_host_s_pages_agree(spark):
    def page(k, body, junk):
        return f"<body><div class=box-{k}>{junk}</div><div class='text c{k}'><h1>Head {k}</h1>{body}</div></body>"

    rows = [(k, f"http://A.example.com/{k}", page(k, "<p>" + "story " * 50, "extra words here")) for k in range(8)]
    # Alone, this page's other box would weigh more than its text.
    rows.append((50, "https://a.example.com:80/short", page(50, "<p>short", "unrelated " * 40)))
    rows += [(60, None, "<p>no url"), (61, "http://a.example.com/odd", "<section>another form</section>"), (62, "http://b.org", None), (62, "http://b.org", None)]
    df = table(spark, rows)
    out = ch.extract(df, "main_text")
    assert out.columns == [*df.columns, "main_text"]
    got = {r.page_id: r.main_text for r in out.collect()}
    assert got[3] == "Head 3 " + " ".join(["story"] * 50)
    assert got[50] == "Head 50 short"
    assert (got[60], got[61], got[62]) == ("no url", "another form", "")
    assert out.count() == len(rows)
    assert {r._winner for r in out.collect()} == {"y"}


def test_empty_table(spark):
    assert ch.extract(table(spark, []), "main_text").count() == 0


def test_given_pages_give_their_articles(spark, small):
    import html
    import re

    from flowmart.llm.queries import op4_consensus_html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = op4_consensus_html(spark, small).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        plain = html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", ""))
        assert r.text == " ".join(plain.split())
        assert r.n_chars == len(r.text)


def test_each_layout_of_a_host_gives_its_own_text(spark):
    teaser, article = "<div class=post><p>" + "teaser " * 30 + "</div>", "<div class=full><p>" + "article " * 90 + "</div>"
    rows = [(k, f"http://two.org/{k}", f"<body>{teaser}{article if k % 5 < 2 else ''}</body>") for k in range(20)]
    menu = f"<body><nav>{'menu ' * 60}</nav>"
    rows += [(100 + k, f"http://menu.org/{k}", f"{menu}{teaser}{article if k % 5 < 2 else ''}</body>") for k in range(20)]
    # One page's own layout, beside a fragment.
    rows.append((30, "http://two.org/once", f"<body><div class=post><p>short</div><main><p>{'once ' * 90}</main></body>"))
    # Pages without a host share nothing.
    rows += [(40 + k, "/relative", f"<body>{teaser}</body>") for k in range(3)] + [(50, None, f"<body>{teaser}{article}</body>")]
    got = {r.page_id: r.main_text for r in ch.extract(table(spark, rows)).collect()}
    assert got[2] == got[102] == ("teaser " * 30).strip()
    assert got[0] == got[50] == ("teaser " * 30 + "article " * 90).strip()
    assert ("article " * 90).strip() in got[100]
    assert "once once" in got[30]


@pytest.mark.parametrize(
    "name",
    ["related-work", "share-price", "banner-story", "search-results", "social-policy", "notice-period", "comments-on-law",
     "skip-intro", "ad-hoc", "menu-recipes", "login-howto", "promo-code-explained", "cookieRecipe"],
)
def test_a_word_of_clutter_in_another_name_drops_nothing(name):
    page = f"<body><nav>menu</nav><article><h1>Head</h1><p>First.</p><div class='{name}'><p>Second.</p></div></article></body>"
    assert own(page) == "Head First. Second."


@pytest.mark.parametrize(
    "name", ["ad", "ad-slot", "advert-300x250", "cookie-notice", "social-share-buttons", "relatedPosts", "sidebar-left", "comment_list", "newsletter-signup-form"]
)
def test_whole_names_of_clutter_go(name):
    page = f"<body><article><h1>Head</h1><p>First.</p><div class='{name}'><p>Second.</p></div></article></body>"
    assert own(page) == "Head First."
