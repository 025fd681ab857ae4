"""Operator 9: extraction rules, wrapper inference, odd rows."""
import html
import random
import re

from conftest import SF_SMALL

from topiclake.llm import html_text as H

from .conftest import prose

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header class="site-header">
<h2>Site</h2></header><nav><ul><li>menu</ul></nav><div id="cookie-notice">We use cookies</div><div class="main-content">
<article><header><h1>Ti&amp;tle</h1></header><p>One  two<br>three &lt;b&gt;<p>Para <b>bold</b> end<!-- no --><ul><li>a<li>b
</ul><div class="ad">ad</div><form><p>x</p></form><aside>s</aside><pre>k  l
m</pre><section class="comments"><h3>Comments</h3><p>hey</p></section><div class="share">Share</div></article></div>
<div class="sidebar"><p>side</p></div><footer>f</footer><script>if(a<b){document.write("<p>no</p>")}</script></body></html>"""


def test_rules():
    assert H.main_text(PAGE) == "Ti&tle\nOne two three <b>\nPara bold end\na\nb\nk l m"
    assert [H.main_text(x) for x in (None, "", "  ", "plain", "<!-- a", "<p>a&nbsp;b &#x41;<p>c", "</p>x<script>y")] == [
        "", "", "", "plain", "", "a b A\nc", "x"]


def test_given_pages(spark):
    for r in H.extract(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).join(
            spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in parts if x)


def pages_of(rng, n, host="h"):
    out = []
    for k in range(n):
        paras = "".join(f"<p>{prose(rng, 12)}</p>" for _ in range(rng.randrange(1, 5)))
        extra = f"<h2>{prose(rng, 3)}</h2>" if k % 2 else ""
        out.append(f"<body><div class=x><h1>{prose(rng, 4)}</h1>{extra}{paras}<div>Read our handbook now</div></div></body>")
    return out


def test_wrapper_of_a_host():
    pages = pages_of(random.Random(3), 8)
    w = H.infer(pages[:6])
    flat = str(w)
    assert "'s'" in flat and "'r'" in flat and "'o'" in flat  # slots, repeated and optional groups
    for p in pages:  # also the two that it was not fitted on
        assert H.match(w, H.stream(p)) is not None
        assert "handbook" in H.main_text(p) and "handbook" not in H.main_text(p, w)
        assert H.main_text(p, w) + "\nRead our handbook now" == H.main_text(p)
    assert H.infer(pages[:2]) is None and H.infer([pages[0]] * 6) is None
    assert H.match(w, H.stream("<body><table><tr><td>other</table></body>")) is None


def test_constants_inside_an_article_stay():
    rng = random.Random(7)
    page = "<body><div>Our own notice</div>{}<div>Read on</div><article><h1>{}</h1><h2>Ingredients</h2><ul><li>{}</ul></article></body>"
    pages = [page.format("", prose(rng, 4), prose(rng, 9)) for _ in range(6)]
    w = H.infer(pages)
    assert w is not None and all("\nIngredients\n" in H.main_text(p, w) and "notice" not in H.main_text(p, w) for p in pages)
    body = "<h1>One title</h1><h2>Part</h2><div>The only text</div>"  # one article among other adverts
    copies = [f"<body><div class=ad><p>{prose(rng, 3)}</p></div>{body}</body>" for _ in range(6)]
    assert all(H.main_text(p, H.infer(copies)) == "One title\nPart\nThe only text" for p in copies)


def test_wrappers_of_hosts_with_copies_and_of_long_pages(spark):
    rng = random.Random(9)
    pages = pages_of(rng, 8)
    few = sorted(pages)[:3]
    rows = [(k, "http://c/", few[k % 3] if k < 90 else pages[k % 8]) for k in range(100)]
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert all("handbook" not in r.text for r in out.collect())
    menu = "".join(f"<div class=k{chr(97 + k % 26)}{chr(97 + k // 26)}>{prose(rng, 2)}</div>" for k in range(300))
    long = [p.replace("<div class=x>", menu + "<div class=x>") for p in pages]
    w = H.infer(long[:6])
    assert len(H.fold(H._nodes(H.stream(long[0])))) > H._MAX_ALIGN
    assert all("handbook" in H.main_text(p) and "handbook" not in H.main_text(p, w) for p in long)


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(k, "http://Hot.example/x", p) for k, p in enumerate(pages_of(rng, 40))]
    long = "<article>" + "".join(f"<p>{prose(rng, 10)}</p>" for _ in range(20_000)) + "</article>"
    rows += [(100, None, PAGE), (101, "no host", None), (102, "http://e/", ""), (None, "http://n/", "<p>x"),
             (103, "http://long/", long), (103, "http://long/", long)]
    pages = spark.createDataFrame([(*r, "clash", "w") for r in rows],
                                  "page_id long, url string, html string, host string, wrapper string")
    out = H.extract(pages)
    assert out.columns == ["page_id", "url", "text"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[100].startswith("Ti&tle") and by[101] == by[102] == "" and by[None] == "x"
    assert by[103].count("\n") == 19_999 and all("handbook" not in by[k] for k in range(40))
    assert H.extract(pages.limit(0)).count() == 0


def test_names_that_only_hold_a_word_keep_their_text():
    art = "<article><h1>Title</h1><p>The whole text of it.</article>"
    text = "Title\nThe whole text of it."
    for page in (f'<div class="layout has-sidebar">{art}<div class="sidebar">side</div></div>', f'<div class="sidebar">{art}</div>',
                 f'<div id="page" class="header-fixed"><main>{art}</main></div>', f'<form id=aspnet><div class="content-sidebar-wrap">{art}</div></form>',
                 f'<header><div class=modal>{art}</div></header>'):
        assert H.main_text(page) == text
    inside = ('<main><h1>Found</h1><div class="search-results"><p>one<p>two</div><section id="related-work"><p>Others did</section>'
              '<div class="share-price">9.5</div><p>energy <math><mi>E</mi></math> is x <label>L</label><div class="article-header">Sub</div></main>')
    assert H.main_text(inside) == "Found\none\ntwo\nOthers did\n9.5\nenergy E is x L\nSub"


def test_furniture_inside_an_article_goes():
    page = ('<article><h1>T</h1><p>text<div class="ad-slot">ad</div><div id="comments">c</div><div class="social-share">s</div>'
            '<ul class="related-posts"><li>r</ul><div class="newsletter-signup">n</div><div hidden>h</div><nav>m</nav>end</article>'
            '<div class="related"><article><p>teaser</article></div>')
    assert H.main_text(page) == "T\ntext\nend"


def test_wrapper_decides_without_landmarks_and_nowhere_else(spark):
    """Hosts without article or main: what all pages share goes, what differs stays; with them it changes nothing."""
    rng = random.Random(21)
    rows, want = [], {}
    for host in range(6):
        shared = [prose(rng, 6) for _ in range(3)]
        for k in range(8):
            own = [prose(rng, 9) for _ in range(rng.randrange(2, 6))]
            body = "".join(f"<p>{x}</p>" for x in own)
            inner = f"<article>{body}</article>" if host % 2 else f"<div class=c>{body}</div>"
            rows.append((len(rows), f"http://h{host}/", f"<body><div class=a>{shared[0]}</div><table><tr><td>{shared[1]}</table>{inner}"
                                                         f"<div class=z><b>{shared[2]}</b></div></body>"))
            want[rows[-1][0]] = "\n".join(own)
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == want
    for page_id, url, page in rows:
        assert (H.main_text(page) == want[page_id]) == (int(url[8]) % 2 == 1)


def test_hosts_with_long_pages_only_have_wrappers(spark, monkeypatch):
    monkeypatch.setattr(H, "LONG_PAGE", 10)
    rows = [(k, "http://l/", p) for k, p in enumerate(pages_of(random.Random(4), 8))]
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all("handbook" not in r.text for r in out)


def test_wrappers_are_fitted_on_every_page_of_a_host(spark, monkeypatch):
    """More kinds of pages on a host than any few of them show: the wording of each kind goes."""
    rng = random.Random(31)
    kinds = [("table", "tr", "td"), ("section", "div", "b"), ("ul", "li", "i"), ("dl", "dd", "em"), ("blockquote", "center", "u")]
    notices = [prose(rng, 5) for _ in kinds]
    rows, want = [], {}
    for k in range(60):
        a, b, c = kinds[k % 5]
        own = [prose(rng, 8) for _ in range(rng.randrange(1, 6))]
        body = "".join(f"<p>{x}" + "<br>".join([""] * rng.randrange(1, 4)) + "</p>" for x in own)
        rows.append((k, "http://one/", f"<body><{a}><{b}><{c}>{notices[k % 5]}</{c}></{b}></{a}><div class=k{k % 5}>{body}</div></body>"))
        want[k] = "\n".join(own)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for tasks in (1, 7):
        assert {r.page_id: r.text for r in H.extract(pages.repartition(tasks)).collect()} == want
    monkeypatch.setattr(H, "JOINED", 16)  # joined in rounds
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    assert all(got[k].endswith(want[k]) for k in want) and sum(got[k] == want[k] for k in want) > 50
    wrapper = H.infer([r[2] for r in rows])
    assert all(H.match(wrapper, H.stream(r[2])) is not None for r in rows)


def test_wrappers_joined_in_any_order_know_the_same_texts():
    pages = pages_of(random.Random(6), 30)
    pages[7] = pages[7].replace("handbook", "leaflet")  # one page of thirty: the place is a slot
    w = H.infer(pages)
    assert "handbook" not in str(w) and w == H.infer(pages[::-1] + pages[:9])
    assert all("Read our" in H.main_text(p, w) for p in pages)
