import html
import re

from rivalry.llm import html_text as ht

PARAGRAPH = "A long paragraph with enough words to be told from a menu, and then some more of them."


def plain(fragment):
    """Brute force for the test pages: what stands in <article>, tags as blanks."""
    body = fragment.split("<article>")[1].split("</article>")[0]
    blocks = re.sub(r"</?(?:p|h1|br)>", "\n", body)
    return " ".join(" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks.split("\n") if b.strip())


def test_whole_table_equals_the_articles(spark, small_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    got = ht.op7_html_text(spark, small_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_other_layouts():
    skin = ("<div id='header'><h2>Site</h2></div><ul class='menu'><li>Home<li>News</ul>{}<div class='side-bar sidebar'>"
            "<p>" + PARAGRAPH + "</p></div><div class=comments><div class=comment><p>" + PARAGRAPH
            + "</p></div></div><div class='cookie-notice'>We use cookies</div><footer>c</footer>")
    text = "<h1>Head &amp; line</h1><p>" + PARAGRAPH + "<p>Short.<p>" + PARAGRAPH
    want = f"Head & line {PARAGRAPH} Short. {PARAGRAPH}"
    for wrap in ("<div class=content>{}</div>", "<main>{}</main>", "<div><div id=post>{}</div></div>", "{}",
                 "<table><tr><td>{}</td></tr></table>"):
        assert ht.main_text("<html><body class='has-sidebar'>" + skin.format(wrap.format(text)) + "</body>") == want, wrap
    inner = "<main><article><header><h1>Head</h1></header><p>" + PARAGRAPH + "</p><form>Mail <input></form><aside>x</aside></article></main>"
    assert ht.main_text(skin.format(inner)) == f"Head {PARAGRAPH}"
    two = "<div><article><p>" + PARAGRAPH + "</p></article><article><p>" + PARAGRAPH + "</p></article></div>"
    assert ht.main_text(skin.format(two)) == f"{PARAGRAPH} {PARAGRAPH}"


def test_inline_and_odd_markup():
    assert ht.main_text("<p>a<b>b</b>c&nbsp;d <i>e</i><br>f &#233;&eacute &am") == "abc d e f éé &am"
    assert ht.main_text("<p>x <span class=ad>buy</span> y") == "x y"
    assert ht.main_text("<script>var a = '</p>';</script><p>t<style>p{}</style>") == "t"
    for empty in (None, "", "   ", "<nav>x</nav>", "<p", "<!-- x", "<div class=ad>"):
        assert ht.main_text(empty) == ""
    assert ht.main_text("just text") == "just text"
    assert ht.main_text("<p>" * 3000 + "deep" + "</div>" * 10) == "deep"


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "u", "<p>a", 0), (1, "u", "<p>a", 0), (None, None, None, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text) for r in ht.extract(pages).collect()) == [(0, ""), (1, "a"), (1, "a")]
    assert ht.extract(pages.limit(0)).collect() == []


def test_smoothing_and_cluster():
    assert ht.smoothed([5.0] * 9) == [5.0] * 9 or max(abs(x - 5) for x in ht.smoothed([5.0] * 9)) < 1e-9
    assert ht.content_cluster([]) == []
    found = ht.content_cluster([1, 1, 1, 1, 1, 90, 80, 100, 90, 1, 1, 1, 1, 1])
    assert found[5:9] == [True] * 4 and not any(found[:3]) and not any(found[-3:])


def test_articles_of_unequal_size_are_kept():
    a, b = ("The first piece of the page tells a long story about rivers and their valleys. " * 6).strip(), (
        "The second piece is shorter and speaks of mountains. " * 6).strip()
    page = "<html><body><p>Top</p>{}<p>End</p></body></html>"
    two = ht.main_text(page.format(f"<div><article><p>{a}</p></article><article><p>{b}</p></article></div>"))
    assert two == f"{a} {b}"
    inner = ht.main_text(page.format(f"<main><article><p>{a}</p></article><div><p>{b}</p></div></main>"))
    assert inner == f"{a} {b}"
    assert ht.main_text(page.format(f"<article><p>{a}</p><p>{b}</p></article>")) == f"{a} {b}"


LONG = "Paragraphs of the article have many characters for each of their tags, so that their smoothed ratio is high. " * 2
LINKS = "<div class='left'><div><a href=/w>World</a></div><div><a href=/s>Sport</a></div><div><a href=/a>Arts</a></div><div><a href=/b>Books</a></div></div>"
MOST = "<div class='right'><b>Most</b> <i>read</i><ul><li><a href=/1>One</a><li><a href=/2>Two</a><li><a href=/3>Three</a></ul></div>"
BOX = "<div class='c3'>" + "<div><b>Rain</b> <i>3</i> <b>mm</b></div>" * 9 + "</div>"
#: Pages without ``article``, ``main`` or names that tell anything, and their main text.
PLAIN_PAGES = [
    ("<body>" + LINKS + BOX + "<div class='middle'><h1>Title</h1><p>" + LONG + "</p><p>Short.</p><p>" + LONG + "</p><p>End.</p></div>" + MOST + "</body>",
     ["Title", LONG, "Short.", LONG, "End."]),
    ("<table><tr><td>" + BOX + LINKS + "</td><td><h2>Title</h2><div>" + LONG + "</div><ul><li>one<li>two</ul><div>" + LONG + "</div></td><td>" + MOST + "</td></tr></table>",
     ["Title", LONG, "one", "two", LONG]),
    ("<body>" + BOX + LINKS + "<h1>Title</h1><p>" + LONG + "<p>Short.<p>" + LONG + MOST + "</body>", ["Title", LONG, "Short.", LONG]),
]


def test_the_cluster_chooses_where_no_mark_tells(monkeypatch):
    import random

    for page, want in PLAIN_PAGES:
        assert ht.main_text(page) == " ".join(x.strip() for x in want)
    rng, real = random.Random(1), ht.content_cluster

    def changed():
        return [ht.main_text(page) != " ".join(x.strip() for x in want) for page, want in PLAIN_PAGES]

    monkeypatch.setattr(ht, "content_cluster", lambda ratios: [not x for x in real(ratios)])
    assert all(changed())
    monkeypatch.setattr(ht, "content_cluster", lambda ratios: [rng.random() < 0.3 for _ in ratios])
    assert sum(sum(changed()) for _ in range(20)) > 30
    monkeypatch.setattr(ht, "content_cluster", lambda ratios: [True] * len(ratios))
    assert all("Rain" in ht.main_text(page) for page, _ in PLAIN_PAGES)


def brute_cluster(lines):
    """Ratios, smoothing and threshold written out, line by line."""
    ratios = [len(t) / max(1, n) for t, n in lines]
    smooth = []
    for i in range(len(ratios)):
        top = weight = 0.0
        for j in range(len(ratios)):
            if abs(i - j) <= 3:
                w = 2.718281828459045 ** (-((i - j) ** 2) / 2)
                top, weight = top + w * ratios[j], weight + w
        smooth.append(top / weight)
    mean = sum(smooth) / len(smooth)
    deviation = (sum((x - mean) ** 2 for x in smooth) / len(smooth)) ** 0.5
    return [x >= min(mean, deviation) - 1e-9 for x in smooth]


def test_cluster_equals_brute_force(small_dir):
    import pyarrow.parquet as pq

    for page in pq.read_table(f"{small_dir}/pages.parquet")["html"].to_pylist()[:60] + [p for p, _ in PLAIN_PAGES]:
        lines = ht._Lines()
        lines.feed(page)
        lines.close()
        lines.cut()
        own = [(t, n) for t, n, *_ in lines.lines]
        assert ht.content_cluster([len(t) / max(1, n) for t, n in own]) == brute_cluster(own)


def test_the_pages_without_their_marks(small_dir):
    """The articles of the table are found by the cluster alone, their element being a plain one."""
    import pyarrow.parquet as pq

    for page in pq.read_table(f"{small_dir}/pages.parquet")["html"].to_pylist():
        bare = re.sub(r"<(/?)article>", r"<\1div>", page)
        assert ht.main_text(bare) == plain(page)


def test_a_long_page_with_nested_blocks():
    body = "".join(f"<section><h3>Part {i}</h3><p>{LONG}</p><ul><li>item {i}</ul></section>" for i in range(400))
    got = ht.main_text(f"<body>{LINKS}<div>{body}</div>{MOST}</body>")
    assert got == " ".join(f"Part {i} {LONG.strip()} item {i}" for i in range(400))
