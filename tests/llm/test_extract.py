"""Main text: layouts with their expected text, and template deduction."""

import pytest

from labelforge.llm import extract

SCHEMA = "page_id long, url string, html string, text string, host string, texts string"

PAGES = [
    ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>"
     "<a href=/a>Home</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy.</div><article><h1>Head &amp; line</h1><p><b>First"
     "<br><p>Second  para\n with <a href=x>link</a>.</p></article><footer>&copy; x</footer>", "Head & line\nFirst\nSecond para with link."),
    ("<main><header><h1>T</h1></header><p>P</p><aside>side</aside><form>f<input></form><div id='reader-comments'><p>c</p></div>"
     "<p>Q</p></main><div class=sidebar>s</div>", "T\nP\nQ"),
    ("<div class='cookie-notice'>We use</div><div id=content><p>One &lt;tag&gt; &#233;<p>Two<ul><li>a<li>b</ul></div>",
     "One <tag> é\nTwo\na\nb"),
    ("<p>one<div>two</div>three<table><tr><td>c1<td>c2</table>", "one\ntwo\nthree\nc1\nc2"),
    ("<article><p>open <i>italic</i> <span class=note>in line</span><p>cut off here", "open italic in line\ncut off here"),
    ("<article>a<nav>n</nav>b<script>x</script>c</article>", "a\nb c"),
    ("a < b and c > d", "a < b and c > d"),
    ("<ARTICLE><P CLASS='Intro'>Upper</P></ARTICLE>", "Upper"),
    ("<div><a href=1>menu one</a> <a href=2>menu two</a></div><p>Text of the page.</p>", "Text of the page."),
    ("<article><div role=navigation>n</div><button>b</button><p>x</p></article><article><p>y</p></article>", "x\ny"),
    ("<p>x</p></div></section><p>y", "x\ny"),
    ("", ""), (None, ""), ("   ", ""), ("<html></html>", ""), ("<!-- open", ""), ("<p", ""),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_layouts(page, want):
    assert extract.main_text(page or "", frozenset()) == want


def test_columns_edge_rows_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>paragraph {i} of it</p>" for i in range(20_000)) + "</article>"
    rows = [(i, f"http://h{i % 3}.example.org/{i}", p) for i, (p, _) in enumerate(PAGES)]
    rows += [(100, None, "<p>null url</p>"), (101, "not a url", "<p>odd</p>"), (None, "http://[bad", "<p>bad</p>"),
             (102, "http://h/x", long), (102, "http://h/x", long)]
    df = spark.createDataFrame([(*r, "t", "h", "x") for r in rows], SCHEMA).repartition(3)
    got = extract.extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None and r["page_id"] < 100:
            assert r["text"] == PAGES[r["page_id"]][1]
        assert r["n_chars"] == len(r["text"])
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[100] == "null url" and texts[None] == "bad" and texts[102].count("\n") == 19_999
    assert extract.extract(df.limit(0)).collect() == []


def test_template_text_of_a_host_is_found_and_left_out(spark):
    """Pages without an article element: what every page repeats is the template."""
    def page(i):
        return (f"<body><div class=top><b>Site name of the host</b></div><div class=box><h2>Story {i}</h2><p>Body {i} text one.</p>"
                f"<p>Body {i} text two.</p></div><div class=low><p>All rights of the site</p></div></body>")
    rows = [(i, f"https://Site.example.com/{i}", page(i)) for i in range(12)] + [(50, "https://other.example.com/", page(50))]
    df = spark.createDataFrame([(*r, "t", "h", "x") for r in rows], SCHEMA).repartition(4)
    classes = extract.equivalence_classes(df).collect()
    assert {c["host"] for c in classes} == {"site.example.com"}
    frame = [c for c in classes if c["pages"] == 12]
    assert sum(len(c["texts"]) for c in frame) == 2 and max(c["tokens"] for c in frame) >= 6
    got = {r["page_id"]: r["text"] for r in extract.extract(df).collect()}
    for i in range(12):
        assert got[i] == f"Story {i}\nBody {i} text one.\nBody {i} text two."
    assert got[50].startswith("Site name of the host")          # one page is no template


def test_equal_vectors_are_one_class_and_unequal_ones_are_not(spark):
    """The hashed sums agree with the occurrence vectors themselves."""
    pages = [f"<div><p>same</p><p>often</p>{'<p>often</p>' * (i % 2)}<i>x</i><h1>a{i // 2}</h1></div>" for i in range(8)]
    df = spark.createDataFrame([(i, "http://h.org/", p, "", "", "") for i, p in enumerate(pages)], SCHEMA)
    vectors = {}
    for i, p in enumerate(pages):
        tags, blocks = extract.parse(p)
        for token in [("t", t) for t in tags] + [("x", b.path, b.text) for b in blocks]:
            vectors.setdefault(token, [0] * 8)[i] += 1
    want = {}
    for token, v in vectors.items():
        if sum(x > 0 for x in v) >= extract.MIN_PAGES and sum(x > 0 for x in v) * 2 >= 8:
            want.setdefault(tuple(v), []).append(token)
    sizes = sorted(len(t) for t in want.values() if len(t) >= extract.MIN_TOKENS and any(x[0] == "t" for x in t))
    assert sorted(c["tokens"] for c in extract.equivalence_classes(df).collect()) == sizes


def test_classes_nest_into_a_tree(spark):
    """Regions that only some pages have hang inside the frame that all have."""
    assert extract.nest([["/html", "/html/body"], ["/html/body/div/p"], ["/html/body/ul", "/html/body/ul/li"], ["/x/y"]]) == \
        [-1, None, 0, None]

    def page(i):
        box = "<div class=box><h2>Same box</h2><em>on these pages</em><p>more</p></div>" if i % 3 else ""
        return f"<html><body><h1>t{i}</h1><table><tr><td>cell {i}</td></tr></table>{box}<p>own text {i}</p></body></html>"
    df = spark.createDataFrame([(i, "http://n.org/", page(i), "", "", "") for i in range(12)], SCHEMA)
    tree = extract.templates(df).first()["tree"]
    frame = [c for c in tree if c["parent"] == -1]
    assert len(frame) == 1 and frame[0]["root"] == "/html"
    assert [c["root"] for c in tree if c["parent"] == frame[0]["class"]] == ["/html/body/div.box"]
    got = {r["page_id"]: r["text"] for r in extract.extract(df).collect()}
    assert got[4] == "t4\ncell 4\nown text 4"


WRAPPED = [
    ("<body class='has-sidebar'><p>One.</p><div class=sidebar>s</div></body>", "One."),
    ("<body><div id=content class='with-sidebar'><article><p>One.</p></article></div></body>", "One."),
    ("<body><div class='page-with-sidebar'><p>The text of the page.</p><div class=ad>Buy.</div></div><p>x</p></body>",
     "The text of the page.\nx"),
    ("<article class='post comments-open'><p>One.</p><div class='ad'>Buy.</div></article>", "One."),
    ("<article id='social-policy'><p>One.</p></article>", "One."),
    ("<article class=sidebar><p>One.</p></article><main class=search><p>Two.</p></main>", "One.\nTwo."),
    ("<article><p>The story.</p><div class='social-policy'>Policy.</div><div class=comments><article class=comment>c</article></div>"
     "</article>", "The story.\nPolicy."),
    ("<article><p>The first story.</p></article><div class=related><article>r</article></div>", "The first story."),
    ("<div id=content><p>The text of the page.</p></div><div class=related><article>Other.</article></div>", "The text of the page."),
]


@pytest.mark.parametrize("page,want", WRAPPED)
def test_names_of_wrappers_do_not_empty_a_page(page, want):
    assert extract.main_text(page, frozenset()) == want


PROBES = ["comment-list", "ad-container", "cookie-bar", "comments-section", "newsletter-box", "sidebar-left"]


@pytest.mark.parametrize("name", PROBES)
def test_container_words_do_not_hide_what_an_element_holds(name):
    page = f"<article><p>The story of the page.</p><div class='{name}'><p>No story.</p></div></article>"
    assert extract.main_text(page, {}) == "The story of the page."
    assert extract.main_text(page.replace("article", "div"), {}) == "The story of the page."


def test_a_paragraph_with_a_long_link_is_text_and_a_row_of_links_is_not():
    page = "<div><a href=1>Home</a> &middot; <a href=2>News</a></div><p>See <a href=3>one long reference text here</a></p>"
    assert extract.main_text(page, {}) == "See one long reference text here"


def test_open_elements_without_end_take_linear_time():
    import time
    seconds = []
    for n in (10_000, 100_000):
        page = "<div><span>" * n + "x" + "<p>y</p></b></section>" * n
        start = time.process_time()
        text = extract.main_text(page, {})
        seconds.append(time.process_time() - start)
        assert text == "x" + "\ny" * n
        assert sum(map(len, extract.parse(page)[0])) < 400 * 2 * n
    assert seconds[1] < 40 * seconds[0] + 1


def test_classes_nest_below_paths_that_were_replaced_by_their_hash():
    tags, _ = extract.parse("<div>" * 500)
    assert len(set(tags)) == 500 and [extract._depth(t) for t in tags] == list(range(1, 501))
    assert extract.nest([tags[:400], tags[400:]]) == [-1, 0]
    assert extract.nest([tags[:300], tags[400:]]) == [-1, None]


def test_the_template_decides_inside_the_article_where_names_cannot(spark):
    """Every page has an article whose boilerplate has meaningless class names; a
    paragraph that all articles share is no boilerplate, nor is a whole copy."""
    shared = "A passage that every story quotes."

    def page(i):
        return (f"<html><body><article><h1>Story {i}</h1><div class=x7><p>Was this useful?</p><p>Tell us.</p></div>"
                f"<div class=q><p>Body {i} one.</p><p>{shared}</p>{'<p>More.</p>' * (i % 3)}</div><p class=z9>Read on at our site.</p>"
                f"<p>End {i}.</p></article></body></html>")
    rows = [(i, "http://a.org/", page(i)) for i in range(12)]
    rows += [(100 + i, "http://copies.org/", "<article><h1>Same</h1><p>Copied text.</p></article>") for i in range(6)]
    df = spark.createDataFrame([(*r, "t", "h", "x") for r in rows], SCHEMA).repartition(4)
    got = {r["page_id"]: r["text"] for r in extract.extract(df).collect()}
    for i in range(12):
        assert got[i] == "\n".join([f"Story {i}", f"Body {i} one.", shared, *["More."] * (i % 3), f"End {i}."])
    assert all(got[100 + i] == "Same\nCopied text." for i in range(6))
    assert "Was this useful?" in extract.main_text(page(1), {})
