import html
import re

from tessera.llm import html_consensus as consensus

SCHEMA = "page_id long, url string, html string"


def test_blocks_follow_html():
    page = ("<body><header>x</header><main><div class=content><h2>A&nbsp;&lt;b&gt;</h2><ul><li>one<li>two</ul>"
            "<p>x <a href='>'>li</a> y<div>z</div></p>tail<table><tr><td>1<td>2</table><section id='comments'><p>no</section>"
            "</div></main><script>\"</p>\"</scripT ><form>q</form><p>end <!-- c --> of<br>it<!-- unclosed")
    assert [t for _, t, _ in consensus.blocks(page)] == ["A <b>", "one", "two", "x li y", "z", "tail", "1", "2", "end of it"]
    assert consensus.blocks(None) == consensus.blocks("") == consensus.blocks("<script>only") == []
    assert [t for _, t, _ in consensus.blocks("<p>" * 5000 + "deep" + "<div>" * 5000 + "er")] == ["deep", "er"]
    assert [t for _, t, _ in consensus.blocks("a < b & c &amp d")] == ["a < b & c & d"]


def test_marked_parts_go_and_article_headers_stay():
    page = ("<nav>menu</nav><div class='ad-box'>buy</div><div id=cookieNotice>cookies</div><article><header><h1>Title</h1></header>"
            "<p>Text, long enough.</p><aside>side</aside><div class='comments'>bad</div><footer>tags</footer></article><div role=complementary>r</div>")
    assert consensus.extract(consensus.blocks(page), []) == "Title\nText, long enough."


def test_consensus_corrects_a_page_whose_own_best_is_wrong(spark):
    usual = "<body><div class='story-{}'><p>A long story with many words, really, in every paragraph of it.</p></div><div class='box'><p>short</p></div>"
    odd = "<body><div class='story-7'><p>Brief.</p></div><div class='box'><p>" + "A very long box, with much more text than the story. " * 5 + "</p></div>"
    rows = [(i, "http://h.example/x", usual.format(i)) for i in range(30)] + [(99, "https://H.example:80/y", odd), (100, "http://other.example/", odd)]
    got = {r.page_id: r.text for r in consensus.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[99] == "Brief." and got[100].startswith("A very long box") and "short" not in got[3]


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in consensus.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)


def test_odd_rows(spark):
    rows = [(1, None, "<p>no url"), (2, "not a url", None), (None, "http://a.example", ""), (3, "http://a.example", "<nav>all marked</nav>"),
            (4, "http://a.example", "<p>" + "word " * 100_000), (4, "http://a.example", "<p>" + "word " * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'p' AS paths", "'h' AS _host", "'t' AS text")
    got = consensus.main_text(df).collect()
    assert len(got) == 6 and sorted(len(r.text) for r in got) == [0, 0, 0, 6, 499_999, 499_999]
    assert {r["paths"] for r in got} == {"p"}
    assert consensus.main_text(df.limit(0)).count() == 0


def test_class_words_do_not_drop_the_article():
    story = "A long story with many words, really, in every paragraph of it. " * 10
    for outer in ("<div class='content has-sidebar'>", "<main class='no-sidebar'>", "<div class='elementor-widget-container'>",
                  "<div class='page-with-header-banner'>", "<div class='story related-top'>", "<div id=sidebar-wrapper>"):
        page = f"<body><nav>menu</nav>{outer}<p>{story}</p><div class='ad'>buy</div><div class=share><a href=x>{story}</a></div></div><p>foot"
        assert consensus.extract(consensus.blocks(page), []).split("\n")[0] == story.strip(), outer
        assert not any("buy" in t or t.count("story") > 10 or n for _, t, n in consensus.blocks(page)), outer
    # a large block is still marked beside an article
    page = f"<div class=story><p>{story}</p></div><div class=comments><p>{'No, never. ' * 100}</p></div>"
    assert consensus.extract(consensus.blocks(page), []) == story.strip()
    assert consensus.blocks("<div class=ad><p>buy</p></div>") == []


def test_host_decides_on_large_marked_containers(spark):
    story, talk = "A long story with many words, really, in it. " * 10, "No, never, said they. " * 200
    page = "<body><div class=story><p>{}</p></div><div class=comments><p>{}</p></div>"
    rows = [(i, "http://h.example/x", page.format(story, "No.")) for i in range(20)] + [(99, "http://h.example/y", page.format(story, talk))]
    got = {r.page_id: r.text for r in consensus.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[99] == got[0] == story.strip()
