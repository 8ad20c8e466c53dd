
from civitas.llm.wrappers import align, extract, fold, infer, main_slots, main_text, matches, stream

ARTICLE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>'
    '<body><header>Site</header><nav><ul><li><a href="/a">Menu</a></li><li><a>Two</a></li></ul></nav>'
    '<!-- x --><div class="ad">Buy</div><div class="cookie-notice">Cookies</div>'
    "<article><h1>Head &amp; line</h1><p><b>Bo</b>ld \n text.<br>next<p>Second&nbsp;one</p>"
    '<form><label>Mail</label></form><script>x<y</script><div class="comments"><p>me too</p></div>'
    "</article><aside>Side</aside><footer>&copy; x</footer>"
)


def read(page, *others):
    return main_text(page, *main_slots(infer([stream(p) for p in (page, *others)])))


def test_article_text():
    assert read(ARTICLE) == "Head & line Bold text. next Second one"
    assert read(ARTICLE + "</body></html>", ARTICLE.replace("<p>Second", "<p>a</p><p>b</p><p>Second")) == (
        "Head & line Bold text. next Second one"
    )


def test_pages_without_article_and_odd_ones():
    assert read("") == "" and read("just text") == "just text"
    assert read("<div id=menu>M</div><div>Body <i>text</i></div>") == "Body text"
    assert read("<p>cut <b") == "cut"
    assert read("<script>never closed <p>x") == ""
    assert read("<article>" + "<p>w</p>" * 20000 + "</article>") == " ".join(["w"] * 20000)


def test_folding_and_alignment():
    assert fold(list("abababc")) == [("+", ("a", "b")), "c"]
    assert fold(list("aab") * 3) == [("+", (("+", ("a",)), "b"))]
    assert align(list("xaby"), list("xy")) == ["x", ("?", ("a", "b")), "y"]
    assert align(["x", ("+", ("a", "b")), "y"], list("xaby")) == ["x", ("+", ("a", "b")), "y"]


def test_wrapper_accepts_its_pages():
    pages = []
    for n in range(6):
        body = "".join(f"<p>{i}</p>" for i in range(n))
        menu = "".join(f"<li><a>{i}</a></li>" for i in range(1 + n % 3))
        ad = "<div class=ad>x</div>" if n % 2 else ""
        pages.append(f"<body><ul>{menu}</ul>{ad}<article><h1>t</h1>{body}</article></body>")
    wrapper = infer([stream(p) for p in pages])
    assert all(matches(wrapper, p) for p in pages)
    assert not matches(wrapper, "<table>x</table>")


def plain(html):
    """The article of the given pages by cutting strings; they hold nothing else of the kind."""
    import html as entities
    import re

    body = html.split("<article>", 1)[1].split("</article>", 1)[0]
    body = re.sub(r"</?b>", "", body)
    blocks = re.split(r"<[^>]*>", body)
    return " ".join(t for t in (" ".join(entities.unescape(b).split()) for b in blocks) if t)


def test_whole_query_against_plain_cutting(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r for r in extract(pages).collect()}
    given = pages.collect()
    assert len(rows) == len(given)
    for p in given:
        assert rows[p.page_id].text == plain(p.html) and rows[p.page_id].url == p.url
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)


def test_edges(spark):
    rows = [(1, None, None, "x"), (None, "http://h/a", "<p>a</p>", "x"), (2, "rel", ARTICLE, "x"), (2, "rel", ARTICLE, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(frame).collect())
    assert got == [(0, "a", 1), (1, "", 0)] + [(2, "Head & line Bold text. next Second one", 38)] * 2
    assert extract(frame.limit(0)).count() == 0


def test_article_is_decided_for_each_page():
    bare = "<body><div><p>text</p></div></body>"
    assert read(bare, ARTICLE) == "text"
    assert read(ARTICLE, bare) == "Head & line Bold text. next Second one"
    assert read("<div>Skip</div><article>A</article>", bare) == "A"


def test_container_names_that_tell_by_a_part():
    assert read("<body class='has-sidebar'><p>text</p></body>") == "text"
    assert read("<body class='left-sidebar'><p>text</p></body>") == "text"
    assert read("<div class='no-sidebar'><p>text</p></div>") == "text"
    assert read("<div>Skip</div><div class='content-sidebar-wrap'><article>A text</article></div>") == "A text"
    related = "<div class='related-posts'><article>Card</article></div>"
    assert read(f"<article>A</article>{related}") == "A"
    assert read(f"<div>Body text</div>{related}") == "Body text"
    assert read("<article>A<div class='cookie-notice'>C</div></article>") == "A"


def test_the_wrapper_tells_layout_from_boilerplate():
    """A page without an article is read in the container that holds the host's one article."""
    wrapped = "<body><i>x</i><div class='content-sidebar-wrap'>{}</div></body>"
    article, bare = wrapped.format("<article><p>A text</p></article>"), wrapped.format("<div><p>Body text</p></div>")
    assert read(bare) == "x"
    assert read(bare, article) == "Body text"
    assert read(article, bare) == "A text"
    noisy = wrapped.format("<div><p>Body text</p><nav>Menu</nav><div class='ad'>Buy</div></div>")
    assert read(noisy, article) == "Body text"


def test_containers_of_cards_stay_boilerplate():
    cards = "<div>B</div><div class='related-posts'>{}</div>"
    one, two = "<article>Card</article>", "<article>Card</article><article>Card</article>"
    bare = cards.format("<p>More to read</p>")
    assert read(bare, cards.format(two)) == "B"
    assert read(bare, "<article>A</article>" + cards.format(one)) == "B"


def texts(spark, pages):
    rows = [(n, "http://h.example/" + str(n), p) for n, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r.text for r in sorted(extract(frame).collect())]


def test_hosts_whose_boilerplate_has_no_telling_names(spark):
    """Texts that the pages of a host share are its template; the rest is read, whatever its length."""
    import random

    chance = random.Random(3)
    words = lambda n: " ".join(chance.choice("abcdefgh") * chance.randint(2, 6) + str(chance.randint(0, 999)) for _ in range(n))
    pages, bodies = [], []
    for n in range(30):
        body = [words(chance.randint(1, 12)) for _ in range(chance.randint(1, 5))]
        aside = "<div>Only now: <b>half</b> price</div>" if n % 3 else ""
        paragraphs = "".join(f"<p>{p}</p>" for p in body)
        pages.append(
            f"<body><ul><li>Home</li><li>News</li><li>Contact us</li></ul>{aside}<div>{paragraphs}</div>"
            f"<div>All texts &copy;  their authors</div></body>"
        )
        bodies.append(" ".join(body))
    assert texts(spark, pages) == bodies


def test_only_the_template_is_left_out(spark):
    page = "<body><h2>{}</h2><div>{}</div><p>{}</p></body>"
    # at the heading's place two pages have another text: it is a slot
    heads = ["Welcome", "Welcome", "Welcome", "Other", "Third"]
    pages = [page.format(h, "Notice", f"Text {n}") for n, h in enumerate(heads)]
    assert texts(spark, pages) == [f"{h} Text {n}" for n, h in enumerate(heads)]
    # two pages tell nothing, nor do copies of one
    assert texts(spark, pages[:1] * 4 + pages[1:2]) == ["Welcome Notice Text 0"] * 4 + ["Welcome Notice Text 1"]
    # what a few of many pages share stays
    few = [page.format(f"H {n}", "Shared" if n < 4 else f"D {n}", f"T {n}") for n in range(12)]
    assert texts(spark, few)[0] == "H 0 Shared T 0"
    # an article has what it has
    articles = [f"<p>Top</p><article><p>Same</p><p>Text {n}</p></article>" for n in range(4)]
    assert texts(spark, articles) == [f"Same Text {n}" for n in range(4)]
    # a page without any other text keeps those of the template
    assert texts(spark, [*pages, "<body><div>Notice</div></body>"])[-1] == "Notice"


def test_different_texts_at_one_place_become_a_slot():
    assert align(["<p", "=a", "/p"], ["<p", "=b", "/p"]) == ["<p", "#", "/p"]
    assert align(["<p", "=a", "/p"], ["<p", "#", "/p"]) == ["<p", "#", "/p"]
    assert align(["<p", "=a", "/p"], ["<p", "=a", "/p"]) == ["<p", "=a", "/p"]
    assert align(["<p", ("?", ("=a",)), "/p"], ["<p", "=b", "/p"]) == ["<p", ("?", ("#",)), "/p"]
    assert align(["<p", "=a", "/p"], ["<p", "/p"]) == ["<p", ("?", ("=a",)), "/p"]
