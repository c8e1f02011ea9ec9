import html
import random
import re

from sharelens.llm import html_extract
from sharelens.llm.html_extract import align, article, extract_articles, pack_shape, unpack_shape
from sharelens.llm.html_pages import read_page
from sharelens.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, host string, shape string, path long, text string"


def words(dice, n):
    return " ".join("".join(dice.choices("abcdefgh", k=dice.randint(2, 7))) for _ in range(n))


def plain_site(dice, k):
    """No article element: the wrapper must find the text between menus and adverts."""
    paragraphs = [words(dice, dice.randint(20, 40)) for _ in range(dice.randint(1, 4))]
    menu = "".join(f"<li><a href=/{i}>{words(dice, 1)}</a>" for i in range(dice.randint(2, 9)))
    advert = '<div class="ad-box">Buy now!</div>' if k % 2 else ""
    page = (
        f"<html><head><title>{words(dice, 3)}</title></head><body><div id=top><ul class=x1>{menu}</ul></div>{advert}"
        f"<div class='col c{k}'>" + "".join(f"<p>{p}" for p in paragraphs) + "<p>Read this on our site</div>"
        f"<div id=sidebar>{words(dice, 60)}</div><div class=comments><p>{words(dice, 50)}</div>"
        "<footer>All rights</footer></body></html>"
    )
    return page, "\n\n".join(paragraphs)


def site_rows(n=12):
    dice = random.Random(4)
    pages = [plain_site(dice, k) for k in range(n)]
    return [(i, f"https://Plain.example/{i}", p) for i, (p, _) in enumerate(pages)], [t for _, t in pages]


ODD = [
    (100, "http://a.b/1", None, ""),
    (101, "http://a.b/2", "", ""),
    (102, None, "just text &amp; more\n\nlines", "just text & more lines"),
    (103, "not a url", "<article><p>One &lt;b&gt;<br>two<p>three<script>x('</p>')</script></article>", "One <b> two\n\nthree"),
    (104, "http://c.d/", "<main><h1>T</h1><nav>no</nav><div>a<div>b</div>c</div></main><footer>f</footer>", "T\n\na\n\nb\n\nc"),
    (105, "http://c.d/x", "<article><b>open <i>tags", "open tags"),
    (106, "http://e.f/", "<!-- <article>no</article> --><article>y < z & é</article>", "y < z & é"),
    (107, "http://g.h/", "<article><form>f</form><p>keep</p><div class='comment-list'>c</div></article>", "keep"),
    (107, "http://g.h/", "<article><form>f</form><p>keep</p><div class='comment-list'>c</div></article>", "keep"),
    (None, "http://i.j/", "<article>" + "<div>" * 3000 + "deep" + "</article>", "deep"),
    (108, "http://k.l/", "<article>" + "<p>" + "w " * 50_000 + "</article>", ("w " * 50_000).strip()),
    (109, "http://m.n/", "<article><header><h1>Head</h1></header>text</article><header>site</header>", "Head\n\ntext"),
]


def run(spark, rows):
    frame = spark.createDataFrame([(*r[:3], "h", "s", 1, "t") for r in rows], SCHEMA)
    return extract_articles(frame).collect()


def test_odd_pages(spark):
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in run(spark, ODD)), key=str)
    assert got == sorted(((i, u, t, len(t)) for i, u, _, t in ODD), key=str)
    assert run(spark, []) == []


def test_site_without_article_element(spark, monkeypatch):
    rows, texts = site_rows()
    got = {r.page_id: r.text for r in run(spark, rows)}
    assert [got[i].replace("\n\nRead this on our site", "") for i in range(len(texts))] == texts


def test_wrappers_in_groups_agree(spark, monkeypatch):
    rows, _ = site_rows(30)
    shapes = set()
    for _, _, page in rows:
        elements, _ = read_page(page)
        shapes.add(pack_shape([(e.path, e.parent, e.key, False, e.repeated) for e in elements]))
    frame = spark.createDataFrame([("h", s, 1) for s in shapes], html_extract.SHAPE_SCHEMA)
    monkeypatch.setattr(html_extract, "FAN_IN", 2)
    (found,) = html_extract.host_wrappers(frame).collect()
    wrapper = unpack_shape(found.shape)
    check_wrapper(wrapper, [unpack_shape(s) for s in shapes])


def check_wrapper(wrapper, streams):
    """Each stream's elements are in the wrapper; what all have is not optional."""
    flags = {e[0]: e[3] for e in wrapper}
    assert len(flags) == len(wrapper)
    everywhere = set.intersection(*({e[0] for e in s} for s in streams))
    assert set(flags) == set.union(*({e[0] for e in s} for s in streams))
    assert {p for p, optional in flags.items() if not optional} == everywhere
    repeated = {e[0] for s in streams for e in s if e[4]}
    assert {e[0] for e in wrapper if e[4]} == repeated


def test_alignment():
    def stream(*pages):
        out = None
        for page in pages:
            elements, _ = read_page(page)
            one = [(e.path, e.parent, e.key, False, e.repeated) for e in elements]
            out = one if out is None else align(out, one)
        return out

    pages = ["<ul><li>a<li>b</ul><p>x</p>", "<ul><li>a</ul><h2>y</h2><p>x</p>", "<h2>z</h2><p>x</p>"]
    wrapper = stream(*pages)
    check_wrapper(wrapper, [stream(p) for p in pages])
    assert html_extract.wrapper_text(wrapper) == "(<ul>(<li></li>)*</ul>)?(<h2></h2>)?<p></p>"


def test_constant_text_of_a_host_is_left_out(spark):
    note = "<p class=hint>Subscribe for more</p>"
    rows = [(i, "http://s.t/", f"<article><p>text {i}</p>{note}</article>") for i in range(6)]
    assert {r.text for r in run(spark, rows)} == {f"text {i}" for i in range(6)}
    same = [(i, "http://s.t/", "<article><p>text</p></article>") for i in range(6)]
    assert {r.text for r in run(spark, same)} == {"text"}


def test_constant_text_of_an_article_stays(spark):
    """Copies of a page, and headings or bodies that several articles have alike, lose nothing."""
    hint = "<p class=hint>Subscribe for more</p>"
    rows = [(i, "http://a.a/", "<article><p>one</p><blockquote>said</blockquote><pre>code</pre></article>") for i in range(5)]
    rows += [(5, "http://a.a/", "<article><p>two</p></article>")]
    rows += [(10 + i, "http://b.b/", f"<article><h1>T{i}</h1><h2>Introduction</h2><p>same body</p></article>") for i in range(6)]
    rows += [(20 + i, "http://c.c/", f"<article><p>{'x' if i else 'y'}</p>{hint}</article>") for i in range(6)]
    got = {r.page_id: r.text for r in run(spark, rows)}
    assert {got[i] for i in range(5)} == {"one\n\nsaid\n\ncode"} and got[5] == "two"
    assert all(got[10 + i] == f"T{i}\n\nIntroduction\n\nsame body" for i in range(6))
    assert all(got[20 + i].endswith("Subscribe for more") for i in range(6))


def test_head_without_end_tag():
    for start in ("<body>", "", "<body class=x>", "<svg>s</svg>", "<br>"):
        page = f"<html><head><meta charset=x><title>no</title><script>no</script>\n{start}<article><p>one</p><p>two</article>"
        assert article(page, set(), set()) == "one\n\ntwo"
    assert article("<html><head><title>no</title></head><body><main>yes</main></body></html>", set(), set()) == "yes"


def test_article_parts_without_marks_all_stay(spark):
    """Several elements share the text: none of them has all, so what holds them is taken."""
    dice = random.Random(8)
    rows, texts = [], {}
    for i in range(6):
        intro, body, lead = words(dice, 7), words(dice, 13), words(dice, 2)
        nav = "<ul><li><a href=/a>alpha</a><li><a href=/b>beta</a></ul>"
        page = f"<html><body>{nav}<div><h1>{lead}</h1><div class=intro>{intro}</div><div class=text>{body}</div></div></body></html>"
        rows.append((i, "http://one.x/", page))
        rows.append((10 + i, "http://two.x/", f"<html><body>{nav}<h1>{lead}</h1><div>{body}</div></body></html>"))
        texts |= {i: f"{lead}\n\n{intro}\n\n{body}", 10 + i: f"{lead}\n\n{body}"}
        assert article(rows[-2][2], {1}, set()) == texts[i]
    rows.append((20, "http://three.x/", "Hello <b>bold</b> world"))
    rows.append((21, "http://four.x/", f"<body>{nav}<div>{nav.replace('ul', 'ol')}<p>see</p><ul><li><a href=/s>source</a></ul></div></body>"))
    texts |= {20: "Hello bold world", 21: "see\n\nsource"}
    assert {r.page_id: r.text for r in run(spark, rows)} == texts


def test_names_that_only_hold_such_a_word_stay():
    kept = [
        '<h2 id="related-work">Related work</h2>', '<section id="search-results"><p>Found</p></section>',
        '<div class="share-price">12</div>', '<p class="ad-hoc">Hoc</p>', '<h2 id="promotion">Promotion</h2>',
        '<section id="notice"><h2>Notice</h2><p>Given</p></section>', '<pre id="ad">code</pre>',
    ]
    gone = [
        '<div class="ad-box">Buy</div>', '<div class="x share-buttons">Tell</div>', '<div id="comments">Me too</div>',
        '<ul class="related-posts"><li>More</ul>', '<div class=site-nav>n</div>', '<p class="advert">Buy</p>',
    ]
    page = "<article>" + "".join(map(str.__add__, kept, [*gone, ""])) + "</article>"
    assert article(page, set(), set()) == "Related work\n\nFound\n\n12\n\nHoc\n\nPromotion\n\nNotice\n\nGiven\n\ncode"
    assert article("<div id=ad>Buy</div><div id=related>More</div><div><p>Text</div>", set(), set()) == "Text"


def test_controls_and_drawings_end_where_they_are_closed():
    whole = "<article><p>A</p><button>Go<p>The whole article text.</p></article>"
    assert article(whole, set(), set()) == "A\n\nGo\n\nThe whole article text."
    assert article("<article>Let <math><mi>x</mi><annotation>\\x</annotation></math> be</article>", set(), set()) == "Let x be"
    assert article("<title-card>Hi there</title-card><p>A</p>", set(), set()) == "Hi there\n\nA"
    nested = "<svg><g><svg><text>in</text></svg></g><text>out</text></svg>"
    assert article(f"<article>a {nested}<button>no<div>no</div></button><SELECT x=1><option>no</Select> b</article>", set(), set()) == "a b"
    assert article("<article>a <textarea><!-- </textarea>b<p>c</article>", set(), set()) == "a b\n\nc"
    assert article("<article>" + "<object>x <svg>" * 20_000 + "</article>", set(), set()) == " ".join(["x"] * 20_000)


def test_fallback_for_a_page_of_its_own():
    page = "<div id=menu><a href=x>m</a></div><div class=body-text><p>one two three</p><p>four five</p></div>"
    assert article(page, {1}, set()) == "one two three\n\nfour five"


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = QUERIES["op6_html_extraction"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", inner)))
        blocks = (" ".join(html.unescape(b).split()) for b in inner.split("\0"))
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
