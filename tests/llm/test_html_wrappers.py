import html
import json
import random
import re

from snapmart.llm import html_wrappers as w
from tests.llm.conftest import SF


def extract(spark, pages):
    df = spark.createDataFrame([(k, u, p) for k, (u, p) in enumerate(pages)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in w.extract_main_text(df).collect()}


def sentence(rng, n=25):
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."


def test_wrapper_has_repeated_optional_and_text_slots():
    one = "<div><h1>A</h1><ul><li>x</li><li>y</li></ul><p>same</p></div>"
    two = "<div><h1>B</h1><img><ul><li>z</li></ul><table><tr><td>q</td></tr></table><p>same</p></div>"
    wrapper = w.merge(w.wrapper_of(w.parse(one)), w.wrapper_of(w.parse(two)))
    block = wrapper.kids[0]
    assert block.sig == "div~blocks"
    assert [k.sig for k in block.kids] == ["h1", "ul", "table", "p"]
    assert [k.maybe for k in block.kids] == [False, False, True, False]
    assert block.kids[1].kids[0].many and len(block.kids[1].kids) == 1
    assert block.kids[0].kids[0].value is None and block.kids[3].kids[0].value is not None
    assert w.dump(w.load(w.dump(wrapper))) == w.dump(wrapper)


def test_alignment_finds_what_some_pages_lack():
    pages = ["<nav><a>x</a></nav><div class=x>ad</div><div class=x><p>t</p></div><div class=x>f</div>",
             "<nav><a>y</a></nav><div class=x><p>u</p></div><div class=x>g</div>"]
    for one, two in (pages, pages[::-1]):
        wrapper = w.merge(w.wrapper_of(w.parse(one)), w.wrapper_of(w.parse(two)))
        assert [(k.sig, k.maybe) for k in wrapper.kids] == [
            ("nav~links", False), ("div.x~text", True), ("div.x~blocks", False), ("div.x~text", False)]


def test_repeated_groups_of_several_tags():
    page = "<dl>" + "<dt>a</dt><dd>b</dd>" * 5 + "</dl>"
    group = w.wrapper_of(w.parse(page)).kids[0].kids
    assert [k.sig for k in group] == ["(dt dd)"] and group[0].many and [k.sig for k in group[0].kids] == ["dt", "dd"]


def test_semantic_page(spark):
    rng = random.Random(1)
    pages, want = [], []
    for k in range(12):
        body = [sentence(rng) for _ in range(rng.randint(1, 5))]
        title = sentence(rng, 4)
        noise = f"<header>Site {k}</header><nav><ul>{''.join(f'<li><a href=/{j}>{sentence(rng, 1)}</a></li>' for j in range(5))}</nav>"
        extra = '<div class="notice">We use cookies &amp; more</div>' * (k % 2)
        comments = f'<section id="comments"><article class="comment"><p>{sentence(rng)}</p></article></section>' * (k % 3 > 0)
        form = "<form><label>Name</label><input><button>Go</button></form>"
        article = f"<h1>{title}</h1>{extra}" + "".join(f"<p>{p.replace(' ', '&nbsp; ', 1)}" + "</p>" * (j % 2) for j, p in enumerate(body)) + form
        pages.append((f"http://h{k % 2}.example/{k}", f"<html><body>{noise}<article>{article}</article>{comments}<aside>{sentence(rng)}</aside><footer>&copy; {sentence(rng)}</footer>"))
        want.append("\n\n".join([title, *body]))
    got = extract(spark, pages)
    assert [got[k] for k in range(12)] == want


def test_page_without_article(spark):
    rng = random.Random(2)
    pages, want = [], []
    for k in range(8):
        body = [sentence(rng, 40) for _ in range(3)]
        head = sentence(rng, 3)
        pages.append(("http://plain.example/", f"<body><div id=top>My site</div><div class=content><h2>{head}</h2>{''.join(f'<p>{p}</p>' for p in body)}</div><div>All rights reserved by the owners of this site, and by all of those who wrote for it over years</div>"))
        want.append("\n\n".join([head, *body]))
    got = extract(spark, pages)
    assert [got[k] for k in range(8)] == want


def test_edge_pages(spark):
    deep = "<div>" * 5000 + "<article>" + "x " * 30 + "</article>"
    got = extract(
        spark,
        [
            (None, None), ("http://a/", ""), ("odd", "<"), ("http://a/", "<article>cut &amp"), ("http://b/", "<article><p>a<br>b <b>c</b>d</p></article></div></p>"),
            ("http://c/", "<article><script>var x='</p>'</script><style>p{}</style><!-- no --><p title='a>b'>text</p>"), ("http://d/", deep),
            ("http://e/", "<article>" + "<p>w</p>" * 20_000), ("http://f/", '<a href="' * 20_000), ("http://f/", "<article>1 < 2 &lt; 3 &#x41;</article>"),
        ],
    )
    assert got[0] == got[1] == "" and got[3] == "cut &" and got[4] == "a b cd" and got[5] == "text"
    assert got[7].count("\n\n") == 19_999 and got[9] == "1 < 2 < 3 A"
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert w.extract_main_text(empty).count() == 0


def test_clashing_columns_and_repeated_pages(spark):
    from pyspark.sql import functions as F

    page = spark.createDataFrame([(1, "http://x/", "<main><p>one two</p></main>")] * 3, "page_id bigint, url string, html string")
    got = w.extract_main_text(page.withColumns({"host": F.lit("h"), "wrapper": F.lit("w"), "text": F.lit("t")})).collect()
    assert [r.text for r in got] == ["one two"] * 3


def test_query(spark):
    got = {r.page_id: r for r in w.op6_html(spark, SF).collect()}
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        inside = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert got[i].text == "\n\n".join(b for b in blocks if b)
        assert got[i].n_chars == len(got[i].text) and got[i].url == page.url


def test_copies_of_one_article_are_no_template(spark):
    page = "<nav><a>x</a></nav><article><h1>The title</h1><p>Only one paragraph here.</p></article>"
    got = extract(spark, [("http://copies.example/", page)] * 10)
    assert set(got.values()) == {"The title\n\nOnly one paragraph here."}


def test_unchanged_text_of_a_host_is_template(spark):
    rng = random.Random(4)
    rows = [sentence(rng, 30) for _ in range(6)]
    legal = "Everything on these pages belongs to the people who wrote it and may not be sold by others at all"
    pages = [("http://t.example/", f"<div><div><p>{r}</p></div><section><p>{legal}</p></section></div>") for r in rows]
    assert sorted(extract(spark, pages).values()) == sorted(rows)


def test_pages_of_both_layouts_on_one_host(spark):
    rng = random.Random(5)
    pages, want = [], []
    for k in range(12):
        body = [sentence(rng) for _ in range(3)]
        paragraphs = "".join(f"<p>{p}</p>" for p in body)
        block = f"<article>{paragraphs}</article>" if k % 3 == 0 else f"<main>{paragraphs}</main>" if k % 3 == 1 else f"<div class=old>{paragraphs}</div>"
        pages.append((None if k < 6 else "http://mixed.example/", f"<body><nav><a>x</a></nav>{block}<footer>f</footer></body>"))
        want.append("\n\n".join(body))
    got = extract(spark, pages)
    assert [got[k] for k in range(12)] == want


def test_text_does_not_depend_on_the_number_of_copies(spark):
    long = "These are the words of the one page that was copied many times over and over again."
    inside = "<article><h1>The title</h1><p>Only one paragraph here.</p></article>"
    outside = f"<body><nav><a>x</a></nav><div><h1>The title</h1><p>{long}</p></div></body>"
    for page, want in ((inside, "The title\n\nOnly one paragraph here."), (outside, f"The title\n\n{long}")):
        for copies in (10, 1000):
            assert set(extract(spark, [("http://copies.example/", page)] * copies).values()) == {want}


def test_heading_of_every_article_is_kept(spark):
    rng = random.Random(6)
    rows = [sentence(rng) for _ in range(30)]
    got = extract(spark, [("http://h.example/", f"<article><h2>Summary</h2><p>{r}</p></article>") for r in rows])
    assert [got[k] for k in range(30)] == [f"Summary\n\n{r}" for r in rows]


def test_names_of_layouts_leave_no_main_section_out(spark):
    text = "<p>Real text</p>"
    pages = [
        f"<body class='has-sidebar'><article>{text}</article></body>", f"<article class='post comments-open'>{text}</article>",
        f"<div id='two-side-layout'><article>{text}</article></div>", f"<main class='search-page'>{text}</main>",
        f"<html class=search><body class='hidden footer'><article>{text}</article></body></html>", f"<main class=search>{text}</main>",
        f"<div class='page sidebar'><div><article class='post tags'>{text}</article></div></div>",
        f"<article>{text}<div class='nav-menu'>menu</div><div class='no-ads'>More</div></article>",
        f"<article>{text}</article><div class=comments><article class=comment>Me too</article></div>",
        f"<div class=discussion><article class=comment>{text}</article></div>",
    ]
    got = extract(spark, [(f"http://n{k}.example/", p) for k, p in enumerate(pages)])
    assert [got[k] for k in range(10)] == ["Real text"] * 7 + ["Real text\n\nMore"] + ["Real text"] * 2


def test_short_pages_lists_and_tables_without_article(spark):
    rng = random.Random(7)
    long = sentence(rng)
    pages = [
        ("<body><p>Short text.</p></body>", "Short text."),
        (f"<div>menu</div><div><p>{long}</p><ul><li>one</li><li>two <ol><li>three</ol></ul><table><tr><td>1</td><td>2</td></tr></table><p>end</p></div>", f"{long}\n\none\n\ntwo\n\nthree\n\n1\n\n2\n\nend"),
        (f"<div><ul><li>one</li><li>{long}</li></ul><div class=ad>Buy</div><div><h3>Then</h3></div></div><div>Top</div>", f"one\n\n{long}\n\nThen"),
        (f"<div class=s1><p>Short</p></div><div class=s2><p>{long}</p></div><div>Top</div>", f"Short\n\n{long}"),
        ("<div><a href=/>Home page of it</a></div><div><h1>Title</h1><p>Few words.</p></div>", "Title\n\nFew words."),
    ]
    got = extract(spark, [(f"http://s{k}.example/", p) for k, (p, _) in enumerate(pages)])
    assert [got[k] for k in range(len(pages))] == [want for _, want in pages]


def test_short_page_of_a_long_host(spark):
    rng = random.Random(8)
    rows = ["Only this."] + [sentence(rng) for _ in range(5)]
    legal = "Everything on these pages belongs to the people who wrote it and may not be sold by others at all"
    got = extract(spark, [("http://l.example/", f"<div id=top>Site</div><div class=text><p>{r}</p></div><div id=end>{legal}</div>") for r in rows])
    assert [got[k] for k in range(6)] == rows


def test_blocks_beyond_the_depth_of_wrappers(spark):
    opened, closed = "<div>" * 100, "</div>" * 100
    aside = "<aside>no</aside><nav><ul><li>no</li></ul></nav><div class=ad><div>no</div></div>"
    deep = "<div>" * 5000 + "<article>" + "x " * 30 + "</article>"
    pages = [
        (f"<div><article><p>start</p>{opened}deep{closed}<p>rest of it</p></article></div>", "start\n\ndeep\n\nrest of it"),
        (f"{opened}before<article>{aside}<p>a</p>{opened}b{aside}{closed}c</article>after{closed}after", "a\n\nb\n\nc"),
        (f"<div>{opened}{aside}{'w ' * 30}<div>x</div>y{closed}</div>", ("w " * 30).strip() + "\n\nx\n\ny"),
        (deep, ("x " * 30).strip()),
        ("<div>" * 30_000 + "<ul><li>text" * 100 + "</div>" * 30_000, "\n\n".join(["text"] * 100)),
    ]
    got = extract(spark, [(f"http://d{k}.example/", p) for k, (p, _) in enumerate(pages)])
    assert [got[k] for k in range(len(pages))] == [want for _, want in pages]


# Texts come through the wrapper


def pages_of(spark, n=40):
    return spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(n).collect()


def renamed(page):
    """Every section tag and every class as one neutral block."""
    page = re.sub(r"<(nav|article|footer|aside|header|main|section)\b[^>]*>", "<div class=x1>", page)
    page = re.sub(r"</(nav|article|footer|aside|header|main|section)>", "</div>", page)
    return re.sub(r'<div class="?ad"?>', '<div class=x1>', page)


def host_pages(rng, n, story=(1, 60)):
    """Pages of one host without any telling tag or name: menu, advert, story, notice."""
    pages, want = [], []
    for k in range(n):
        # Every other story is a few words long.
        title = sentence(rng, 3)
        body = [sentence(rng, rng.randint(*story)) for _ in range(rng.randint(1, 4))] if k % 2 else [sentence(rng, 2)]
        advert = f"<div class=x>{sentence(rng, 30)}</div>" * (k % 3 > 0)
        menu = "".join(f"<li><a href=/{j}>{sentence(rng, 2)}</a></li>" for j in range(6))
        pages.append(f"<body><div class=x><ul>{menu}</ul></div>{advert}<div class=x><h2>{title}</h2>{''.join(f'<p>{p}</p>' for p in body)}</div><div class=x>{sentence(rng, 12)}</div></body>")
        want.append("\n\n".join([title, *body]))
    return pages, want


def test_every_host_has_a_wrapper_that_its_pages_fit(spark):
    from snapmart.llm.url_filter import split_url
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("host", split_url(F.col("url"))[0])
    ways = {r.host: (r.pages, json.loads(r.way)) for r in w.infer_wrappers(pages).collect()}
    rows = pages.collect()
    assert set(ways) == {r.host for r in rows} and sum(n for n, _ in ways.values()) == len(rows)
    assert all(w.read(w.parse(r.html), ways[r.host][1]) is not None for r in rows)


def test_neutral_tags_and_names_give_the_same_texts(spark):
    some = pages_of(spark, 1000)
    one = extract(spark, [(p.url, p.html) for p in some])
    two = extract(spark, [(p.url, renamed(p.html)) for p in some])
    assert "<article" not in renamed(some[0].html) and one == two


def test_wrapper_tells_the_story_where_a_page_alone_cannot(spark):
    pages, want = host_pages(random.Random(11), 30)
    got = extract(spark, [("http://x.example/", p) for p in pages])
    assert [got[k] for k in range(30)] == want
    # Without the wrapper, short stories beside longer adverts are lost.
    alone = [w.main_text(p, None) for p in pages]
    assert sum(a != b for a, b in zip(alone, want)) >= 3


def test_order_of_pages_does_not_matter(spark):
    rng = random.Random(12)
    pages, want = host_pages(rng, 24)
    places = list(range(24))
    for _ in range(3):
        rng.shuffle(places)
        got = extract(spark, [("http://x.example/", pages[k]) for k in places])
        assert [got[j] for j in range(24)] == [want[k] for k in places]


def test_number_of_pages_does_not_matter(spark):
    rng = random.Random(13)
    rows = [sentence(rng) for _ in range(6)]
    for n in (1, 2, 3, 4, 6):
        got = extract(spark, [("http://n.example/", f"<div class=top>Site</div><div class=text><h2>Summary</h2><p>{r}</p></div>") for r in rows[:n]])
        assert [got[k] for k in range(n)] == [f"Summary\n\n{r}" for r in rows[:n]]


def test_names_inside_the_article_drop_no_text(spark):
    rng = random.Random(14)
    text, long = sentence(rng, 12), sentence(rng, 60)
    pages = [
        (f"<article><p>{long}</p><section id='discussion'><h2>Discussion</h2><p>{text}</p></section></article>", f"{long}\n\nDiscussion\n\n{text}"),
        (f"<article><p>{long}</p><section id='search'><p>{text}</p></section></article>", f"{long}\n\n{text}"),
        (f"<article><p class='side'>{text}</p><p class='bottom'>b</p><p class='legal'>c</p></article>", f"{text}\n\nb\n\nc"),
        (f"<article><header><h1>Title</h1></header><p>{long}</p></article>", f"Title\n\n{long}"),
        (f"<nav><a>x</a></nav><h1>Title</h1><article><p>{long}</p></article>", f"Title\n\n{long}"),
        (f"<main><p>{long}</p></main><article><p>{text}</p></article><article><p>{text}</p></article>", long),
        (f"<article><p>{long}</p></article><article><h3>Teaser</h3><p>few words</p></article>", long),
        (f"<article><p>{long}</p><div id=remarks><article><p>{text}</p></article><article><p>{text}</p></article></div></article>", long),
        (f"<article><p>{long}</p></article><div id=remarks><article><p>{text}</p></article></div>", long),
        (f"<article><p>{long}</p><div class=comments><p>{text}</p></div><aside>{text}</aside><div class='ad'>Buy</div></article>", long),
    ]
    got = extract(spark, [(f"http://i{k}.example/", p) for k, (p, _) in enumerate(pages)])
    assert [got[k] for k in range(len(pages))] == [want for _, want in pages]


def test_hot_host_of_unlike_pages_stays_bounded(spark):
    rng = random.Random(15)
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda: "".join(rng.choice(letters) for _ in range(4))
    whole, want = None, []
    for k in range(150):
        junk = "".join(f"<div class={name()}><div class={name()}>{name()}</div></div>" for _ in range(20))
        page = f"<body><div class=text><p>{sentence(rng)}</p></div>{junk}</body>"
        one = w.wrapper_of(w.parse(page))
        whole = w.pruned(w.merge(whole, one)) if whole else one
        want.append(page)
    assert len(w.ordered(whole)) <= w.NODES
    levels = w.way(whole)
    assert all(w.read(w.parse(p), levels) == re.search("<p>(.*?)</p>", p).group(1) for p in want)


def test_ways_that_are_too_many_to_broadcast(spark):
    from pyspark.sql import functions as F
    from snapmart.llm.url_filter import split_url

    rng = random.Random(16)
    rows, want = [], {}
    for h, n in (("a", 12), ("b", 3), ("c", 1)):
        pages, texts = host_pages(rng, n, (30, 60))
        for p, t in zip(pages, texts):
            want[len(rows)] = t
            rows.append((len(rows), f"http://{h}.example/", p))
    df = spark.createDataFrame([*rows, (99, None, None)], "page_id bigint, url string, html string").withColumn("host", split_url(F.col("url"))[0])
    got = w.read_pages(df, w.infer_wrappers(df), broadcast_bytes=0, hot_pages=5)
    assert {r.page_id: r.text for r in got.collect()} == want | {99: ""}
