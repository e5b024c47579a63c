import pytest

from tidewright.llm import html_text

SCHEMA = "page_id bigint, url string, html string, host string, text string"


def page(n, body, nav="<a href=/a>Home</a>", foot="(c) site"):
    return f"<!DOCTYPE html><html><head><title>t{n}</title><script>var t='</p>';</script></head><body><nav>{nav}</nav>{body}<footer>{foot}</footer></body></html>"


CASES = [
    ("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>four <b>fi</b>ve</article>", "A & B one two three four five"),
    ("<article><p><b>open<br><p>next</p></article> after", "open next"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>by me</footer><aside>side</aside></article>", "T x"),
    ("<article><p>x</p><form><input value=1><button>Send</button></form><div class='ad box'>buy</div></article>", "x"),
    ("<article><p>x</p><section id=comments><article class=comment>hi</article></section></article>", "x"),
    ("<main><p>x</p><div class='cookie-notice'>ok?</div></main><div class=sidebar>s</div>", "x"),
    ("<header>Site</header><div><p>x</p><ul><li>1<li>2</ul></div><div id='cookie'>ok</div>", "x 1 2"),
    ("<article><!-- no --><p>a&lt;b &eacute;&#233;&#xE9;&nbsp;c</p><style>p{}</style><noscript>js</noscript></article>", "a<b ééé c"),
    ("<article><p>cut off", "cut off"),
    ("<article></article>", ""),
    ("", ""),
]


@pytest.mark.parametrize("body, want", CASES)
def test_one_page(body, want):
    assert html_text.main_text(page(0, body), set()) == want


STORY = "<p>the story of this page is told at some length here</p>"
WHOLE = [
    f"<html><body class='no-sidebar with-comments'><article>{STORY}</article></body></html>",
    f"<html class=login><body class=search><article>{STORY}</article></body></html>",
    f"<body><div id='page-header-fixed'><div class=overlay><article>{STORY}</article></div></div></body>",
    f"<body><article class='post has-social-share'>{STORY}</article></body>",
    f"<body><article class='post social'>{STORY}</article></body>",
    f"<body><div class='search'>{STORY}</div><div class=site-footer>us</div></body>",
    f"<body><article>{STORY}<div class='post-comments'>{'<p>I disagree with all of it</p>' * 9}</div></article></body>",
]


@pytest.mark.parametrize("html", WHOLE)
def test_class_words_cut_no_whole_page(html):
    assert html_text.main_text(html, set()) == "the story of this page is told at some length here"


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "extra", "extra") for r in rows], SCHEMA)
    return {r["page_id"]: r["text"] for r in html_text.main_texts(df).collect()}


def test_templates_go_and_articles_stay(spark):
    """Boxes that recur around different articles go, on their host only; copied articles and passages
    inside articles stay."""
    rows, want = [], {}
    for i in range(30):
        box = "<div><p>Read our terms</p></div>"
        rows.append((i, f"https://a.example/{i}", f"<body>{box}<div><p>story {i} is long enough</p></div></body>"))
        want[i] = f"story {i} is long enough"
    for i in range(30, 60):
        rows.append((i, f"https://b.example/{i}", "<body><div><p>the same story on all pages</p></div></body>"))
        want[i] = "the same story on all pages"
    for i in range(60, 90):
        rows.append((i, f"https://c.example/{i}", page(i, f"<article><p>shared passage</p><p>own text number {i}</p><div>Rate this</div></article>")))
        want[i] = f"shared passage own text number {i}"
    rows.append((90, "https://d.example/", "<body><div><p>Read our terms</p></div><p>other</p></body>"))
    want[90] = "Read our terms other"
    assert texts(spark, rows) == want


def test_long_template_short_stories(spark):
    """Boilerplate longer than the stories goes; a copied story with another counter is one article and stays."""
    legal = "<div><p>" + "all rights in these pages and their words remain with us " * 9 + "</p></div>"
    tale = " ".join(f"tale{k}" for k in range(60))
    rows, want = [], {}
    for i in range(30):
        rows.append((i, f"https://a.example/{i}", f"<body>{legal}<div><p>story {i} is <b>much</b> shorter than what the lawyers of site {i} have to say</p></div></body>"))
        want[i] = f"story {i} is much shorter than what the lawyers of site {i} have to say"
    for i in range(30, 60):
        rows.append((i, f"https://b.example/{i}", f"<body><div><p>{tale}</p></div><div>seen {i} times</div></body>"))
        want[i] = f"{tale} seen {i} times"
    assert texts(spark, rows) == want


def test_counts_remove_text_inside_articles(spark):
    """A notice in a plain paragraph of every article goes, on a whole host or in one section; a passage in half
    of the articles and one that copies of an article repeat stay."""
    rows, want = [], {}

    def add(url, own, *shared):
        i = len(rows)
        rows.append((i, f"https://{url}/{i}", f"<body><article><h1>T{i}</h1><p>{own}</p>{''.join(f'<p>{s}</p>' for s in shared)}</article></body>"))
        return i

    for k in range(60):
        i = add("a.example", f"story {k}", "Sign up for our letter today", *["half of them"] * (k % 2))
        want[i] = f"T{i} story {k}" + " half of them" * (k % 2)
    for k in range(60):
        i = add("b.example/news", f"news {k}", "From the news desk")
        want[i] = f"T{i} news {k}"
        i = add("b.example/sport", f"sport {k}")
        want[i] = f"T{i} sport {k}"
    for _ in range(60):
        i = len(rows)
        rows.append((i, f"https://c.example/{i}", "<body><article><p>one story</p><p>on all pages</p></article></body>"))
        want[i] = "one story on all pages"
    assert texts(spark, rows) == want


def test_templates_of_large_hosts_go(spark):
    """A box around six of 3 500 articles goes, whatever the size of its host."""
    rows = [(i, f"https://a.example/{i}", f"<body><div>Box</div><p>story {i}</p></body>") for i in range(6)]
    rows += [(i, f"https://a.example/{i}", f"<body><p>story {i}</p></body>") for i in range(6, 3500)]
    assert texts(spark, rows) == {i: f"story {i}" for i in range(3500)}


def test_odd_rows(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    rows = [(1, None, None), (2, "", ""), (3, "nonsense", "just words"), (None, "http://x.example", "<p>no id"),
            (4, "http://x.example", deep), (4, "http://x.example", deep), (5, "http://x.example", "< > <<p>a</p <b>")]
    got = texts(spark, rows)
    assert got[1] == got[2] == "" and got[3] == "just words" and got[None] == "no id" and got[4] == "deep"
    df = spark.createDataFrame([(*r, "extra", "extra") for r in rows], SCHEMA)
    assert html_text.main_texts(df).count() == len(rows)
    assert html_text.main_texts(df.limit(0)).count() == 0
