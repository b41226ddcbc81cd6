import random
import time

import pytest

from retail_lake.llm import pages

LONG = "A sentence of prose that is long enough to be counted as such. " * 4


def page(article, body_class="content"):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script>"
        "</head><body><nav><ul><li><a href=/x>menu</a></li></ul></nav><!-- x --><header>Site</header>"
        f'<div class="ad">Buy now</div><div class="{body_class} n-12">{article}</div>'
        '<div class="comments"><p>I liked this very much indeed, thank you for it.</p></div>'
        "<aside>Other</aside><footer>&copy; us</footer></body></html>"
    )


def test_blocks_references_and_white_space():
    text = pages.extract(
        page(
            f"<h1>One &amp;\n two</h1><p>{LONG}<b>bold<br>next&nbsp;line</b><p>Third &lt;p&gt;"
            "<ul><li>a<li>b</ul><form><input>Go</form><script>if(a<b){}</script>end"
        ),
        [],
    )
    prose = " ".join(LONG.split())
    assert text == f"One & two\n{prose} bold next line\nThird <p>\na\nb\nend"


@pytest.mark.parametrize("source", ["", " ", "plain", "<", "<p", "</p>", "<p>x", "<a b='>'>", "<!--", "&#x1F600;"])
def test_broken_markup_does_not_fail(source):
    assert isinstance(pages.extract(source, []), str)


def test_markup_that_breaks_off_is_read_as_far_as_it_goes():
    whole = page(f"<p>{LONG}</p><p>{LONG}</p>")
    cut = whole[: whole.index(LONG) + 100]
    assert pages.extract(cut, []) == LONG[:100].strip()


def test_host_path_decides_where_a_page_by_itself_would_err(spark):
    """The page's longest prose is a box; the others of the host show where the article is."""
    box = f'<div class="offer"><p>{LONG}{LONG}</p></div>'
    rows = [(i, f"http://h.example/{i}", page(f"<p>{LONG}{i}</p>", "main")) for i in range(9)]
    odd = page("<p>A short note, and no more.</p>", "main").replace("<aside>", box + "<aside>")
    rows += [(9, "http://h.example/9", odd), (10, "http://other.example/", odd)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in pages.main_text(frame).collect()}
    assert texts[9] == "A short note, and no more."
    assert texts[10] == " ".join((LONG + LONG).split())
    assert texts[3] == " ".join(f"{LONG}3".split())


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, host string, votes int"
    rows = [
        (1, None, page(f"<p>{LONG}</p>"), "x", "y", 1),
        (1, None, page(f"<p>{LONG}</p>"), "x", "y", 1),
        (2, "no host", None, None, None, None),
        (None, "http://a.example", "", None, None, None),
        (3, "http://a.example/x", "<p>" + "word " * 50_000, None, None, None),
    ]
    found = pages.main_text(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 5
    texts = {(r.page_id, r.url): (r.text, r.n_chars) for r in found}
    prose = " ".join(LONG.split())
    assert texts[(1, None)] == (prose, len(prose))
    assert texts[(2, "no host")] == ("", 0) and texts[(None, "http://a.example")] == ("", 0)
    assert texts[(3, "http://a.example/x")][1] == 50_000 * 5 - 1
    assert pages.main_text(spark.createDataFrame([], schema)).count() == 0


def test_large_ids_beside_a_null_one(spark):
    ids = [2**60 + 1, 2**60 + 3, None]
    rows = [(i, "http://a.example", page(f"<p>{LONG}</p>")) for i in ids]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = pages.main_text(frame)
    assert {r.page_id for r in found.collect()} == set(ids) and dict(found.dtypes)["page_id"] == "bigint"


def test_all_parts_of_an_article():
    nested = f"<article><h1>Title</h1><p>The lead.</p><section><p>{LONG}<p>{LONG}</section><section><p>{LONG}<p>{LONG}</section></article>"
    prose = LONG.strip()
    assert pages.extract(f"<body>{nested}", []).split("\n") == ["Title", "The lead.", *[prose] * 4]
    split = f"<body><nav>menu</nav><div class=lead>A lead of some words.</div><div class=body><p>{LONG}<p>{LONG}</div><aside>other"
    assert pages.extract(split, []).split("\n") == ["A lead of some words.", prose, prose]


def test_attributes_in_every_form():
    for attribute in ("title=it's", "title='>'", 'title=">"', "title = a/b", "a=b'c\"d", "=x", "x", "/ x='' /"):
        assert pages.extract(f"<p {attribute}>Text that we don't lose, you see</p>", []) == "Text that we don't lose, you see"
    assert pages.extract(f"<p>{LONG}</p><p title='never closed>x</p>", []) == LONG.strip()


@pytest.mark.parametrize("name", ["post-comments", "story-share", "content-related", "menu-story", "postComments"])
def test_a_noise_word_beats_an_article_word(name):
    extra = f'<div class="{name}"><p>{LONG}</p></div>'
    assert pages.extract(f"<article><p>{LONG}x</p>{extra}</article>", []) == f"{LONG}x"
    titled = f'<article><div class="post-header"><h1>Title</h1></div><div class="has-sidebar"><p>{LONG}</p></div></article>'
    assert pages.extract(titled, []) == f"Title\n{LONG.strip()}"


def test_deep_markup_takes_linear_time():
    begin = time.perf_counter()
    for n in (100_000,):
        for source in ("<div>" * n, "<b>" * n + "</i>" * n, "<li>" * n, "<a b='" * n, "<" * n, "<!--" * n, "<p>" * n):
            pages.extract(source + LONG, [])
            pages.vote_of(source + LONG)
    assert time.perf_counter() - begin < 120
    assert pages.extract("<div>" * 100_000 + LONG, []) == LONG.strip()


def _generated(rng):
    """A page as its author meant it: markup, and the blocks of its article in order."""
    words = "lorem ipsum dolor sit amet &amp; consetetur sadipscing elitr &lt;sed&gt;".split()
    counter = iter(range(1, 1000))

    def prose(least=6):
        return f"{next(counter)} " + " ".join(rng.choices(words, k=rng.randint(least, 40)))

    def read(text):
        return text.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")

    blocks = []

    def block(depth=0):
        kind = rng.randrange(7 if depth < 4 else 4)
        text = prose()
        if kind == 0:
            blocks.append(read(text))
            return f"<p title=it's>{text}" + rng.choice(["", "</p>\n"])
        if kind == 1:
            half = rng.randrange(1, len(text.split()))
            blocks.append(read(text))
            return "<p>" + " ".join(text.split()[:half]) + "<br><b>" + " ".join(text.split()[half:]) + "</b></p>"
        if kind == 2:
            items = [prose(2) for _ in range(3)]
            blocks.extend(map(read, items))
            return "<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>"
        if kind == 3:
            noise = rng.choice(["<aside>{}</aside>", "<form>{}<input></form>", "<script>{}</p></script>", '<div class="post-comments">{}</div>', "<!-- {} -->", "<section id=newsletterSignup><p>{}</section>"])
            return noise.format(prose())
        name = rng.choice(["section", "div", "div class=part-7", "blockquote"])
        return f"<{name}>" + "".join(block(depth + 1) for _ in range(rng.randint(1, 4))) + f"</{name.split()[0]}>"

    title = f"Title {next(counter)}"
    blocks.append(title)
    inner = f"<h1>{title}</h1>" + block() + "".join(block() for _ in range(rng.randint(1, 6)))
    wrap = rng.choice(["<article>{}</article>", "<main><div>{}</div></main>", "<div class='post x'><div>{}</div></div>", "<div>{}</div>"])
    chrome = "<nav><a href=/>menu</a></nav><header>Site</header>", "<div class=sidebar>" + prose() + "</div><footer>us</footer>"
    return f"<!DOCTYPE html><html><body>{chrome[0]}{wrap.format(inner)}{chrome[1]}</body></html>", "\n".join(blocks)


def test_generated_pages_against_what_their_author_meant(spark):
    rng = random.Random(5)
    made = [_generated(rng) for _ in range(400)]
    for source, meant in made:
        assert pages.extract(source, []) == meant
    rows = [(i, f"http://h{i % 7}.example/{i}", source) for i, (source, _) in enumerate(made)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    texts = {r.page_id: r.text for r in pages.main_text(frame).collect()}
    wrong = [i for i, (_, meant) in enumerate(made) if texts[i] != meant]
    assert not wrong
