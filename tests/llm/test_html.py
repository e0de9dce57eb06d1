"""HTML extraction: given pages against their markup, unseen layouts, odd pages."""

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from nodecast.llm import html_text
from nodecast.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").collect()


@pytest.fixture(scope="module")
def chain(pages):
    return html_text.fit([r.html for r in pages[::2]])


def test_query_on_given_pages(spark, pages):
    found = {r.page_id: r for r in QUERIES["op10_html_extraction"](spark, FOLDER).collect()}
    assert len(found) == len(pages)
    for r in pages:
        wanted = "\n".join(b[0] for b in html_text.blocks(r.html) if html_text.says(b))
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (wanted, len(wanted), r.url)


def test_unseen_layout(chain):
    html = """<html><head><title>A title</title><style>p{}</style></head><body>
    <div class="site-header"><a href="/">Home</a></div>
    <div class="cookie-banner">We use cookies to do things. <button>OK</button></div>
    <div class="content"><h1>The &amp; heading</h1><p>First   paragraph with <b>bold</b>
     words&nbsp;and an end.<p>Second one, it goes on for a while and ends.
    <div class="ad">Buy this thing now</div><p>Third paragraph<br>of the text is here.</p>
    <script>var x = "<p>no</p>";</script></div>
    <div class="comments"><p>I like what you wrote here, thanks.</p></div>
    <footer>&copy; 2020 Some site, all rights reserved.</footer></body></html>"""
    assert chain.text(html) == (
        "The & heading\nFirst paragraph with bold words and an end.\nSecond one, it goes on for a while and ends."
        "\nThird paragraph of the text is here."
    )


def test_viterbi_finds_the_best_labels():
    rnd = random.Random(3)
    weights = {f: rnd.uniform(-2, 2) for f in "abcdef"}
    chain = html_text.Chain(weights, np.array([[0.7, -0.4], [-0.9, 0.5]]), 0.1)
    for n in range(1, 7):
        page = [rnd.sample("abcdef", 2) for _ in range(n)]

        def worth(labels):
            own = sum(0.1 + sum(weights[f] for f in b) for b, y in zip(page, labels) if y)
            return own + sum(chain.moves[a][b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product([False, True], repeat=n), key=worth)
        assert chain.labels(page) == list(best)


def test_odd_pages(spark, chain):
    assert chain.text(None) == chain.text("") == chain.text("<p") == ""
    long = "<article>" + "<p>Some words that are the text.</p>" * 3000 + "</article>"
    assert chain.text(long).count("\n") == 2999
    assert chain.text("<b>" * 3000 + "x") in ("", "x")
    rows = [(1, "u", long), (1, "u", long), (2, None, None), (None, "v", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = html_text.extract(frame).collect()
    assert sorted(((r.page_id, r.url, r.n_chars) for r in found), key=str) == sorted(
        [(1, "u", 3000 * 30 - 1), (1, "u", 3000 * 30 - 1), (2, None, 0), (None, "v", 0)], key=str
    )
    assert html_text.extract(frame.limit(0)).collect() == []


def test_broken_markup_is_no_error(chain):
    assert chain.text("<article><p>a b c d e f g.</p><![foo[bar]]><p>h i j k l m n.</p></article>").count("\n") == 1
    rnd = random.Random(5)
    pieces = ["<", "<!", "<![", "]]>", "<!--", "-->", "<p", "<p>", "</", "</p>", "<a href='", "'", '"', ">", "<article>", "<?x", "&", "&#x;", "&amp", "\0",
              "<script>", "</script>", "<![CDATA[", "<!doctype", "<svg>", "text ", "<div class=a id=b>", "</div >", "=", "/", "é"]
    for _ in range(3000):
        chain.text("".join(rnd.choices(pieces, k=rnd.randint(1, 25))))


def test_cues_count_wherever_they_stand(chain):
    page = "<body><div><p>{}</p></div><article><p>Some words of the article, and an end.</p></article></body>"
    notice, filler = "subscribe to the newsletter, privacy terms, login and register", "words " * 200
    first, last = (html_text.own_features(html_text.blocks(page.format(t))[0]) for t in (f"{notice} {filler}.", f"{filler} {notice}."))
    assert first == last and "cue:newsletter" in last


def test_text_of_any_visible_element_is_seen(chain):
    page = "<article><p>The formula <math><mi>x</mi></math> and <svg><text>a label</text></svg> stand here, as does <noscript>this</noscript>.</p></article>"
    assert chain.text(page) == "The formula x and a label stand here, as does this."


def test_deep_markup_takes_linear_time(chain):
    started = time.time()
    for n, piece, end in ((100_000, "<div class=x>a", ""), (100_000, "<b>", "text"), (50_000, "<b><i></u>", "x"), (50_000, "<li><a>x</a>", "")):
        chain.text(piece * n + end)
    assert time.time() - started < 30


def test_running_sums_equal_the_features(chain, pages):
    for page in pages[:40]:
        plain = [chain.bias + chain.worth(html_text.features(b)) for b in html_text.blocks(page.html)]
        running = [chain.bias + b[1] + chain.worth(html_text.own_features(b)) for b in html_text.blocks(page.html, chain.weights)]
        assert np.allclose(plain, running)


def test_layout_whose_markup_misleads(chain):
    """An article element around everything, so that its markup alone says too much."""
    page = """<body><article><div class="menu"><a href=x>Home</a><a href=y>News and more</a></div><h1>The heading of it</h1>
    <p>The first paragraph of the text goes on for a while and ends here.</p><p>The second one does so too, and ends.</p>
    <div class="comments"><h3>Replies</h3><div class="comment"><p>I like what you wrote here.</p></div></div>
    <div class="newsletter subscribe">Subscribe to the newsletter</div></article><footer>Copyright 2020</footer></body>"""
    assert not all(html_text.says(b) == y for b, y in zip(html_text.blocks(page), [False, True, True, True] + [False] * 4))
    found = chain.text(page)
    assert "first paragraph" in found and "second one" in found
    assert not any(w in found for w in ("Subscribe", "Copyright", "I like"))
