"""Main text of web pages by a linear-chain conditional random field.

A page becomes the sequence of its leaf blocks: stretches of text between tags
that start or end a block.  Each block has features from its ancestors (tags,
and words of their class, id and role) and from its text (length, share of
linked text, punctuation, cue words).  A two-label chain over the blocks,
content or not, is fitted on labelled pages and decoded by Viterbi.

Labelled pages: at most ``SAMPLE`` given pages (those with the smallest hash,
none longer than ``LONGEST``; documented bounds) whose own markup says which
blocks are the article, and for each of them one of the ``LAYOUTS`` filled with
its paragraphs, so that pages without that markup, and adverts, forms or reader
comments inside of it, are learnt too.  Every page is then extracted whole.

Null and empty pages give an empty text, as do pages without content blocks.
Repeated rows give repeated rows.  Other columns are not read.  Without any
page to learn from, the layouts alone are learnt.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nodecast.llm.tasks import hashed_sample, small_batches

SAMPLE, LONGEST, ROUNDS = 300, 200_000, 12

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol"
    " option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("script style template iframe textarea".split())
#: a start tag closes open elements of these names, up to the nearest of the others
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
CUES = frozenset(
    "cookie cookies subscribe newsletter copyright advertisement sponsored comments comment reply replies login"
    " register share follow privacy terms rights reserved menu home search sign".split()
)
WORD = re.compile(r"[^\W\d_]+")
NAME = re.compile(r"[a-z]+")


class Blocks(HTMLParser):
    """Collects (text, above, own, linked characters) of the leaf blocks.

    ``own`` is the block element that holds the text, ``above`` what its ancestors
    say: their features or, with ``weights``, only the sum of these features'
    weights, which is kept up to date as elements open and close.  So the work is
    linear in the page, however deep its elements are nested.
    """

    def __init__(self, weights: dict[str, float] | None = None):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple] = []
        self.weights = weights
        self.stack: list[tuple[str, list[str]]] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # where each tag is open
        self.block_places: list[int] = []
        self.active: Counter = Counter()  # features of the open elements
        self.score = 0.0
        self.text: list[str] = []
        self.linked = 0
        self.hidden = 0

    def parse_marked_section(self, i, report=1):
        """What HTML does not know, like ``<![if x]>``, is a comment."""
        return self.parse_bogus_comment(i)

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            own = self.stack[self.block_places[-1]][0] if self.block_places else ""
            above = frozenset(self.active) if self.weights is None else self.score
            self.found.append((text, above, own, self.linked))
        self.text, self.linked = [], 0

    def _nearest(self, names) -> int:
        return max((self.places[n][-1] for n in names if self.places[n]), default=-1)

    def _close(self, names: tuple, stops: tuple) -> None:
        at = self._nearest(names)
        if at > self._nearest(stops):
            self.flush()
            self._cut(at)

    def _open(self, tag: str, words: list[str]) -> None:
        own = ["t:" + tag, *("c:" + w for w in words)]
        self.places[tag].append(len(self.stack))
        if tag in BLOCK:
            self.block_places.append(len(self.stack))
        self.stack.append((tag, own))
        self.hidden += tag in HIDDEN
        for feature in own:
            self.active[feature] += 1
            if self.weights is not None and self.active[feature] == 1:
                self.score += self.weights.get(feature, 0.0)

    def _cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag, own = self.stack.pop()
            self.places[tag].pop()
            if tag in BLOCK:
                self.block_places.pop()
            self.hidden -= tag in HIDDEN
            for feature in own:
                self.active[feature] -= 1
                if not self.active[feature]:
                    del self.active[feature]
                    if self.weights is not None:
                        self.score -= self.weights.get(feature, 0.0)
        if not self.stack:
            self.score = 0.0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            self._close(("p",), ("table", "td", "th", "caption", "button", "object"))
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        self._open(
            tag, [w for key, value in attrs if key in ("class", "id", "role") and value for w in NAME.findall(value.lower())]
        )

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        at = self._nearest((tag,))
        # an inline end tag does not reach past its block
        if at >= 0 and (tag in BLOCK or not self.block_places or at > self.block_places[-1]):
            self._cut(at)

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)
            if self.places["a"]:
                self.linked += len(data.strip())


def blocks(html: str, weights: dict[str, float] | None = None) -> list[tuple]:
    parser = Blocks(weights)
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.found


def own_features(block: tuple) -> list[str]:
    """What a block's own element and text say."""
    text, _, own, linked = block
    found = ["own:" + own, f"length:{min(len(text).bit_length(), 12)}", f"links:{min(4, 4 * linked // len(text))}"]
    found.append("sentence" if text[-1] in ".!?…»”\"'" else "no sentence")
    lower = text.lower()
    if any(cue in lower for cue in CUES):  # few blocks have to be cut into words
        found += ["cue:" + w for w in sorted(CUES.intersection(WORD.findall(lower)))]
    if "©" in text:
        found.append("cue:©")
    return found


def features(block: tuple) -> list[str]:
    """All features of a block that was parsed without weights."""
    return sorted(block[1].union(own_features(block)))


class Chain:
    """Weights of the two labels by feature, and of label changes."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray, bias: float):
        self.weights, self.moves, self.bias = weights, moves.tolist(), bias

    def worth(self, own: Iterable[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in own)

    def labels(self, page: list[list[str]]) -> list[bool]:
        """Which blocks, given by their features, are content."""
        return self.decode([self.bias + self.worth(own) for own in page])

    def decode(self, scores: list[float]) -> list[bool]:
        """Viterbi.  A block's score is that of content against the rest."""
        if not scores:
            return []
        (stay_out, go_in), (go_out, stay_in) = self.moves
        out, inside, back = 0.0, 0.0, []
        for i, score in enumerate(scores):
            if i:
                from_out, from_in = (out + stay_out, inside + go_out), (out + go_in, inside + stay_in)
                back.append((from_out[1] > from_out[0], from_in[1] > from_in[0]))
                out, inside = max(from_out), max(from_in) + score
            else:
                inside = score
        label, found = inside > out, []
        for came in reversed(back):
            found.append(label)
            label = came[label]
        return [*found, label][::-1]

    def text(self, html: str | None) -> str:
        found = blocks(html or "", self.weights)
        keep = self.decode([self.bias + b[1] + self.worth(own_features(b)) for b in found])
        return "\n".join(b[0] for b, k in zip(found, keep) if k)


def fit_chain(pages: list[tuple[list[list[str]], list[bool]]], rounds: int = ROUNDS, ridge: float = 1e-3) -> Chain:
    """Maximum likelihood by AdaGrad over pages, with forward and backward sums."""
    names = {f: i for i, f in enumerate(sorted({f for page, _ in pages for own in page for f in own}))}
    w, moves, bias = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(1)
    gw, gm, gb = np.full(len(names), 1e-2), np.full((2, 2), 1e-2), np.full(1, 1e-2)
    coded = [([np.array([names[f] for f in own]) for own in page], np.array(y, int)) for page, y in pages if page]
    for _ in range(rounds):
        for page, y in coded:
            n = len(page)
            score = np.zeros((n, 2))
            score[:, 1] = [bias[0] + w[own].sum() for own in page]
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = score[0]
            for i in range(1, n):
                ahead[i] = score[i] + np.logaddexp(ahead[i - 1, 0] + moves[0], ahead[i - 1, 1] + moves[1])
            for i in range(n - 2, -1, -1):
                reach = moves + (score[i + 1] + behind[i + 1])[None, :]
                behind[i] = np.logaddexp(reach[:, 0], reach[:, 1])
            total = np.logaddexp(*ahead[-1])
            slope = np.exp(ahead[:, 1] + behind[:, 1] - total) - y  # expected less observed
            step_m = np.zeros((2, 2))
            for i in range(1, n):
                step_m += np.exp(ahead[i - 1][:, None] + moves + (score[i] + behind[i])[None, :] - total)
                step_m[y[i - 1], y[i]] -= 1
            step_w = np.zeros(len(names))
            for own, s in zip(page, slope):
                step_w[own] += s
            touched = np.unique(np.concatenate(page))
            step_w[touched] += ridge * w[touched]
            for value, memory, step in ((w, gw, step_w), (moves, gm, step_m), (bias, gb, np.array([slope.sum()]))):
                memory += step * step
                value -= 0.5 * step / np.sqrt(memory)
    return Chain(dict(zip(names, w.tolist())), moves, float(bias[0]))


# Page skeletons, one block a line after the opening tags: "+" marks content.  P is a
# paragraph, T a title, W a few words.
LAYOUTS = (
    """<body><header class="site-header">|- T|
    <ul class="menu"><li><a href=x>|- W|</a></li><li><a href=x>|- W|</a></li></ul></header>
    <div id="content" class="post-content"><h1>|+ T|</h1><p>|+ P|</p><h2>|+ T|</h2><p>|+ P|</p>
    <div class="ad banner">|- W|</div><p>|+ P|</p></div><aside class="sidebar"><h3>|- T|</h3><p>|- P|</p></aside>
    <div id="comments" class="comments"><h3>|- T|</h3><div class="comment"><p>|- P|</p></div>
    <div class="comment"><p>|- P|</p></div></div><footer>|- Copyright W|</footer></body>""",
    """<body><div class="cookie notice"><p>|- cookies P|</p><button>|- W|</button></div><nav><a href=x>|- W|</a></nav>
    <main><article><header><h1>|+ T|</h1></header><p>|+ P|</p><aside class="related"><a href=x>|- T|</a></aside>
    <blockquote><p>|+ P|</p></blockquote><ul><li>|+ W|</li><li>|+ W|</li></ul><div class="ad">|- P|</div><p>|+ P|</p>
    <section class="comments"><h2>|- T|</h2><p>|- P|</p><form class="reply"><label>|- W|</label></form></section>
    </article></main><footer><p>|- P|</p></footer></body>""",
    """<body><table><tr><td class="menu"><a href=x>|- W|</a><br><a href=x>|- W|</a></td><td class="text"><h2>|+ T|</h2>
    <p>|+ P|</p><p>|+ P|</p><pre>|+ W|</pre></td></tr></table><div class="footer">|- © W|</div></body>""",
    """<body><div role="navigation"><a href=x>|- W|</a></div><div class="entry main"><h1>|+ T|</h1><p>|+ P|</p><p>|+ W|</p>
    <div class="share social"><a href=x>|- share W|</a></div><form class="newsletter subscribe"><p>|- subscribe P|</p>
    <button>|- W|</button></form><p>|+ P|</p></div><div class="sidebar widget"><ul><li><a href=x>|- T|</a></li></ul>
    <p>|- P|</p></div><div role="contentinfo">|- privacy terms W|</div></body>""",
    """<head><title>|- T|</title></head><body><nav><ul><li><a href=x>|- W|</a></li></ul></nav><div class="ad">|- P|</div>
    <article><h1>|+ T|</h1><p>|+ P|</p><figure><figcaption>|+ T|</figcaption></figure><nav class="toc"><a href=x>|- W|</a></nav>
    <p>|+ P|</p><p>|+ W|</p><form><p>|- P|</p></form><div class="comments"><p>|- P|</p><p>|- P|</p></div></article>
    <footer>|- © P|</footer></body>""",
    """<body><div class="header"><p>|- T|</p></div><div class="article body"><p>|+ P|</p><p>|+ P|</p><p>|+ P|</p></div>
    <div class="notice banner alert"><p>|- P|</p></div><section id="comments"><article class="comment"><p>|- P|</p>
    </article><article class="comment"><p>|- P|</p></article></section><div class="footer"><p>|- P|</p></div></body>""",
)


def filled(layout: str, paragraphs: list[str]) -> tuple[str, list[bool]]:
    """A layout with its slots filled, and the label of each block."""
    html, labels, at = [], [], 0
    for piece in layout.split("|"):
        if piece[:2] in ("+ ", "- "):
            text = paragraphs[at % len(paragraphs)]
            at += 1
            few = " ".join(text.split()[: 3 + at % 4])
            piece, content = piece[2:], piece[0] == "+"
            slot = {"P": text, "T": few + " " + few, "W": few}[piece.split()[-1]]
            piece = " ".join([*piece.split()[:-1], slot.replace("&", "&amp;").replace("<", "&lt;")])
            labels.append(content)
        html.append(piece)
    return "".join(html), labels


def says(block: tuple) -> bool:
    """Whether the markup itself makes a block part of the article."""
    return "t:article" in block[1] and not {"t:nav", "t:aside", "t:footer", "t:form"} & block[1]


PLAIN = ["One plain sentence that stands for the text of a page.", "Another one, a little longer than the first, follows it here."]


def fit(pages: list[str]) -> Chain:
    labelled, paragraphs = [], PLAIN
    for i, html in enumerate([*pages, *["" for _ in range(max(0, 2 * len(LAYOUTS) - len(pages)))]]):
        found = blocks(html)
        content = [says(b) for b in found]
        if any(content):
            labelled.append(([features(b) for b in found], content))
            paragraphs = [b[0] for b, c in zip(found, content) if c][-12:]
        html, content = filled(LAYOUTS[i % len(LAYOUTS)], paragraphs)
        found = blocks(html)
        if len(found) == len(content):
            labelled.append(([features(b) for b in found], content))
    return fit_chain(labelled)


def extract(frame: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` per row."""
    spark = small_batches(frame.sparkSession)
    short = frame.where((F.length(html) <= LONGEST) & (F.length(html) > 0))
    offered = short.select(key, url, F.col(html).alias("html"))
    sample = hashed_sample(offered, F.xxhash64(url, key), frame.count(), SAMPLE)
    shared = spark.sparkContext.broadcast(fit([r.html for r in sample.collect()]))  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [key, url, "text", "n_chars"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(key, url).schema)
    return frame.select(key, url, html).mapInArrow(run, f"{fields}, text string, n_chars long")
