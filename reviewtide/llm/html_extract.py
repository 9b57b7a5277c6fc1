"""Main text of web pages by a tree-structured graphical model.

A page's block elements are the variables of a model with the page's tree as its graph:
each is content or not. An element's features (its tag, what its names say, length, links
and punctuation of its text) give its own potential, a parent and a child share a pairwise
one. Messages upward and downward the tree (sum-product) give every element's marginal,
and the text of the elements that are more likely content than not is the page's text.

The potentials are trained here, by the likelihood of labelled pages: a sample of the
given pages (``SAMPLE_PAGES`` of them, however many there are) whose own markup names one
article, and pages laid out from the text of that sample, with menus, sidebars, notices,
adverts, forms and comments around it, the marks of which vary. If no page of the sample
names one article, the laid-out pages take the longer texts of all blocks, whatever these
are, and without any they take invented ones; so there is always a model. Extraction is a projection
over the pages with the weights, a few kilobytes, sent along; nothing is shuffled.

Null and empty pages have an empty text. Repeated rows are extracted each by itself, other
columns pass through, and columns named like the added ones are replaced.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.bpe import slices
from reviewtide.llm.dom import Node, blocks, parse

SAMPLE_PAGES = 200
LAID_OUT = 400
LONG_TEXT = 8
EPOCHS = 60
SEED = 7

# Words in names of elements, by what they say about them.
NAMED = {
    "menu": "nav navbar menu breadcrumb breadcrumbs toc tabs pagination pager skip",
    "header": "header masthead topbar banner branding logo",
    "footer": "footer copyright colophon bottom legal",
    "side": "sidebar side aside rail widget related recommended more popular trending teaser",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promoted outbrain taboola",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe paywall",
    "form": "form search login signup signin contact input",
    "comments": "comment comments commentlist reply replies discussion disqus respond",
    "social": "share social sharing follow",
    "content": "content article post entry story main body text maincontent articlebody",
}
FAMILY = {word: family for family, words in NAMED.items() for word in words.split()}
TAGS = tuple(
    "p div h1 h2 h3 h4 ul ol li dl dt dd blockquote pre table tr td th section article header "
    "footer nav aside main form fieldset figure figcaption address html body details".split()
)
FEATURES = (
    *(f"tag:{t}" for t in TAGS),
    *(f"named:{f}" for f in NAMED),
    *(f"inside:{f}" for f in NAMED),
    "tag:other", "inside:article", "inside:chrome", "long", "short", "empty", "linked", "sentences",
    "inputs", "sign", "share", "bias",
)
INDEX = {name: k for k, name in enumerate(FEATURES)}
CHROME = frozenset("nav aside footer form header dialog menu".split())
_NAME = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…。][\"'”’)]?(\s|$)")


@dataclass
class Page:
    nodes: list[Node]
    blocks: list[tuple[int, str]]
    features: np.ndarray  # a row for each node
    parents: np.ndarray


def read(html: str) -> Page:
    nodes = parse(html)
    texts = blocks(nodes)
    n = len(nodes)
    own = [""] * n
    for at, text in texts:
        own[at] = f"{own[at]} {text}" if own[at] else text
    below = np.array([node.own for node in nodes], float)
    links = np.array([node.own_links for node in nodes], float)
    sentences = np.array([len(_SENTENCE.findall(text)) for text in own], float)
    for k in range(n - 1, 0, -1):
        parent = nodes[k].parent
        below[parent] += below[k]
        links[parent] += links[k]
        sentences[parent] += sentences[k]
    x = np.zeros((n, len(FEATURES)))
    inside: list[frozenset] = [frozenset()] * n
    for k, node in enumerate(nodes):
        row = x[k]
        row[INDEX.get(f"tag:{node.tag}", INDEX["tag:other"])] = 1
        named = {FAMILY[w] for w in _NAME.findall(node.names) if w in FAMILY}
        above = inside[node.parent] if k else frozenset()
        for family in named:
            row[INDEX[f"named:{family}"]] = 1
        for family in above:
            row[INDEX[f"inside:{family}"]] = 1
        marks = named | ({"chrome"} if node.tag in CHROME else set())
        inside[k] = above | marks | ({"article"} if node.tag in ("article", "main") else set())
        row[INDEX["inside:article"]] = "article" in inside[k]
        row[INDEX["inside:chrome"]] = "chrome" in inside[k]
        row[INDEX["long"]] = log1p(below[k]) / 5
        row[INDEX["short"]] = 0 < below[k] < 30
        row[INDEX["empty"]] = below[k] == 0
        row[INDEX["linked"]] = links[k] / below[k] if below[k] else 0
        row[INDEX["sentences"]] = log1p(sentences[k])
        row[INDEX["inputs"]] = min(node.inputs, 2)
        row[INDEX["sign"]] = "©" in own[k]
        row[INDEX["share"]] = below[k] / below[0] if below[0] else 0
        row[INDEX["bias"]] = 1
    return Page(nodes, texts, x, np.array([node.parent for node in nodes]))


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + log1p(np.exp(low - high))


def marginals(unary: np.ndarray, pair: np.ndarray, parents: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sum-product on the tree: P(content) of each node, P(parent's, own label) summed over
    all edges, and the log of the partition sum. ``unary``: the log potential of content."""
    n = len(unary)
    up = [[0.0, u] for u in unary.tolist()]  # own potential and all messages from below
    message = [[0.0, 0.0]] * n
    w = pair.tolist()
    above = parents.tolist()
    for k in range(n - 1, 0, -1):
        u = up[k]
        m = [_log_sum(w[y][0] + u[0], w[y][1] + u[1]) for y in (0, 1)]
        message[k] = m
        parent = up[above[k]]
        parent[0] += m[0]
        parent[1] += m[1]
    total = _log_sum(*up[0])
    belief = [None] * n
    belief[0] = up[0]
    edges = np.zeros((2, 2))
    for k in range(1, n):
        b, m, u = belief[above[k]], message[k], up[k]
        rest = [b[0] - m[0], b[1] - m[1]]  # what the parent knows from elsewhere
        joint = [[rest[y] + w[y][z] + u[z] - total for z in (0, 1)] for y in (0, 1)]
        edges += np.exp(joint)
        belief[k] = [u[z] + _log_sum(rest[0] + w[0][z], rest[1] + w[1][z]) for z in (0, 1)]
    p = np.array(belief)
    return 1 / (1 + np.exp(np.clip(p[:, 0] - p[:, 1], -60, 60))), edges, total


@dataclass
class Model:
    weights: np.ndarray
    pair: np.ndarray  # [label of the parent, label of the child]

    def content(self, page: Page) -> np.ndarray:
        return marginals(page.features @ self.weights, self.pair, page.parents)[0]

    def text(self, html: str | None) -> str:
        if not html:
            return ""
        page = read(html)
        p = self.content(page)
        return "\n\n".join(text for at, text in page.blocks if p[at] > 0.5)


def train(labelled: list[tuple[Page, np.ndarray]], epochs: int = EPOCHS) -> Model:
    """The potentials of largest likelihood, by gradient steps of adapted length."""
    model = Model(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    theta = np.zeros(len(FEATURES) + 4)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    observed = np.zeros_like(theta)
    n = sum(len(y) for _, y in labelled) or 1
    for page, y in labelled:
        observed[:-4] += y @ page.features
        np.add.at(observed[-4:], 2 * y[page.parents[1:]] + y[1:], 1)
    for step in range(1, epochs + 1):
        expected = np.zeros_like(theta)
        for page, _ in labelled:
            p, edges, _ = marginals(page.features @ model.weights, model.pair, page.parents)
            expected[:-4] += p @ page.features
            expected[-4:] += edges.ravel()
        slope = (observed - expected) / n - 1e-4 * theta
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        theta = theta + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        model = Model(theta[:-4], theta[-4:].reshape(2, 2))
    return model


def marked_labels(page: Page) -> np.ndarray | None:
    """Labels from the page's own markup, if it has one article and that has text."""
    articles = [k for k, node in enumerate(page.nodes) if node.tag == "article"]
    if len(articles) != 1:
        return None
    y = np.zeros(len(page.nodes), int)
    for k, node in enumerate(page.nodes):
        inside = k == articles[0] or (k and y[node.parent])
        y[k] = bool(inside) and node.tag not in CHROME
    return y if any(y[at] for at, _ in page.blocks) else None


def laid_out(rng: random.Random, paragraphs: list[str]) -> str:
    """A page of known labels (attribute data-y) in a layout drawn by ``rng``."""
    few = lambda a, b: [rng.choice(paragraphs) for _ in range(rng.randint(a, b))]
    words = lambda a, b: " ".join(rng.choice(paragraphs).split()[: rng.randint(a, b)])

    def tag(name: str, y: int, inner: str, family: str | None = None, always: bool = False) -> str:
        names = ""
        if family and (always or rng.random() < 0.8):
            style = rng.choice(["{}", "site-{}", "{}-box", "page-{}"])
            names = f' {rng.choice(["class", "id"])}="{style.format(rng.choice(NAMED[family].split()))}"'
        return f'<{name} data-y="{y}"{names}>{inner}</{name}>'

    def menu(family: str, name: str) -> str:
        entries = "".join(tag("li", 0, f'<a href="#">{words(1, 3)}</a>') for _ in range(rng.randint(3, 8)))
        return tag(name, 0, tag("ul", 0, entries), family, name == "div")

    def body() -> list[str]:
        parts = [tag(rng.choice(["h1", "h2"]), 1, words(3, 9))]
        for text in few(1, 8):
            kind = rng.random()
            if kind < 0.75:
                parts.append(tag("p", 1, text))
            elif kind < 0.83:
                parts.append(tag("ul", 1, "".join(tag("li", 1, words(4, 14)) for _ in range(3))))
            elif kind < 0.9:
                parts.append(tag("blockquote", 1, tag("p", 1, text)))
            else:
                parts.append(tag("h2", 1, words(2, 6)))
                parts.append(tag("p", 1, text))
            if rng.random() < 0.1:
                parts.append(tag(rng.choice(["div", "aside"]), 0, tag("p", 0, words(4, 20)), "advert", True))
        return parts

    def comment() -> str:
        return tag("div", 0, tag("p", 0, words(5, 40)), "comments")

    article = "".join(body())
    if rng.random() < 0.3:
        article = tag("header", 0, words(2, 6), "header") + article
    shell = rng.choice(["article", "main", "div", "div", "section"])
    chrome_before = [
        menu("menu", rng.choice(["nav", "div"])),
        tag(rng.choice(["header", "div"]), 0, words(1, 6), "header", True),
        tag("div", 0, tag("p", 0, words(5, 25)), "notice", True),
        tag(rng.choice(["div", "section"]), 0, words(4, 20), "advert", True),
        tag("form", 0, f"<input><label>{words(1, 3)}</label>", "form"),
    ]
    chrome_after = [
        tag(rng.choice(["section", "div"]), 0, "".join(comment() for _ in range(rng.randint(1, 5))), "comments", True),
        tag(rng.choice(["aside", "div"]), 0, "".join(tag("p", 0, words(4, 20)) for _ in range(3)), "side", True),
        menu("side", rng.choice(["aside", "div"])),
        tag(rng.choice(["footer", "div"]), 0, f"&copy; {words(2, 12)}", "footer", True),
        tag("div", 0, tag("p", 0, words(5, 25)), "notice", True),
        tag("div", 0, f'<a href="#">{words(1, 2)}</a> <a href="#">{words(1, 2)}</a>', "social", True),
    ]
    before = rng.sample(chrome_before, rng.randint(1, len(chrome_before)))
    after = rng.sample(chrome_after, rng.randint(1, len(chrome_after)))
    main = tag(shell, 1, article, "content", shell in ("div", "section"))
    whole = "".join([*before, main, *after])
    if rng.random() < 0.4:
        whole = f'<div data-y="1" class="wrapper">{whole}</div>'
    return f'<html data-y="1"><body data-y="1">{whole}</body></html>'


def known_labels(page: Page) -> np.ndarray:
    return np.array([int(node.label or 1) for node in page.nodes])


def _long_texts(pages: list[str]) -> list[str]:
    """The texts of pages' blocks that have as many words as a sentence."""
    texts = (text for html in pages for _, text in read(html).blocks)
    return [text.replace("<", " ") for text in texts if text.count(" ") >= LONG_TEXT]


def _invented(rng: random.Random) -> list[str]:
    letters = "eeeetttaaaooiinnsshhrrddlu"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(5, 18))).capitalize() + "."
    return [" ".join(sentence() for _ in range(rng.randint(1, 5))) for _ in range(50)]


def _labelled(pages: list[str], laid: int, seed: int) -> list[tuple[Page, np.ndarray]]:
    rng, labelled, paragraphs = random.Random(seed), [], []
    for html in pages:
        page = read(html)
        y = marked_labels(page)
        if y is not None:
            y[0] = 1
            labelled.append((page, y))
            paragraphs += [text.replace("<", " ") for at, text in page.blocks if y[at] and " " in text]
    paragraphs = paragraphs or _long_texts(pages) or _invented(rng)
    for _ in range(laid):
        page = read(laid_out(rng, paragraphs))
        labelled.append((page, known_labels(page)))
    return labelled


def trained(pages: DataFrame, sample: int = SAMPLE_PAGES, laid: int = LAID_OUT) -> Model:
    """A model from ``sample`` of the different pages, drawn by hash.

    A range of hashes that about twice as many pages fall into is looked at, so that
    tasks send a few rows to the driver, however many there are.
    """
    with_html = pages.filter("html IS NOT NULL").select("html", F.xxhash64("html").alias("key"))
    share = min(1.0, 2 * sample / max(1, with_html.count()))
    drawn = with_html.filter(F.col("key") <= int(2**63 * (2 * share - 1)) - 1).distinct()
    rows = drawn.orderBy("key", "html").limit(sample).collect()
    return train(_labelled([row["html"] for row in rows], laid, SEED))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``pages`` without ``html``, with text and n_chars (its code points)."""
    names = [c for c in pages.columns if c not in ("text", "n_chars")]
    plain = pages.select(*(F.col(f"`{c}`") for c in names))
    kept = [c for c in names if c != "html"]
    schema = ", ".join(f"`{c}` {k}" for c, k in plain.dtypes if c != "html") + ", `text` string"

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [model.text(html) for html in batch.column("html").to_pylist()]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, "text"])

    return plain.mapInArrow(task, schema).withColumn("n_chars", F.length("text").cast("bigint"))
