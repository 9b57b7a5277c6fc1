"""Quality rules and HTML extraction."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from reviewtide.llm import html_extract as hx
from reviewtide.llm import quality

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_statistics(frame, docs):
    judged = quality.judge(frame(docs)).select("doc_id", *BASE, "base_failed").collect()
    texts = dict(docs)
    assert len(judged) == len(docs)
    for row in judged:
        expected = brute.base_statistics(texts[row["doc_id"]])
        assert tuple(row)[1:6] == expected
        assert row["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])


def test_windows_that_share_a_hash_only(spark, monkeypatch):
    """Texts decide, not hashes: with a constant hash the count stays right."""
    text = "a b c d e f a b c d e g h"
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    df = spark.createDataFrame([(text,)], "t string")
    counted = df.select(quality.repeated_words(F.split("t", " ")).alias("n")).first()["n"]
    assert counted == brute.base_statistics(text)[4] == 10


@pytest.mark.parametrize(
    "line, fails",
    [
        ("A plain sentence, with its full stop.", False),
        ("a line of prose that ends without any mark at all", False),
        ("Really?! That is what they said!", False),
        ("Home | News | Sport | About", True),
        ("one | two", False),
        ("A*** line&&& full### of$$$ marks%%%", True),
        ("LOUD!! WORDS!! ALL!! OVER!!", True),
        ("Please enable JavaScript to view this page.", True),
        ("Licensed under the Apache License, Version 2.0.", False),
        ("", False),
        ("costs 5 % & more, see #3", False),
    ],
)
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "t string")
    assert df.select(quality.line_fails(F.col("t"), quality.Rules()).alias("f")).first()["f"] is fails


def test_lost_text_rejects(frame):
    prose = "This is a sentence of prose that has a good many more words than ten of them."
    menu = "Home | News | Sport | About"
    docs = frame([(1, prose), (2, f"{prose}\n{menu}"), (3, f"{prose}\n" + f"{menu}\n" * 5), (4, None)])
    kept = {r["doc_id"]: r for r in quality.clean(docs).collect()}
    assert set(kept) == {1, 2}
    assert kept[2]["text"] == prose and kept[2]["n_chars"] == len(prose)
    assert kept[1]["text"] == prose
    assert sorted(quality.clean(docs).columns) == sorted(docs.columns)


def test_quality_of_no_rows(empty):
    assert quality.judge(empty).count() == 0 and quality.clean(empty).columns == empty.columns


PARAGRAPHS = [f"Sentence {k} tells of things, and of more things. It ends here." for k in range(40)]


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def plain_pages() -> list[str]:
    rng = random.Random(4)
    pages = []
    for k in range(60):
        texts = "".join(f"<p>{p}</p>" for p in rng.sample(PARAGRAPHS, rng.randint(1, 6)))
        pages.append(
            page(
                f"<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
                f'<div class="ad">{rng.choice(PARAGRAPHS)}</div><article><h1>Title {k}</h1>{texts}</article>'
                f"<footer>&copy; site {k}. {rng.choice(PARAGRAPHS)}</footer>"
            )
        )
    return pages


@pytest.fixture(scope="module")
def model():
    return hx.train(hx._labelled(plain_pages(), 300, 1))


def test_sum_product_equals_enumeration():
    """Marginals, edge marginals and the partition sum of a small tree, by listing all labellings."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    parents = np.array([-1, 0, 0, 1, 1, 2])
    unary, pair = rng.normal(size=6), rng.normal(size=(2, 2))
    weight, p, edges = 0.0, np.zeros(6), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(unary[k] * y[k] for k in range(6)) + sum(pair[y[parents[k]], y[k]] for k in range(1, 6)))
        weight += w
        p += w * np.array(y)
        for k in range(1, 6):
            edges[y[parents[k]], y[k]] += w
    got = hx.marginals(unary, pair, parents)
    assert np.allclose(got[0], p / weight) and np.allclose(got[1], edges / weight)
    assert np.isclose(got[2], np.log(weight))


def test_held_out_layouts(model):
    """Blocks of pages laid out with another seed, judged rightly."""
    rng, right, blocks = random.Random(2024), 0, 0
    for _ in range(200):
        read = hx.read(hx.laid_out(rng, PARAGRAPHS))
        y, p = hx.known_labels(read), model.content(read)
        right += sum(bool(y[at]) == bool(p[at] > 0.5) for at, _ in read.blocks)
        blocks += len(read.blocks)
    assert right / blocks > 0.98


def test_text_of_a_page(model):
    html = page(
        '<header class="site-header">My site</header><nav><ul><li><a href=/>Home</a></li></ul></nav>'
        "<!-- a comment --><article><h1>On  caf&eacute;s &amp; tea</h1><p>First\n  part, <b>bold</b>.<br>"
        f"Goes on.<p>{PARAGRAPHS[3]}<script>var a = '</p>';</script></article>"
        '<section id="comments"><div class="comment"><p>I agree with this.</p></div></section>'
        "<form><input><label>Mail</label><textarea>x</textarea></form><footer>&copy; 2024</footer>"
    )
    assert model.text(html) == f"On cafés & tea\n\nFirst part, bold. Goes on.\n\n{PARAGRAPHS[3]}"


ARTICLE = f"<article><h1>On tea</h1><p>{PARAGRAPHS[3]}</p></article>"


@pytest.mark.parametrize(
    "before",
    [
        "<html><head><title>T</title><style>p{}</style></head><body>",
        "<html><head><title>T</title><meta charset=utf-8><script>var a;</script>\n<body>",
        "<html><head><title>T</title><link href=a>",
        "<html><head><noscript><link href=a></noscript><base href=b>\n",
        "<html><head><head><title>T</title></head><body>",
        "<html><head><noscript><img src=a><body>",
        "<head><title>T</title><body>",
        "<head>",
        "<html><title>T</title><body>",
        "<html><body>",
        "<title>T</title>",
        "<!DOCTYPE html>\n<meta charset=utf-8>",
        "",
    ],
)
def test_pages_that_leave_tags_out(model, before):
    """The ends of a head, heads and bodies are optional; the text is there nonetheless."""
    text = f"On tea\n\n{PARAGRAPHS[3]}"
    assert model.text(before + ARTICLE + "</body></html>") == text
    assert model.text(before + ARTICLE) == text


def test_inline_elements_that_stay_open(model):
    """However many there are, a paragraph ends where the next block starts."""
    html = page(f"<article><p>{PARAGRAPHS[1]}" + "<b><i>" * 20 + f"<p>{PARAGRAPHS[2]}<ul><li>one<b>" + "<span>" * 30
                + "<li>two</ul></article>")
    assert [text for _, text in hx.read(html).blocks] == [PARAGRAPHS[1], PARAGRAPHS[2], "one", "two"]


def test_hidden_elements(model):
    shown = f"<article><h1>On tea</h1><p>{PARAGRAPHS[3]}</p>{{}}</article>"
    for hidden in ('<p hidden>Not shown.</p>', '<div style="color:red; Display : none"><p>Not<p>shown.</div>',
                   "<p><span hidden>Not shown.</span></p>"):
        assert model.text(page(shown.format(hidden))) == f"On tea\n\n{PARAGRAPHS[3]}"


def div_page(k: int, names: tuple[str, str, str]) -> tuple[str, str]:
    """A page without <article>, written by hand, and its text."""
    menu, main, foot = names
    paragraphs = [PARAGRAPHS[(k + i) % 40] for i in range(1 + k % 4)]
    html = page(
        f'<div class="{menu}"><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></div>'
        f'<div class="{main}"><h1>Title number {k}</h1>{"".join(f"<p>{p}</p>" for p in paragraphs)}</div>'
        f'<div class="comments"><p>Nice one, thanks.</p></div><div class="{foot}">&copy; site {k}</div>'
    )
    return html, "\n\n".join([f"Title number {k}", *paragraphs])


@pytest.mark.parametrize("names", [("menu", "content", "footer"), ("navbar", "entry-text", "legal")])
def test_tables_without_article(spark, names):
    """A model comes about, and the text of layouts of div alone is found."""
    pages = [div_page(k, names) for k in range(30)]
    df = spark.createDataFrame([(k, html) for k, (html, _) in enumerate(pages)], "page_id int, html string")
    found = {r["page_id"]: r["text"] for r in hx.extract(df, hx.trained(df)).collect()}
    right = sum(found[k] == text for k, (_, text) in enumerate(pages))
    assert right >= 27 and all(found.values())


def test_a_table_of_bare_pages(spark):
    """Nothing to learn from: the model is that of invented pages."""
    df = spark.createDataFrame([(1, "<p>Short.</p>"), (2, None), (3, ARTICLE * 2)], "page_id int, html string")
    found = {r["page_id"]: r["text"] for r in hx.extract(df, hx.trained(df)).collect()}
    assert found[3].count(PARAGRAPHS[3]) == 2 and found[2] == ""


def test_text_ends_a_head():
    read = hx.read(f"<html><head><title>T</title> \n{PARAGRAPHS[3]}<p>{PARAGRAPHS[4]}")
    assert [text for _, text in read.blocks] == [PARAGRAPHS[3], PARAGRAPHS[4]]
    read = hx.read(f"<html><head><title>T</title><img src=a>{PARAGRAPHS[3]}")
    assert [text for _, text in read.blocks] == [PARAGRAPHS[3]]


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<!--", "<script>", "</div></p>", "&", "<html>" * 3])
def test_odd_pages(model, html):
    assert isinstance(model.text(html), str)


def test_deep_and_long_pages(model):
    deep = page("<article>" + "<div>" * 3000 + f"<p>{PARAGRAPHS[0]}</p>" + "</div>" * 3000 + "</article>")
    assert PARAGRAPHS[0] in model.text(deep)
    long = page("<article>" + f"<p>{PARAGRAPHS[1]}</p>" * 5000 + "</article>")
    assert model.text(long).count(PARAGRAPHS[1]) == 5000


def test_extract(spark, model):
    pages = [(k, f"u{k}", html, "clash") for k, html in enumerate(plain_pages()[:5])]
    pages += [(None, None, None, None), (7, "u", "", "x"), (1, "u1", pages[1][2], "clash")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    found = hx.extract(df, hx.trained(df, laid=100))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == 8
    for r in rows:
        assert r["n_chars"] == len(r["text"])
    assert {r["text"] for r in rows if r["page_id"] in (None, 7)} == {""}
    for r in rows:
        if r["page_id"] in range(5):
            assert r["text"].startswith(f"Title {r['page_id']}\n\nSentence")
    assert hx.extract(df.limit(0), model).count() == 0
    assert hx.trained(df.limit(0)).text("<p>x</p>") in ("", "x")
