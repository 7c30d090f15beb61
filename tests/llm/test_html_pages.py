"""HTML extraction: names that say nothing, names never seen, and pages of any length."""

import time
import zlib

import numpy as np
import pytest

from wayfold.llm import html_main

FIVE = "".join(f"<p>The report of part {i} was published in spring, and gives the figures of the whole year.</p>" for i in range(5))
LINES = "\n".join(f"The report of part {i} was published in spring, and gives the figures of the whole year." for i in range(5))


@pytest.fixture(scope="module")
def pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")


@pytest.fixture(scope="module")
def trees(pages):
    return html_main.fit(pages)


def _text(trees, page):
    nodes = html_main.parsed(page)
    return html_main.main_text(nodes, html_main.decoded(nodes, trees.odds(html_main.measured(nodes, trees.lexicon))))


@pytest.mark.parametrize(
    "page",
    [
        '<body class="no-sidebar"><article>%s</article>',
        '<body class="has-sidebar page"><article>%s</article>',
        '<body><article class="post sharing-enabled">%s</article>',
        '<body><article>%s</article><div class="ft">All rights here. Our house, 2020</div>',
        '<body><article>%s</article><section id="discussion"><div class=c><b>Ann</b><p>Nice text, thanks a lot.</p></div>'
        "<div class=c><b>Bob</b><p>I think so too.</p></div></section>",
    ],
)
def test_names_of_wrappers_footers_and_comments(trees, page):
    assert _text(trees, f"<html>{page % FIVE}</body></html>") == LINES


def test_names_that_were_held_out(pages):
    """Trees that never saw a third of the names, on pages laid out with those, made of other articles."""
    trees = html_main.fit(pages.where("page_id % 4 <> 0"), words=html_main.name_words(0))
    held = html_main.name_words(1)
    assert not set(trees.lexicon) & {x for names in held.values() for x in names}
    right = taken = wanted = 0
    for r in pages.where("page_id % 4 = 0").collect():
        rng = np.random.default_rng(zlib.crc32(r.html.encode()) + 7)
        nodes = html_main.parsed(html_main.laid_out(html_main.article_of(r.html), rng, held))
        label = html_main.labelled(nodes)
        kept = html_main.decoded(nodes, trees.odds(html_main.measured(nodes, trees.lexicon)))
        own = np.array([sum(len(c) for c in n.children if isinstance(c, str)) for n in nodes])
        right, taken, wanted = right + own[label & kept].sum(), taken + own[kept].sum(), wanted + own[label].sum()
    assert right / taken > 0.96 and right / wanted > 0.96


def test_marks_are_no_features(trees):
    page = f'<body><div class="{html_main.OUT} x1">{FIVE}</div></body>'
    nodes, plain = html_main.parsed(page), html_main.parsed(page.replace(html_main.OUT + " ", ""))
    html_main.labelled(nodes)
    assert (html_main.measured(nodes, trees.lexicon) == html_main.measured(plain, trees.lexicon)).all()


@pytest.mark.parametrize(
    "page",
    [
        "<p>x y z</p>" * 100_000, '<a "' * 40_000, '<a b="' * 40_001, "<div>" * 2_000 + "</b>" * 40_000, "<! " * 40_000,
        "<li><div>" * 20_000, "<title>" * 40_000, "<!--" * 40_000, "<div>" * 5_000 + "<p>a" * 40_000,
    ],
    ids=["siblings", "quotes", "values", "stray ends", "declarations", "deep", "raw", "comments", "paragraphs"],
)
def test_time_follows_the_length(trees, page):
    def seconds(text):
        began = time.process_time()
        _text(trees, text)
        return time.process_time() - began

    short = min(seconds(page[: len(page) // 8]) for _ in range(2))
    # Eight times as long: 64 times the time if it were quadratic.
    assert seconds(page) < 30 * short + 1.0


def test_parsing_odd_tags():
    def tags(page):
        return [n.tag for n in html_main.parsed(page)][1:]

    assert tags('<p class="x"">a</p><b>c</b>') == ["p", "b"]
    assert tags("<p title='a>b'>t<br/>u</p>") == ["p", "br"]
    assert tags("<ul><li>a<li>b</ul></p><p>c<div>d</div>") == ["ul", "li", "li", "p", "div"]
    nodes = html_main.parsed("<p>a<p>b<table><tr><td>c<p>d<td>e</table>f")
    assert [nodes[n.parent].tag for n in nodes[1:]] == ["", "", "", "table", "tr", "td", "tr"]
    assert html_main.parsed("a <b and c")[0].children == ["a ", "<b and c"]
