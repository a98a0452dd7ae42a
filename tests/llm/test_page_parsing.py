"""Reading of html against the standard library's parser, on broken pages, and in linear time."""

import random
import time
from html.parser import HTMLParser

import pytest

from lakeops.llm.pages import BLOCKS, DROPPED, MAIN, OPEN, OUTSIDE, parse


def text_of(page):
    blocks, zones, _ = parse(page)
    return " ".join(b for b, z in zip(blocks, zones) if z != OUTSIDE)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p data-x=don't>Hello there it's fine</p><p>it's more</p></article>", "Hello there it's fine it's more"),
        ('<p title="a"">Hello</p>', "Hello"),
        ("<p title='a'' class=x>Hello</p>", "Hello"),
        ('<a title="q>r">s</a> t', "s t"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ('one <a href="y', 'one <a href="y'),
        ('<p class="x"id="y">yes</p><div hidden>no</div><div hidden="">no</div>', "yes"),
        ("<p>1<br>2</p><script>if (a<b) {}</script>3<title>no", "1 2 3"),
        ("<p a=\"b>one</p><p>two</p>", "one two"),
        ("<!-- <p>no</p> --><![CDATA[no]]><!doctype html><?x no?>yes</ no>", "yes"),
        ("<article><p>one</p>" + "".join(f'<div class="{c}">no</div>' for c in ("share-buttons", "cookie-notice", "related", "sidebar", "sponsored"))
         + '<div class="section-header">two</div><a href="/hidden-gems" title="the hidden cost">three</a></article><div>menu</div>', "one two three"),
        ("<div class=content>" + "<p>a long body of text</p>" * 3 + "</div><article class=card>A</article><article class=card>B</article>",
         "a long body of text " * 2 + "a long body of text"),
        ("<div>" + "<p>a long body of text</p>" * 3 + "</div><article>first</article><article>second</article>",
         "a long body of text " * 2 + "a long body of text"),
        ("<article>the long article text</article><div>menu</div><article class=card>B</article>", "the long article text"),
        ("<article class=card>a page of cards alone</article><div>x</div>", "a page of cards alone"),
        ("<article>part one of it</article><article>part two of it</article><div>menu</div>", "part one of it part two of it"),
    ],
)
def test_pages_that_were_read_wrongly(page, text):
    assert text_of(page) == text


class Plain(HTMLParser):
    """Text by blocks, without dropped elements, of pages whose tags are all closed in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.held, self.dropped = [], "", 0

    def cut(self):
        if text := " ".join(self.held.split()):
            self.blocks.append(text)
        self.held = ""

    def handle_starttag(self, tag, attributes):
        if tag in BLOCKS or tag in DROPPED:
            self.cut()
        self.dropped += tag in DROPPED

    def handle_endtag(self, tag):
        if tag in BLOCKS or tag in DROPPED:
            if self.dropped:
                self.held = ""
            self.cut()
        self.dropped -= tag in DROPPED

    def handle_data(self, data):
        self.held = "" if self.dropped else self.held + data


def random_page(draw, depth=0):
    out = []
    for _ in range(draw.randrange(1, 6)):
        kind = draw.randrange(8)
        if kind < 3 or depth > 4:
            out.append(draw.choice(["some words ", "&amp; ", "it's ", "&lt;b&gt; ", "a\n b ", "\"quoted\" ", "é &eacute; ", "x"]))
        elif kind == 3:
            out.append(draw.choice(["<!-- a <p> ' \" -->", "<br>", "<hr/>", "<img alt='>' src=x>"]))
        elif kind == 4:
            out.append(f"<script>var a = '<p>no</p>' + \"{draw.randrange(9)}\" < 3;</script>")
        else:
            name = draw.choice("div p section b i span a nav footer aside h1 blockquote".split())
            attributes = draw.choice(["", " title=\"it's > that\"", " data-a='\"'", " lang=en data-x=1", " title=don't"])
            out.append(f"<{name}{attributes}>{random_page(draw, depth + 1 if name != 'p' else 9)}</{name}>")
    return "".join(out)


def test_random_pages_equal_a_plain_reader():
    draw = random.Random(3)
    for _ in range(1500):
        page = random_page(draw)
        plain = Plain()
        plain.feed(page)
        plain.close()
        plain.cut()
        assert text_of(page) == " ".join(plain.blocks), page


def test_broken_pages_do_not_stop_the_reader():
    draw = random.Random(4)
    parts = ["<", ">", "</", "p", "article", " class=", "'", '"', "card", "=", "/", "<!--", "-->", "<script", "text ", "&", "&amp;", "\n", "<li>", "😀"]
    for _ in range(3000):
        blocks, zones, stream = parse("".join(draw.choice(parts) for _ in range(draw.randrange(0, 40))))
        assert len(blocks) == len(zones) and set(zones) <= {MAIN, OPEN, OUTSIDE}
        assert all(b and b == " ".join(b.split()) for b in blocks)


BAD = ['<a "x ', '<a ="x ', "</i>", "<div></i>", "<a x='y ", "<!-- ", "<", "<p", "<script>", '<a b="c>', "</p", "<![CDATA[", "<li>", "<a b='>\"", "<b>"]


@pytest.mark.parametrize("bad", BAD)
def test_bad_pages_take_linear_time(bad):
    took = []
    for size in (1 << 17, 1 << 20):
        begin = time.process_time()
        parse(bad * (size // len(bad)))
        took.append(time.process_time() - begin)
    assert took[1] < 24 * took[0] + 0.5 and took[1] < 10
