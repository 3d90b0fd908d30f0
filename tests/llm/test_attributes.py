"""Tags whose attributes hold angle brackets, against a parser; pages with odd columns and no pages."""

import random
from html.parser import HTMLParser

from orderflow.llm import html


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.seen = []

    def handle_data(self, data):
        self.seen.append(data)


def test_no_markup_from_any_attribute():
    chance = random.Random(8)
    values = ["1 < 2", "<b>Buy now</b>", "a > b", "x", "", "it's", 'say "hi"', "</p>", "=", "a=b", "é<", "/"]
    for _ in range(2_000):
        page, want = [], []
        for _ in range(chance.randrange(1, 5)):
            attributes = []
            for _ in range(chance.randrange(4)):
                value = chance.choice(values)
                quote = "'" if '"' in value else '"'
                bare = value.isalnum() and chance.random() < 0.3
                space = chance.choice(["", " "])
                attributes.append(f"data-{chance.choice('xyz')}{space}={space}{value if bare else quote + value + quote}")
            if chance.random() < 0.3:
                attributes.append("hidden")
            tag = chance.choice(["p", "div", "a"])
            text = chance.choice(["text", "two words", "q\"uote", "it's"])
            page.append(f"<{' '.join([tag, *attributes])}{chance.choice(['', ' ', ' /'])}>{text}</{tag}>")
            want.append(text)
        joined = "".join(page)
        parser = _Text()
        parser.feed(joined)
        parser.close()
        assert parser.seen == want
        found, at = [], 0
        for m in html._TOKEN.finditer(joined):
            found += [joined[at : m.start()]] if at < m.start() else []
            at = m.end()
        assert found == want and at == len(joined)


def test_an_unclosed_quote_ends_with_its_tag():
    page = '<a title="foo>text</a> <b class="x">more</b>'
    assert "".join(html._TOKEN.sub("", page)) == "text more"


def test_odd_pages(spark):
    body = "<p data-x=\"1 < 2\" class=\"z\">" + "A sentence of the article, long enough to count. " * 6 + "</p>"
    page = f"<html><body><div class='menu'><a href='/'>Home</a></div><article>{body}{body}</article></body></html>"
    layout = "page_id long, url string, html string, text string, path string"
    rows = [(1, None, page, "t", "p"), (2, "http://a.b/c", None, "t", "p"), (None, "http://a.b/d", page, "t", "p"), (4, "http://a.b/e", "<p>" + "word " * 200_000, "t", "p")]
    found = html.extract(spark.createDataFrame(rows, layout)).collect()
    assert len(found) == 4 and all("data-x" not in r.text and "<" not in r.text for r in found)
    assert sum("sentence of the article" in r.text for r in found) == 2
    assert html.extract(spark.createDataFrame([], layout)).count() == 0
