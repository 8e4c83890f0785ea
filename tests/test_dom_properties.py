"""Random (often broken) HTML: the element table is always a well-formed tree
and the page text equals an independent extraction."""

import random
from html.parser import HTMLParser

from leadforge.operators.dom import NON_TEXT_TAGS, VOID_TAGS, parse_html

TAGS = ["div", "p", "a", "span", "b", "li", "ul", "br", "img", "script", "style", "template", "rt", "nav"]


def _random_html(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(1, 40)):
        r = rng.random()
        t = rng.choice(TAGS)
        if r < 0.35:
            out.append(f"<{t} class='c{rng.randint(0, 3)}' data-x>")
        elif r < 0.55:
            out.append(f"</{t}>")
        elif r < 0.6:
            out.append("<!-- note -->")
        else:
            out.append(rng.choice(["x", " y ", "&amp;", "\n", "z&eacute;", "  "]))
    return "".join(out)


class _PlainText(HTMLParser):
    """Independent text extraction with the same end-tag rule."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out, self.node = [], [], []

    def flush(self):
        # a text node of blanks alone is one line feed or one space
        data, self.node = "".join(self.node), []
        if data and not data.strip(" \n\t\f\r"):
            data = "\n" if "\n" in data else " "
        if not any(t in NON_TEXT_TAGS for t in self.open):
            self.out.append(data)

    def handle_comment(self, data):
        self.flush()

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag not in VOID_TAGS:
            self.open.append(tag)

    def handle_endtag(self, tag):
        self.flush()
        if tag in self.open:
            i = len(self.open) - 1 - self.open[::-1].index(tag)
            del self.open[i:]

    def handle_data(self, data):
        self.node.append(data)


def test_random_documents_form_a_tree():
    rng = random.Random(7)
    for _ in range(2000):
        html = _random_html(rng)
        text, stext, elems = parse_html(html)
        ref = _PlainText()
        ref.feed(html)
        ref.close()
        ref.flush()
        assert text == "".join(ref.out), html
        by_id = {e["id"]: e for e in elems}
        for e in elems:
            assert e["id"] <= e["end"] <= len(elems)
            assert e["tf"] <= e["tt"] and e["sf"] <= e["st"]
            p = by_id.get(e["parent"])
            if p is not None:
                assert p["id"] < e["id"] <= p["end"] and e["end"] <= p["end"]
                assert p["tf"] <= e["tf"] and e["tt"] <= p["tt"]
            if e["prev"]:
                s = by_id[e["prev"]]
                assert s["parent"] == e["parent"] and s["end"] < e["id"]
            spans = [x["id"] for x in elems if x["parent"] == e["parent"] and x["id"] > e["id"] and x["tag"] == "span"]
            assert e["nspan"] == (spans[0] if spans else 0)
            assert text.encode()[e["tf"]:e["tt"]].decode() in text
            if e["tag"] in VOID_TAGS:
                assert e["end"] == e["id"]
