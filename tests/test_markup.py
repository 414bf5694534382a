"""The selector reader against a tree built by the standard library's parser."""

import random
from html.parser import HTMLParser

import pytest

from tallyloom.operators import markup

VOID = {"br", "img", "hr", "input"}


class Tree(HTMLParser):
    """A list of [tag, attributes, parent, text parts]; list items and paragraphs end as browsers end them."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.nodes, self.open = [], []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "li":
            self.implied({"li"}, {"ul", "ol"})
        if tag in ("div", "ul", "ol", "p"):
            self.implied({"p"}, set())
        if tag == "a":
            self.implied({"a"}, set())
        self.nodes.append([tag, {k: v or "" for k, v in reversed(attrs)}, self.open[-1] if self.open else None, []])
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)

    handle_startendtag = handle_starttag

    def implied(self, ended, walls):
        for at in range(len(self.open) - 1, -1, -1):
            tag = self.nodes[self.open[at]][0]
            if tag in ended:
                del self.open[at:]
                return
            if tag in walls:
                return

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[at]][0] == tag:
                del self.open[at:]
                return

    def handle_data(self, data):
        if not any(self.nodes[k][0] == "script" for k in self.open):
            for k in self.open:
                self.nodes[k][3].append(data)

    def above(self, k):
        while (k := self.nodes[k][2]) is not None:
            yield k


def page(rnd, depth=0):
    out = []
    for _ in range(rnd.randint(1, 4)):
        kind = rnd.randint(0, 9)
        inner = page(rnd, depth + 1) if depth < 4 else rnd.choice(["x", "1 > 0", ""])
        cls = rnd.choice(["", ' class="box"', " class='other box'", " class=boxed", ' id="k" class="a  b"'])
        if kind == 0:
            out.append(rnd.choice(["plain ", "<!-- <li><a href='/no'>no</a> -->", "<br>", "<img src='a>b'>", "<hr/>"]))
        elif kind == 1:
            out.append('<script>if (a < b) { "</li><div class=box>" }</script>')
        elif kind <= 4:
            out.append(f"<div{cls}>{inner}" + ("</div>" if rnd.random() < 0.85 else ""))
        elif kind <= 7:
            items = "".join(f"<li{cls}><a HREF='/{rnd.randint(0, 99)}'>t <b>{rnd.randint(0, 9)}</b></a>" + rnd.choice(["", "</li>", inner]) for _ in range(2))
            out.append(f"<ul>{items}</ul>")
        else:
            out.append(f"<p{cls}>{inner}" + rnd.choice(["", "</p>", "</em>"]))
    return "".join(out)


def test_against_a_tree(spark):
    rnd = random.Random(4)
    pages = {i: page(rnd) for i in range(150)}
    has = lambda n, c: c in n[1].get("class", "").split()
    rules = {
        "li a": lambda t, k: t.nodes[k][0] == "a" and any(t.nodes[j][0] == "li" for j in t.above(k)),
        ".box li a[href]": lambda t, k: t.nodes[k][0] == "a" and any(
            t.nodes[j][0] == "li" and any(has(t.nodes[i], "box") for i in t.above(j)) for j in t.above(k)),
        "div > p, #k": lambda t, k: (t.nodes[k][0] == "p" and t.nodes[k][2] is not None and t.nodes[t.nodes[k][2]][0] == "div")
        or t.nodes[k][1].get("id") == "k",
        "div.b.a": lambda t, k: t.nodes[k][0] == "div" and has(t.nodes[k], "a") and has(t.nodes[k], "b"),
        "br": lambda t, k: t.nodes[k][0] == "br",
    }
    want = set()
    for i, html in pages.items():
        tree = Tree(html)
        for name, rule in rules.items():
            picked = [k for k in range(len(tree.nodes)) if rule(tree, k)]
            want |= {(i, name, place, "".join(tree.nodes[k][3]), tree.nodes[k][1].get("href")) for place, k in enumerate(picked)}
    rows = spark.createDataFrame([*pages.items(), (998, None), (999, "")], "id int, html string")
    got = markup.select_elements(rows, "id", "html", {r: r for r in rules}).collect()
    assert {(r["id"], r["selector"], r["place"], r["text"], r["attributes"].get("href")) for r in got} == want
    assert len(want) > 500


@pytest.mark.parametrize(
    "html,found",
    [
        ("<div class='w'><div>1</div><time>t1</time></div><time>t2</time>", ["t1"]),
        ("<div class=w><ul><li>a<li><time>t1<li>b</ul><time>t2", ["t1", "t2"]),
        ("<div class='w x'><br/><img src='>'><!-- <time>no</time> <time>t</time></div>", []),
        ("<div class='w'><time>a &amp; b", ["a &amp; b"]),
        ("<div class='ww'><time>t</time></div></div><time class=w>t</time>", []),
        ("<script>var w = '<div class=w><time>';</script><time>t</time>", []),
        ("< div class='w'><time>t</time>", []),
    ],
)
def test_containers_end_where_they_end(html, found):
    picked = list(markup.read_page(html, {"x": markup.parse_selector(".w time")}))
    assert [text for _, _, _, text in sorted(picked, key=lambda p: p[1])] == found


def test_pairs_by_order(spark):
    html = "<div class='events'><time>1</time><ul><li><a>x</a><li><a>y</a></ul></div>"
    rows = spark.createDataFrame([(1, html), (2, None)], "id int, html string")
    got = markup.paired_elements(rows, "id", "html", {"time": ".events time", "name": ".events li a"})
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, "1", "x"), (1, 1, None, "y")]


def test_bad_selectors_are_refused():
    for bad in ("", "a,", "a:hover", "..x"):
        with pytest.raises(ValueError):
            markup.parse_selector(bad)
