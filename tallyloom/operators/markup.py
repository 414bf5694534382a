"""Elements of web pages by selector.

A page is read once, tag by tag, with a stack of the open elements, so nested
containers end where they end, whatever stands inside them. Pages are spread
over the tasks and pass in Arrow batches; a page's elements are rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Elements without content, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title".split())
UNSEEN = frozenset(("script", "style"))
# A start tag ends an open element of the second list, unless one of the third list was opened since.
_BLOCKS = "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "a": (("a",), ("table",)),
    **{b: (("p",), ("button", "table", "td", "th")) for b in _BLOCKS},
}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|([^<]+|<)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_COMPOUND = re.compile(r"""(\*|[A-Za-z][\w-]*)?((?:\.[\w-]+|\#[\w-]+|\[[\w-]+(?:=(?:"[^"]*"|'[^']*'|[^\]]*))?\])*)""")
_PART = re.compile(r"""\.([\w-]+)|\#([\w-]+)|\[([\w-]+)(?:=(?:"([^"]*)"|'([^']*)'|([^\]]*)))?\]""")


@dataclass
class Element:
    tag: str
    attributes: dict[str, str]
    place: dict[str, int] = field(default_factory=dict)  # by selector name, where it is one's match
    text_from: int = 0

    def fits(self, compound: tuple) -> bool:
        tag, classes, wanted = compound
        if tag not in ("", "*", self.tag) or not classes.issubset(self.attributes.get("class", "").split()):
            return False
        return all(k in self.attributes and v in (None, self.attributes[k]) for k, v in wanted)


def parse_selector(selector: str) -> list[list[tuple[str, tuple]]]:
    """Alternatives (``a, b``) of steps from left to right: the combinator before (`` `` or ``>``) and the compound."""
    out = []
    for one in selector.split(","):
        steps, combinator = [], " "
        for word in re.findall(r"""(?:\[[^\]]*\]|[^\s>])+|>""", one):
            if word == ">":
                combinator = ">"
                continue
            found = _COMPOUND.fullmatch(word)
            if not found:
                raise ValueError(f"no selector: {word}")
            parts = _PART.findall(found[2])
            wanted = [("id", p[1]) for p in parts if p[1]]
            wanted += [(p[2].lower(), p[3] or p[4] or p[5] or None) for p in parts if p[2]]
            steps.append((combinator, ((found[1] or "").lower(), {p[0] for p in parts if p[0]}, wanted)))
            combinator = " "
        if not steps:
            raise ValueError("an empty selector")
        out.append(steps)
    return out


def matches(stack: list[Element], steps: list[tuple[str, tuple]]) -> bool:
    """The last element of ``stack`` (from the root on) is selected."""

    def fits(at: int, step: int) -> bool:
        if not stack[at].fits(steps[step][1]):
            return False
        if step == 0:
            return True
        above = range(at - 1, -1, -1) if steps[step][0] == " " else range(at - 1, max(at - 2, -1), -1)
        return any(fits(k, step - 1) for k in above)

    return fits(len(stack) - 1, len(steps) - 1)


def read_page(html: str, selectors: Mapping[str, list]) -> Iterator[tuple[str, int, dict[str, str], str]]:
    """(selector name, place, attributes, text) of each match, as the elements end."""
    stack: list[Element] = []
    text: list[str] = []
    count = dict.fromkeys(selectors, 0)

    def close(down_to: int) -> Iterator[tuple[str, int, dict[str, str], str]]:
        while len(stack) > down_to:
            e = stack.pop()
            for name, place in e.place.items():
                yield name, place, e.attributes, "".join(text[e.text_from :])

    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.match(html, at)  # a lone < is text, so something always matches
        at = token.end()
        if token[4] is not None:
            text.append(token[4])
        elif token[2] is not None:
            tag = token[2].lower()
            if token[1]:
                open_at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
                if open_at is not None:
                    yield from close(open_at)
                continue
            ended, walls = IMPLIED.get(tag, ((), ()))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in ended:
                    yield from close(k)
                    break
                if stack[k].tag in walls:
                    break
            attributes: dict[str, str] = {}
            for name, *values in _ATTRIBUTE.findall(token[3]):
                attributes.setdefault(name.lower(), "".join(values))
            stack.append(Element(tag, attributes, text_from=len(text)))
            for name, alternatives in selectors.items():
                if any(matches(stack, steps) for steps in alternatives):
                    stack[-1].place[name] = count[name]
                    count[name] += 1
            if tag in VOID:
                yield from close(len(stack) - 1)
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                inside, at = (html[at : end.start()], end.end()) if end else (html[at:], size)
                if tag not in UNSEEN:
                    text.append(inside)
                yield from close(len(stack) - 1)
    yield from close(0)


def select_elements(pages: DataFrame, page_id: str, html: str, selectors: Mapping[str, str]) -> DataFrame:
    """A row per element that a selector picks: the page's id, ``selector`` (its name), ``place`` (0, 1, ... in page
    order), ``attributes`` and ``text`` (with that of the elements inside, as written in the page).

    Selectors are made of tags, ``.class``, ``#id`` and ``[attribute=value]``, descendants (a blank),
    children (``>``) and alternatives (a comma). A null page has no elements.
    """
    parsed = {name: parse_selector(s) for name, s in selectors.items()}
    out = T.StructType([
        pages.schema[page_id], T.StructField("selector", T.StringType()), T.StructField("place", T.IntegerType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())), T.StructField("text", T.StringType()),
    ])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                page = batch.column(1)[at].as_py()
                found = list(read_page(page, parsed)) if page else []
                if found:
                    names, places, attributes, texts = zip(*found, strict=True)
                    ids = pa.array([batch.column(0)[at].as_py()] * len(found), arrow.field(0).type)
                    made = (pa.array(c, f.type) for c, f in zip((names, places, [list(a.items()) for a in attributes], texts), list(arrow)[1:], strict=True))
                    yield pa.RecordBatch.from_arrays([ids, *made], schema=arrow)

    return pages.select(page_id, F.col(html).alias("_html")).mapInArrow(read, out)


def paired_elements(pages: DataFrame, page_id: str, html: str, selectors: Mapping[str, str]) -> DataFrame:
    """The texts that the selectors pick, paired by their order: a row per page and place, a column per selector.

    A column is null where its selector picks fewer elements than another one.
    """
    found = select_elements(pages, page_id, html, selectors)
    texts = [F.max(F.when(F.col("selector") == name, F.col("text"))).alias(name) for name in selectors]
    return found.groupBy(page_id, "place").agg(*texts)


def list_links(pages: DataFrame, page_id: str, html: str, container: str | None = None) -> DataFrame:
    """Targets and texts of the links in list items, in page order; of those inside elements of the class
    ``container``, if one is given."""
    selector = "li a[href]" if container is None else f".{container} li a[href]"
    links = select_elements(pages, page_id, html, {"links": selector})
    return links.select(page_id, "place", F.col("attributes")["href"].alias("target"), F.col("text").alias("title"))
