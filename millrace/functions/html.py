"""HTML and XML: body text, sections, structured data, metadata. A small tree on the standard library's parser."""

from __future__ import annotations

import json
import re
import weakref
import xml.etree.ElementTree as ElementTree
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.batches import steps
from millrace.functions.text import BOILERPLATE

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE = ("script", "style", "nav", "footer", "header", "aside", "noscript")
# Where a page's text is looked for, in this order.
SELECTORS = ("article", "[role='main']", "main", ".entry-content", ".post-content", ".article-body", ".content-body", "#content", "#main-content", ".content")
SECTION_CHARS = 5000


class Node:
    """A parent holds its children and they know it by a weak reference, so a tree is freed with its root, not by the search for cycles."""

    __slots__ = ("tag", "attributes", "children", "above", "__weakref__")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.children, self.above = tag, attributes, [], None if parent is None else weakref.ref(parent)

    @property
    def parent(self) -> Node | None:
        return self.above and self.above()

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self, without: Sequence[str] = ()) -> Iterator[str]:
        stack: list = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif node.tag not in without:
                stack += reversed(node.children)

    def text(self, without: Sequence[str] = ()) -> str:
        return re.sub(r"\s+", " ", " ".join(self.strings(without))).strip()


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "td", "tr", "dd", "dt") and self.at.tag == tag:  # these end one before
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    builder.feed(html)
    builder.close()
    return builder.root


SIMPLE = re.compile(r"""([\w-]+)?((?:[.#][\w-]+|\[[\w:-]+(?:\s*=\s*["']?[^"'\]]*["']?)?\])*)$""")
PART = re.compile(r"""([.#])([\w-]+)|\[([\w:-]+)(?:\s*=\s*["']?([^"'\]]*)["']?)?\]""")


def fits(node: Node, simple: str) -> bool:
    """A tag, classes, an id, attributes: one step of a selector."""
    m = SIMPLE.match(simple)
    if not m or not simple:
        return False
    if m[1] and node.tag != m[1].lower():
        return False
    for kind, name, attribute, value in PART.findall(m[2]):
        if kind == "." and name not in node.attributes.get("class", "").split():
            return False
        if kind == "#" and node.attributes.get("id") != name:
            return False
        if attribute and (attribute not in node.attributes or value and node.attributes[attribute] != value):
            return False
    return True


def select(root: Node, selector: str) -> Iterator[Node]:
    """Nodes in document order for a selector of steps with spaces between; with commas, the first alternative that finds anything."""
    for alternative in selector.split(","):
        *above, last = alternative.split()
        found = []
        for node in root.walk():
            if not fits(node, last):
                continue
            up, rest = node.parent, list(above)
            while rest and up is not None:
                if fits(up, rest[-1]):
                    rest.pop()
                up = up.parent
            if not rest:
                found.append(node)
        if found:
            yield from found
            return


def good_enough(text: str) -> bool:
    low = text.lower()
    return len(text) >= 300 and len(text.split()) >= 50 and not (len(text) < 1000 and any(p in low for p in BOILERPLATE))


def body_of(html: str | None, selectors: Sequence[str] = ()) -> str | None:
    """The first place of selectors, then of SELECTORS, whose text is long enough; else the body's text; else null."""
    if not html:
        return None
    root = parse(html)
    for selector in (*selectors, *SELECTORS):
        for node in select(root, selector):
            text = node.text(NOISE)
            if good_enough(text):
                return text
            break
    for node in select(root, "body"):
        return node.text(NOISE) or None
    return None


def sections_of(html: str | None) -> list[dict]:
    """heading, level, text by h1 to h3; without any heading one section of all text."""
    if not html:
        return []
    root, out, held = parse(html), [], {"heading": "", "level": 0, "text": []}

    def close():
        text = " ".join(held["text"])[:SECTION_CHARS]
        if text:
            out.append({"heading": held["heading"], "level": held["level"], "text": text})

    for node in root.walk():
        if any(p.tag in NOISE for p in up(node)):
            continue
        if node.tag in ("h1", "h2", "h3"):
            close()
            held = {"heading": node.text(), "level": int(node.tag[1]), "text": []}
        elif node.tag in ("p", "li", "blockquote", "td", "dd") and (text := node.text(NOISE)):
            held["text"].append(text)
    close()
    return out


def up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def person(value) -> str | None:
    """An author as structured data gives it: an object, a list of them, or a string."""
    if isinstance(value, list):
        return person(value[0]) if value else None
    if isinstance(value, dict):
        return value.get("name")
    return value if isinstance(value, str) and value else None


def json_ld_of(html: str | None, types: Sequence[str] = ("Article", "NewsArticle", "MedicalWebPage", "WebPage")) -> dict | None:
    """title, description, author, published, body of the first block with a headline or name; of a list the first of the types, else its first."""
    for node in select(parse(html or ""), 'script[type="application/ld+json"]'):
        try:
            data = json.loads("".join(node.strings()))
        except ValueError:
            continue
        if isinstance(data, dict) and isinstance(data.get("@graph"), list):
            data = data["@graph"]
        if isinstance(data, list):
            objects = [x for x in data if isinstance(x, dict)]
            data = next((x for x in objects if x.get("@type") in types), objects[0] if objects else None)
        if isinstance(data, dict) and (title := data.get("headline") or data.get("name")):
            return {"title": str(title), "description": data.get("description"), "author": person(data.get("author")), "published": data.get("datePublished"), "body": data.get("articleBody")}
    return None


def meta_of(html: str | None, title_tag: bool = False) -> dict | None:
    """title, description, published, site from Open Graph or plain meta tags; with title_tag also from <title>."""
    root = parse(html or "")
    named: dict[str, str] = {}
    for node in root.walk():
        if node.tag == "meta" and (name := node.attributes.get("property") or node.attributes.get("name")) and node.attributes.get("content"):
            named.setdefault(name.lower(), node.attributes["content"])
    title = named.get("og:title") or named.get("title")
    if not title and title_tag:
        title = next((n.text() for n in select(root, "title")), None)
    if not title:
        return None
    return {"title": title, "description": named.get("og:description") or named.get("description"), "published": named.get("article:published_time"), "site": named.get("og:site_name")}


def by_selectors(html: str | None, places: dict[str, str]) -> dict[str, str | None]:
    """For each name the text of the first node its selector finds; of a time its datetime."""
    root = parse(html or "")
    out: dict[str, str | None] = {}
    for name, selector in places.items():
        node = next(select(root, selector), None)
        out[name] = None if node is None else node.attributes.get("datetime") or node.text() or None
    return out


def links_of(html: str | None) -> list[str]:
    return [n.attributes["href"] for n in parse(html or "").walk() if n.tag == "a" and n.attributes.get("href")]


def xml_text_of(data: bytes | str | None) -> str | None:
    """All text of an XML document, squeezed; null under 300 characters or if it isn't XML."""
    try:
        root = ElementTree.fromstring(data or "")
    except ElementTree.ParseError:
        return None
    text = re.sub(r"\s+", " ", " ".join(root.itertext())).strip()
    return text if len(text) >= 300 else None


def over(kind: str, arrow: pa.DataType, one: Callable, column: Column) -> Column:
    """one() over a column, in steps of bounded size."""

    @F.arrow_udf(kind)
    def run(values: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([one(v) for v in part.to_pylist()], arrow) for part in steps(values)])

    return run(column)


def extract_body(html: Column, selectors: Sequence[str] = ()) -> Column:
    return over("string", pa.string(), lambda h: body_of(h, selectors), html)


def extract_sections(html: Column) -> Column:
    return over("array<struct<heading:string,level:int,text:string>>", pa.list_(pa.struct([("heading", pa.string()), ("level", pa.int32()), ("text", pa.string())])), sections_of, html)


def structs(*names: str) -> tuple[str, pa.DataType]:
    return f"struct<{','.join(f'{n}:string' for n in names)}>", pa.struct([(n, pa.string()) for n in names])


def as_text(found: dict | None) -> dict | None:
    return None if found is None else {k: v if v is None or isinstance(v, str) else json.dumps(v) for k, v in found.items()}


def extract_json_ld(html: Column) -> Column:
    return over(*structs("title", "description", "author", "published", "body"), lambda h: as_text(json_ld_of(h)), html)


def extract_meta(html: Column, title_tag: bool = False) -> Column:
    return over(*structs("title", "description", "published", "site"), lambda h: meta_of(h, title_tag), html)


def extract_by_selectors(html: Column, places: dict[str, str]) -> Column:
    return over(*structs(*places), lambda h: by_selectors(h, places), html)


def extract_links(html: Column) -> Column:
    return over("array<string>", pa.list_(pa.string()), links_of, html)


def extract_xml_text(xml: Column) -> Column:
    return over("string", pa.string(), xml_text_of, xml)
