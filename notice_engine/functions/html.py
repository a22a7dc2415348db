"""A small tree over the standard HTML parser, and what is read from it.

Recovery: void tags never hold children; an end tag without a start is ignored; an
end tag closes everything opened since its start. Text of scripts, styles, templates
and comments belongs to no other element.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset({"script", "style", "template"})
NO_RESULTS = "검색 결과가 없습니다"


class Node:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self):
        """Elements below, in document order."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, Node):
                yield node
                stack.extend(reversed(node.children))

    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif node.name not in APART:
                stack.extend(reversed(node.children))

    def text(self, separator: str = "", strip: bool = False) -> str:
        if strip:
            return separator.join(s for s in (x.strip() for x in self.strings()) if s)
        return separator.join(self.strings())

    def single(self) -> str | None:
        """The one string inside, if there is nothing else on the way to it."""
        node = self
        while isinstance(node, Node):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node

    def all(self, *names: str) -> list[Node]:
        return [n for n in self.walk() if n.name in names]

    def first(self, tag: str, /, **attrs: str) -> Node | None:
        return next((n for n in self.walk() if n.name == tag and all(n.attrs.get(k) == v for k, v in attrs.items())), None)

    def has_class(self, name: str) -> bool:
        value = self.attrs.get("class") or ""
        return name in value.split() or value == name


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        found: dict[str, str] = {}
        for k, v in attrs:
            found[k] = v if v is not None else ""
        node = Node(tag, found, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        before = self.open
        self.handle_starttag(tag, attrs)
        self.open = before

    def handle_endtag(self, tag):
        node = self.open
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        if self.open.children and isinstance(self.open.children[-1], str):
            self.open.children[-1] += data
        else:
            self.open.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def list_rows(html: str | None) -> list[tuple[int, list[str], list[tuple[str, str]]]]:
    """(1-based number among all rows, cell texts, links) of the first list table's body; unfit rows left out."""
    table = next((n for n in parse(html).all("table") if n.has_class("tableHor")), None)
    body = table.first("tbody") if table else None
    found = []
    for number, row in enumerate(body.all("tr") if body else [], start=1):
        cells = row.all("td")
        texts = [c.text(strip=True) for c in cells]
        if len(cells) < 5 or any(NO_RESULTS in t for t in texts) or not any(texts):
            continue
        links = [(a.text(strip=True), a.attrs["href"]) for c in cells for a in c.all("a") if a.attrs.get("href")]
        found.append((number, texts, links))
    return found


def page_info(html: str | None) -> tuple[int, bool, bool]:
    """(current page, has next, has previous)."""
    root = parse(html)
    field = root.first("input", name="nowpage")
    try:
        page = int(field.attrs["value"]) if field and field.attrs.get("value") else 1
    except ValueError:
        page = 1
    divs = root.all("div")
    bar = next((d for d in divs if d.has_class("paging")), None) or next((d for d in divs if d.has_class("pagination")), None)
    labels = {a.single() for a in bar.all("a")} if bar else set()
    return page, bool(labels & {"다음", ">"}), bool(labels & {"이전", "<"})


def has_data(html: str | None) -> bool:
    root = parse(html)
    if NO_RESULTS in root.text():
        return False
    tables = [t for t in root.all("table") if t.has_class("tableHor")]
    return any(r.text().strip() for t in tables for b in t.all("tbody") for r in b.all("tr"))


def _selected(root: Node) -> Node | None:
    """First element of the first rule that selects any."""
    in_class = lambda n, part: part in (n.attrs.get("class") or "")
    rules = (
        lambda n: "notice-content" in (n.attrs.get("class") or "").split(),
        lambda n: "content" in (n.attrs.get("class") or "").split(),
        lambda n: "board-content" in (n.attrs.get("class") or "").split(),
        lambda n: n.name == "div" and in_class(n, "content"),
        lambda n: n.name == "td" and in_class(n, "content"),
        lambda n: "post-content" in (n.attrs.get("class") or "").split(),
    )
    for rule in rules:
        for node in root.walk():
            if rule(node):
                return node
    return None


def links(root: Node) -> list[tuple[str, str | None, str | None, str, str]]:
    """Link elements: (tag, href, onclick, stripped text, text as shown)."""
    return [(n.name, n.attrs.get("href"), n.attrs.get("onclick"), n.text(strip=True), n.text().strip()) for n in root.all("a", "button")]


def detail(html: str | None) -> tuple[str, str, list[tuple[str, str]], list[tuple[str, str | None, str | None, str, str]]]:
    """(whole text, content before cleaning, key/value pairs in order, link elements) of a detail page."""
    root = parse(html)
    chosen = _selected(root)
    content = chosen.text("\n", strip=True) if chosen else ""
    if not content:
        content = next((t for t in (n.text("\n", strip=True) for n in root.all("table")) if len(t) > 100), "")
    pairs = []
    for table in root.all("table"):
        for row in table.all("tr"):
            cells = row.all("td", "th")
            if len(cells) >= 2:
                key, value = (c.text(strip=True) for c in cells[:2])
                if key and value and len(key) < 50:
                    pairs.append((key, value))
    for group in root.all("dl"):
        for term, said in zip(group.all("dt"), group.all("dd"), strict=False):
            key, value = term.text(strip=True), said.text(strip=True)
            if key and value:
                pairs.append((key, value))
    return root.text(), content, pairs, links(root)
