"""Turn one HTML text into flat element rows and text pieces.

This is the only per-row Python of the package. It follows the parsing rules of the HTML
standard that matter for article pages: implied html/head/body, void and raw-text elements,
implied end tags, and reopening of formatting elements that were left open. Not covered:
moving content out of tables and the full repair of misnested formatting end tags.
"""

from __future__ import annotations

import re
from html import unescape

# Tags whose subtree never counts while templates are learned.
EXCLUDED_TAGS = frozenset(
    ["a", "link", "script", "input", "form", "noscript", "style", "iframe", "ul"]
)

# HTML standard: void elements, raw-text elements, formatting elements.
VOID = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)
DATA_ONLY = frozenset(["script", "style"])
RAW_TEXT = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE_RAW = frozenset(["title", "textarea"])
HEAD_TAGS = frozenset("base link meta noscript script style title".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# HTML standard: start tags that end an open paragraph.
ENDS_PARAGRAPH = HEADINGS | frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form header hgroup hr li listing main menu nav ol p plaintext "
    "pre section summary table ul xmp".split()
)
# HTML standard: elements an unmatched end tag never reaches across.
SCOPE_EDGE = frozenset("html table td th caption button object marquee applet".split())
TABLE_PARTS = frozenset("table caption colgroup tbody thead tfoot tr td th".split())
SPECIAL = ENDS_PARAGRAPH | SCOPE_EDGE | frozenset(
    "body head tr tbody thead tfoot colgroup select iframe textarea".split()
)
# Start tag -> open elements it ends, and the elements the search stops at.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
}
# Elements before which text extraction puts a space.
BREAKING = frozenset(
    "html head body frameset script noscript style meta link title frame noframes section nav "
    "aside hgroup header footer p h1 h2 h3 h4 h5 h6 ul ol pre div blockquote hr address figure "
    "figcaption form fieldset ins del dl dt dd li table caption thead tfoot tbody colgroup col "
    "tr th td video audio canvas details menu plaintext template article main svg math br".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(>?)"
    r"|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
# Only runs that differ from one space, so ordinary text is left untouched.
SPACES = re.compile(r"[\t\n\f\r][ \t\n\f\r]*| [ \t\n\f\r]+")

NODE_FIELDS = (
    "node", "parent", "last", "depth", "tag", "id", "cls", "cut", "own", "text_len",
    "first_piece", "n_pieces",
)


def identity(attributes: str) -> tuple[str, str]:
    """The id and class attributes of a start tag."""
    found = {"id": "", "class": ""}
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in found:
            if value[:1] in ("\"", "'"):
                value = value[1:-1]
            found[name] = unescape(value)
    return found["id"], found["class"]


class Tree:
    """Open-element stack plus the growing element and piece lists of one page."""

    def __init__(self) -> None:
        self.nodes: list[list] = []
        self.pieces: list[tuple[int, bool, str]] = []
        self.own: list[list[str]] = []
        self.spans: list[list[int]] = []
        self.counted: list[str] = []  # text outside cut subtrees, spaces collapsed
        self.counted_len = 0
        self.ends_in_space = True
        self.stack: list[int] = []
        self.formatting: list[tuple[str, str, str, str, int]] = []  # tag, id, class, raw, node
        self.head = self.body = -1
        self.open("html", "", "")
        self.head = self.open("head", "", "")

    def tag(self, node: int) -> str:
        return self.nodes[node][4]

    def open(self, tag: str, id_: str, cls: str, keep_open: bool = True) -> int:
        node = len(self.nodes)
        parent = self.stack[-1] if self.stack else -1
        cut = parent >= 0 and (self.nodes[parent][7] or (self.body >= 0 and tag in EXCLUDED_TAGS))
        first_piece = len(self.pieces) + 1
        self.nodes.append(
            [node, parent, node, len(self.stack), tag, id_, cls, cut, "", 0, first_piece, 0]
        )
        self.own.append([])
        if tag == "br" and parent >= 0:
            self.own[parent].append(" ")
        if tag in BREAKING:
            self.piece(node, cut, " ")
        self.spans.append([self.counted_len, 0])
        self.stack.append(node)
        if not keep_open:
            self.close()
        return node

    def close(self) -> None:
        node = self.stack.pop()
        row = self.nodes[node]
        row[2] = len(self.nodes) - 1
        row[11] = len(self.pieces) - row[10] + 1
        own = self.own[node]
        if own:
            row[8] = (own[0] if len(own) == 1 else SPACES.sub(" ", "".join(own))).strip(" ")
        self.spans[node][1] = self.counted_len

    def close_through(self, tags: set[str], edge: frozenset[str] | set[str]) -> bool:
        """Close elements up to the innermost one of `tags`, unless an edge comes first."""
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.tag(self.stack[at])
            if tag in tags:
                while len(self.stack) > at:
                    self.close()
                return True
            if tag in edge:
                return False
        return False

    def piece(self, node: int, cut: bool, text: str) -> None:
        self.pieces.append((node, cut, text))
        if cut:
            return
        if self.ends_in_space and text[0] == " ":
            text = text[1:]
        if text:
            self.counted.append(text)
            self.counted_len += len(text)
            self.ends_in_space = text[-1] == " "

    def need_body(self) -> None:
        if self.body < 0:
            while len(self.stack) > 1:
                self.close()
            self.body = self.open("body", "", "")

    def reopen_formatting(self) -> None:
        if not self.formatting:
            return
        open_now = set(self.stack)
        at = len(self.formatting)
        while at and self.formatting[at - 1][4] not in open_now:
            at -= 1
        for i in range(at, len(self.formatting)):
            tag, id_, cls, raw, _ = self.formatting[i]
            self.formatting[i] = (tag, id_, cls, raw, self.open(tag, id_, cls))

    def remember_formatting(self, tag: str, id_: str, cls: str, raw: str, node: int) -> None:
        """Keep at most three equal entries; the earliest is forgotten."""
        equal = [f for f in self.formatting if f[0] == tag and f[3] == raw]
        if len(equal) >= 3:
            self.formatting.remove(equal[0])
        self.formatting.append((tag, id_, cls, raw, node))

    def text(self, raw: str, data: bool = False) -> None:
        raw = SPACES.sub(" ", raw)
        if not raw or data:
            return
        if raw == " " and (self.body < 0 or self.stack == [0]):
            return
        if self.body < 0 and self.tag(self.stack[-1]) in ("html", "head"):
            self.need_body()
        if self.body >= 0:
            self.reopen_formatting()
        node = self.stack[-1]
        self.own[node].append(raw)
        self.piece(node, self.nodes[node][7], raw)

    def start(self, tag: str, raw: str) -> None:
        id_, cls = identity(raw) if raw else ("", "")
        if tag in ("html", "head", "body"):
            if tag == "body":
                self.need_body()
            if tag != "head":
                row = self.nodes[self.body if tag == "body" else 0]
                row[5], row[6] = row[5] or id_, row[6] or cls
            return
        if self.body < 0:
            if tag in HEAD_TAGS:
                if self.stack == [0]:
                    self.need_body()
                else:
                    self.open(tag, id_, cls, tag not in VOID)
                    return
            else:
                self.need_body()
        if tag in ENDS_PARAGRAPH:
            self.close_through({"p"}, SCOPE_EDGE)
        if tag in IMPLIED_END:
            self.close_through(*IMPLIED_END[tag])
        if tag in HEADINGS and self.tag(self.stack[-1]) in HEADINGS:
            self.close()
        if tag == "tr" and self.tag(self.stack[-1]) == "table":
            self.open("tbody", "", "")
        if tag in ("td", "th") and self.tag(self.stack[-1]) in ("tbody", "thead", "tfoot"):
            self.open("tr", "", "")
        if tag == "a" and any(f[0] == "a" for f in self.formatting):
            self.end("a")
        if tag not in SPECIAL:
            self.reopen_formatting()
        node = self.open(tag, id_, cls, tag not in VOID)
        if tag in FORMATTING:
            self.remember_formatting(tag, id_, cls, raw.strip(), node)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            self.need_body()
        elif tag == "head":
            if self.body < 0:
                while len(self.stack) > 1:
                    self.close()
        elif tag == "br":
            self.start("br", "")
        elif self.body < 0:
            if tag == self.tag(self.stack[-1]):
                self.close()
        elif tag == "p":
            if not self.close_through({"p"}, SCOPE_EDGE):
                self.open("p", "", "", keep_open=False)
        elif tag in HEADINGS:
            self.close_through(set(HEADINGS), SCOPE_EDGE)
        elif tag in FORMATTING:
            for at in range(len(self.formatting) - 1, -1, -1):
                if self.formatting[at][0] == tag:
                    node = self.formatting.pop(at)[4]
                    if node in self.stack:
                        self.close_through({tag}, SPECIAL)
                    break
            else:
                self.close_through({tag}, SPECIAL)
        elif tag in TABLE_PARTS:
            self.close_through({tag}, {"html", "table"} - {tag})
        elif tag in SPECIAL:
            self.close_through({tag}, SCOPE_EDGE - {tag})
        else:
            self.close_through({tag}, SPECIAL)

    def finish(self) -> tuple[list[list], list[tuple[int, bool, str]]]:
        self.need_body()
        while self.stack:
            self.close()
        whole = "".join(self.counted)
        wide = not whole.isascii() and len(whole.encode("utf-16-le")) > 2 * len(whole)
        for row, (start, end) in zip(self.nodes, self.spans):
            if row[7]:
                continue
            while start < end and whole[start] == " ":
                start += 1
            while start < end and whole[end - 1] == " ":
                end -= 1
            row[9] = end - start
            if wide:  # lengths are in UTF-16 units
                row[9] += sum(1 for ch in whole[start:end] if ch > "\uffff")
        return self.nodes, self.pieces


def parse_page(html: str | None) -> tuple[list[list], list[tuple[int, bool, str]]]:
    """Element rows (see NODE_FIELDS, in document order) and text pieces (node, cut, text)."""
    tree = Tree()
    html = html or ""
    at = 0
    while at < len(html):
        token = TOKEN.match(html, at)
        at = token.end()
        end_tag, start_tag, attributes, closed = token.groups()
        if end_tag:
            tree.end(end_tag.lower())
        elif start_tag:
            if not closed:
                continue
            tag = start_tag.lower()
            tree.start(tag, attributes)
            if tag in RAW_TEXT or tag in ESCAPABLE_RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])|\Z", re.I).search(html, at)
                raw = html[at:stop.start()]
                tree.text(unescape(raw) if tag in ESCAPABLE_RAW else raw, data=tag in DATA_ONLY)
                at = stop.start()
                if at == len(html):
                    tree.end(tag)
        elif not (html.startswith("<!", token.start()) or html.startswith("<?", token.start())):
            tree.text(unescape(token.group()))
    return tree.finish()
