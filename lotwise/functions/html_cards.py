"""HTML pages to cards: the one place that needs a tokenizer, so the one Python table function.

It emits, per card, the text of the addressed elements and nothing else; every
parse of that text is a native expression. Tags are found by one regular
expression, and attributes are read only of tags that a spec asks for, which
takes a fraction of the time of a full parse.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass
from html import unescape

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need no copy of this package: ship the table function by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The start of a comment, an end tag, a start tag with its attributes, or other markup.
# A quote counts only after an equals sign; what fits nothing is text.
TOKEN = re.compile(
    r"""(?P<comment><!--)
    |</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>
    |<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?)*+)>
    |<[!?/][^>]*>""",
    re.DOTALL | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""([^\s/=>][^\s/=>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'][^\s]*)?)?""")
UNQUOTED_END = re.compile(r"""=\s*[^\s"']+$""")

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Tags whose content is text up to their end tag, and whether it is text to read.
RAW_TAGS = {"script": False, "style": False, "title": True, "textarea": True}
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW_TAGS}
UNSEEN_TEXT_TAGS = frozenset(["template"])
MEMO_SIZE = 4096

CARD_SCHEMA = T.StructType(
    [
        T.StructField("card_no", T.IntegerType()),
        T.StructField(
            "hits",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("field", T.StringType()),
                        T.StructField("scope", T.IntegerType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("attr", T.StringType()),
                        T.StructField("n_children", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)


@dataclass(frozen=True)
class Address:
    """An element address: tag plus class.

    A class with a blank in it must equal the whole class attribute, one
    without must be among its words. With `pattern` it is a regular expression
    searched in the words and in the whole attribute. None takes any class.
    """

    tag: str
    cls: str | None = None
    pattern: bool = False

    def matches(self, tag: str, class_attr: str | None) -> bool:
        if tag != self.tag:
            return False
        if self.cls is None:
            return True
        if class_attr is None:
            return False
        words = class_attr.split()
        candidates = [*words, " ".join(words)]
        if self.pattern:
            return any(re.search(self.cls, c) for c in candidates)
        return self.cls in candidates


@dataclass(frozen=True)
class CardSpec:
    """What to take from a page.

    `scope` names the field whose elements number the hits inside them, so
    that repeated blocks within a card (priced units, change items) stay apart.
    """

    card: Address
    fields: dict[str, Address]
    scope: str | None = None
    attrs: tuple[tuple[str, str], ...] = ()


class _Hit:
    __slots__ = ("field", "scope", "parts", "attr", "children")

    def __init__(self, field: str, scope: int | None, attr: str | None):
        self.field, self.scope, self.attr = field, scope, attr
        self.parts: list[str] = []
        self.children = 0

    def row(self) -> tuple:
        return (self.field, self.scope, "".join(self.parts), self.attr, self.children)


class _Card:
    __slots__ = ("hits", "n_scopes", "scopes")

    def __init__(self) -> None:
        self.hits: list[_Hit] = []
        self.n_scopes = 0
        self.scopes: list[int] = []  # open ones, innermost last


class _Element:
    __slots__ = ("tag", "hits", "scoped", "n_hits", "n_cards", "text_last")

    def __init__(self, tag: str, n_hits: int, n_cards: int):
        self.tag, self.n_hits, self.n_cards = tag, n_hits, n_cards
        self.hits: list[_Hit] | tuple = ()
        self.scoped: list[_Card] | tuple = ()
        self.text_last = False


class CardReader:
    """Collects cards in document order. Unclosed elements end with their parent."""

    def __init__(self, spec: CardSpec, memo: dict | None = None):
        self.spec = spec
        self.memo = {} if memo is None else memo  # (tag, class) -> what it matches
        self.tags = {a.tag for a in spec.fields.values()} | {spec.card.tag}
        self.attrs = dict(spec.attrs)
        self.cards: list[_Card] = []
        self.stack: list[_Element] = []
        self.open_cards: list[_Card] = []
        self.open_hits: list[_Hit] = []
        self.n_unseen = 0
        self.unclosed: set[str] = set()  # what was sought and not found in the rest of the page

    def read(self, html: str) -> list[list[tuple]]:
        """The hits of each card."""
        at, end = 0, html.rfind(">") + 1
        while token := TOKEN.search(html, at, end):
            if self.open_hits and token.start() > at:
                self._text(html[at : token.start()])
            at = token.end()
            tag = token["start"]
            if tag is not None:
                at = self._start(tag.lower(), token["attrs"], html, at)
            elif token["end"] is not None:
                self._end(token["end"].lower())
            else:
                if self.open_hits:
                    self._count_child(False)
                if token["comment"]:
                    at = self._after_comment(html, at)
        if self.open_hits and at < len(html):
            self._text(html[at:])
        return [[hit.row() for hit in card.hits] for card in self.cards]

    def _after_comment(self, html: str, at: int) -> int:
        # An unclosed comment ends with its tag, so that it hides no cards.
        close = -1 if "-->" in self.unclosed else html.find("-->", at)
        if close >= 0:
            return close + 3
        self.unclosed.add("-->")
        return html.find(">", at) + 1 or at

    def _after_raw(self, tag: str, html: str, at: int) -> int:
        close = None if tag in self.unclosed else RAW_END[tag].search(html, at)
        if close is None:
            self.unclosed.add(tag)
            return at
        if RAW_TAGS[tag] and self.open_hits and close.start() > at:
            self._text(html[at : close.start()])
        return close.start()

    def _start(self, tag: str, attrs: str, html: str, at: int) -> int:
        if self.open_hits:
            self._count_child(False)
        element = _Element(tag, len(self.open_hits), len(self.open_cards))
        if tag in self.tags:
            self._match(element, _attributes(attrs))
        if tag in VOID_TAGS:
            self._leave(element)
            return at
        self.stack.append(element)
        if tag in UNSEEN_TEXT_TAGS:
            self.n_unseen += 1
        if attrs.endswith("/") and not UNQUOTED_END.search(attrs):
            self._pop()
        elif tag in RAW_TAGS:
            return self._after_raw(tag, html, at)
        return at

    def _text(self, text: str) -> None:
        self._count_child(True)
        if not self.n_unseen:
            if "&" in text:
                text = unescape(text)
            for hit in self.open_hits:
                hit.parts.append(text)

    def _count_child(self, is_text: bool) -> None:
        # Only elements that are hits have their children counted.
        if self.stack:
            top = self.stack[-1]
            if top.hits:
                if not (is_text and top.text_last):
                    for hit in top.hits:
                        hit.children += 1
                top.text_last = is_text

    def _match(self, element: _Element, values: dict) -> None:
        is_card, names = self._matches(element.tag, values.get("class"))
        if names and self.open_cards:
            element.hits, element.scoped = [], []
            for card in self.open_cards:
                self._hit(element, card, names, values)
            self.open_hits.extend(element.hits)
        if is_card:
            self.cards.append(_Card())
            self.open_cards.append(self.cards[-1])

    def _hit(self, element: _Element, card: _Card, names: list[str], values: dict) -> None:
        inside = card.scopes[-1] if card.scopes else None
        for name in names:
            scope = inside
            if name == self.spec.scope:
                scope = card.n_scopes
                card.n_scopes += 1
                card.scopes.append(scope)
                element.scoped.append(card)
            hit = _Hit(name, scope, values.get(self.attrs.get(name)))
            card.hits.append(hit)
            element.hits.append(hit)

    def _matches(self, tag: str, class_attr: str | None) -> tuple[bool, list[str]]:
        found = self.memo.get((tag, class_attr))
        if found is None:
            names = [n for n, a in self.spec.fields.items() if a.matches(tag, class_attr)]
            found = self.spec.card.matches(tag, class_attr), names
            if len(self.memo) < MEMO_SIZE:
                self.memo[tag, class_attr] = found
        return found

    def _leave(self, element: _Element) -> None:
        if len(self.open_hits) > element.n_hits:
            del self.open_hits[element.n_hits :]
        if len(self.open_cards) > element.n_cards:
            del self.open_cards[element.n_cards :]
        for card in element.scoped:
            card.scopes.pop()

    def _pop(self) -> None:
        element = self.stack.pop()
        if element.tag in UNSEEN_TEXT_TAGS:
            self.n_unseen -= 1
        self._leave(element)

    def _end(self, tag: str) -> None:
        stack = self.stack
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].tag == tag:
                while len(stack) > depth:
                    self._pop()
                return


def _attributes(text: str) -> dict[str, str | None]:
    values: dict[str, str | None] = {}
    for name, value in ATTRIBUTE.findall(text):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        values[name.lower()] = unescape(value) if "&" in value else value
    return values


def cards_function(spec: CardSpec):
    """Table function html -> (card_no, hits), for use with `lateralJoin`."""

    memo: dict = {}

    class Cards:
        def eval(self, html: str):
            if html is None:
                return
            for number, hits in enumerate(CardReader(spec, memo).read(html)):
                yield number, hits

    return F.udtf(Cards, returnType=CARD_SCHEMA)
