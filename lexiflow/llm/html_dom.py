"""Parsing of web pages into element trees with their text in page order."""

from __future__ import annotations

import re
from html import unescape

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head title script style noscript template svg math iframe object select option textarea button".split())
RAW = set("script style textarea title noscript template iframe".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr img br input button select textarea".split())
QUIET = INLINE | UNSEEN                               # these break no block
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("html body article main section div aside nav header footer form table ul ol dl td th blockquote".split())

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
NAMING = ("class", "id", "role", "itemprop", "aria-label", "name")


class Page:
    """Elements in page order (0 is the page itself) and texts with breaks."""

    def __init__(self, html: str):
        self.tag, self.parent, self.depth = ["#page"], [-1], [0]
        self.words: list[tuple[str, ...]] = [()]
        self.given: list[str] = [""]                 # the data-y attribute of training pages
        self.own = [0]
        self.events: list[tuple[int, str] | None] = []
        self._stack = [0]
        # Where on the stack each tag is open, and elements that bound a search: all of
        # these, and without cells.  So the nearest of a tag is found without a walk.
        self._places: dict[str, list[int]] = {}
        self._bounds: dict[bool, list[int]] = {True: [], False: []}
        self._parse(html)

    def _open(self, tag: str, raw: str) -> None:
        stack = self._stack
        if tag not in QUIET and tag not in VOID:    # a block ends an open paragraph, with what is in it
            self._end("p", True)
        if tag in ITEMS:
            for name in ITEMS[tag]:
                self._end(name, False)
        words, given = [], ""
        for name, value in _ATTRIBUTE.findall(raw) if raw else ():
            name = name.lower()
            if name in NAMING:
                words += _WORD.findall(_CAMEL.sub(" ", value).lower())
            elif name == "data-y":
                given = value.strip("\"'")
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.depth.append(self.depth[stack[-1]] + 1)
        self.words.append(tuple(words))
        self.given.append(given)
        self.own.append(0)
        if tag not in QUIET:
            self.events.append(None)
        if tag == "br":
            self.events.append((stack[-1], " "))
        if tag not in VOID and not raw.endswith("/"):
            self._places.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                self._bounds[True].append(len(stack))
                if tag not in ("td", "th"):
                    self._bounds[False].append(len(stack))
            stack.append(len(self.tag) - 1)

    def _end(self, tag: str, cells: bool | None) -> None:
        """Close the nearest open ``tag``, unless an element of SCOPES is in between
        (without ``cells``: other than td and th; None: whatever is in between)."""
        places = self._places.get(tag)
        if not places:
            return
        at, stack = places[-1], self._stack
        if cells is not None and self._bounds[cells] and self._bounds[cells][-1] > at:
            return
        if any(self.tag[s] not in QUIET for s in stack[at:]):
            self.events.append(None)
        for s in stack[at:]:
            self._places[self.tag[s]].pop()
        for bounds in self._bounds.values():
            while bounds and bounds[-1] >= at:
                bounds.pop()
        del stack[at:]

    def _text(self, text: str) -> None:
        text = unescape(text)
        at = self._stack[-1]
        self.own[at] += len(text.strip())
        self.events.append((at, text))

    def _parse(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _MARK.search(html, at)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag = name.lower()
            if m[1] or m[4]:
                self._end(tag, None if tag in SCOPES else True)
                continue
            raw = (m[3] if m[2] else m[6]) or ""
            self._open(tag, raw)
            if tag in RAW and self._stack[-1] == len(self.tag) - 1:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = close.start() if close else n

    def text(self, kept: list[bool]) -> str:
        """The texts of kept elements: white space in a block as one blank, blocks by line breaks."""
        blocks, now = [], []
        for event in [*self.events, None]:
            if event is None:
                if now:
                    block = " ".join("".join(now).split())
                    if block:
                        blocks.append(block)
                    now = []
            elif kept[event[0]]:
                now.append(event[1])
        return "\n".join(blocks)
