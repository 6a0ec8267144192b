"""The text lines of one web page, with what its markup says about them.

A line is the text of a block, character references decoded and white space
made single. Elements that are page furniture by their tag, their class, id or
role (menus, footers, adverts, reader comments ...) or that are not shown at
all give no lines. A page that marks its article (``article``, or a class, id
or property for an article's body) gives the article's lines, which are *sure*,
and those of its ``main`` element outside of it; a page with a ``main`` alone
gives that, any other page everything. Lines that are not sure may still be
furniture without a name; comparing pages tells (see :mod:`page_diff`).

Markup is read as browsers do where it matters here: a new block ends an open
paragraph, list items and cells end each other, stray end tags are ignored, and
what a page leaves open ends with it. The time follows the length of a page, also
of one written to be slow.
"""

from __future__ import annotations

import html
import re
from collections import Counter

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")

# The tags of HTML by what they mean for text.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNSEEN = {"head", "template", "svg", "object", "select", "button", "canvas", "audio", "video", "datalist", "dialog"}
FURNITURE_TAGS = {"nav", "footer", "aside", "form", "header", "fieldset", "menu"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "link", "mark", "meta", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

# Names in classes, ids and roles of what is not the article, and
# of what is.
FURNITURE = set(
    "ad ads adsense advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment commentlist comments "
    "complementary consent contentinfo cookie cookies copyright disqus disclaimer footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification notifications overlay pager pagination popup promo promotion recommendations "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar topbar widget widgets".split())
ARTICLE_NAMES = {"article", "articlebody", "article-body", "article-content", "article-text", "blogpost", "entry-content", "post-body",
                 "post-content", "story-body"}
MAIN_NAMES = {"main", "content", "main-content"}  # ids only
OF_ARTICLE = {"article", "post", "entry", "story", "content"}
NEGATED = {"has", "no", "not", "with", "without", "is"}

#: How far up an inline end tag is matched.
DEEP = 64


def _furniture_name(name: str) -> bool:
    parts = [p.lower() for p in PART.findall(name)]
    if not parts or parts[0] in NEGATED:
        return False
    if len(parts) > 1 and parts[0] in OF_ARTICLE and parts[-1] == "header":
        return False
    return parts[0] in FURNITURE or parts[-1] in FURNITURE or "".join(parts) in FURNITURE


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): (v[1:-1] if v[:1] in "\"'" else v) for k, v in reversed(ATTRIBUTE.findall(text))}


class _Page:
    """Reads a page into segments ``(line, text, furniture, zone)``.

    ``furniture`` numbers the innermost furniture element around a segment (-1
    for none) and ``zone`` the innermost article or main element."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, int]] = []  # name, times unseen, furniture, zone
        self.open: Counter[str] = Counter()
        self.furniture: list[int] = []  # the furniture element around each
        self.zones: list[tuple[str, int, int]] = []  # kind, furniture around, zone around
        self.segments: list[tuple[int, str, int, int]] = []
        self.line = 0

    def read(self, page: str) -> None:
        at, endless = 0, set()
        while True:
            token = TOKEN.search(page, at)
            self._text(page[at:token.start()] if token else page[at:])
            if token is None:
                return
            at = token.end()
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if token[1]:
                self._end(name)
                continue
            if name in RAW:
                close = None if name in endless else re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                if close:
                    at = close.end()
                elif name in ("script", "style"):
                    return
                else:
                    endless.add(name)  # looked for once
                self._break(name)
                continue
            self._start(name, token[3])

    def _top(self) -> tuple[str, int, int, int]:
        return self.stack[-1] if self.stack else ("", 0, -1, -1)

    def _text(self, text: str) -> None:
        _, unseen, furniture, zone = self._top()
        if text and not unseen:
            self.segments.append((self.line, html.unescape(text) if "&" in text else text, furniture, zone))

    def _break(self, name: str) -> None:
        if name not in INLINE:
            self.line += 1

    def _pop_to(self, names: set[str], stop: set[str]) -> None:
        """Ends the nearest open element of ``names`` with all in it, unless one of ``stop`` is nearer."""
        if not any(self.open[n] for n in names):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                for gone in self.stack[k:]:
                    self.open[gone[0]] -= 1
                del self.stack[k:]
                return
            if self.stack[k][0] in stop:
                return

    def _start(self, name: str, attributes: str) -> None:
        self._break(name)
        if name not in INLINE and self.open["p"]:
            self._pop_to({"p"}, set())
        if name in ENDS:
            self._pop_to(*ENDS[name])
        if name in VOID:
            return
        _, unseen, furniture, zone = self._top()
        kind = name if name in ("article", "main") else None
        named = name in FURNITURE_TAGS and not (name == "header" and zone >= 0 and self.zones[zone][0] == "article")
        unseen += name in UNSEEN
        if attributes and not attributes.isspace():
            given = _attributes(attributes)
            unseen += "hidden" in given or given.get("aria-hidden") == "true" or re.search(
                r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "")) is not None
            if name not in ("html", "body"):
                own = [*given.get("class", "").split(), given.get("id", ""), *given.get("role", "").split()]
                named = named or any(map(_furniture_name, own))
                lower = {n.lower() for n in own}
                if lower & ARTICLE_NAMES or given.get("itemprop", "").lower() == "articlebody":
                    kind = "article"
                elif kind is None and (given.get("id", "").lower() in MAIN_NAMES or given.get("role", "").lower() == "main"):
                    kind = "main"
        if named:
            self.furniture.append(furniture)
            furniture = len(self.furniture) - 1
        if kind:
            self.zones.append((kind, furniture, zone))
            zone = len(self.zones) - 1
        self.stack.append((name, unseen, furniture, zone))
        self.open[name] += 1

    def _end(self, name: str) -> None:
        self._break(name)
        if self.open[name]:
            # An inline end tag ends nothing beyond its block, nor ``DEEP`` elements up.
            if name not in INLINE:
                self._pop_to({name}, set())
            else:
                for k in range(len(self.stack) - 1, max(len(self.stack) - 1 - DEEP, -1), -1):
                    if self.stack[k][0] == name:
                        self.open[name] -= 1
                        del self.stack[k]
                        break
                    if self.stack[k][0] not in INLINE:
                        break


def _lines(segments: list[tuple[int, str, int, int]], sure: list[bool]) -> list[tuple[str, bool]]:
    """The segments' lines, without empty ones."""
    out, start = [], 0
    for k in range(1, len(segments) + 1):
        if k == len(segments) or segments[k][0] != segments[start][0]:
            text = " ".join("".join(part for _, part, *_ in segments[start:k]).split())
            if text:
                out.append((text, all(sure[start:k])))
            start = k
    return out


def lines_of(page: str | None) -> list[tuple[str, bool]]:
    """``(line, sure)`` for the lines of a page that may be of its article, in order."""
    read = _Page()
    read.read(page or "")
    # Whether a zone lies in a clean article or a clean main, itself included; zones follow those around them.
    in_article, in_main = [], []
    for kind, furniture, around in read.zones:
        in_article.append(furniture < 0 and kind == "article" or around >= 0 and in_article[around])
        in_main.append(furniture < 0 and kind == "main" or around >= 0 and in_main[around])
    clean = [s for s in read.segments if s[2] < 0]
    sure = [s[3] >= 0 and in_article[s[3]] for s in clean]
    marked = [s[3] >= 0 and (in_article[s[3]] or in_main[s[3]]) for s in clean]
    found = _lines([s for s, m in zip(clean, marked) if m], [a for a, m in zip(sure, marked) if m])
    if found:
        return found
    # Furniture around a whole article (a form, a wrapper of that name) is none.
    size = Counter()
    for _, part, furniture, zone in read.segments:
        if furniture >= 0 and zone >= 0 and read.zones[zone][1] == furniture:
            size[zone] += len(part)
    best = max(size, key=size.get, default=None)
    if best is not None and size[best] > sum(len(part) for _, part, *_ in clean):
        held, around = [], read.zones[best][1]
        for number, (_, furniture, outer) in enumerate(read.zones):
            held.append(number == best or furniture == around and outer >= 0 and held[outer])
        own = [s for s in read.segments if s[2] == around and s[3] >= 0 and held[s[3]]]
        return _lines(own, [True] * len(own))
    return _lines(clean, [False] * len(clean))
