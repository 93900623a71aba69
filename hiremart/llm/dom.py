"""A light DOM of a page as flat lists, and features of its elements.

Elements are numbered in page order, so a subtree is a stretch of numbers and sums over subtrees are
differences of running sums. Unclosed elements end where HTML ends them: a paragraph before the next
block, an item before the next item, anything else with its parent. Malformed or cut-off pages give
the elements that can be read; there is no limit on length or depth.
"""

from __future__ import annotations

import re

import numpy as np

_RAW = "script|style|noscript|template|textarea|iframe|svg|title|select"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?<=/)>"  # foreign elements can close themselves
    r"|<(?P<raw>" + _RAW + r")(?=[\s/>]|\Z)(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>?.*?(?:</(?P=raw)\s*>|\Z)"
    # What only old browsers show; without an end tag these are elements like others, not all the rest of the page.
    r"|<(?P<old>object|canvas)(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>(?:(?!<(?P=old)[\s/>]).)*?</(?P=old)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<(?=[a-zA-Z])[^>]*\Z", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big canvas cite code data del dfn em font i ins kbd label mark object q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
#: What closes an open element of the same kind.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tbody thead tfoot body html".split())

# Kinds of tags and of attribute tokens whose presence is a feature; fixed values.
TAG_KINDS = {
    "article": "article main", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside",
    "form": "form input button fieldset label", "heading": "h1 h2 h3 h4 h5 h6", "paragraph": "p blockquote pre",
    "list": "ul ol li dl dt dd", "table": "table tr td th tbody thead", "box": "div section", "head": "head", "root": "html body",
    "dialog": "dialog",
}
TOKEN_KINDS = {
    "content": "article content post entry story body text main page single prose markdown hentry",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs tabbar skip links toolbar",
    "edge": "header masthead footer topbar bottom colophon banner branding logo copyright legal hero",
    "side": "sidebar side aside rail widget related recommended recommendations popular trending more widgets",
    "notice": "cookie cookies consent notice gdpr alert warning message modal popup overlay dialog toast announcement "
              "privacy notification paywall",
    "advert": "ad ads advert advertisement advertising adsbox adslot sponsor sponsored promo promotion banner dfp "
              "outbrain taboola affiliate",
    "form": "form search login signin signup subscribe subscription newsletter contact input register",
    "comment": "comment comments reply replies discussion disqus respond responses commentlist thread feedback",
    "share": "share sharing social follow tags byline author meta metadata tools buttons rating",
    "frame": "wrapper wrap container layout site app root outer row col column grid inner",
}
_TAG_BIT = {tag: 1 << n for n, tags in enumerate(TAG_KINDS.values()) for tag in tags.split()}
_TOKEN_BIT: dict[str, int] = {}
for _n, _tokens in enumerate(TOKEN_KINDS.values()):
    for _token in _tokens.split():
        _TOKEN_BIT[_token] = _TOKEN_BIT.get(_token, 0) | 1 << _n


class Page:
    """Elements (tag, attrs, parent, end) and text segments ((element, text), element -1: a break)."""

    def __init__(self, html: str) -> None:
        self.tag, self.attrs, self.parent, self.end = ["#page"], [""], [-1], [0]
        self.segments: list[tuple[int, str]] = []
        self._open, self._count = [0], {}
        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                self.segments.append((self._open[-1], html[at:m.start()]))
            at = m.end()
            name = m["tag"] or m["tag2"]
            if name:
                name = name.lower()
                if name not in INLINE:
                    self.segments.append((-1, " "))
                if m["end"] or m["end2"]:
                    self._close(name)
                else:
                    self._start(name, m["attrs"] or m["attrs2"] or "")
        if at < len(html):
            self.segments.append((self._open[-1], html[at:]))
        while self._open:
            self._pop()

    def _pop(self) -> str:
        node = self._open.pop()
        self.end[node] = len(self.tag)
        tag = self.tag[node]
        self._count[tag] = self._count.get(tag, 1) - 1
        return tag

    def _close(self, name: str) -> None:
        if self._count.get(name, 0) > 0:
            while self._pop() != name:
                pass

    def _start(self, name: str, attrs: str) -> None:
        if name in SIBLINGS and any(self._count.get(s, 0) for s in SIBLINGS[name]):
            wanted = SIBLINGS[name]
            for back in range(len(self._open) - 1, 0, -1):
                tag = self.tag[self._open[back]]
                if tag in wanted:
                    while len(self._open) > back:
                        self._pop()
                    break
                if tag in SCOPES:
                    break
        if name not in INLINE and name not in VOID and self._count.get("p", 0) > 0:
            back = len(self._open) - 1
            while self.tag[self._open[back]] in INLINE:
                back -= 1
            if self.tag[self._open[back]] == "p":
                while len(self._open) > back:
                    self._pop()
        if name in VOID:
            return
        self.tag.append(name)
        self.attrs.append(attrs)
        self.parent.append(self._open[-1])
        self.end.append(0)
        if not attrs.endswith("/") or name in TAG_ALL:
            self._open.append(len(self.tag) - 1)
            self._count[name] = self._count.get(name, 0) + 1
        else:
            self.end[-1] = len(self.tag)


TAG_ALL = INLINE | frozenset(_TAG_BIT)


def token_bits(attrs: str) -> int:
    """The kinds of tokens in class, id, role and the like."""
    if not attrs or "=" not in attrs:
        return 0
    bits = 0
    for groups in _NAMED.findall(attrs):
        for word in _WORDS.findall("".join(groups)):
            bits |= _TOKEN_BIT.get(word.lower(), 0)
    return bits


def features(pages: list[Page]) -> np.ndarray:
    """One row for each element of all pages, in order."""
    tag = np.array([_TAG_BIT.get(t, 0) for p in pages for t in p.tag])
    cache: dict[str, int] = {}
    for p in pages:
        for a in p.attrs:
            if a not in cache:
                cache[a] = token_bits(a)
    token = np.array([cache[a] for p in pages for a in p.attrs])
    sizes = np.array([len(p.tag) for p in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    total = len(tag)
    own = np.arange(total)
    end = np.array([e for p in pages for e in p.end]) + base
    parent = np.array([x for p in pages for x in p.parent])
    root = parent < 0
    parent = np.where(root, own, parent + base)
    link = np.array([t == "a" for p in pages for t in p.tag])
    chars, stops = np.zeros(total), np.zeros(total)
    start = 0
    for p, n in zip(pages, sizes.tolist()):
        for node, text in p.segments:
            if node >= 0:
                chars[start + node] += len(text.strip())
                stops[start + node] += text.count(".") + text.count(",")
        start += n

    def below(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(x)])
        return sums[end] - sums[own]

    def inside(marked: np.ndarray) -> np.ndarray:
        """Whether a proper ancestor is marked."""
        steps = np.zeros(total + 1)
        np.add.at(steps, own[marked], 1)
        np.add.at(steps, end[marked], -1)
        return np.cumsum(steps)[:-1] - marked > 0

    in_link = inside(link) | link
    size, links, stop, elements = below(chars), below(chars * in_link), below(stops), end - own
    depth_steps = np.zeros(total + 1)
    np.add.at(depth_steps, own, 1)
    np.add.at(depth_steps, end, -1)
    depth = np.cumsum(depth_steps)[:-1]
    children = np.bincount(parent[~root], minlength=total).astype(float)
    kids_chars = np.bincount(parent[~root], size[~root], minlength=total)
    order = own - parent
    siblings = children[parent]
    page_size = size[base]
    columns = [
        np.log1p(size), np.log1p(chars), links / (size + 1), stop / (size + 1), np.log1p(size / elements),
        np.log1p(elements), depth, np.log1p(siblings), order / np.maximum(elements[parent], 1),
        np.log1p(np.where(siblings > 1, (kids_chars[parent] - size) / np.maximum(siblings - 1, 1), 0)),
        size / (page_size + 1), size / (size[parent] + 1), np.log1p(children), (own - base) / np.repeat(sizes, sizes),
    ]
    for n in range(len(TAG_KINDS)):
        has = (tag >> n & 1) > 0
        columns += [has, inside(has)]
        if n == 0 or n == 7:  # articles and paragraphs inside
            columns.append(np.minimum(below(has) - has, 5))
    for n in range(len(TOKEN_KINDS)):
        has = (token >> n & 1) > 0
        columns += [has, inside(has)]
        if n == 0:
            columns.append(np.minimum(below(has) - has, 5))
    columns.append(np.isin(np.concatenate([p.tag for p in pages]), list(INLINE)))
    return np.stack(columns, 1).astype(np.float32)
