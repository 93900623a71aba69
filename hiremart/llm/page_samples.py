"""Training pages with known parts, drawn from a seeded random grammar of common page layouts.

Elements carry ``data-y``: c (article), b (boilerplate) or m (holds both); unmarked elements have the
mark of the nearest marked ancestor. Words come from given texts, so they are like the corpus's.
"""

from __future__ import annotations

import random
from collections.abc import Callable

Part = Callable[[], str]


class Sampler:
    def __init__(self, words: list[str], seed: int) -> None:
        self.words, self.r = words or ["word"], random.Random(seed)

    def text(self, low: int, high: int) -> str:
        n = int(low * (high / low) ** self.r.random())
        out = [self.r.choice(self.words) for _ in range(n)]
        for i in range(n):
            if self.r.random() < 0.1:
                out[i] = out[i].rstrip(".,") + self.r.choice([".", ",", "&amp;"])
        return " ".join(out) + self.r.choice([".", ".", ""])

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def some(self, chance: float) -> bool:
        return self.r.random() < chance

    def named(self, tag: str, names: tuple[str, ...], mark: str, body: str, plain: float = 0.0) -> str:
        """An element with one of the names as class or id, or without any name at chance ``plain``."""
        attr = "" if self.some(plain) or not names else f' {self.pick("class", "class", "id")}="{self.pick(*names)}"'
        return f'<{tag}{attr} data-y="{mark}">{body}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.r.choice(self.words)}">{self.text(1, 4)}</a>' for _ in range(self.r.randint(low, high))]
        return self.pick("<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), "".join(items))

    def prose(self, low: int, high: int, count: int) -> str:
        return "".join(f"<p>{self.text(low, high)}</p>" for _ in range(self.r.randint(1, count)))

    # ---- boilerplate
    def menu(self) -> str:
        if self.some(0.6):
            return self.named("nav", ("nav", "navbar", "main-menu", "breadcrumb", "toc"), "b", self.links(2, 9), 0.6)
        return self.named(self.pick("div", "ul"), ("nav", "menu", "navigation", "breadcrumbs", "pagination", "top-nav", "tabs"),
                          "b", self.links(2, 9))

    def header(self) -> str:
        body = self.pick(f"<h1>{self.text(1, 5)}</h1>", f"<a href='/'>{self.text(1, 3)}</a>", f"<p>{self.text(2, 15)}</p>")
        body += self.links(2, 6) if self.some(0.5) else ""
        if self.some(0.6):
            return self.named("header", ("site-header", "masthead", "top"), "b", body, 0.6)
        return self.named("div", ("header", "masthead", "banner", "topbar", "site-header", "branding"), "b", body)

    def footer(self) -> str:
        body = self.pick(f"&copy; {self.text(1, 4)} &middot; {self.text(3, 25)}", self.prose(4, 40, 3), self.links(2, 8))
        if self.some(0.65):
            return self.named("footer", ("footer", "site-footer", "colophon"), "b", body, 0.7)
        return self.named("div", ("footer", "site-footer", "bottom", "copyright", "legal"), "b", body)

    def sidebar(self) -> str:
        body = f"<h3>{self.text(1, 4)}</h3>" * self.some(0.6) + self.pick(self.links(3, 10), self.prose(3, 60, 4))
        if self.some(0.6):
            return self.named("aside", ("sidebar", "related", "widget"), "b", body, 0.6)
        return self.named(self.pick("div", "section"), ("sidebar", "side", "related", "related-posts", "widget-area", "recommended",
                                                        "popular", "right-rail", "trending"), "b", body)

    def notice(self) -> str:
        body = self.pick(self.text(3, 60), self.prose(4, 60, 2)) + f"<button>{self.text(1, 2)}</button>" * self.some(0.5)
        tag = self.pick("div", "div", "section", "aside", "dialog", "p")
        return self.named(tag, ("cookie-banner", "cookie-notice", "consent", "gdpr", "notice", "alert", "alert-box", "modal", "popup",
                                "announcement", "privacy-notice", "cookies", "notification", "paywall"), "b",
                          self.text(3, 60) if tag == "p" else body)

    def advert(self) -> str:
        body = self.pick(self.text(2, 30), self.text(2, 30), f"<a href='/x'>{self.text(2, 12)}</a>", f"<p>{self.text(2, 40)}</p>")
        tag = self.pick("div", "div", "div", "aside", "section", "ins", "p")
        return self.pick("", "", f"<!-- ad {self.r.randint(0, 9)} -->") + self.named(
            tag, ("ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "promo", "sponsor", "banner-ad", "adsbox", "promotion",
                  "affiliate"), "b", self.text(2, 30) if tag == "p" else body)

    def form(self) -> str:
        body = f"<label>{self.text(1, 6)}</label><input name=q>" * self.r.randint(1, 3) + f"<button>{self.text(1, 2)}</button>"
        body = self.pick("", f"<p>{self.text(3, 25)}</p>", f"<h3>{self.text(1, 5)}</h3>") + body
        form = self.named("form", ("search", "newsletter", "signup", "login", "subscribe", "contact"), "b", body, 0.5)
        return form if self.some(0.6) else self.named("div", ("newsletter", "subscribe", "search-box", "signup"), "b", form)

    def comments(self) -> str:
        names = ("comment", "reply", "comment-body", "response")
        each = "".join(self.named(self.pick("div", "li", "article", "p"), names, "b", self.text(3, 90), 0.1)
                       for _ in range(self.r.randint(1, 6)))
        head = f"<h2>{self.text(1, 4)}</h2>" * self.some(0.6)
        return self.named(self.pick("section", "div", "ol", "aside"), ("comments", "comment-list", "discussion", "responses", "disqus_thread",
                                                                      "reader-comments", "replies", "user-comments"), "b", head + each)

    def share(self) -> str:
        return self.named(self.pick("div", "ul"), ("share", "social", "share-buttons", "tags", "social-links"), "b", self.links(2, 5))

    # ---- the article
    def inline(self, text: str) -> str:
        words = text.split(" ")
        for _ in range(self.r.randint(0, 3)):
            i = self.r.randrange(len(words))
            tag = self.pick("b", "i", "em", "strong", "a", "span", "code")
            words[i] = f"<{tag}{' href=/a' if tag == 'a' else ''}>{words[i]}</{tag}>"
        return " ".join(words)

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.62:
            return f"<p>{self.inline(self.text(1, 130))}" + self.pick("</p>", "</p>", "</p>", "")
        if kind < 0.70:
            return f"<p><b>{self.text(1, 60)}<br>"
        if kind < 0.78:
            level = self.pick("h2", "h2", "h3", "h4")
            return f"<{level}>{self.text(1, 9)}</{level}>"
        if kind < 0.84:
            return self.pick("<ul>", "<ol>") + "".join(f"<li>{self.inline(self.text(1, 25))}" for _ in range(self.r.randint(1, 6))) + "</ul></ol>"
        if kind < 0.89:
            return f"<blockquote>{self.pick(self.text(3, 50), self.prose(3, 50, 2))}</blockquote>"
        if kind < 0.92:
            rows = "".join("<tr>" + "".join(f"<td>{self.text(1, 5)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.r.randint(1, 4)))
            return f"<table>{rows}</table>"
        if kind < 0.95:
            return f"<figure><img src=x><figcaption>{self.text(2, 15)}</figcaption></figure>"
        if kind < 0.97:
            return f"<pre>{self.text(2, 30)}</pre>"
        return self.named(self.pick("div", "section"), ("text", "intro", "chapter", "paragraph", "section", "row"), "c",
                          self.pick(self.text(2, 60), self.prose(3, 80, 3)), 0.5)

    def article(self) -> str:
        count = self.pick("0", "1", "2", "5", "12", "25")
        parts = [f"<h1>{self.text(1, 12)}</h1>"] * self.some(0.85) + [self.block() for _ in range(int(count))]
        if not parts:
            parts = [f"<p>{self.text(1, 60)}</p>"]
        for part, chance in ((self.advert, 0.25), (self.share, 0.12), (self.form, 0.1), (self.sidebar, 0.1), (self.notice, 0.08), (self.menu, 0.06)):
            if self.some(chance):
                parts.insert(self.r.randint(0, len(parts)), part())
        for part, chance in ((self.header, 0.08), (self.footer, 0.12), (self.comments, 0.15)):
            if self.some(chance):
                parts.insert(0 if part == self.header else len(parts), part())
        body = "".join(parts)
        if self.some(0.65):
            return self.named("article", ("post", "article", "entry", "story", "hentry"), "c", body, 0.6)
        if self.some(0.3):
            return f'<main data-y="c">{body}</main>'
        return self.named(self.pick("div", "div", "section"), ("content", "post", "article", "entry-content", "post-content", "article-body",
                                                               "story", "main-content", "content-main", "post-body", "text"), "c", body)

    def page(self) -> str:
        before = [p() for p, chance in ((self.menu, 0.7), (self.header, 0.5), (self.notice, 0.35), (self.advert, 0.5), (self.form, 0.2),
                                        (self.sidebar, 0.2)) if self.some(chance)]
        after = [p() for p, chance in ((self.comments, 0.4), (self.sidebar, 0.4), (self.form, 0.25), (self.advert, 0.35), (self.notice, 0.3),
                                       (self.menu, 0.2), (self.share, 0.15)) if self.some(chance)]
        self.r.shuffle(before)
        self.r.shuffle(after)
        body = self.article()
        if self.some(0.3):  # the article shares a box with some of what follows it
            cut = self.r.randint(0, len(after))
            inner = body + "".join(after[:cut])
            body = self.pick('<main data-y="m">', '<div class="main" data-y="m">', '<div id="content" data-y="m">',
                             '<div class="container" data-y="m">', '<div data-y="m">')
            body += inner + ("</main>" if body.startswith("<main") else "</div>")
            after = after[cut:]
        whole = "".join(before) + body + "".join(after) + (self.footer() if self.some(0.75) else "")
        if self.some(0.3):
            whole = f'<div{self.pick("", " class=wrapper", " id=page", " class=container")} data-y="m">{whole}</div>'
        head = f'<head data-y="b"><meta charset="utf-8"><title>{self.text(2, 9)}</title><style>p{{margin:0}}</style></head>'
        return f'<!DOCTYPE html><html lang="en" data-y="m">{head}<body data-y="m">{whole}' + self.pick("</body></html>", "")
