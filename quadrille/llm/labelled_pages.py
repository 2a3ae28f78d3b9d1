"""Labelled pages to train the extractor: seeded random layouts whose blocks are known to be content or not."""

from __future__ import annotations

import random

SYLLABLES = ["th", "er", "on", "an", "re", "in", "de", "ou", "el", "ch", "ti", "la", "ge", "ver", "men", "ist", "os", "ar", "ul", "é"]
JUNK = ["Accept all cookies", "We use cookies to improve this site", "Subscribe to our newsletter", "Share this", "Log in", "Sign up", "Menu", "Search", "Privacy policy", "Terms of use", "All rights reserved", "Advertisement", "Sponsored", "Related posts", "Read more", "Contact us", "Follow us", "Leave a reply", "Skip to content"]


class Maker:
    """One page: ``html`` grows, ``labels`` holds (text, is content) of its blocks in order."""

    def __init__(self, rng: random.Random):
        self.rng, self.html, self.labels = rng, [], []
        self.named = rng.random() < 0.75  # the others carry no telling class names
        self.symbols = rng.choice([["%%%", "***", "###", "$$$", "&&&"], [" |", " |", ","], [" -", ""]]) if rng.random() < 0.25 else []

    def words(self, a: int, b: int) -> str:
        out = ["".join(self.rng.choices(SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(self.rng.randint(a, b))]
        return " ".join(w + self.rng.choice(self.symbols) for w in out) if self.symbols else " ".join(out)

    def sentences(self, a: int, b: int) -> str:
        return " ".join(self.words(4, 18).capitalize() + self.rng.choice([".", ".", ",", "?"]) for _ in range(self.rng.randint(a, b)))

    def open(self, tag: str, *names: str) -> None:
        name = self.rng.choice(names) if names and self.named else f"c{self.rng.randint(1, 99)}" if self.rng.random() < 0.5 else ""
        self.html.append(f'<{tag} {self.rng.choice(["class", "id"])}="{name}">' if name else f"<{tag}>")

    def block(self, tag: str, text: str, content: bool, inner: str | None = None) -> None:
        self.html.append(f"<{tag}>{inner or text}</{tag}>")
        self.labels.append((text, content))

    def links(self, n: int) -> None:
        for _ in range(n):
            text = self.rng.choice([self.words(1, 4), self.rng.choice(JUNK)])
            self.block("li", text, False, f'<a href="/x">{text}</a>')

    def part(self, kind: str) -> None:
        r = self.rng
        if kind == "header":
            tag = r.choice(["header", "div"])
            self.open(tag, "header", "site-header", "masthead", "topbar")
            self.block(r.choice(["div", "p", "h1", "h2"]), self.words(1, 5), False)
            if r.random() < 0.5:
                self.block("p", self.words(2, 9), False)
        elif kind == "menu":
            tag = r.choice(["nav", "nav", "div"])
            self.open(tag, "nav", "menu", "navbar", "breadcrumb", "navigation")
            self.html.append("<ul>")
            self.links(r.randint(2, 9))
            self.html.append("</ul>")
        elif kind == "notice":
            tag = "div"
            self.open(tag, "cookie-notice", "cookie banner", "consent", "notice", "alert popup")
            self.block("p", r.choice(JUNK[:3]) + " " + self.sentences(0, 2), False)
            self.block("button", r.choice(["OK", "Accept", "Close"]), False)
        elif kind == "advert":
            tag = r.choice(["div", "aside"])
            self.open(tag, "ad", "ads", "advert", "sponsored", "banner promo")
            if r.random() < 0.5:
                text = self.sentences(1, 3)
                self.html.append(text)
                self.labels.append((text, False))
            else:
                self.block("p", self.sentences(1, 3), False)
        elif kind == "sidebar":
            tag = r.choice(["aside", "div"])
            self.open(tag, "sidebar", "widget", "related", "side-bar recent")
            self.block(r.choice(["h3", "h4"]), r.choice([self.words(1, 4), *JUNK[13:15]]), False)
            if r.random() < 0.6:
                self.html.append("<ul>")
                self.links(r.randint(2, 6))
                self.html.append("</ul>")
            else:
                self.block("p", self.sentences(1, 4), False)
        elif kind == "form":
            tag = "form"
            self.open(tag, "newsletter", "search", "login form", "subscribe")
            self.block("p", r.choice(JUNK) + " " + self.words(0, 6), False)
            self.block("button", r.choice(["Send", "Go", "Subscribe"]), False)
        elif kind == "comments":
            tag = r.choice(["section", "div", "ol"])
            self.open(tag, "comments", "comment-list", "responses", "discussion comments")
            if r.random() < 0.7:
                self.block("h3", f"{r.randint(1, 40)} " + r.choice(["comments", "responses", "replies"]), False)
            for _ in range(r.randint(1, 4)):
                self.open("div", "comment", "reply", "comment-body")
                self.block("p", self.words(1, 2), False)
                self.block("p", self.sentences(1, 5), False)
                self.html.append("</div>")
        else:
            tag = r.choice(["footer", "footer", "div"])
            self.open(tag, "footer", "site-footer", "copyright", "bottom")
            text = f"© {self.words(1, 3)} · " + r.choice([self.words(2, 9), *JUNK])
            if r.random() < 0.5:
                self.html.append(text)
                self.labels.append((text, False))
            else:
                self.block("p", text, False)
        self.html.append(f"</{tag}>")

    def article(self) -> None:
        r = self.rng
        tag = r.choice(["article", "article", "main", "div", "section"])
        self.open(tag, "content", "article", "post-body", "entry-content", "main story")
        if r.random() < 0.85:
            self.block("h1", self.words(2, 12), True)
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.72:
                self.block("p", self.sentences(1, 6), True)
            elif kind < 0.8:
                self.block(r.choice(["h2", "h3"]), self.words(1, 7), True)
            elif kind < 0.86:
                self.block("blockquote", self.sentences(1, 3), True)
            elif kind < 0.92:
                self.html.append("<ul>")
                for _ in range(r.randint(2, 4)):
                    self.block("li", self.words(2, 14), True)
                self.html.append("</ul>")
            elif kind < 0.97:
                self.block("p", self.words(1, 3) + "." if r.random() < 0.6 else self.words(5, 40), True)
            else:
                self.part("advert")
        self.html.append(f"</{tag}>")


def labelled_pages(n: int = 600, seed: int = 11) -> list[tuple[str, list[tuple[str, bool]]]]:
    """``n`` pages with the texts and labels of their blocks."""
    rng, pages = random.Random(seed), []
    for _ in range(n):
        m = Maker(rng)
        before = [k for k in ("header", "menu", "notice", "advert", "sidebar", "form") if rng.random() < 0.4]
        after = [k for k in ("advert", "sidebar", "form", "comments", "menu", "notice") if rng.random() < 0.35]
        rng.shuffle(before)
        rng.shuffle(after)
        wrap = rng.random() < 0.4
        if wrap:
            m.open("div", "wrapper", "container", "page")
        for k in before:
            m.part(k)
        m.article()
        for k in after:
            m.part(k)
        if rng.random() < 0.8:
            m.part("footer")
        pages.append(("<html><body>" + "".join(m.html) + ("</div>" if wrap else "") + "</body></html>", m.labels))
    return pages
