"""Labelled pages that the main-text model is trained on by default.

A page is a layout of parts. Parts that are main text are marked
data-main="1", the others "0"; their texts are plain sentences of varied
length, so that a part's place, names, size and links tell what it is, and
not its words. Real marked pages can be used instead (``main_text.train``).
"""

from __future__ import annotations

import random
import re

_WORDS = (
    "the river runs past old mills and farms where people once made paper "
    "and cloth in spring water rises over fields while boats wait near the "
    "stone bridge for trade to begin again after long winters of snow"
).split()


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(_WORDS) for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(4, 18).capitalize() + "." for _ in range(self.r.randint(low, high)))

    def link(self) -> str:
        return f'<a href="/{self.r.choice(_WORDS)}">{self.words(1, 3)}</a>'

    def links(self, low: int, high: int) -> str:
        return "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(low, high)))

    # what is not main text
    def nav(self) -> str:
        inner = self.r.choice([f"<ul>{self.links(3, 9)}</ul>", " | ".join(self.link() for _ in range(5)), f"<div><ul>{self.links(3, 6)}</ul></div>"])
        return self.r.choice([f'<nav data-main="0">{inner}</nav>', f'<div class="menu" data-main="0">{inner}</div>', f'<div id="navigation" class="navbar" data-main="0">{inner}</div>', f'<ul class="menu nav" data-main="0">{self.links(4, 8)}</ul>'])

    def header(self) -> str:
        brand = self.r.choice([f"<h1>{self.words(1, 3)}</h1>", f'<a class="logo" href="/">{self.words(1, 2)}</a>', f"<p>{self.words(3, 8)}</p>", f"<h2>{self.words(1, 3)}</h2>"])
        return self.r.choice([f'<header data-main="0">{brand}{self.words(0, 4)}</header>', f'<div class="header" data-main="0">{brand}</div>', f'<div id="masthead" class="site-header banner" data-main="0">{brand}{self.nav()}</div>'])

    def footer(self) -> str:
        text = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2)}", f"<p>&copy; {self.words(2, 6)}</p>", f"<p>{self.sentences(1, 3)}</p><ul>{self.links(2, 6)}</ul>", self.sentences(1, 2)])
        return self.r.choice([f'<footer data-main="0">{text}</footer>', f'<footer data-main="0">{text}</footer>', f'<div class="footer" data-main="0">{text}</div>', f'<div id="site-footer" data-main="0">{text}</div>'])

    def advert(self) -> str:
        name = self.r.choice(["ad", "ads", "advert", "advertisement", "ad banner", "sponsored", "promo", "ad-slot", "sponsor"])
        text = self.r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>", f"{self.link()} {self.sentences(1, 1)}", f"<span>{self.words(2, 9)}</span>"])
        tag = self.r.choice(["div", "div", "div", "aside", "section", "p", "ins"])
        return f'<{tag} class="{name}" data-main="0">{text}</{tag}>'

    def notice(self) -> str:
        name = self.r.choice(["cookie", "cookie-notice", "notice", "consent", "alert", "popup", "newsletter", "subscribe", "gdpr banner", "cookie-banner", "modal", "warning notice", "paywall"])
        return f'<div class="{name}" data-main="0">{self.r.choice(["", "<p>"])}{self.sentences(1, 3)}{self.r.choice(["", "<button>OK</button>", self.link()])}</div>'

    def sidebar(self) -> str:
        inner = "".join(self.r.choice([f"<h3>{self.words(1, 3)}</h3><ul>{self.links(3, 8)}</ul>", f"<p>{self.sentences(1, 2)}</p>", f"<div>{self.link()}<p>{self.words(5, 20)}</p></div>"]) for _ in range(self.r.randint(1, 3)))
        name = self.r.choice(["sidebar", "related", "widget", "sidebar right", "related-posts", "recommended", "trending", "tags"])
        return self.r.choice([f'<aside data-main="0">{inner}</aside>', f'<aside class="{name}" data-main="0">{inner}</aside>', f'<div class="{name}" data-main="0">{inner}</div>', f'<div id="{name.split()[0]}" data-main="0">{inner}</div>'])

    def comments(self) -> str:
        one = "".join(self.r.choice([f'<div class="comment"><p>{self.sentences(1, 4)}</p></div>', f"<li><b>{self.words(1, 1)}</b><p>{self.sentences(1, 3)}</p></li>", f'<article class="comment"><p>{self.sentences(1, 4)}</p></article>', f"<p>{self.sentences(1, 4)}</p>"]) for _ in range(self.r.randint(1, 4)))
        name = self.r.choice(["comments", "comment-list", "responses", "discussion", "reader-comments", "replies"])
        tag = self.r.choice(["div", "section", "ol", "ul"])
        return f'<{tag} {self.r.choice(["class", "id"])}="{name}" data-main="0">{self.r.choice(["", "<h2>" + self.words(1, 3) + "</h2>"])}{one}</{tag}>'

    def crumbs(self) -> str:
        name = self.r.choice(["breadcrumb", "breadcrumbs", "share", "social", "share-buttons", "pagination", "toolbar", "meta", "byline"])
        return f'<div class="{name}" data-main="0">{" ".join(self.link() for _ in range(self.r.randint(2, 4)))}</div>'

    # main text
    def paragraph(self) -> str:
        text = self.sentences(1, 6)
        kind = self.r.random()
        if kind < 0.15:
            text = f"<b>{self.words(2, 8)}</b> {text}"
        elif kind < 0.3:
            text = f"{text} {self.link()} {self.sentences(1, 2)}"
        elif kind < 0.4:
            text = f"<em>{self.words(1, 5)}</em>, {text}"
        elif kind < 0.45:
            return f"<p><b>{text}<br>"
        elif kind < 0.5:
            text = f"{self.words(1, 2).capitalize()}."
        return f"<p>{text}</p>"

    def article(self) -> str:
        parts = [self.r.choice([f"<h1>{self.words(2, 9)}</h1>", f"<h1>{self.words(2, 9)}</h1>", f"<h2>{self.words(2, 9)}</h2>", ""])]
        for _ in range(self.r.randint(1, 9)):
            kind = self.r.random()
            if kind < 0.7:
                parts.append(self.paragraph())
            elif kind < 0.76:
                parts.append(f"<h2>{self.words(1, 6)}</h2>")
            elif kind < 0.8:
                parts.append("<ul>" + "".join(f"<li>{self.words(3, 14)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.84:
                parts.append(f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>")
            elif kind < 0.87:
                parts.append(f"<pre><code>{self.words(4, 20)}</code></pre>")
            elif kind < 0.9:
                parts.append(f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>")
            elif kind < 0.93:
                parts.append(f"<div>{self.sentences(1, 4)}</div>")
            else:
                parts.append(self.r.choice([self.advert, self.sidebar, self.crumbs, self.notice])())
        if self.r.random() < 0.35:
            return self.bare(parts)
        inner = "".join(parts)
        opened = self.r.choice(
            ["<article>", "<article>", "<article>", "<main>", '<div class="content">', '<div id="content" class="post">', '<div class="article-body">', '<main id="main"><article class="post entry">', '<section class="story">', '<div class="entry-content">', '<main><div class="text">', '<div id="main">']
        )
        tags = [t.split()[0].strip("<>") for t in opened.split("<")[1:]]
        marked = opened.replace("<" + tags[-1], f'<{tags[-1]} data-main="1"', 1) if len(tags) == 1 else opened[::-1].replace(f"<{tags[-1]}"[::-1], f'<{tags[-1]} data-main="1"'[::-1], 1)[::-1]
        return marked + inner + "".join(f"</{t}>" for t in reversed(tags))

    def form(self) -> str:
        fields = "".join(self.r.choice([f"<label>{self.words(1, 2)}</label><input>", "<textarea></textarea>", f"<p>{self.sentences(1, 2)}</p>", self.words(2, 6)]) for _ in range(self.r.randint(1, 4)))
        name = self.r.choice(["", ' class="search"', ' id="contact-form"', ' class="signup"', ' class="login form"'])
        return f'<form{name} data-main="0">{fields}<input type="submit"></form>'

    def bare(self, parts: list[str]) -> str:
        """The article without an element of its own that names it: its parts
        beside the others, in a plain wrapper, a table's cell, or as text."""
        marked = [p if "data-main" in p[: p.find(">") + 1] else re.sub(r"^<(\w+)", r'<\1 data-main="1"', p) for p in parts if p]
        kind = self.r.random()
        if kind < 0.4:
            return "".join(marked)
        if kind < 0.55:
            wrap = self.r.choice(["<div>", '<div class="container">', '<div class="row">', '<div class="wrap inner">', "<center>", '<div id="page">'])
            return f"{wrap}{''.join(marked)}</{wrap[1:].split()[0].strip('>')}>"
        if kind < 0.7:
            links = [self.link() for _ in range(self.r.randint(2, 8))]
            side = self.r.choice(["", f'<td width="20%" data-main="0">{self.links(3, 8)}</td>', f'<td valign="top" data-main="0">{" ".join(links)}</td>', f'<td data-main="0">{"<br>".join(links)}</td>'])
            cell = self.r.choice(["<td>", '<td valign="top">', '<td width="80%">'])
            return f"<table><tr>{side}{cell}{''.join(marked)}</td></tr></table>"
        if kind < 0.85:
            tag = self.r.choice(["font", "center", "div", "div"])
            text = self.r.choice(["<br><br>", "<br>\n<br>"]).join(self.sentences(2, 6) for _ in range(self.r.randint(2, 6)))
            return f'<{tag} data-main="1">{text}</{tag}>'
        # the page's body holds the text itself
        self.body = ' data-main="1"'
        return self.r.choice(["<br><br>", "<hr>", "\n<br>"]).join(self.sentences(2, 6) for _ in range(self.r.randint(2, 6)))

    def page(self) -> str:
        self.body = ""
        before = [self.r.choice([self.header, self.nav, self.advert, self.notice, self.crumbs, self.form])() for _ in range(self.r.randint(0, 4))]
        after = [self.r.choice([self.sidebar, self.comments, self.advert, self.notice, self.nav, self.crumbs, self.form])() for _ in range(self.r.randint(0, 3))]
        after += [self.footer()] if self.r.random() < 0.9 else []
        body = "".join([*before, self.article(), *after])
        if not self.body and self.r.random() < 0.1:  # one form around all
            body = f'<form action="/" method="post">{body}</form>'
        if not self.body and self.r.random() < 0.4:
            body = f'<div class="{self.r.choice(["wrapper", "container", "page", "row"])}">{body}</div>'
        end = "</body></html>" if self.r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style></head><body{self.body}>{body}{end}"


def labelled_pages(n: int = 1500, seed: int = 1) -> list[str]:
    return [_Writer(seed * 1_000_003 + i).page() for i in range(n)]
