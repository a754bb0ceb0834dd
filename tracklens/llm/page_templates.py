"""Training pages with known main text, laid out anew from the texts of given pages.

Given pages carry no labels. Their texts (blocks of all kinds) are dealt into layouts
of many kinds, so the extractor learns where main text stands and how it is marked,
not what it says. ``data-main`` marks what belongs to the article (1) or not (0).
"""

from __future__ import annotations

import html
import random

# Words that sites use in class and id attributes.
_MAIN = "content article post entry story body text main page single prose"
_BOILER = {
    "nav": "nav menu navbar navigation breadcrumbs topbar tabs links",
    "header": "header masthead branding banner logo top site",
    "footer": "footer bottom copyright colophon legal credits",
    "aside": "sidebar aside widget rail secondary column related recommended trending popular",
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion adsense dfp",
    "notice": "notice cookie cookies consent alert message gdpr privacy popup modal overlay warning banner",
    "form": "form newsletter subscribe signup login search contact",
    "comments": "comments comment discussion replies respond disqus commentlist reader responses",
    "share": "share social sharing follow toolbar meta tags author",
}
_TAGS = {"nav": ("nav", "nav", "div", "ul"), "header": ("header", "header", "div"), "footer": ("footer", "footer", "div"), "aside": ("aside", "aside", "div", "section"), "form": ("form",), "comments": ("section", "div", "div")}
_PLAIN = "wrap container inner outer box block row col grid item section group clearfix module left right center"


class Layout:
    """One random page from lists of texts (long ones and short ones)."""

    def __init__(self, long: list[str], short: list[str], seed: int):
        self.rng = random.Random(seed)
        self.long, self.short = long, short
        self.named = self.rng.random() < 0.8  # class names tell something
        self.semantic = self.rng.random() < 0.75  # element names tell something

    def attrs(self, words: str) -> str:
        r = self.rng
        if not self.named:
            return r.choice(["", f' class="{r.choice(_PLAIN.split())}"', f' class="c{r.randrange(9999)}x"'])
        name = r.choice(words.split())
        if r.random() < 0.5:
            name = r.choice("-_ ").join(r.sample([name, r.choice(_PLAIN.split())], 2))
        return f' {r.choice(["class", "class", "id"])}="{name}"'

    def escaped(self, text: str) -> str:
        return html.escape(text, quote=self.rng.random() < 0.5)

    def line(self) -> str:
        return self.escaped(self.rng.choice(self.short))

    def sentence(self) -> str:
        words = self.rng.choice(self.long).split()
        return self.escaped(" ".join(words[: self.rng.randint(3, 30)]))

    def paragraph(self) -> str:
        return self.escaped(self.rng.choice(self.long if self.rng.random() < 0.85 else self.short))

    def links(self, n: int) -> str:
        r = self.rng
        one = [f'<a href="/{k}">{self.line()}</a>' for k in range(n)]
        if r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in one) + "</ul>"
        return r.choice([" ", " | ", "<br>"]).join(one)

    def boiler(self, kind: str) -> str:
        r = self.rng
        tags = _TAGS.get(kind, ("div", "div", "section", "p") if kind in ("ad", "notice") else ("div",))
        tag = r.choice(tags) if self.semantic or kind == "form" else "div"
        if kind == "nav":
            body = self.links(r.randint(2, 9))
        elif kind == "header":
            body = r.choice([f"<h1>{self.line()}</h1>", f'<a href="/">{self.line()}</a>', f"<p>{self.sentence()}</p>", ""]) + (self.boiler("nav") if r.random() < 0.5 else f"<p>{self.line()}</p>")
        elif kind == "footer":
            body = r.choice(["&copy; ", "", "&copy; 2024 "]) + r.choice([self.line(), self.sentence(), self.links(r.randint(2, 6)), f"<p>{self.sentence()}</p>"])
        elif kind == "aside":
            body = "".join(f"<h3>{self.line()}</h3>" + r.choice([self.links(r.randint(2, 7)), f"<p>{self.sentence()}</p>", f"<p>{self.paragraph()}</p>"]) for _ in range(r.randint(1, 3)))
        elif kind == "ad":
            text = r.choice([self.sentence, self.line, self.paragraph])()
            body = text if tag == "p" else r.choice([text, f"<p>{text}</p>", f'<a href="/x">{text}</a>', f"<h4>{self.line()}</h4><p>{text}</p>"])
        elif kind == "notice":
            body = r.choice([self.sentence(), self.line()]) if tag == "p" else r.choice([self.sentence(), f"<p>{self.sentence()}</p><button>OK</button>", f"<p>{self.paragraph()}</p><a href='/p'>{self.line()}</a>"])
        elif kind == "form":
            body = f"<label>{self.line()}</label><input name=q>" + r.choice(["", f"<p>{self.sentence()}</p>", f"<h3>{self.line()}</h3>", f"<p>{self.paragraph()}</p>"]) + "<button>OK</button>"
        elif kind == "comments":
            each = r.choice(["li", "div", "article", "p"])
            many = [f"<{each}>" + (self.paragraph() if each == "p" else f"<b>{self.line()}</b><p>{self.paragraph()}</p>") + f"</{each}>" for _ in range(r.randint(1, 6))]
            body = r.choice([f"<h2>{self.line()}</h2>", f"<h3>{self.line()}</h3>", ""]) + ("<ol>" + "".join(many) + "</ol>" if each == "li" else "".join(many)) + (self.boiler("form") if r.random() < 0.3 else "")
        else:
            body = self.links(r.randint(2, 5)) if r.random() < 0.6 else f"<p>{self.line()}</p>"
        return f'<{tag}{self.attrs(_BOILER[kind])} data-main="0">{body}</{tag}>'

    def block(self) -> str:
        r = self.rng
        k = r.random()
        if k < 0.55:
            return f"<p>{self.paragraph()}</p>"
        if k < 0.62:
            return f"<p><b>{self.paragraph()}<br>"
        if k < 0.68:
            return f"<p>{self.paragraph()} <a href='/s'>{self.line()}</a> {self.sentence()}</p>"
        if k < 0.76:
            return f"<h{(n := r.randint(2, 4))}>{self.line()}</h{n}>"
        if k < 0.83:
            return "<ul>" + "".join(f"<li>{r.choice([self.line, self.sentence, self.paragraph])()}</li>" for _ in range(r.randint(1, 6))) + "</ul>"
        if k < 0.88:
            return f"<blockquote><p>{self.paragraph()}</p></blockquote>"
        if k < 0.92:
            return f"<div>{self.paragraph()}</div>"
        if k < 0.95:
            return f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>"
        if k < 0.97:
            return "<table>" + "".join(f"<tr><td>{self.line()}</td><td>{self.line()}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        return f"<pre>{self.paragraph()}</pre>"

    def main(self) -> str:
        r = self.rng
        blocks = [self.block() for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 12, 20]))]
        if r.random() < 0.85 or not blocks:
            title = f"<h1>{self.line()}</h1>"
            blocks.insert(0, f"<header>{title}</header>" if r.random() < 0.15 else title)
        inside = [k for k in ("ad", "ad", "aside", "form", "share", "notice", "comments") if r.random() < 0.12]
        for kind in inside:
            blocks.insert(len(blocks) if kind == "comments" else r.randint(1, len(blocks)), self.boiler(kind))
        body = "".join(blocks)
        for _ in range(r.choice([0, 0, 1, 2])):
            body = f"<div{self.attrs(_MAIN)}>{body}</div>"
        tag = r.choice(["article", "article", "article", "main", "div", "section"]) if self.semantic else "div"
        return f'<{tag}{self.attrs(_MAIN) if tag in ("div", "section") or r.random() < 0.3 else ""} data-main="1">{body}</{tag}>'

    def page(self) -> str:
        r = self.rng
        before = [k for k in ("notice", "header", "nav", "ad", "aside", "form", "share") if r.random() < 0.35]
        after = [k for k in ("share", "ad", "aside", "comments", "form", "notice", "nav", "footer", "footer") if r.random() < 0.4]
        r.shuffle(before)
        body = "".join([*map(self.boiler, before), self.main(), *map(self.boiler, after)])
        for _ in range(r.choice([0, 0, 1, 2])):
            body = f"<div{self.attrs(_PLAIN)}>{body}</div>"
        if r.random() < 0.1:
            body = f'<form action="/post">{body}</form>'
        return f'<html><head><title>{self.line()}</title></head><body data-main="0">{body}</body></html>'
