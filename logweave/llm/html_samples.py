"""Labelled pages for training, made by rule: many layouts around articles whose text is marked."""

from __future__ import annotations

import random

#: Stands before every word of an article in a made page; reading a label takes it out again.
MARK = ""
_PARTS = ("th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve sch ung eux ción é ñ ß ü ma ko ri da").split()


class _Maker:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_PARTS) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int, mark: bool = False) -> str:
        style = self.r.random()
        out = [self.word() for _ in range(self.r.randint(lo, hi))]
        out[0] = out[0].capitalize()
        if style < 0.1:
            out = [w.upper() + "!!" for w in out]
        elif style < 0.15:
            out = [w + " |" for w in out]
        elif style < 0.2:
            out = [w + self.r.choice(("***", "&amp;&amp;&amp;", "%%%")) for w in out]
        else:
            out = [w + self.r.choice((",", ".")) if self.r.random() < 0.12 else w for w in out]
        if mark:
            out = [MARK + w for w in out]
            for i in range(len(out)):
                if self.r.random() < 0.04:
                    tag = self.r.choice(("b", "em", "strong", "i", "code", 'a href="/x"'))
                    out[i] = f"<{tag}>{out[i]}</{tag.split()[0]}>"
        return " ".join(out) + self.r.choice((".", ".", "", "!", "?"))

    def links(self, lo: int, hi: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.r.randint(lo, hi)))

    def pick(self, *x):
        return self.r.choice(x)

    def paragraphs(self, lo: int, hi: int) -> str:
        out = []
        for _ in range(self.r.randint(lo, hi)):
            kind = self.r.random()
            text = self.words(1, self.r.choice((3, 12, 40, 90)), True)
            if kind < 0.68:
                out.append(f"<p>{text}" + self.pick("</p>", "</p>", ""))
            elif kind < 0.74:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.80:
                out.append(f"<h2>{self.words(2, 6, True)}</h2>")
            elif kind < 0.86:
                items = "".join(f"<li>{self.words(2, 12, True)}</li>" for _ in range(self.r.randint(2, 5)))
                out.append(f"<ul>{items}</ul>")
            elif kind < 0.90:
                out.append(f"<blockquote>{self.words(5, 25, True)}</blockquote>")
            elif kind < 0.93:
                out.append(f"<pre>{self.words(4, 15, True)}</pre>")
            elif kind < 0.96:
                out.append("<table><tr>" + "".join(f"<td>{self.words(1, 4, True)}</td>" for _ in range(3)) + "</tr></table>")
            else:
                out.append(f"<div>{self.words(8, 40, True)}</div>")
        return "".join(out)

    def advert(self) -> str:
        name = self.pick("ad", "ads", "advert", "ad-slot", "sponsored", "promo-box", "banner-ad", "advertisement")
        return f"<{(t := self.pick('div', 'div', 'aside', 'section'))} class=\"{name}\">{self.pick('', '<p>')}{self.words(3, 25)}</{t}>"

    def notice(self) -> str:
        name = self.pick("cookie-banner", "consent", "notice", "gdpr-popup", "newsletter", "subscribe-box", "alert", "modal")
        return f"<div {self.pick('class', 'id')}=\"{name}\"><p>{self.words(5, 30)}</p>{self.pick('', '<button>OK</button>', '<a href=\"/p\">' + self.word() + '</a>')}</div>"

    def comments(self) -> str:
        each = "".join(f'<div class="{self.pick("comment", "reply", "comment-body")}"><p>{self.words(4, 40)}</p></div>' for _ in range(self.r.randint(1, 5)))
        return f"<{(t := self.pick('section', 'div', 'ol'))} {self.pick('id', 'class')}=\"{self.pick('comments', 'comment-list', 'disqus_thread', 'discussion', 'responses comments')}\"><h3>{self.words(1, 3)}</h3>{each}</{t}>"

    def form(self) -> str:
        return f'<form {self.pick("", "class=search", "id=login", "class=contact-form")}><label>{self.words(1, 3)}</label><input name=q>{self.pick("", f"<p>{self.words(3, 15)}</p>")}<button>{self.word()}</button></form>'

    def side(self) -> str:
        tag, name = self.pick("aside", "div", "section"), self.pick("sidebar", "side", "related", "widget", "trending", "recommended", "right-rail")
        body = self.pick(f"<h4>{self.words(1, 3)}</h4><ul>{self.links(2, 6)}</ul>", f"<p>{self.words(5, 35)}</p>", f"<h3>{self.words(1, 3)}</h3><p>{self.words(4, 20)}</p>")
        return f"<{tag} {'class' if tag != 'aside' or self.r.random() < 0.5 else 'data-x'}=\"{name}\">{body}</{tag}>"

    def menu(self) -> str:
        return self.pick(f"<nav><ul>{self.links(3, 8)}</ul></nav>", f'<div class="{self.pick("menu", "navbar", "main-nav", "breadcrumbs")}"><ul>{self.links(2, 7)}</ul></div>', f'<ul id="{self.pick("nav", "menu", "topnav")}">{self.links(3, 8)}</ul>', f'<div role="navigation">{self.links(2, 5)}</div>')

    def top(self) -> str:
        body = self.pick(f"<h1>{self.words(1, 3)}</h1>", f"<a href=/>{self.word()}</a>", f"<p>{self.words(2, 9)}</p>")
        return self.pick(f"<header>{body}{self.pick('', self.menu())}</header>", f'<div class="{self.pick("header", "masthead", "site-header", "top-banner")}">{body}</div>', "")

    def foot(self) -> str:
        body = f"{self.pick('&copy; ', '', 'Copyright ')}{self.word()}.example.com {self.pick('&middot; ', '| ')}{self.words(2, 25)}"
        return self.pick(f"<footer>{body}</footer>", f'<div class="{self.pick("footer", "site-footer", "copyright", "legal")}"><p>{body}</p></div>', f"<footer><p>{body}</p><ul>{self.links(2, 5)}</ul></footer>")

    def article(self) -> str:
        title = self.pick(f"<h1>{self.words(2, 9, True)}</h1>", f"<h2>{self.words(2, 9, True)}</h2>", "")
        inner = self.paragraphs(1, 9)
        for add, chance in ((self.advert, 0.25), (self.side, 0.08), (self.form, 0.05), (self.notice, 0.06)):
            if self.r.random() < chance:
                inner += add() + self.paragraphs(1, 3)
        if self.r.random() < 0.15:
            inner += f'<div class="{self.pick("share", "social-links")}"><ul>{self.links(2, 4)}</ul></div>'
        if self.r.random() < 0.2:
            inner += self.comments()
        tag, names = self.pick(*[("article", "")] * 5, ("article", ' class="post"'), ("main", ""), ("main", ' id="content"'), ("div", ' class="article-body"'), ("div", ' id="content"'), ("div", ' class="post-content"'), ("div", ' class="entry"'), ("section", ' class="story"'), ("div", ' role="main"'), ("div", ""))
        body = f"<{tag}{names}>{title}{inner}</{tag}>"
        return f"<div{self.pick('', ' class=wrapper', ' class=container', ' id=page')}>{body}</div>" if self.r.random() < 0.3 else body

    def page(self) -> str:
        head = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
        before = [f() for f, chance in ((self.top, 0.6), (self.menu, 0.7), (self.advert, 0.5), (self.notice, 0.25), (self.form, 0.2), (self.side, 0.2)) if self.r.random() < chance]
        after = [f() for f, chance in ((self.comments, 0.3), (self.side, 0.4), (self.advert, 0.3), (self.form, 0.15), (self.notice, 0.25), (self.foot, 0.85)) if self.r.random() < chance]
        return head + "".join(before) + self.article() + "".join(after) + self.pick("</body></html>", "")


def pages(n: int, seed: int = 17) -> list[str]:
    maker = _Maker(seed)
    return [maker.page() for _ in range(n)]
