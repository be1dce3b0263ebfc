"""A page as a tree of block elements and text leaves: a small reader of HTML as browsers take it."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; without an end tag it is the rest of the page.
RAW = frozenset("script style textarea title".split())
#: Left out with all they hold where they have an end tag; without one, what follows is read on.
SKIPPED = frozenset("template noscript iframe object svg select canvas audio video button datalist".split())
_LONE = frozenset({"button", "select"})
BLOCKS = ("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form fieldset table thead tbody tfoot tr td th caption "
          "figure figcaption blockquote pre address details summary dialog center menu head hgroup search legend option").split()
TAGS = {name: i for i, name in enumerate(BLOCKS)}
_CLOSES_P = frozenset(BLOCKS) - {"html", "body", "head", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "option", "legend"}
_CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
              "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"form"})}
_SCOPE = frozenset("table td th caption body html".split())

#: Kinds of class, id and role names, each a feature of an element.
NAMES = [
    ("content", r"article|content|post(?!er|al)|entry|story|main|body|prose|text|markdown"),
    ("menu", r"nav|menu|breadcrumb|crumb|pagination|pager|toc|tabs?\b|skip"),
    ("header", r"header|masthead|banner|logo|topbar|branding|hero"),
    ("footer", r"foot|copyright|legal|colophon|contentinfo|imprint"),
    ("side", r"side|aside|related|recommend|widget|trending|popular|complementary|more-|rail|teaser|also"),
    ("advert", r"\bads?\b|\bad[-_]|[-_]ads?\b|advert|sponsor|promo|dfp|taboola|outbrain|affiliate"),
    ("notice", r"cookie|consent|notice|gdpr|alert|popup|modal|overlay|newsletter|subscribe|signup|paywall|toast|dialog|privacy"),
    ("comment", r"comment|disqus|reply|replies|respond|discussion|reader|feedback"),
    ("share", r"share|social|follow|tweet|like-"),
    ("form", r"form|search|login|input|register|contact"),
    ("meta", r"meta|byline|author|date|tag(s|list)|categor|caption|credit"),
    ("hidden", r"hidden|sr-only|visually|screen-reader|d-none|display:\s*none|visibility:\s*hidden"),
]
_NAMES = [re.compile(x, re.IGNORECASE) for _, x in NAMES]
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TAG = re.compile(r"</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")


class Tree(NamedTuple):
    """Nodes in page order, parents first. Elements: tag >= 0 and names; leaves: tag -1, text and its linked part."""

    parent: list[int]
    tag: list[int]
    names: list[int]
    text: list[str]
    linked: list[int]


class _Names:
    """What the class, id and role of a tag say, remembered for tags seen before."""

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def of(self, tag: str) -> int:
        if "=" not in tag and "hidden" not in tag:
            return 0
        found = self.seen.get(tag)
        if found is None:
            found = 0
            for name, a, b, c in _ATTRIBUTE.findall(tag):
                name = name.lower()
                if name in ("class", "id", "role", "style", "aria-label", "itemprop"):
                    value = a or b or c
                    for i, pattern in enumerate(_NAMES):
                        if (name == "style") == (NAMES[i][0] == "hidden") or name in ("class", "id"):
                            found |= bool(pattern.search(value)) << i
                elif name == "hidden":
                    found |= 1 << (len(NAMES) - 1)
            if len(self.seen) > 20_000:
                self.seen.clear()
            self.seen[tag] = found
        return found


_names = _Names()


def _end_of(page: str, at: int) -> int:
    """Where the tag that begins at `at` ends; -1 if nowhere."""
    end = page.find(">", at)
    if end < 0:
        return -1
    tag = page[at:end]
    if tag.count('"') % 2 or tag.count("'") % 2:
        whole = _TAG.match(page, at)
        if whole:
            return whole.end() - 1
    return end


_ANY_SKIPPED = re.compile("<(?:" + "|".join(sorted(SKIPPED)) + r")(?=[\s/>])", re.IGNORECASE)
_RAW_END = {name: re.compile("</" + name, re.IGNORECASE) for name in RAW}


def _next_markup(page: str, lt: int) -> tuple[str, bool, int, int]:
    """Of the markup at `lt`: name ('' of a comment, '<' of no markup), whether it is an end tag, where it ends (-1: nowhere), and where reading goes on."""
    n, c = len(page), page[lt + 1 : lt + 2]
    if c == "!" or c == "?":
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            return "", False, end, n if end < 0 else end + 3
        end = page.find(">", lt)
        return "", False, end, n if end < 0 else end + 1
    closing = c == "/"
    found = _NAME.match(page, lt + 1 + closing)
    if not found:
        return "<", closing, lt, lt + 1 if not closing else max(page.find(">", lt) + 1, lt + 1) or n
    end = _end_of(page, lt)
    return found[0].lower(), closing, end, n if end < 0 else end + 1


def _after_raw(page: str, name: str, at: int) -> int:
    stop = _RAW_END[name].search(page, at)
    after = page.find(">", stop.end()) if stop else -1
    return len(page) if after < 0 else after + 1


def _skips(page: str) -> dict[int, int]:
    """Where the skipped elements begin that have an end tag within their parent, and where they end."""
    found = _ANY_SKIPPED.search(page)
    out: dict[int, int] = {}
    if not found:
        return out
    stack: list[tuple[str, int]] = []
    open_now: Counter[str] = Counter()

    def pop(upto: str) -> int:
        while True:
            name, begin = stack.pop()
            open_now[name] -= 1
            if name == upto:
                return begin

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            break
        name, closing, end, at = _next_markup(page, lt)
        if name in RAW and not closing and end >= 0:
            at = _after_raw(page, name, at)
        elif (name in SKIPPED or name in TAGS) and end >= 0:
            if closing:
                if open_now[name]:
                    begin = pop(name)
                    if name in SKIPPED:
                        out[begin] = at
            elif page[end - 1] != "/" or name not in SKIPPED:
                if name in _LONE and open_now[name]:   # one inside another: the outer has no end
                    pop(name)
                stack.append((name, lt))
                open_now[name] += 1
    return out


def read(page: str) -> Tree:
    skips = _skips(page)
    tree = Tree([-1], [TAGS["html"]], [0], [""], [0])
    stack: list[tuple[str, int]] = [("html", 0)]
    parts: list[str] = []
    linked, in_link = 0, 0

    def node(tag: int, names: int, text: str, links: int) -> int:
        tree.parent.append(stack[-1][1])
        tree.tag.append(tag)
        tree.names.append(names)
        tree.text.append(text)
        tree.linked.append(links)
        return len(tree.parent) - 1

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                node(-1, 0, text, min(linked, len(text)))
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        del stack[upto:]

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            piece = page[at:lt]
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if lt == n:
            break
        name, closing, end, at = _next_markup(page, lt)
        if not name:
            continue
        if name == "<":
            parts.append("<" if not closing else "")
            continue
        if end < 0:
            break
        if closing:
            if name in TAGS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        flush()
                        close(i)
                        break
                else:
                    parts.append(" ")
            elif name == "a":
                in_link = 0
            continue
        if name in RAW or name in SKIPPED:
            parts.append(" ")
            at = _after_raw(page, name, at) if name in RAW and (page[end - 1] != "/" or name != "textarea") else skips.get(lt, at)
            continue
        if name not in TAGS:
            if name == "br" or name == "hr":
                parts.append(" ")
            elif name == "a":
                in_link = 1
            continue
        flush()
        in_link = 0 if name not in ("li", "h1", "h2", "h3", "h4", "div", "p", "span") else in_link
        if name in ("html", "body", "head") and any(x == name for x, _ in stack):
            continue
        if name == "body":
            close(1)
        if name in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in _SCOPE:
                    break
        if name in _CLOSED_BY:
            gone, scope = _CLOSED_BY[name]
            cut = len(stack)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in scope:
                    break
                if stack[i][0] in gone:
                    cut = i
            close(cut)
        stack.append((name, node(TAGS[name], _names.of(page[lt + 1 + len(name) : end]), "", 0)))
    flush()
    return tree
