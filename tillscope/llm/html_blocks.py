"""A page cut in blocks of text, each with the zone of the page it stands in."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

MAIN, OPEN, CHROME = 2, 1, 0  # inside the main element; nothing known; menus, adverts, forms and the like
# inside a container that says it is chrome but may hold the page: a form, a class name, a class name of other articles; an article in one of them
_FORM, _NAMED, _OTHERS, _AGAIN = 3, 4, 5, 6
_SOFT = frozenset((_FORM, _NAMED, _OTHERS))

# fixed values: element names of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object canvas select".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CHROME_TAGS = frozenset("nav footer aside form menu button fieldset dialog head search".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# words of class names and ids that mark what is not the article
_CHROME_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share captcha comment comments commentlist cookie cookies consent copyright
    disclaimer disqus dialog feedback footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination
    popup promo promoted promotion recommended register related replies reply respond share sharing sidebar signup sitemap skip social sponsor sponsored subscribe
    subscription tagcloud toolbar widget""".split()
)
_MAIN_TAGS = frozenset(("article", "main"))
_CHROME_ARTICLES = frozenset("ad ads comment comments related reply replies promo sponsored recommended advertisement".split())
_ABOUT_OTHERS = ("has", "with", "no", "without", "is", "not")  # "has-sidebar" says nothing of the element itself
# an open paragraph or list item ends where one of these starts
_CLOSES_P = _BLOCK - {"li", "dd", "dt", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"}
_SIBLINGS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)), "option": ("option", ("select",)), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "tr": ("tr", ("table",))}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT_NAME = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")


def _named_chrome(names: str, chrome: frozenset[str]) -> bool:
    for name in names.split():
        words = _SPLIT_NAME.split(_CAMEL.sub(r"\1 \2", name).lower())
        if words[0] not in _ABOUT_OTHERS and not chrome.isdisjoint(words):
            return True
    return False


def _zone(tag: str, attributes: str, parent: int, inside_main: bool) -> int:
    if parent == CHROME or tag in _CHROME_TAGS and tag != "form":
        return CHROME
    zone, role = parent, ""
    if tag == "form":
        zone = CHROME if inside_main else zone if parent in _SOFT else _FORM
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id"):
                names = html.unescape("".join(values))
                if tag in ("html", "body") or not _named_chrome(names, _CHROME_ARTICLES if tag in _MAIN_TAGS else _CHROME_WORDS):
                    continue
                if inside_main or tag in _MAIN_TAGS:
                    return CHROME
                if zone != _OTHERS:
                    zone = _OTHERS if _named_chrome(names, _CHROME_ARTICLES) else _NAMED
            elif name == "role":
                role = "".join(values).lower()
                if role in _CHROME_ROLES and not (tag == "form" and role == "form"):
                    return CHROME
            elif name == "hidden" or (name == "aria-hidden" and "".join(values).lower() == "true"):
                return CHROME
            elif name == "style" and re.search(r"display\s*:\s*none", "".join(values), re.I):
                return CHROME
    if zone == CHROME or tag == "header" and not inside_main:
        return CHROME
    if tag == "main" or role == "main":
        return MAIN
    if tag == "article" or role == "article":
        return {_FORM: _AGAIN, _NAMED: _AGAIN, _OTHERS: _OTHERS, _AGAIN: _AGAIN}.get(zone, MAIN)
    return zone


def blocks(page: str) -> Iterator[tuple[int, str]]:
    """(zone, text) of the blocks of a page in order; texts are decoded, with single spaces, and not empty.

    A form or a container with a telling class name is chrome, but <main> in it is the main element,
    and so is <article> where the page has no other.
    """
    found = list(_blocks(page))
    again = CHROME if any(zone == MAIN for zone, _ in found) else MAIN
    for zone, text in found:
        yield again if zone == _AGAIN else CHROME if zone in _SOFT else zone, text


def _blocks(page: str) -> Iterator[tuple[int, str]]:
    stack: list[tuple[str, int]] = []
    text: list[str] = []
    zone = OPEN
    at = 0

    def block() -> Iterator[tuple[int, str]]:
        if text:
            plain = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if plain:
                yield zone, plain

    while True:
        match = _TOKEN.search(page, at)
        text.append(page[at : match.start()] if match else page[at:])
        if not match:
            break
        at = match.end()
        if match.group(2) is None:
            continue
        tag, closing = match.group(2).lower(), bool(match.group(1))
        if tag in _RAW and not closing:
            if not match.group(3).rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in _VOID:
            if tag == "br":
                text.append(" ")
            elif tag == "hr":
                yield from block()
            continue
        if tag in _BLOCK:
            yield from block()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        else:
            if tag in _CLOSES_P:
                _close(stack, ("p",), _BLOCK)
            if tag in _SIBLINGS:
                names, limits = _SIBLINGS[tag]
                _close(stack, tuple(names.split()), frozenset(limits))
            parent = stack[-1][1] if stack else OPEN
            if not match.group(3).rstrip().endswith("/") or tag in _BLOCK:
                stack.append((tag, _zone(tag, match.group(3), parent, any(z in (MAIN, _AGAIN) for _, z in stack))))
        zone_now = stack[-1][1] if stack else OPEN
        if zone_now != zone:
            yield from block()
            zone = zone_now
    yield from block()


def _close(stack: list[tuple[str, int]], names: tuple[str, ...], limits: frozenset[str]) -> None:
    """Close the nearest open element of ``names`` that lies inside the nearest element of ``limits``."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in names:
            del stack[i:]
            return
        if stack[i][0] in limits:
            return
