"""The text blocks of an HTML page and where on the page they stand."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe
    legend li main menu nav noscript object ol optgroup option p pre script section select style
    summary svg table tbody td template textarea tfoot th thead title tr ul video audio""".split()
)
SECTIONS = frozenset("article aside body div footer form header main nav section".split())
CLOSED_BY_A_BLOCK = frozenset(("p", "dt", "dd", "li"))

# What a page has around its article, by tag, role and the words of class and id.
ASIDE_TAGS = frozenset(
    """aside button dialog footer form head iframe menu nav noembed noframes script select style svg
    template textarea title xmp""".split()
)
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu navigation search".split()
)
ASIDE_WORDS = frozenset(
    """ad ads adsbygoogle advert advertisement advertising adverts aside banner breadcrumb
    breadcrumbs comment comments consent cookie cookies disclaimer disqus footer login menu modal
    nav navbar navigation newsletter notice notices notification pagination popup promo promoted
    related replies respond search share sharing sidebar signup skip social sponsor sponsored
    subscribe toolbar widget widgets""".split()
)
COMMENT_WORDS = frozenset(("comment", "comments"))
HEADER_WORDS = frozenset(("header", "masthead"))
ARTICLE_TAGS = frozenset(("article", "main"))
# A name such as no-sidebar or comments-open says something of the page around it.
NOT_BEFORE = frozenset("has have is no not with without".split())
NOT_AFTER = frozenset("closed disabled enabled image none off on open period results".split())
MOST_OF_PAGE = 0.5  # of a page's text: an element with more is no aside, whatever its names

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s=>/]+)(?:\s*=\s*(?:(["'])|([^\s>]*)))?""")
_WORD = re.compile(r"[a-z]+")


def _names(attributes: dict[str, str], words: frozenset[str]) -> bool:
    """Whether a class or id has one of the words, other than after NOT_BEFORE or before
    NOT_AFTER."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = ["", *_WORD.findall(name), ""]
        for before, word, after in zip(parts, parts[1:], parts[2:], strict=False):
            if word in words and before not in NOT_BEFORE and after not in NOT_AFTER:
                return True
    return False


class Block(NamedTuple):
    text: str
    aside: bool  # in a menu, header, footer, advert, form and the like
    article: bool  # in an article


def _attributes(html: str, at: int, closed: set[str]) -> tuple[dict[str, str], int]:
    """The attributes of a tag from ``at`` on, and the place after the tag."""
    found: dict[str, str] = {}
    while at < len(html):
        if html[at] == ">":
            return found, at + 1
        match = _ATTRIBUTE.match(html, at)
        if match is None:
            at += 1
            continue
        name, quote, value = match.groups()
        at = match.end()
        if quote:
            end = -1 if quote in closed else html.find(quote, at)
            if end < 0:  # never closed: the tag ends at the next bracket
                closed.add(quote)
                end = html.find(">", at)
                return found, len(html) if end < 0 else end + 1
            value, at = html[at:end], end + 1
        found.setdefault(name.lower(), value or "")
    return found, at


def _kind(tag: str, attributes: dict[str, str], in_article: bool) -> str | None:
    """"aside" by tag or role, "named" for an aside by class or id, "article", or None for an
    element that changes nothing."""
    if tag in ("html", "body"):
        return None
    if tag in ASIDE_TAGS:
        return "aside"
    role = attributes.get("role", "").lower().strip()
    if tag in ARTICLE_TAGS or role in ("main", "article"):
        return "named" if _names(attributes, COMMENT_WORDS) else "article"
    if role in ASIDE_ROLES or "hidden" in attributes:
        return "aside"
    if _names(attributes, ASIDE_WORDS):
        return "named"
    if not in_article and (tag == "header" or _names(attributes, HEADER_WORDS)):
        return "aside" if tag == "header" else "named"
    return None


def blocks(html: str) -> list[Block]:
    """The non-empty text blocks of a page in order, whatever the state of its markup.

    Character references are decoded and white space becomes one space. Comments, scripts and
    styles are no text. An element that is an aside by its names only, and holds most of the
    text outside the other asides, is none, unless the page has an article elsewhere.
    """
    out: list[tuple[str, bool, bool, tuple[int, ...]]] = []
    named: list[int] = []  # the open asides by name
    sizes: list[int] = []  # text in each aside by name
    held: list[str] = []
    open_parts: list[list] = []  # [tag, kind, elements of that tag open inside]
    asides = articles = 0
    closed: set[str] = set()

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, asides > 0, articles > 0, tuple(named)))
                for i in named if not asides else ():
                    sizes[i] += len(text)

    def leave(n: int) -> None:
        nonlocal asides, articles
        for _, kind, _ in open_parts[n:]:
            asides -= kind == "aside"
            articles -= kind == "article"
            if kind == "named":
                named.pop()
        del open_parts[n:]

    at, size = 0, len(html)
    while at < size:
        next_tag = html.find("<", at)
        if next_tag < 0:
            held.append(html[at:])
            break
        if next_tag > at:
            held.append(html[at:next_tag])
        at = next_tag + 1
        if html.startswith("!--", at):
            end = html.find("-->", at + 1)
            at = size if end < 0 else end + 3
            continue
        if html[at : at + 1] in ("!", "?"):
            end = html.find(">", at)
            at = size if end < 0 else end + 1
            continue
        name = _NAME.match(html, at)
        if name is None:
            held.append("<")
            continue
        tag, ending = name[1].lower(), html[at] == "/"
        attributes, at = _attributes(html, name.end(), closed)
        if tag == "br":
            held.append(" ")
        if tag in BLOCKS:
            flush()
        if ending:
            if open_parts and open_parts[-1][0] == tag:
                open_parts[-1][2] -= 1
                if not open_parts[-1][2]:
                    flush()
                    leave(len(open_parts) - 1)
            elif tag in SECTIONS:
                lower = [i for i, part in enumerate(open_parts) if part[0] == tag]
                if lower and tag != "div":
                    leave(lower[-1])
            continue
        if tag in BLOCKS and open_parts and open_parts[-1][0] in CLOSED_BY_A_BLOCK:
            if open_parts[-1][0] == tag or tag not in CLOSED_BY_A_BLOCK:
                leave(len(open_parts) - 1)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            at = size if end is None else html.find(">", end.end())
            at = size if at < 0 else at + (end is not None)
            continue
        if tag in VOID:
            continue
        kind = _kind(tag, attributes, articles > 0)
        if kind:
            flush()
            open_parts.append([tag, kind, 1])
            asides += kind == "aside"
            articles += kind == "article"
            if kind == "named":
                named.append(len(sizes))
                sizes.append(0)
        elif open_parts and open_parts[-1][0] == tag:
            open_parts[-1][2] += 1
    flush()
    marked = any(article and not aside and not within for _, aside, article, within in out)
    most = MOST_OF_PAGE * sum(len(text) for text, aside, _, _ in out if not aside)
    small = [marked or size <= most for size in sizes]
    return [
        Block(text, aside or any(small[i] for i in within), article)
        for text, aside, article, within in out
    ]
