"""Blocks of text of an HTML page, each with the part of the page it stands in."""

from __future__ import annotations

import html
import re

#: Elements whose text is never shown, that end a block, that have no end tag.
HIDDEN = frozenset("head title script style template noscript textarea iframe object svg math canvas audio video".split())
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Parts around the text, by element, by role, and by words in class or id.
CHROME = frozenset("nav footer aside form menu button select dialog fieldset option search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus footer form header masthead menu menus modal nav navbar navigation newsletter notice notices popup promo promoted promotion "
    "related replies reply respond share sharing sidebar sidebars signup social sponsor sponsored subscribe toolbar widget".split()
)
BODY_WORDS = frozenset("article content entry main post story".split())
BODY_ROLES = frozenset("main article".split())
#: Elements that an opening tag of the same or a listed kind closes.
CLOSED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


def _part(tag: str, attributes: str, around: str) -> str:
    """'chrome', 'body' or what stands around: chrome stays chrome, and a body's own header is body."""
    if around == "chrome" or tag in HIDDEN or tag in CHROME:
        return "chrome"
    names, roles = set(), set()
    for kind, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        (roles if kind.lower() == "role" else names).update((a or b or c).lower().split())
    words = {w for n in names for w in WORDS.findall(n)}
    if roles & CHROME_ROLES or words & (CHROME_WORDS - {"header"} if around == "body" else CHROME_WORDS) or re.search(r"\b(hidden|aria-hidden\s*=\s*[\"']?true)", attributes or "", re.I):
        return "chrome"
    if tag == "header" and around != "body":
        return "chrome"
    if tag in ("article", "main") or roles & BODY_ROLES:
        return "body"
    if tag in ("div", "section") and words & BODY_WORDS:
        return "likely" if around == "other" else around
    return around


def blocks(page: str) -> list[tuple[str, str]]:
    """(part, text) of every block that holds text, in page order.

    Parts: 'body' inside an article or main element, 'likely' inside a container named like one,
    'chrome' around the text, 'other' elsewhere. Character references are decoded, white space is
    one space, inline markup goes without a trace, a line break is white space.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []
    part, held, at = "other", [], 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((part, text))
            held.clear()

    end = len(page)
    while at < end:
        m = MARKUP.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if any(t == tag for t, _ in stack):
                if tag in BLOCK or tag in HIDDEN:
                    flush()
                while stack.pop()[0] != tag:
                    pass
                if (now := stack[-1][1] if stack else "other") != part:
                    flush()
                    part = now
            elif tag in BLOCK:
                flush()
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCK:
            flush()
            while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
            # A paragraph left open with inline elements in it ends too.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in BLOCK:
                    if tag in CLOSED_BY.get(stack[k][0], ()):
                        del stack[k:]
                    break
            part = stack[-1][1] if stack else "other"
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, at)
            at = close.end()
            continue
        if (inner := _part(tag, m[3], part)) != part:
            flush()
        stack.append((tag, inner))
        part = inner
    flush()
    return out
