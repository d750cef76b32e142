"""Token streams of web pages: block tags and text slots, with repeats folded."""

from __future__ import annotations

import re
from html import unescape

#: Element names by how they are treated.
RAW = "script|style"
#: Left out with what they hold; if self-closed or without an end, the tag alone is.
SKIPPED = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("template", "textarea", "select", "button", "svg", "iframe", "title")}
VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "math", "semantics", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mstyle", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup",
    "munder", "mover", "munderover", "mfenced", "mpadded", "mphantom", "menclose", "mtable", "mtr", "mtd",
}
SIBLINGS = {"li", "dt", "dd", "tr", "td", "th", "option", "p"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "dd", "dt", "fieldset",
    "figure", "figcaption", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "li", "main", "menu", "nav", "ol",
    "p", "pre", "section", "table", "tr", "td", "th", "ul",
}
#: Elements that are not part of an article, and words in class, id or role that say so.
FOREIGN = {"nav", "aside", "form", "footer", "head", "menu", "dialog", "header", "noscript", "object", "canvas"}
#: Those that belong to an article around them.
OWNED = {"header", "noscript", "object", "canvas"}
FOREIGN_WORDS = {
    "ad", "adbox", "ads", "adsbygoogle", "adsense", "advert", "advertisement", "advertising", "adverts", "alert", "banner",
    "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments", "complementary", "consent", "contentinfo", "cookie",
    "cookiebar", "cookies", "discussion", "disqus", "footer", "form", "gdpr", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "recommended",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "sidenav", "signup", "social", "sponsor",
    "sponsored", "submenu", "subscribe", "toolbar", "topbar", "topnav", "widget",
}
#: Words that tell the state or layout of an element, not what it is.
STATES = {"has", "with", "without", "no", "not", "is", "open", "opened", "closed", "enabled", "disabled", "active", "layout"}
#: Words that after a foreign one name a part of it, as in ``share-buttons``; ``search-results`` is something else.
PARTS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "control", "footer", "group", "header",
    "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "meta", "outer", "panel", "post", "posts", "reply", "right",
    "row", "section", "slot", "text", "title", "top", "unit", "wrap", "wrapper",
}
CORE, CORE_WORDS = {"article", "main"}, {"article", "main", "articlebody"}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<[!?][^>]*>|<({RAW})(?![^\s/>])[^>]*>.*?(?:</\1\s*>|$)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|([^<]+|<)""",
    re.S | re.I,
)
MARKS = re.compile(r"""(?<![\w:.-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
#: Groups of up to so many tokens are compared at every token; longer repeats are found by as many tokens that occurred before.
MAX_GROUP = 48


def is_foreign(words: list[str]) -> bool:
    """Whether a class token, split into words, names a foreign part: the whole token counts, not any of its words."""
    if not words or STATES & set(words):
        return False
    first = next((i for i, w in enumerate(words) if w in FOREIGN_WORDS), None)
    return first is not None and (words[-1] in FOREIGN_WORDS or PARTS.issuperset(words[first + 1 :]))


def label(name: str, attributes: str) -> str:
    """The tag's name, with ``!`` if its marks say foreign and ``*`` if they say core."""
    foreign = core = False
    for found in MARKS.findall(attributes):
        for mark in "".join(found).lower().split():
            found_words = WORD.findall(mark)
            words = set(found_words)
            foreign |= is_foreign(found_words)
            core |= bool(words & CORE_WORDS) and not words & (STATES | FOREIGN_WORDS)
    if name in ("html", "body"):
        return name
    return name + "!" * foreign + "*" * core


def parse(html: str) -> tuple[list[str], list[tuple[int, str, int]]]:
    """(tokens, blocks) of a page.

    Tokens are labels of block elements, ``/`` before those that end, and ``#`` for a
    text.  Ends that the page leaves out are added, so that the stream is balanced.  A
    block is (its token, its text, characters of it in links); blocks end at block tags
    and at line breaks.  Inline tags, comments, scripts and the like leave no token.
    """
    tokens: list[str] = []
    blocks: list[tuple[int, str, int]] = []
    stack: list[str] = []
    run: list[str] = []
    links, linked = 0, False

    def flush() -> None:
        nonlocal links
        if run:
            text = " ".join("".join(run).split())
            if text:
                blocks.append((len(tokens), text, min(links, len(text))))
                tokens.append("#")
            run.clear()
        links = 0

    def end(depth: int) -> None:
        while len(stack) > depth:
            tokens.append("/" + stack.pop())

    at, endless = 0, set()
    while at < len(html):
        m = TOKEN.match(html, at)  # some alternative fits anywhere
        at = m.end()
        text = m.group(8)
        if text is not None:
            text = unescape(text)
            run.append(text)
            links += len(text) * linked
            continue
        name = (m.group(3) or m.group(6) or "").lower()
        if name in SKIPPED:
            opens = not (m.group(2) or m.group(5) or m.group().endswith("/>"))
            if opens and name not in endless:
                closing = SKIPPED[name].search(html, at)
                if closing:
                    at = closing.end()
                else:
                    endless.add(name)
            continue
        if name == "a":
            linked = not (m.group(2) or m.group(5))
        if not name or name in INLINE or name in VOID and name != "hr":
            continue
        flush()
        if name in ("br", "hr"):
            continue
        names = [re.sub(r"[!*]", "", x) for x in stack[-12:]]
        if m.group(2) or m.group(5):
            if name in names:
                end(len(stack) - names[::-1].index(name) - 1)
            elif name in (names := [re.sub(r"[!*]", "", x) for x in stack]):
                end(len(stack) - names[::-1].index(name) - 1)
            continue
        if names and names[-1] == "p" and name in CLOSES_P or names and names[-1] == name and name in SIBLINGS:
            end(len(stack) - 1)
        own = label(name, m.group(4) or m.group(7) or "")
        stack.append(own)
        tokens.append(own)
    flush()
    end(0)
    return tokens, blocks


def fold(tokens: list[str], blocks: list[tuple[int, str, int]]) -> tuple[list[str], list[int]]:
    """(signature, slot): groups of tokens that repeat side by side kept once, and the place of each block's text in it.

    At each token the shortest group that ends there is folded, whatever its length.
    """
    out: list[str] = []
    slots: list[int] = []
    ends: dict[int, list[int]] = {}  # where runs of MAX_GROUP tokens end, by their hashes
    hashed: list[int] = []  # the hash of the run that ends after MAX_GROUP tokens, after one more, and so on
    for token in tokens:
        out.append(token)
        if token == "#":
            slots.append(len(out) - 1)
        n = len(out)
        sizes = range(1, min(MAX_GROUP, n // 2) + 1)
        if n > 2 * MAX_GROUP:
            while len(hashed) + MAX_GROUP <= n:
                hashed.append(hash(tuple(out[len(hashed) : len(hashed) + MAX_GROUP])))
                ends.setdefault(hashed[-1], []).append(len(hashed) + MAX_GROUP - 1)
            sizes = [*sizes, *(n - e for e in reversed(ends[hashed[-1]]) if MAX_GROUP < n - e <= n // 2)]
        for size in sizes:
            if out[n - 1 - size] == token and out[n - size] == out[n - 2 * size] and out[n - size :] == out[n - 2 * size : n - size]:
                del out[n - size :]
                while hashed and len(hashed) + MAX_GROUP - 1 > len(out):
                    ends[hashed.pop()].pop()
                i = len(slots)
                while i and slots[i - 1] >= n - size:
                    i -= 1
                slots[i:] = [s - size for s in slots[i:]]
                break
    return out, slots


def is_core(tag: str) -> bool:
    return tag.rstrip("!*") in CORE or tag.endswith("*") and "!" not in tag


def roles(signature: list[str]) -> dict[int, tuple[bool, bool]]:
    """(foreign, core) of each text slot, by the elements around it.

    Where this leaves no text, the marks of elements that hold the article, or all texts
    of a page without one, do not count: they tell the layout.
    """
    around, stack = {}, []
    for i, token in enumerate(signature):
        if token == "#":
            around[i] = tuple(stack)
        elif token[0] == "/":
            for k in range(len(stack) - 1, -1, -1):
                if signature[stack[k]] == token[1:]:
                    del stack[k:]
                    break
        else:
            stack.append(i)

    def found(layout: set[int]) -> dict[int, tuple[bool, bool]]:
        out = {}
        for i, elements in around.items():
            foreign = core = False
            for e in elements:
                tag = signature[e]
                name = tag.rstrip("!*")
                core |= is_core(tag)
                foreign |= ("!" in tag and e not in layout) or (name in FOREIGN and not (core and name in OWNED))
            out[i] = (foreign, core)
        return out

    marked = {e for elements in around.values() for e in elements if "!" in signature[e]}
    strict = found(set())
    if not marked or any(core and not foreign for foreign, core in strict.values()):
        return strict
    named = found(marked)
    if any(core and not foreign for foreign, core in named.values()):
        layout = set()
        for i, (foreign, core) in named.items():
            if core and not foreign:
                first = next(k for k, e in enumerate(around[i]) if is_core(signature[e]))
                layout |= marked & set(around[i][: first + 1])
        return found(layout)
    texts = [around[i] for i, (foreign, _) in named.items() if not foreign]
    if len(texts) > 1 and all(foreign for foreign, _ in strict.values()):
        return found(marked & set.intersection(*map(set, texts)))
    return strict
