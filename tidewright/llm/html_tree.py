"""A small tolerant HTML reader: elements, their texts, and hashes of their subtrees."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import xxhash

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp svg math select".split())
BLOCK = frozenset(
    """address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search
    section summary table tbody td tfoot th thead title tr ul""".split()
)
CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
    "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
    "option": ("option", {"select"}),
}

# What a page carries besides its article: elements, and words of class, id and role.
ASIDE = frozenset("nav aside footer form script style noscript template iframe button select textarea svg dialog menu head title".split())
ASIDE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices alert popup modal overlay sidebar aside menu menus nav
    navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments reply replies
    discussion disqus share sharing social follow newsletter subscribe signup login search related
    recommended recirculation pagination pager complementary contentinfo""".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies discussion disqus".split())
# Words that change nothing beside one of these: a class counts as a whole, "site-footer" but not "no-sidebar".
NEUTRAL = frozenset("box bar wrapper wrap container block section area widget list group inner site page post article main".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*)>?", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "words", "tokens", "children", "digest", "size", "plain", "kept")

    def __init__(self, tag: str, attributes: str):
        self.tag = tag
        found = _NAMED.findall(attributes) if "=" in attributes else ()
        values = [value.strip("\"'").lower() for _, value in found]
        self.words = frozenset(w for v in values for w in _WORD.findall(v))
        self.tokens = [frozenset(_WORD.findall(t)) for v in values for t in v.split()]
        self.children: list[Element | str] = []
        self.digest = self.size = 0
        self.plain = self.kept = False

    def named(self, words: frozenset[str] = ASIDE_WORDS) -> bool:
        """Whether a whole class, id or role says that this is no part of the article."""
        return not words.isdisjoint(self.words) and any(t & words and t <= words | NEUTRAL for t in self.tokens)

    def aside(self, words: frozenset[str] = ASIDE_WORDS) -> bool:
        return self.tag in ASIDE or not self.kept and self.named(words)


def parse(page: str) -> Element:
    """The page as a tree. Unclosed elements end with their parent or where HTML ends them."""
    root = Element("#page", "")
    stack, at = [root], 0
    for m in iter(lambda: _TOKEN.search(page, at), None):
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag = name.lower()
        if m.group(1):
            _close(stack, tag)
            continue
        _end_implied(stack, tag)
        element = Element(tag, m.group(3))
        stack[-1].children.append(element)
        if tag in VOID or m.group(3).endswith("/"):
            continue
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            element.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        stack.append(element)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*>?", re.I)


def _close(stack: list[Element], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if tag not in BLOCK and stack[i].tag in BLOCK:
            return  # the end of an inline element doesn't end a block


_SCOPE = BLOCK - {"p", "br", "hr"}


def _end_implied(stack: list[Element], tag: str) -> None:
    if tag in BLOCK and tag != "br":
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in _SCOPE:
                break
    if tag in CLOSES:
        ended, within = CLOSES[tag]
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in within:
                return
            if stack[i].tag in ended.split():
                del stack[i:]
                return


def _inner(element: Element) -> Iterator[Element]:
    """All elements below, children before parents, without recursion."""
    order, todo = [], [element]
    while todo:
        e = todo.pop()
        order.append(e)
        todo.extend(c for c in e.children if not isinstance(c, str))
    return reversed(order)


def digest_subtrees(root: Element) -> None:
    """Weighs the page and sets ``digest`` of each subtree: tag, class and id words, and its children in order; text by its words."""
    for e in _inner(root):
        h = xxhash.xxh64(e.tag.encode())
        h.update(" ".join(sorted(e.words)).encode())
        for c in e.children:
            if isinstance(c, str):
                if squeezed := " ".join(c.split()):
                    h.update(b"\0" + squeezed.encode())
            else:
                h.update(b"\1" + c.digest.to_bytes(8, "big"))
        e.digest = h.intdigest()
    weigh(root)


def weigh(root: Element) -> None:
    """``size`` of each subtree's text, and ``kept`` where class words decide nothing: on the page's frame,
    on what is or holds an article, and on what holds most of the page's text, unless it is the readers'
    comments on an article."""
    for e in _inner(root):
        below = [c for c in e.children if not isinstance(c, str)]
        if e.tag not in RAW:
            e.size = sum(len("".join(c.split())) for c in e.children if isinstance(c, str)) + sum(c.size for c in below)
        e.plain = e.tag == "article" and not e.named() or any(c.plain for c in below)
    for e in _inner(root):
        if e.words:
            comments = root.plain and e.named(COMMENT_WORDS)
            most = 2 * e.size > root.size and not comments
            e.kept = e.tag in ("html", "body", "main") or e.plain or most or e.tag == "article" and not root.plain


def containers(root: Element) -> list[Element]:
    """The elements that hold the article: ``article``, else ``main``; [] if the page has neither."""
    found: dict[str, list[Element]] = {"article": [], "main": []}
    todo = [root]
    while todo:
        e = todo.pop()
        kind = "main" if e.tag == "main" or "main" in e.words and e.tag != "html" and e.tag != "body" else e.tag
        if kind == "article" and not e.aside():
            found["article"].append(e)
            continue
        if kind == "main":
            found["main"].append(e)
        if kind == "main" or not e.aside():
            todo.extend(c for c in reversed(e.children) if not isinstance(c, str))
    return found["article"] or found["main"][:1]


def text_of(parts: list[Element], dropped: set[int], article: bool) -> str:
    """Text of the parts without subtrees in ``dropped`` and without what isn't article: blocks
    trimmed, white space as single spaces, joined by one space. Inside an ``article`` a header
    holds its title and stays."""
    out: list[str] = []
    todo: list[Element | str] = list(reversed(parts))
    tops = {id(p) for p in parts}
    words = ASIDE_WORDS - {"header"} if article else ASIDE_WORDS
    while todo:
        e = todo.pop()
        if isinstance(e, str):
            out.append(e)
            continue
        if e.digest in dropped or id(e) not in tops and (e.aside(words) or e.tag == "header" and not article):
            continue
        if e.tag in BLOCK:
            out.append(" ")
            todo.append(" ")
        todo.extend(reversed(e.children))
    return " ".join(html.unescape("".join(out)).split())
