"""A page's block elements and text blocks as a tree, from HTML as it is found.

Browsers' rules that matter for text are kept: unclosed paragraphs and list
items end where the next begins, end tags without a start are ignored,
scripts and styles are raw text, form controls hold no text. Inline markup
is no node; ``br`` is white space. One pass over the text, no backtracking.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

# Fixed values of HTML: element names by their part in the layout of text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark math nobr q rb rp rt ruby s samp small span strike strong sub sup "
                   "time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp".split())
MUTE = frozenset("head select option optgroup button template svg object audio video canvas datalist map".split())
IN_HEAD = frozenset("meta link base title script style noscript template".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
                   "menu nav ol p pre section summary table ul".split())
#: An element that starts ends an open one of the second group, unless one of the third lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"})}
#: Elements told apart as features; all others are one.
TAGS = ("#text", "#root", "html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "fieldset", "label", "legend", "p", "h1", "h2",
        "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "address", "details",
        "summary", "dialog", "menu", "center", "#other")
TAG = {t: k for k, t in enumerate(TAGS)}
#: Words of class, id, role, itemprop and aria-label by what they say.
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager toc topbar tabs skip",
    "edge": "header masthead footer foot colophon contentinfo copyright bottom banner logo branding",
    "side": "sidebar side aside rail widget widgets complementary related recommended recommendations popular trending latest more readnext seealso",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup toast paywall dialog message disclaimer privacy",
    "advert": "ad ads adv advert adverts advertisement adbox adsense adslot sponsor sponsored sponsors promo promoted promotion outbrain taboola dfp commercial",
    "talk": "comment comments commentlist disqus reply replies respond discussion discussions responses reactions feedback review reviews guestbook",
    "share": "share sharing social follow tools toolbar actions buttons print rating vote votes",
    "form": "form search searchbox login signin register contact poll survey input",
    "hidden": "hidden invisible offscreen sr visuallyhidden noprint",
    "body": "article articlebody content post entry story body text main maincontent prose markdown page copy hentry lead intro abstract",
}
HINT = tuple(HINTS)
_HINT_OF = {w: 1 << k for k, g in enumerate(HINT) for w in HINTS[g].split()}
DEEPEST = 256

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


@dataclass
class Tree:
    """Nodes in page order, a parent before its children: tag number, hint bits, text (leaves only), linked characters and given label (-1: none)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[int] = field(default_factory=lambda: [TAG["#root"]])
    hint: list[int] = field(default_factory=lambda: [0])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    label: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int, tag: int, hint: int, text: str = "", linked: int = 0, label: int | None = None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.hint.append(hint)
        self.text.append(text)
        self.linked.append(linked)
        self.depth.append(self.depth[parent] + 1)
        self.label.append(self.label[parent] if label is None else label)
        return len(self.parent) - 1


@lru_cache(4096)
def _attributes(raw: str) -> tuple[int, int | None]:
    """Hint bits of an element's attributes, and the label that ``data-main`` gives it."""
    bits, label = 0, None
    for name, value in _ATTR.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            for word in _WORD.findall(value):
                bits |= _HINT_OF.get(word.lower(), 0)
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            bits |= _HINT_OF["hidden"]
        elif name == "data-main":
            label = int(value == "1")
    return bits, label


def parse(page: str, label_of: dict[str, int] | None = None) -> Tree:
    """The tree of a page. ``label_of`` labels elements by name where no ``data-main`` does; others inherit."""
    tree, at, end = Tree(), 0, len(page)
    stack: list[tuple[str, int]] = [("#root", 0)]  # name, its block node
    opened: dict[str, int] = {}
    run: list[str] = []
    linked = mute = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        if text:
            tree.add(stack[-1][1], TAG["#text"], 0, text, min(linked, len(text)))
        run.clear()
        linked = 0

    def said(piece: str) -> None:
        nonlocal linked
        if piece and not mute:
            piece = html.unescape(piece) if "&" in piece else piece
            run.append(piece)
            if opened.get("a"):
                linked += len(piece.strip())

    def pop() -> None:
        nonlocal mute
        name = stack[-1][0]
        if name not in INLINE:
            flush()
        stack.pop()
        opened[name] -= 1
        mute -= name in MUTE

    def close(names: set[str] | frozenset[str], within: set[str] | frozenset[str] = frozenset()) -> None:
        """End the innermost open element of ``names`` and all in it, unless one of ``within`` holds it off."""
        if any(opened.get(n) for n in names):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    while len(stack) > k:
                        pop()
                    return
                if stack[k][0] in within:
                    return

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            said(page[at:])
            break
        found = _TOKEN.match(page, lt)
        if not found:  # a plain less-than sign
            said(page[at:lt + 1])
            at = lt + 1
            continue
        said(page[at:lt])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if name == "br":
                said(" ")
            elif not opened.get(name):
                continue
            elif name in INLINE:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k]  # blocks inside stay open
                        opened[name] -= 1
                        break
            else:
                close({name})
            continue
        if opened.get("head") and name not in IN_HEAD and name != "head":
            close({"head"})
        if name == "br":
            said(" ")
        elif name in RAW:
            tail = _RAW_END[name].search(page, at)
            at = end if tail is None else tail.start()
            if tail is not None:
                at = page.find(">", at) + 1 or end
        elif name in VOID:
            if name == "hr":
                close({"p"})
                flush()
        else:
            if name in ENDS_P:
                close({"p"}, {"button", "table", "td", "th"})
            if name in ENDS:
                close(*ENDS[name])
            node = stack[-1][1]
            if name not in INLINE:
                flush()
                if not mute and name not in MUTE and tree.depth[node] < DEEPEST:
                    bits, label = _attributes(found[3])
                    if label is None and label_of:
                        label = label_of.get(name)
                    node = tree.add(node, TAG.get(name, TAG["#other"]), bits, label=label)
            if not found[3].endswith("/") or name not in ("svg", "math"):
                stack.append((name, node))
                opened[name] = opened.get(name, 0) + 1
                mute += name in MUTE
    flush()
    return tree
