"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is read once into its leaf blocks: runs of text between the begin and
end of block elements, with the tags and the class and id names of all open
ancestors but ``html`` and ``body``, whose names describe the site and not a
block.  A name counts in each of its forms (``ad-free`` is not ``ad``), by how
far above the block its element stands and by how much of the page's text that
element holds, so a word on a wrapper is another feature than the same word on
a small box.  Further features are the block's own element, the share of the
page's text in its parents, what its text looks like (length, share inside
links, sentence end, copyright sign) and how long its neighbours are.  The
field gives every block a score for being main text and one for following a
block of the same or the other kind; Viterbi decoding keeps the best sequence.

The model is trained once per session on labelled pages.  There is no table of
page labels, so the labelled pages are drawn from layouts (``labelled_page``):
every page is put together from zones whose label is known, in random order,
nesting and size, with words of no language.  Zones have the element and class
names that such zones have on the web, or names that say nothing; containers of
any kind, main text included, also bear names of other zones in compounds
(``has-sidebar``, ``ad-free``), as pages do to describe their layout.  The model
is small and travels with the task.

Texts are taken whole: character references are decoded, white space inside a
block becomes one space, blocks of main text are joined by a line feed.
Scripts, styles, templates, titles and the like never become blocks.  An
element whose text is hidden (``HIDDEN``) hides it up to its own end tag or that
of an element around it; one without an end tag of its own, up to the next block
element; the head ends with the first text or element that cannot stand in it.
Only a script or style without an end tag reaches to the end of the page.

Defined results: a null or empty page has an empty text; a page without tags
is one block; a page of any length is read whole; unclosed and stray tags,
comments and quotes do not stop the reading, and a quote within an unquoted
value opens nothing; labels of equal score go to main text; an empty table
gives an empty table; repeated rows are read alike; extra columns stay,
whatever their names (an input column of the output's name is replaced).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.common import fresh, map_arrow, quoted

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+)*+>
    |[^>]*+(?:>|\Z))""", re.S | re.X)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# elements that hold no markup; their text is not part of the page's text
RAW = frozenset("script style title textarea".split())
# elements whose text is not part of the page's text
HIDDEN = frozenset("template noscript select option button svg iframe object canvas audio video head".split())
# elements that may stand in the head
IN_HEAD = frozenset("meta link base noscript template head html".split()) | RAW
# elements that stand within a line
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br input "
                   # formulas
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose "
                   "msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics "
                   "annotation annotation-xml".split())
# elements whose names describe the page as a whole
PAGE = frozenset("html body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# a start tag of the value's elements ends an open element of the key
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}}
_END = (".", "!", "?", "…", "。", ":", '"', "”", ")")

Block = tuple[tuple[str, ...], str]


def _tokens(tag: str, attributes: str) -> list[str]:
    """Feature words of an element: its tag and its class, id and role names, whole and, if compound, by their words."""
    out = [f"<{tag}"]
    if "=" in attributes:
        for _, value in _NAMES.findall(attributes):
            for name in value.strip("\"'").split():
                words = [w.lower() for w in _NAME_WORD.findall(name)]
                if len(words) == 1:
                    out.append(f".{words[0]}")
                elif words:
                    out += [f".{'-'.join(words)}", *[f"~{w}" for w in words]]
    return out


def _length(text: str) -> int:
    n = text.count(" ") + 1
    return next((k for k, m in enumerate((2, 5, 10, 20, 50)) if n <= m), 5)


def _look(text: str, linked: int, own: str) -> list[str]:
    share = linked / len(text)
    return ["any", f"own={own}", f"words={_length(text)}",
            "link=" + ("none" if not linked else "all" if share > 0.9 else "some"),
            "end=" + str(text.endswith(_END)), "copyright=" + str("©" in text)]


def _held(share: float) -> str:
    """How much of the page's text an element holds."""
    return "all" if share > 0.95 else "most" if share > 0.5 else "some" if share > 0.1 else "few"


@dataclass
class _Leaf:
    text: str
    look: list[str]
    names: tuple[tuple[str, int, int], ...]    # feature word, its innermost element, that element's solid depth
    parents: list[int]                         # the nearest solid elements, from the inside
    depth: int                                 # solid elements that are open


def _described(leaves: list[_Leaf], held: list[int]) -> list[Block]:
    """The features of all leaves, once it is known how much text every element holds."""
    total = max(1, sum(len(x.text) for x in leaves))
    lengths = [_length(x.text) for x in leaves]
    part = [_held(n / total) for n in held]
    out, known, words = [], None, []
    for k, x in enumerate(leaves):
        if x.names is not known:
            known, words = x.names, []
            for w, element, depth in x.names:
                away = x.depth - depth
                words += [w, f"{w}|{part[element]}", f"{w}|{'near' if away < 2 else 'mid' if away < 4 else 'far'}"]
        near = [f"in{i}={part[e]}" for i, e in enumerate(x.parents)]
        sides = [f"prev={lengths[k - 1] if k else 'none'}", f"next={lengths[k + 1] if k + 1 < len(leaves) else 'none'}"]
        out.append(((*words, *x.look, *near, *sides), x.text))
    return out


Tag = tuple[int, int, bool, str, str]


def _tags(html: str) -> list[Tag]:
    """(begin, end, is an end tag, name, attributes) of every tag; begin and end of raw text are those of its element."""
    out: list[Tag] = []
    endless: set[str] = set()
    at, size = 0, len(html)
    while m := _TAG.search(html, at):
        at = m.end()
        tag = (m.group(2) or "").lower()
        if tag in RAW and not m.group(1) and not m.group(3).endswith("/>"):
            end = None if tag in endless else re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            if end or tag in ("script", "style"):
                at = end.end() if end else size
                tag = ""
            else:
                endless.add(tag)
        out.append((m.start(), at, bool(m.group(1)), tag, m.group(3) or ""))
    return out


def _ended(tags: list[Tag]) -> set[int]:
    """The places of start tags of hidden elements that have an end tag of their own."""
    out: set[int] = set()
    begun: dict[str, list[int]] = {}
    for k, (_, _, is_end, tag, attributes) in enumerate(tags):
        if tag in HIDDEN and (is_end or not attributes.endswith("/>")):
            if not is_end:
                begun.setdefault(tag, []).append(k)
            elif begun.get(tag):
                out.add(begun[tag].pop())
    return out


def blocks(html: str | None) -> list[Block]:
    """(features, text) of every leaf block in page order."""
    out: list[_Leaf] = []
    html = html or ""
    stack: list[tuple[str, list[str], int]] = []      # name, feature words, number of the element
    held: list[int] = []        # characters in every element so far, by its number
    places: dict[str, list[int]] = {}      # where in the stack elements of a name are
    solid: list[int] = []       # places of elements that do not stand within a line
    active: dict[str, list[tuple[int, int]]] = {}     # by feature word, the open elements that bear it
    veils: list[int] = []       # places of hidden elements in the stack
    loose = False               # in a hidden element without an end tag
    pieces: list[str] = []
    linked = 0
    links = 0
    known: tuple[tuple[str, int, int], ...] | None = None
    own = "none"

    def push(tag: str, words: list[str]) -> None:
        nonlocal links
        places.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            solid.append(len(stack))
        stack.append((tag, words, len(held)))
        links += tag == "a"
        for w in words:
            active.setdefault(w, []).append((len(held), len(solid)))
        held.append(0)

    def pop() -> None:
        nonlocal links
        tag, words, number = stack.pop()
        if stack:
            held[stack[-1][2]] += held[number]
        places[tag].pop()
        if tag not in INLINE:
            solid.pop()
        if veils and veils[-1] == len(stack):
            veils.pop()
        links -= tag == "a"
        for w in words:
            active[w].pop()
            if not active[w]:
                del active[w]

    def flush() -> None:
        nonlocal linked, known
        text = " ".join("".join(pieces).split())
        if text:
            if known is None:
                known = tuple((w, *of[-1]) for w, of in active.items())
            if stack:
                held[stack[-1][2]] += len(text)
            out.append(_Leaf(text, _look(text, min(linked, len(text)), own), known,
                             [stack[i][2] for i in solid[:-3:-1]], len(solid)))
        pieces.clear()
        linked = 0

    tags = _tags(html)
    ended = _ended(tags)
    at = 0
    for k, (begin, end, is_end, tag, attributes) in enumerate([*tags, (len(html), len(html), False, "", "")]):
        raw, at = html[at:begin], end
        if raw and stack and stack[-1][0] == "head" and len(veils) == 1 and raw.strip():
            pop()
        if raw and not veils and not loose:
            raw = unescape(raw) if "&" in raw else raw
            pieces.append(raw)
            if links:
                linked += len(raw.strip())
        if not tag:
            continue
        if is_end:
            depth = places[tag][-1] if places.get(tag) else None
            # a tag within a hidden element, or its own, does not part the text around it
            apart = tag not in INLINE and tag not in HIDDEN and not (veils and (depth is None or depth > veils[0]))
            if apart:
                loose = False
                flush()
            if depth is not None and (tag not in INLINE or not solid or solid[-1] < depth):
                while len(stack) > depth:
                    pop()
                if apart:
                    known, own = None, stack[solid[-1]][0] if solid else "none"
            continue
        if tag in RAW:
            loose = loose or (not veils or stack[-1][0] == "head") and not attributes.endswith("/>")
            continue
        if stack and stack[-1][0] == "head" and tag not in IN_HEAD:
            pop()
        if tag in HIDDEN:
            if not attributes.endswith("/>"):
                if k in ended or tag == "head":
                    veils.append(len(stack))
                    push(tag, [])
                elif not veils:
                    loose = True
            continue
        if tag == "br" and not veils and not loose:
            pieces.append(" ")
        if tag not in INLINE and not veils:
            # what stands in a hidden element without an end tag: sources and parameters
            loose = loose and tag in VOID and tag != "hr"
            if not loose:
                flush()
                ends = CLOSED_BY
                while stack and (stack[-1][0] in INLINE and tag in ("p", "li")
                                 or stack[-1][0] in ends and (ends[stack[-1][0]] is None or tag in ends[stack[-1][0]])):
                    pop()
                known, own = None, tag
        if tag in VOID or attributes.endswith("/>"):
            continue
        push(tag, [] if veils or tag in PAGE else _tokens(tag, attributes))
    flush()
    while stack:
        pop()
    return _described(out, held)


class Field:
    """The random field: a weight per feature (for main text against the rest), first and next label's weights."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.first = [0.0, 0.0]
        self.next = [[0.0, 0.0], [0.0, 0.0]]

    def emissions(self, page: list[Block]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in features]) for features, _ in page]

    def decode(self, page: list[Block]) -> list[int]:
        """The labels of the best sequence (Viterbi); ties go to main text."""
        if not page:
            return []
        back, best = [], None
        for e in self.emissions(page):
            if best is None:
                best = [self.first[0], self.first[1] + e]
                continue
            came = [1 if best[1] + self.next[1][y] >= best[0] + self.next[0][y] else 0 for y in (0, 1)]
            back.append(came)
            best = [best[came[y]] + self.next[came[y]][y] + (e if y else 0.0) for y in (0, 1)]
        label = 1 if best[1] >= best[0] else 0
        out = [label]
        for came in reversed(back):
            label = came[label]
            out.append(label)
        return out[::-1]

    def marginals(self, page: list[Block]) -> tuple[np.ndarray, np.ndarray]:
        """P(label) by block and P(label, next label) by neighbouring blocks (forward-backward)."""
        e = np.zeros((len(page), 2))
        e[:, 1] = self.emissions(page)
        step = np.array(self.next)
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[0] = e[0] + self.first
        for t in range(1, len(page)):
            ahead[t] = e[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + step, axis=0)
        for t in range(len(page) - 2, -1, -1):
            behind[t] = np.logaddexp.reduce(step + (e[t + 1] + behind[t + 1])[None, :], axis=1)
        total = np.logaddexp(*ahead[-1])
        both = ahead[:-1, :, None] + step + (e[1:] + behind[1:])[:, None, :] - total
        return np.exp(ahead + behind - total), np.exp(both)


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 6, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by AdaGrad over labelled pages."""
    field, squares = Field(), {}
    order = random.Random(5)

    def move(key: object, value: float, gradient: float) -> float:
        squares[key] = squares.get(key, 1e-6) + gradient * gradient
        return float(value + rate * gradient / squares[key] ** 0.5 - decay * value)

    for _ in range(rounds):
        order.shuffle(pages)
        for page, labels in pages:
            if not page:
                continue
            single, both = field.marginals(page)
            for (features, _), y, p in zip(page, labels, single[:, 1], strict=True):
                gap = y - p
                if abs(gap) > 1e-4:
                    for f in features:
                        field.weights[f] = move(f, field.weights.get(f, 0.0), gap)
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            gap = seen - both.sum(axis=0)
            for a in (0, 1):
                field.first[a] = move(("first", a), field.first[a], (labels[0] == a) - single[0, a])
                for b in (0, 1):
                    field.next[a][b] = move((a, b), field.next[a][b], gap[a, b])
    return field


# Layouts of the labelled pages: containers by what stands in them.
MAIN = ("article", "main", 'div class="content"', 'div class="post-body"', 'section class="entry-content"',
        'div id="main-content"', 'div class="article-body"', 'main role="main"', 'div class="story text"')
OUTER = ("", "div", 'div class="wrapper"', 'div class="container"', 'div id="page"', "section", 'div class="row"')
LINKS = ("nav", 'div class="menu"', 'ul class="navbar"', 'div id="navigation"', 'div class="breadcrumbs"',
         'nav class="site-nav" role="navigation"', 'div class="pagination"', 'div class="tag-list tags"',
         'ul class="menu"', 'div class="related links"', 'div class="share social"')
SIDE = ("aside", 'div class="sidebar"', 'div id="side-column"', 'div class="widget"', 'section class="related"',
        'div class="newsletter subscribe"', 'div class="recommended teaser"')
ADS = ('div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="banner"', 'div id="ad-top"',
       'div class="sponsored promo"', 'section class="advertisement"', 'div class="promotion"', 'ins class="ad-slot"')
NOTICES = ('div class="cookie-notice"', 'div class="alert"', 'div id="consent"', 'div class="notice"',
           'div class="popup modal"', 'div class="cookie banner"', 'div role="dialog"', 'div class="disclaimer legal"')
HEADS = ("header", 'div class="header"', 'div id="masthead"', 'div class="top-bar"', 'header class="site-header"')
FEET = ("footer", 'div class="footer"', 'div id="footer"', 'footer class="site-footer"', 'div class="copyright"')
FORMS = ("form", 'form class="search"', 'div class="login-form"', 'form id="subscribe"', 'fieldset')
COMMENTS = ('div class="comments"', 'section id="comments"', 'div class="comment-list"', 'ol class="commentlist"',
            'div class="discussion replies"', 'section class="reader-comments responses"')


# Words that containers of any kind bear in compounds, to say what a page has or lacks.
TOPICS = ("sidebar", "menu", "nav", "cookie", "consent", "ad", "ads", "banner", "comments", "comment", "widget", "footer",
          "header", "search", "form", "social", "share", "related", "promo", "popup", "newsletter", "login", "notice")
COMPOUNDS = ("has-{}", "no-{}", "with-{}", "{}-free", "{}-open", "{}-closed", "{}-enabled", "{}-left", "{}-right",
             "without-{}", "single-{}", "{}-area", "{}-visible", "hide-{}", "is-{}", "{}-below", "page-{}")


def _odd(rng: random.Random) -> str:
    """A name that says nothing."""
    return "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(2, 10)))


def _described_layout(container: str, rng: random.Random, share: float = 0.3) -> str:
    """A container that sometimes bears names of other zones in compounds, or alone, besides its own."""
    if not container or rng.random() > share:
        return container
    names = [rng.choice(COMPOUNDS).format(rng.choice(TOPICS)) for _ in range(rng.randint(1, 3))]
    if rng.random() < 0.15:
        names.append(rng.choice(TOPICS))
    if rng.random() < 0.3:
        names.append(_odd(rng))
    rng.shuffle(names)
    if ' class="' in container:
        return container.replace(' class="', f' class="{" ".join(names)} ' if rng.random() < 0.5 else ' class="', 1) \
            if rng.random() < 0.7 else re.sub(r' class="([^"]*)"', lambda m: f' class="{m.group(1)} {" ".join(names)}"', container)
    return f'{container} class="{" ".join(names)}"'


def _nameless(container: str, rng: random.Random) -> str:
    """Now and then the container with a name that says nothing, in place of its own."""
    if rng.random() < 0.2:
        return f'{rng.choice(("div", "div", "section"))} class="{_odd(rng)}"'
    return container


def _words(rng: random.Random, low: int, high: int) -> str:
    syllables = ("ka", "lo", "mi", "ter", "en", "su", "ra", "vo", "nil", "ö", "dá", "pe", "shi", "qu")
    out = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    return " ".join(out).capitalize() + rng.choice((".", ".", ".", "", "!", "?"))


def _within(container: str, inner: str, rng: random.Random) -> str:
    """``inner`` in its container, whose end tag is sometimes left out."""
    if not container:
        return inner
    tag = container.split()[0]
    return f"<{container}>{inner}</{tag}>"


def labelled_page(rng: random.Random) -> str:
    """One page; the words of main text carry the mark ``\\x01``, by which its blocks are labelled."""
    def prose(mark: str, low: int, high: int) -> str:
        out = []
        for _ in range(rng.randint(low, high)):
            text = mark + _words(rng, 1, rng.choice((3, 12, 60, 120)))
            if rng.random() < 0.2:
                text += f' <a href="#">{_words(rng, 1, 4)}</a> ' + _words(rng, 1, 9)
            kind = rng.random()
            out.append(f"<p>{text}" + rng.choice(("</p>", "</p>", "</p>", "", "<br>")) if kind < 0.75 else
                       f"<ul><li>{text}</li><li>{mark}{_words(rng, 1, 9)}</li></ul>" if kind < 0.82 else
                       f"<blockquote>{text}</blockquote>" if kind < 0.88 else
                       f"<h{rng.randint(2, 4)}>{mark}{_words(rng, 1, 7)}</h2>" if kind < 0.94 else
                       f"<div>{text}</div>" if kind < 0.98 else f"<pre>{text}</pre>")
        return "".join(out)

    def link_list() -> str:
        items = [f'<a href="/x">{_words(rng, 1, 5)}</a>' for _ in range(rng.randint(1, 8))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if rng.random() < 0.7 else " ".join(items)

    def rest(container: str) -> str:
        if container in LINKS:
            inner = link_list()
        elif container in FORMS:
            inner = f'<label>{_words(rng, 1, 3)}</label><input name="q">'
            inner += rng.choice(("", f"<p>{_words(rng, 2, 20)}</p>"))
        elif container in FEET:
            inner = rng.choice(("&copy; ", "© 2020 ", "")) + _words(rng, 1, 25) + rng.choice(("", link_list()))
        elif container in COMMENTS:
            inner = "".join(f'<div class="comment"><b>{_words(rng, 1, 2)}</b><p>{_words(rng, 1, 60)}</p></div>'
                            for _ in range(rng.randint(1, 5)))
        elif container in HEADS:
            inner = rng.choice((f"<h1>{_words(rng, 1, 4)}</h1>", f"<p>{_words(rng, 1, 8)}</p>", "")) + link_list()
        else:
            inner = rng.choice((_words(rng, 1, 40), prose("", 1, 3), f"<h3>{_words(rng, 1, 4)}</h3>" + link_list()))
        return _within(_nameless(container, rng), inner, rng)

    title = f"<h1>\x01{_words(rng, 1, 12)}</h1>"
    main = prose("\x01", 1, rng.choice((1, 3, 9, 9)))
    if rng.random() < 0.15:
        main += rest(rng.choice(ADS + SIDE + LINKS)) + prose("\x01", 1, 4)
    main = rng.choice((title, f"<header>{title}</header>" if rng.random() < 0.3 else title, "")) + main
    # some pages have no container, or one whose name says nothing
    odd = _odd(rng)
    plain = rng.choice(("", "div", f'div class="{odd}"', f'section id="{odd}"', "section"))
    own = _described_layout(rng.choice(MAIN) if rng.random() < 0.6 else plain, rng)
    body = _within(rng.choice(OUTER), _within(own, main, rng), rng)
    bare = rng.random() < 0.2        # nothing but main text
    before = [] if bare else [rest(rng.choice(kind)) for kind in (HEADS, LINKS, ADS, NOTICES, SIDE, FORMS)
                              if rng.random() < 0.35]
    after = [] if bare else [rest(rng.choice(kind)) for kind in (COMMENTS, SIDE, LINKS, ADS, NOTICES, FORMS, FEET)
             if rng.random() < 0.35]
    rng.shuffle(before)
    tail = rng.choice(("</body></html>", "</body></html>", ""))
    if rng.random() < 0.05:
        return "\x01" + _words(rng, 1, 60)      # no markup at all
    whole = "".join(before) + body + "".join(after)
    if rng.random() < 0.4:
        whole = _within(_described_layout(rng.choice(OUTER[1:]), rng, 0.8), whole, rng)
    return "<!DOCTYPE html><html><head><title>t</title></head><body>" + whole + tail


def labelled_blocks(page: str) -> tuple[list[Block], list[int]]:
    found = blocks(page)
    return ([(f, t.replace("\x01", "")) for f, t in found], [int("\x01" in t) for _, t in found])


@lru_cache(maxsize=1)
def trained(n_pages: int = 1_500, seed: int = 11) -> Field:
    """The field, trained on ``n_pages`` labelled pages; the same on every call."""
    rng = random.Random(seed)
    return fit([labelled_blocks(labelled_page(rng)) for _ in range(n_pages)])


def main_text(html: str | None, field: Field) -> str:
    """The main text of one page."""
    page = blocks(html)
    return "\n".join(t for (_, t), y in zip(page, field.decode(page), strict=True) if y)


def _extract(at: int, out_col: str, field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                texts = pa.array([main_text(h, field) for h in part.column(at).to_pylist()], type=pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*batch.schema.names, out_col])
    return run


def extract(df: DataFrame, html_col: str = "html", out_col: str = "text", field: Field | None = None) -> DataFrame:
    """``df`` with the main text of each page added as ``out_col``."""
    df = df.select(*[quoted(c) for c in df.columns if c.lower() != out_col.lower()])
    made = fresh(df.columns, "main_text")
    out = map_arrow(df, _extract(df.columns.index(html_col), made, field or trained()), f"`{made}` string")
    return out.toDF(*df.columns, out_col)
