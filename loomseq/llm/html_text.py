"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat blocks at block-level tags. A block has its number of words and the share of them inside links, the same
two numbers of the block before, of the block after, and of the whole container (div, section, article, ...) that it stands in,
whose share of the page's largest container counts as well.
Beside these stand hints of the markup: whether the block is inside the page's article (or, where there is none, its main or
content element), inside a boilerplate element (nav, footer, aside, form, ...), inside a container whose name speaks of
boilerplate (possibly or surely), inside reader comments, or inside a heading. A decision tree says which blocks are text. It is
grown from the small labelled pages below, whose blocks carry their labels; no hint decides alone: a container with a
boilerplate name and long unlinked paragraphs inside an article is text, and pages without any hint are told by words and links.
Markup that never shows (script, style, template, head, comments of the markup) makes no block.

Defined results: null or empty html gives empty text; unclosed and cut-off tags end where the page ends; pages of any
length are read whole; repeated rows and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import rows_of

# The elements of HTML by what they mean for text.
HIDDEN = {"script", "style", "template", "noscript", "svg", "math", "iframe", "object", "head", "title", "textarea", "select", "option", "canvas", "video", "audio"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILER = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "header", "address"}
CONTAINER = {"body", "div", "section", "article", "main", "td", "center", *BOILER}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSE_EACH_OTHER = {"p", "li", "option", "dt", "dd", "tr", "td", "th"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}
CONTENT = re.compile(r"(?i)^(?:article|content|entry|main|post|story|text|body)(?:[_-]?(?:area|article|body|content|main|text))?$")
SURE = "ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|signup|sign-up|login|breadcrumbs?|pagination|pager|share|sharing|social|copyright|skip"
MAYBE = "banner|notices?|alert|nav|navbar|navigation|menu|sidebar|side|aside|widget|footer|header|masthead|topbar|related|recommended|tags?|legal|search|toolbar"
TALK = "comments?|commentary|repl(?:y|ies)|responses?|respond|disqus|discussions?|feedback|guestbook"
NAMED = [re.compile(rf"(?i)(?:^|[\s_-])(?:{x})(?:$|[\s_-])") for x in (MAYBE, SURE, TALK)]
#: A heading of reader comments; "discussion" alone is a common heading of articles, so it needs a number or a reader.
TALK_HEADING = re.compile(
    r"(?i)^(?:(?:\d+\s+)?(?:(?:reader|user)s?'?\s+)?(?:comments?|responses?|replies|kommentare?|commentaires?|comentarios?|leave a (?:reply|comment))(?:\s*\(?\d*\)?)?"
    r"|(?:\d+\s+|(?:reader|user)s?'?\s+)discussion|discussion\s*\(\d+\)):?$"
)
#: Words that say nothing of what a part is about: a name is sure only if nothing else stands beside its sure words.
VAGUE = set("area bar block body bottom box btn button buttons card col column container content field footer form group head header icon icons image inner item items label left "
            "line link links list main media message module nav network networks outer page panel policy post right row section set site slot space strip text title to tool tools top unit us window with wrap wrapper zone".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "group_words", "group_links", "group_share", "heading", "article", "boiler", "named", "talk")
ARTICLE, MAIN, BODY, NAV, NAME, TALKING = range(6)  # what an open element can be inside of


def _attributes(text: str) -> tuple[str, str, bool]:
    """(class and id, role, whether hidden)"""
    mark = role = ""
    gone = False
    for k, v in NAMES.findall(text) if text else ():
        k, v = k.lower(), v.strip("\"'")
        if k in ("class", "id"):
            mark += " " + v
        elif k == "role":
            role = v.lower()
        else:
            gone = gone or k == "hidden" or (k == "aria-hidden" and v.lower() == "true") or (k == "style" and re.search(r"display\s*:\s*none", v, re.I) is not None)
    return mark, role, gone


@functools.lru_cache(4096)
def _sure(mark: str) -> int:
    """2 where a class or id consists of sure words (and vague or possible ones), 1 where something else stands beside them, as in
    market-share."""
    level = 0
    for token in mark.split() if NAMED[1].search(mark) else ():
        if NAMED[1].search(token):
            rest = [x for x in re.split(r"[_-]+", NAMED[1].sub(" ", token).lower().replace(" ", "-")) if x]
            level = max(level, 2 if all(x in VAGUE or x.isdigit() or NAMED[0].search(x) or NAMED[1].search(x) for x in rest) else 1)
    return level


class _Open:
    """An open element: whether hidden, what it counts as, and its container's number."""

    __slots__ = ("group", "hidden", "kind", "tag")

    def __init__(self, tag: str, hidden: int, kind: tuple[int, ...], group: int):
        self.tag, self.hidden, self.kind, self.group = tag, hidden, kind, group


def _kind(tag: str, mark: str, role: str, in_article: bool) -> tuple[int, ...]:
    """What an element counts as: article, main, content by name, boilerplate, how sure its name is, reader comments."""
    plain = tag in ("html", "body")
    talk = not plain and bool(NAMED[2].search(mark))
    name = 0 if plain or tag in ("article", "main") else _sure(mark) or int(bool(NAMED[0].search(mark)))
    boiler = (tag in BOILER and not (tag == "header" and in_article)) or role in ROLES
    named = not plain and any(map(CONTENT.match, mark.split()))
    return int(tag == "article" and not talk), int(tag == "main" or role == "main"), int(named), int(boiler), name, int(talk)


class _Cutter:
    """Cuts one page into blocks: (text, words, share of linked words, heading, container, the six kinds)."""

    def __init__(self):
        self.out: list[tuple] = []
        self.piece: list[str] = []
        self.linked: list[str] = []
        self.stack: list[_Open] = []
        self.inside = [[0], [0], [0], [0], [0], [0]]  # for each kind the values of the open elements
        self.hidden = self.anchors = self.heading = 0
        self.up = [-1]  # container above each container

    def flush(self) -> None:
        if not self.piece:
            return
        text = " ".join(html.unescape("".join(self.piece)).split())
        if text:
            words = len(text.split())
            links = min(1.0, len(html.unescape(" ".join(self.linked)).split()) / words)
            if self.heading and TALK_HEADING.match(text):  # what follows in this container are reader comments
                at = next((x for x in reversed(self.stack) if x.tag in CONTAINER and x.tag not in ("body", "article", "main")), None)
                if at is not None and not at.kind[TALKING]:
                    at.kind = (*at.kind[:TALKING], 1)
                    self.inside[TALKING].append(1)
            self.out.append((text, words, links, self.heading, self.stack[-1].group if self.stack else 0, [max(x) for x in self.inside]))
        self.piece, self.linked = [], []

    def say(self, text: str) -> None:
        if text and not self.hidden:
            self.piece.append(text)
            if self.anchors:
                self.linked.append(text)

    def push(self, e: _Open) -> None:
        self.stack.append(e)
        self.hidden += e.hidden
        for of, x in zip(self.inside, e.kind, strict=True):
            if x:
                of.append(x)

    def pop(self) -> None:
        e = self.stack.pop()
        self.hidden -= e.hidden
        for of, x in zip(self.inside, e.kind, strict=True):
            if x:
                of.remove(x)

    def inline(self, tag: str, closing: bool, rest: str) -> None:
        """Inline elements only matter where they hide something."""
        within = bool(self.stack) and self.stack[-1].tag in INLINE  # what a hidden inline element holds
        if closing and within and self.stack[-1].tag == tag:
            self.pop()
        elif not closing and tag not in VOID and ((within and self.stack[-1].tag == tag) or (rest and _attributes(rest)[2])):
            self.push(_Open(tag, 1, (0,) * 6, self.stack[-1].group if self.stack else 0))

    def close(self, tag: str) -> None:
        if any(x.tag == tag for x in self.stack):
            while self.stack[-1].tag != tag:
                self.pop()
            self.pop()
        self.anchors = 0

    def open(self, tag: str, rest: str) -> None:
        if tag == "body":  # a head that was never closed
            while self.stack and self.stack[-1].tag != "html":
                self.pop()
        if tag in CLOSE_EACH_OTHER and self.stack and self.stack[-1].tag == tag:
            self.pop()
        mark, role, gone = _attributes(rest)
        group = self.stack[-1].group if self.stack else 0
        if tag in CONTAINER:
            self.up.append(group)
            group = len(self.up) - 1
        self.push(_Open(tag, int(tag in HIDDEN or gone), _kind(tag, mark, role, len(self.inside[ARTICLE]) > 1), group))

    def cut(self, page: str) -> list[tuple]:
        at, n = 0, len(page)
        while at < n:
            m = TOKEN.search(page, at)
            self.say(page[at : m.start() if m else n])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag == "a":
                self.anchors = 0 if closing else 1
            if tag in INLINE:
                self.inline(tag, closing, m[3])
                continue
            if not self.hidden:
                self.flush()
            if tag in HEADINGS:
                self.heading = 0 if closing else 1
            if tag in VOID:
                continue
            if closing:
                self.close(tag)
            elif tag in RAW:  # its inside is not markup
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            else:
                self.open(tag, m[3])
        self.flush()
        return self.out


def blocks(page: str | None) -> tuple[list[tuple], list[int]]:
    """The blocks of a page, and for each container the one above it."""
    cutter = _Cutter()
    return (cutter.cut(page) if page else []), cutter.up


def features(found: list[tuple], up: list[int]) -> np.ndarray:
    x = np.zeros((len(found), len(FEATURES)))
    words, links = np.array([b[1] for b in found], float), np.array([b[2] for b in found])
    x[:, 0], x[:, 1] = words, links
    x[1:, 2:4], x[:-1, 4:6] = x[:-1, :2], x[1:, :2]
    total, linked = np.zeros(len(up)), np.zeros(len(up))
    group = np.array([b[4] for b in found])
    np.add.at(total, group, words)
    np.add.at(linked, group, words * links)
    for g in range(len(up) - 1, 0, -1):  # a container comes after the one above it
        total[up[g]] += total[g]
        linked[up[g]] += linked[g]
    x[:, 6], x[:, 7] = total[group], linked[group] / np.maximum(1, total[group])
    kinds = np.array([b[5] for b in found])
    plain = (total - linked)[group]
    x[:, 8] = plain / max(1, plain.max())
    x[:, 9] = [b[3] for b in found]
    # inside the article, or the main, or the content element, whichever is the first that the page has text in: 2; outside it: 0;
    # pages without any: 1
    x[:, 10] = 1
    for k in (ARTICLE, MAIN, BODY):
        own = kinds[:, k] > 0
        if (words * (own & (kinds[:, TALKING] == 0) & (links < 0.5))).sum() >= (1 if k == ARTICLE else 12):
            x[:, 10] = np.where(own, 2, 0)
            break
    x[:, 11], x[:, 12], x[:, 13] = kinds[:, NAV], kinds[:, NAME], kinds[:, TALKING]
    return x


#: Labelled pages, made by hand from common layouts. +n is a block of n words that is text, -n one that isn't. Where the layout
#: tells them apart and not their sizes, a page is taken DRAWS times with sizes drawn anew: after a star from wide ranges, after an
#: o so that the text mostly stays the longest part of the page. RANGES: least and greatest logarithm of the factor for + and -.
DRAWS = 12
RANGES = {"* ": ((-2.5, 1.2), (-1.5, 1.5)), "o ": ((-0.7, 1.0), (-1.5, 0.0))}
PAGES = """
* <body><nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></nav><div class=ad>-9</div><article><h1>+9</h1><p>+120<p>+45<p>+4<p>+80</article><footer>-8</footer>
* <body><header><a>-2</a><p>-6</p></header><nav><a>-1</a></nav><article><h1>+5</h1><p>+2</p><p>+1</p></article><footer>-12 <a>-3</a></footer>
* <body><div class=cookie-notice>-35</div><nav><li><a>-2</a><li><a>-2</a></nav><article><header><h1>+7</h1><p>+4</p></header><p>+60</p><div class=ad>-14</div><p>+75</p><div class=newsletter>-22<form>-3</form></div><p>+50</p><footer>-4 <a>-3</a></footer></article><aside><h3>-2</h3><ul><li><a>-6</a><li><a>-7</a></ul></aside>
<body><article><h1>+6</h1><p>+90</p><section class=related-work><h2>+2</h2><p>+70</p><p>+55</p></section><section id=search-methods><h2>+2</h2><p>+48</p></section><section class=menu-design><h2>+3</h2><p>+64</p><ul><li>+4<li>+6<li>+5</ul></section><div class=notice>-16</div><div class=related><h3>-1</h3><ul><li><a>-7</a><li><a>-8</a></ul></div></article>
* <body><article><h1>+8</h1><p>+70</p><p>+66</p><div class=comments><h3>-2</h3><div><b>-1</b><p>-34</p></div><div><b>-1</b><p>-60</p></div></div></article><footer>-5</footer>
* <body><article><h1>+8</h1><p>+40</p><section class=user-responses><h2>-2</h2><p>-30</p><p>-85</p><p>-3</p></section></article><section id=comments><p>-44</p><p>-9</p><form>-4</form></section>
o <body><div id=top><a>-1</a> <a>-1</a> <a>-2</a></div><div><h1>+7</h1><p>+80</p><p>+55</p><p>+6</p><table><tr><td>+2<td>+1<tr><td>+1<td>+3</table><pre>+14</pre><p>+72</p></div><div><h3>-2</h3><ul><li><a>-5</a><li><a>-6</a><li><a>-4</a></ul></div><div>-5</div>
<body><div><a>-2</a></div><div><p>-4</p></div><div><h2>+6</h2><p>+48</p><ul><li>+9<li>+5<li>+12</ul><p>+36</p><p>+90</p></div><div class=sidebar><p>-14</p><a>-3</a></div><div>-7 <a>-2</a> <a>-2</a></div>
o <body><h1>+5</h1><p>+65</p><p>+40 <a>+2</a></p><p>+30</p><ul><li><a>-2</a><li><a>-3</a></ul><p>-3</p>
o <body><p>+30</p><p>+12</p><p>+150</p>
o <body><p>+150</p>
o <body><h1>+4</h1><p>+12</p>
o <body><div><p>+22</p></div>
<body><nav><a>-2</a> <a>-1</a></nav><main><h1>+6</h1><p>+44</p><p>+30</p><aside>-20</aside><p>+52 <a>+4</a></p><ul><li><a>+3</a> +6<li>+4</ul><form><p>-12</p></form></main><footer><p>-14</p><p>-26</p></footer>
<body><div class=header><h1>-3</h1><p>-7</p></div><div class=menu><a>-1</a> <a>-1</a></div><div class=content><h2>+5</h2><p>+54</p><p>+9</p><p>+61</p><div class=share>-2 <a>-1</a></div></div><div class=footer><p>-18</p><p>-40</p></div>
<body><div class=banner>-28</div><div class=sidebar><h3>-2</h3><p>-45</p></div><div class=alert>-18</div><div class=content><p>+4</p><h2>+3</h2><p>+30</p><blockquote>+18</blockquote><p>+2</p></div><div class=legal>-60</div>
* <body><main><article><h1>+9</h1><p>+35</p><h2>+1</h2><p>+22</p><figure><figcaption>+8</figcaption></figure><p>+28 <a>+9</a></p><p><a>+7</a></p></article><div><h2>-3</h2><p>-15 <a>-4</a></p><p>-40</p></div></main>
<body><article><p>+14</p><p>+1</p><div class=tags>-1 <a>-1</a> <a>-1</a></div><div class=social><a>-1</a> <a>-1</a></div><div class=header><h1>+6</h1><p>+50</p></div><div class=sidebar><p>-22</p></div></article><div class=widget><h4>-2</h4><p>-32</p></div><div class=subscribe><p>-55</p></div>
o <body><form><p>-8</p><label>-2</label></form><div>-3</div><div><h1>+8</h1><div><p>+33</p><p>+47</p><dl><dt>+1<dd>+11<dt>+2<dd>+9</dl></div></div><address>-9</address>
* <body><article><h1>+3</h1><p>+24</p><table><tr><th>+1<th>+2<tr><td>+1<td>+1</table><pre>+30</pre><ol><li>+3<li>+2</ol><p>+16</p></article><div>-10</div><p>-25</p><p>-60</p>
* <body><article><h1>+5</h1><p>+26</p><div class=sponsored><p>-48</p><p>-70</p></div><div class=promo>-9</div><p>+31</p><nav><a>-1</a> <a>-1</a></nav></article><aside><p>-36</p></aside><dialog><p>-24</p></dialog>
<body><div><h1>+6</h1><p>+38</p><p>+58</p><div class=comments><p>-28</p><p>-64</p></div></div><div class=popup><p>-30</p></div><div class=copyright>-6</div>
* <body><nav><ul><li><a>-1</a><li><a>-1</a></ul></nav><div class=ad>-8</div><article><h1>+8</h1><p>+8<br>+30</p><p>+24</p></article><footer>-14</footer>
* <body><div class=ad>-8</div><article><p>+8</p></article><footer>-30</footer>
* <body><article><h1>+3</h1><p>+3</p><p>+40</p></article>
* <body><article><h1>+4</h1><p>+90</p></article>
* <body><article><p>+4</p><p>+30</p><h2>+3</h2><p>+12</p></article><footer>-20</footer>
* <body><nav><a>-1</a></nav><article><p>+60</p><h2>+3</h2><p>+15</p><h2>+2</h2><p>+28</p></article>
* <body><div>-6</div><article><h2>+2</h2><ul><li>+6<li>+9<li>+3</ul><h2>+4</h2><p>+19</p></article><div>-40</div>
* <body><article><p>+100</p><p>+4</p></article><div class=ad>-7</div>
* <body><article><p>+30</p><p><a>+6</a> +30</p><ul><li><a>+4</a><li><a>+5</a> +3</ul></article><nav><a>-2</a></nav>
o <body><div><h1>+4</h1><p>+22</p></div>
o <body><div><p>+4</p><p>+33</p></div><div>-4</div>
o <body><div>-4</div><div><h1>+3</h1><p>+70</p><h2>+3</h2><p>+34</p></div><div>-4</div>
o <body><div><a>-3</a></div><div><h1>+5</h1><p>+28</p><h2>+4</h2><p>+35</p><ul><li>+4<li>+8</ul></div><div><a>-3</a> -2</div>
o <body><div><p>+46</p><p>+4</p><p>+46</p><p>+2</p></div>
* <body><header><h1>-2</h1></header><div class=notice>-24</div><article><h1>+7</h1><p>+7</p><div class=comments><p>-18</p></div></article><aside>-28</aside><footer>-9 <a>-2</a></footer>
* <body><div>-22</div><p>-33</p><article><h1>+7</h1><p>+24</p><ul><li>+2<li><a>+3</a><li>+1</ul><p>+20</p><table><tr><td>+1<td>+2</table></article><section><p>-30</p><p>-90</p></section>
* <body><article><h1>+7</h1><p>+7</p><form><p>-6</p></form><section class=comments><h2>-1</h2><article class=comment><p>-40</p></article></section></article>
<body><article><h1>+7</h1><p>+60</p><section class=navigation-basics><h2>+3</h2><p>+40</p><p>+28</p></section><div class=alert>-20</div><div class=sidebar><p>-15</p><p>-9</p></div><div class=toolbar><a>-1</a><a>-2</a></div><p>+44</p></article>
<body><article><h1>+7</h1><p>+30</p><div class=legal-history><p>+80</p><p>+42</p></div><div class=search>-3</div><div class=widget><h3>-2</h3><p>-18</p></div></article><div class=related-posts><p>-80</p></div>
o <body><div><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a><li><a>-3</a></ul></div><div><h1>+6</h1><p>+18</p><p>+14</p><p>+26</p></div><div>-8</div>
o <body><div><h1>+9</h1><p>+9</p><p>+44</p><p>+3</p><p>+51</p></div><div><a>-2</a> <a>-1</a> <a>-3</a></div><div>-9</div>
o <body><div><div><h1>+6</h1></div><div><p>+55</p><p>+48</p></div><div><p>+5</p><p>+60</p></div></div><div><p>-3 <a>-4</a></p></div>
o <body><div><a>-1</a> <a>-2</a></div><div><h1>+5</h1><p>+20</p><table><tr><td>+2<td>+1<td>+3</table><p>+1</p><ul><li>+3<li>+7<li>+2</ul><pre>+20</pre><p>+40 <a>+2</a></p></div><div>-9</div>
o <body><div class=ad>-9</div><div><h1>+5</h1><p>+3</p><p>+90</p><h2>+3</h2><p>+8</p></div><footer>-12</footer>
o <body><aside>-30</aside><div><h1>+5</h1><p>+8</p><p>+8</p><p>+20</p><p>+1</p><p>+40</p></div><div class=cookie-notice>-25</div>
o <body><div class=sidebar><p>-18</p></div><nav><a>-2</a></nav><div><h1>+5</h1><ul><li>+3<li>+7<li>+2</ul><p>+40 <a>+2</a></p><p>+20</p><h2>+4</h2></div>
o <body><div><h1>+5</h1><table><tr><td>+2<td>+1<td>+3</table><p>+60</p><pre>+8</pre></div>
o <body><div class=comments><p>-20</p></div><div><h1>+5</h1><p>+90</p><p>+90</p><p>+3</p></div><form><p>-6</p></form>
o <body><main><h1>+5</h1><p>+8</p><h2>+2</h2><p>+1</p><table><tr><td>+2<td>+1<td>+3</table><p>+40 <a>+2</a></p></main><div>-9</div>
* <body><article><h1>+5</h1><p>+1 <a>+2</a></p><p>+20</p><p>+3 <a>+2</a></p></article>
* <body><article><h1>+5</h1><p>+8</p><div class=ad>-9</div><p>+1 <a>+2</a></p></article><footer>-12</footer>
* <body><article><h1>+5</h1><p>+1 <a>+2</a></p><aside>-30</aside><ul><li>+3<li>+7<li>+2</ul></article><nav><a>-2</a></nav>
o <body><div><h1>+5</h1><p>+90</p><p>+20</p><table><tr><td>+2<td>+1<td>+2<tr><td>+3<td>+1<td>+1</table></div><footer>-12</footer>
o <body><aside>-30</aside><div><h1>+5</h1><table><tr><td>+2<td>+3<td>+2<tr><td>+3<td>+1<td>+1</table><p>+8</p><p>+200</p></div>
o <body><div><h1>+5</h1><p>+40</p><table><tr><td>+3<td>+1<td>+1<tr><td>+3<td>+2<td>+2</table><p>+3</p><p>+40</p><h2>+3</h2><table><tr><td>+2<td>+1</table></div><div class=cookie-notice>-40</div>
* <body><article><h1>+5</h1><p>+200</p><table><tr><td>+2<td>+3<td>+2<tr><td>+3<td>+1<td>+1</table></article><div class=sidebar><p>-18</p></div>
* <body><article><h1>+5</h1><table><tr><td>+2<td>+3<td>+2<tr><td>+3<td>+1<td>+1</table><h2>+1</h2><p>+200</p><pre>+3</pre><p>+40</p></article>
* <body><article><h1>+5</h1><nav><a>-2</a></nav><p>+3</p></article><footer>-12</footer>
o <body><main><h1>+5</h1><p>+40</p><table><tr><td>+3<td>+1<td>+1<tr><td>+3<td>+2<td>+2</table><p>+3</p></main><nav><a>-2</a></nav><div class=ad>-9</div>
* <body><article><h1>+5</h1><p>+20</p><p>+2</p></article>
* <body><nav><a>-2</a></nav><article><h1>+5</h1><ul><li>+3<li>+5<li>+2</ul></article>
* <body><aside>-30</aside><article><h1>+5</h1><p>+40</p><table><tr><td>+2<td>+3<td>+2<tr><td>+3<td>+1<td>+1</table></article>
o <body><div><h1>+5</h1><p>+40</p><ul><li>+3<li>+5<li>+2</ul></div>
o <body><div class=sidebar><p>-18</p></div><main><h1>+5</h1><p>+60</p><p>+2</p></main>
* <body><article><h1>+5</h1><p>+40</p><p>+1 <a>+2</a></p><p>+30</p><p>+4 <a>+9</a></p><p>+20</p></article>
* <body><article><h1>+5</h1><p>+90</p><ul><li>+3<li>+8</ul><p>+1 <a>+2</a></p><p>+60 <a>+2</a></p></article><div class=ad>-9</div>
* <body><article><h1>+7</h1><p>+40</p><div class=related><ul><li><a>-7</a><li><a>-6</a></ul></div><p>+30</p></article>
* <body><article><h1>+7</h1><div class=share><a>-1</a><a>-2</a></div><p>+40</p><nav><a>-3</a></nav><p>+12</p><p>+60</p></article><footer>-6</footer>
* <body><article><div class=tags><a>-1</a></div><p>+14</p><ul><li><a>+4</a><li><a>+3</a></ul><p>+14</p></article>
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of PAGES. The first word of a block tells its label."""
    xs, ys, rng = [], [], np.random.default_rng(1)
    for line in PAGES.strip().split("\n"):
        page, ranges = line.removeprefix("* ").removeprefix("o "), RANGES.get(line[:2])
        for _ in range(DRAWS if ranges else 1):
            factor = lambda sign: np.exp(rng.uniform(*ranges[sign == "-"])) if ranges else 1.0  # noqa: B023, E731
            many = lambda m: " ".join([m[1] * 2] * max(1, round(int(m[2]) * factor(m[1]))))  # noqa: B023, E731
            found, up = blocks(re.sub(r"([+-])(\d+)", many, page))
            xs.append(features(found, up))
            ys += [int(b[0].startswith("+")) for b in found]
    return np.concatenate(xs), np.array(ys)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 6):
    """A binary tree by Gini impurity: (feature, threshold, low, high) or a label. Thresholds lie between 64 quantiles at most; of
    equal splits the first feature wins, so words and links come before hints."""
    if depth == 0 or len(set(y.tolist())) == 1 or len(y) < 2 * least:
        return int(round(y.mean()))
    best = None
    gini = lambda v: 2 * v.mean() * (1 - v.mean()) * len(v)
    for f in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65), method="nearest"))
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            if min(low.sum(), (~low).sum()) >= least:
                g = gini(y[low]) + gini(y[~low])
                if best is None or g < best[0] - 1e-9:
                    best = (g, f, t, low)
    if best is None or best[0] >= gini(y) - 1e-9:
        return int(round(y.mean()))
    _, f, t, low = best
    return f, t, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def classify(tree, row) -> int:
    while not isinstance(tree, int):
        f, t, low, high = tree
        tree = low if row[f] <= t else high
    return tree


def main_text(page: str | None, tree) -> str:
    found, up = blocks(page)
    if not found:
        return ""
    rows = features(found, up).tolist()
    return " ".join(b[0] for b, row in zip(found, rows, strict=True) if classify(tree, row))


@functools.cache
def grown():
    """The tree of the labelled pages, grown once in a process."""
    return grow(*labelled())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    tree = grown()

    def run(batches):
        for b in rows_of(batches, 4 << 20, "html"):
            text = [main_text(p, tree) for p in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
