"""Main text of web pages: a tree-structured graphical model over the DOM.

A page becomes a tree of block elements whose leaves are runs of text. Every
node is ``furniture``, ``content`` or ``mixed`` (a container of both; runs are
never mixed). Its own signs - words in class, id and role, and for runs
length, links and punctuation - give the node potential, and its label given
its parent's, for their two tags, the edge potential. Sum-product messages go up and down the tree
once, which gives each run's exact marginal; runs that are more likely content
than not make up the text, in page order.

The potentials are counted on labelled pages: pages of a seeded generator that
varies layout, markup habits and lengths and knows the label of every run.
Their number is a parameter; they stand for a bounded labelled sample, while
the model is applied to all pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import text_chunks

FURNITURE, CONTENT, MIXED = 0, 1, 2
#: Labelled pages that the model is trained on.
TRAINING_PAGES = 1_000
#: Private sign that marks content runs in generated pages.
MARK = ""

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title noframes noembed xmp".split())
#: Of these, the one whose text is shown, as it stands.
SHOWN_RAW = "xmp"
#: Elements of SVG and MathML whose children are HTML again, and those that are not shown.
HTML_INSIDE = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
UNSEEN_FOREIGN = frozenset("desc metadata annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption button video audio canvas frameset select optgroup option".split())
#: Inline elements that stand apart from the text around them.
SPACED = frozenset("iframe object svg math textarea text".split())
#: Start tags that end an open element of these names (down to the nearest of the second list).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "button", "video", "audio", "canvas", "legend", "select", "optgroup", "option"}
#: HTML start tags that end an open svg or math element.
ENDS_FOREIGN = ENDS_P | frozenset("b big br code em embed i img nobr p ruby s small span strong strike sub sup table tt u var".split())
#: Elements whose runs tell each sign once for all of their parent's.
ITEMS = frozenset("li dt dd td th".split())
#: Words in class, id and role, by what they hint at.
HINTS = {
    "content": "article content post entry main story body text page prose blog news single",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip",
    "head": "header head masthead topbar top logo branding hero banner",
    "foot": "footer foot copyright legal colophon bottom imprint",
    "side": "sidebar side aside widget widgets related recommended recommendations trending popular more complementary rail teaser",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription toast dialog overlay paywall warning message",
    "advert": "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion promoted adsbygoogle commercial dfp banner",
    "comment": "comment comments disqus reply replies discussion respond responses commentlist reviews",
    "form": "form search login signin signup register subscribe",
    "social": "share sharing social follow like tweet author byline meta tags tag date",
}
_hint = {w: kind for kind, words in HINTS.items() for w in words.split()}

_markup = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=\"']|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)", re.DOTALL)
_attr = re.compile(r"(?<![^\s\"'/])(class|id|role)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.IGNORECASE)
_raw_end = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE | re.ASCII) for name in RAW}
_token = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Tree:
    """Nodes in page order, parents first. ``text`` is None for elements."""

    parent: list[int] = field(default_factory=list)
    signs: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)

    def add(self, parent: int, signs: list[str], text: str | None = None) -> int:
        self.parent.append(parent)
        self.signs.append(signs)
        self.text.append(text)
        return len(self.parent) - 1


def _hints(attrs: str) -> list[str]:
    """Hint kinds of class, id, role."""
    kinds: set[str] = set()
    for m in _attr.finditer(attrs):
        kinds.update(_hint[w] for w in map(str.lower, _token.findall(m[2] or m[3] or m[4] or "")) if w in _hint)
    return sorted(kinds)


def run_signs(text: str, linked: int, parent: str) -> list[str]:
    """Signs of a run, each given its parent's tag (``sign|tag``)."""
    words = text.split()
    n = len(words)
    ended = text.rstrip("\"'”’»)]")[-1:] in set(".!?…:。！？")
    share = linked / max(1, len(text))
    return [f"words={min(7, n.bit_length())}|{parent}", f"links={0 if share < 0.1 else 1 if share < 0.6 else 2}|{parent}",
            f"ended={ended}|{parent}", f"copyright={'©' in text}|{parent}"]


def _tag(tree: Tree, node: int) -> str:
    return tree.signs[node][0].partition("|")[0].removeprefix("tag=")


def parse(page: str) -> Tree:
    """The tree of a page; nodes without text below them are left out. Start
    tags imply end tags as in HTML; what is cut off or malformed is read as
    browsers do: an unfinished tag is dropped, open elements end with the page."""
    tree = Tree()
    tree.add(-1, ["tag=root|"])
    stack: list[tuple[str, int, bool, bool]] = [("root", 0, False, False)]  # name, node of the nearest block, not shown, svg or math inside
    opened: Counter[str] = Counter()
    run: list[str] = []
    linked = 0
    inline_signs: list[str] = []
    shown: dict[int, set[str]] = {}
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        if text:
            node = stack[-1][1]
            signs = run_signs(text, linked, _tag(tree, node)) + inline_signs
            if _tag(tree, node) in ITEMS:  # items of a list are alike: what an earlier one has shown is no news
                known = shown.setdefault(tree.parent[node], set())
                signs = [s for s in signs if s not in known]
                known.update(signs)
            tree.add(node, signs, text)
        run.clear()
        inline_signs.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1][2]:
            text = html.unescape(text) if "&" in text else text
            run.append(text)
            if opened["a"]:
                linked += len(text)

    def close(depth: int) -> None:
        if any(name in BLOCK for name, *_ in stack[depth:]):
            flush()
        for name, *_ in stack[depth:]:
            opened[name] -= 1
        del stack[depth:]

    def find(names, stop) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stop:
                return None
        return None

    while at < len(page):
        m = _markup.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name or not m[0].endswith(">"):
            continue
        if m["end"]:
            if name in ("body", "html") or not opened[name]:
                if name == "br":
                    say(" ")
                continue
            depth = find({name}, () if name in BLOCK else BLOCK)
            if depth is not None:
                close(depth)
            if name in SPACED:
                say(" ")
            continue
        if stack[-1][3] and name in ENDS_FOREIGN:
            depth = len(stack) - 1
            while stack[depth - 1][3]:
                depth -= 1
            close(depth)
        foreign = stack[-1][3] or name in ("svg", "math")
        if name == "br":
            say(" ")
            continue
        if name in SPACED:
            say(" ")
        if foreign and m["attrs"].endswith("/"):
            continue
        if name in RAW:
            end = _raw_end[name].search(page, at)
            if end is None and foreign:
                continue
            until = len(page) if end is None else end.start()
            if name == SHOWN_RAW and not stack[-1][2]:
                flush()
                run.append(page[at:until])
                flush()
            at = until
            continue
        if name in ("body", "html", "head"):
            continue
        if name in ENDS_P and opened["select"] and name != "hr" and (depth := find({"select"}, ())) is not None:
            close(depth)
        if name in ENDS_P and opened["p"] and (depth := find({"p"}, {"td", "th", "button", "caption"})) is not None:
            close(depth)
        if name in ENDS:
            names, stop = ENDS[name]
            while any(opened[x] for x in names) and (depth := find(names, stop)) is not None:
                close(depth)
        hints = _hints(m["attrs"]) if m["attrs"] else []
        if name in VOID:
            if name == "hr":
                flush()
            continue
        hidden = stack[-1][2] or foreign and name in UNSEEN_FOREIGN
        inside = foreign and name not in HTML_INSIDE
        if name in BLOCK:
            flush()
            node = tree.add(stack[-1][1], [f"tag={name}|{_tag(tree, stack[-1][1])}", f"hinted={bool(hints)}|{name}", *(f"hint={h}" for h in hints)])
            stack.append((name, node, hidden, inside))
        else:
            inline_signs += [f"inline={h}" for h in hints]
            stack.append((name, stack[-1][1], hidden, inside))
        opened[name] += 1
    flush()
    return _with_text(tree)


def _with_text(tree: Tree) -> Tree:
    used = [t is not None for t in tree.text]
    for i in range(len(used) - 1, 0, -1):
        used[tree.parent[i]] |= used[i]
    used[0] = True
    place, out = {-1: -1}, Tree()
    for i, keep in enumerate(used):
        if keep:
            place[i] = out.add(place[tree.parent[i]], tree.signs[i], tree.text[i])
    return out


@dataclass(frozen=True)
class Model:
    """Potentials. ``sign``: (node kind, sign) -> logarithm by label; ``edge``:
    tags of node and parent, or the node kind for tags never seen together,
    -> [parent label][label]; ``root`` by label."""

    sign: dict[tuple[str, str], tuple[float, float, float]]
    edge: dict[str, tuple[tuple[float, float, float], ...]]
    root: tuple[float, float, float]

    def edge_of(self, tree: Tree, i: int) -> tuple[tuple[float, float, float], ...]:
        return self.edge.get(_tags(tree, i)) or self.edge[_kind(tree, i)]


def _kind(tree: Tree, i: int) -> str:
    return "element" if tree.text[i] is None else "run"


def _tags(tree: Tree, i: int) -> str:
    return tree.signs[i][0].removeprefix("tag=") if tree.text[i] is None else f"run|{_tag(tree, tree.parent[i])}"


def marginals(tree: Tree, model: Model) -> list[tuple[float, float, float]]:
    """Sum-product: each node's label distribution given the whole tree."""
    n = len(tree.parent)
    own = []
    for i in range(n):
        kind = _kind(tree, i)
        score = [0.0, 0.0, 0.0 if kind == "element" else -math.inf]
        for s in tree.signs[i]:
            add = model.sign.get((kind, s))
            if add:
                score = [a + b for a, b in zip(score, add, strict=True)]
        top = max(score)
        own.append([math.exp(x - top) for x in score])
    below = [list(x) for x in own]  # own potential times the messages from the children
    message: list[list[float]] = [[]] * n
    for i in range(n - 1, 0, -1):
        e, b = model.edge_of(tree, i), below[i]
        m = [e[p][0] * b[0] + e[p][1] * b[1] + e[p][2] * b[2] for p in range(3)]
        total = sum(m)
        message[i] = [x / total for x in m]
        up = below[tree.parent[i]]
        up = [a * b for a, b in zip(up, message[i], strict=True)]
        total = sum(up)
        below[tree.parent[i]] = [x / total for x in up]
    above = [[1.0, 1.0, 1.0]] * n  # what comes from outside a node's subtree
    above[0] = list(model.root)
    out = []
    for i in range(n):
        if i:
            p = tree.parent[i]
            rest = [a * b / m if m else 0.0 for a, b, m in zip(above[p], below[p], message[i], strict=True)]
            e = model.edge_of(tree, i)
            down = [rest[0] * e[0][y] + rest[1] * e[1][y] + rest[2] * e[2][y] for y in range(3)]
            total = sum(down)
            above[i] = [x / total for x in down]
        joint = [a * b for a, b in zip(above[i], below[i], strict=True)]
        total = sum(joint) or 1.0
        out.append(tuple(x / total for x in joint))
    return out


def main_text(page: str | None, model: Model) -> str:
    tree = parse(page or "")
    belief = marginals(tree, model)
    return " ".join(t for t, b in zip(tree.text, belief, strict=True) if t is not None and b[CONTENT] > 0.5)


# --- labelled pages -------------------------------------------------------------------------------------------------


class _Pages:
    """Generator of labelled pages; content runs begin with ``MARK``."""

    #: Hint words that name content, too.
    ODD = "top-quote more-text message share-tip tag-list news-alert form-guide search-tips review contact warning-text legal-text bottom-line popular-songs commercial-law notice-text"

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        n = r.randint(low, high)
        return " ".join("".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n))

    def sentences(self, count: int) -> str:
        return " ".join(self.words(2, 18).capitalize() + self.r.choice(".....?!") for _ in range(count))

    def one_of(self, *xs: str) -> str:
        return self.r.choice(xs)

    def made(self, *makers: Callable[[], str], chance: float = 1.0) -> str:
        """What one of the makers gives, or with the remaining chance nothing; the others aren't run."""
        return self.r.choice(makers)() if chance == 1.0 or self.r.random() < chance else ""

    def maybe(self, chance: float, x: str) -> str:
        return x if self.r.random() < chance else ""

    def open(self, *choices: str) -> tuple[str, str]:
        """Start and end tag of one of ``tag.class`` / ``tag#id`` / ``tag``."""
        tag, sep, name = re.match(r"(\w+)([.#@]?)(.*)", self.one_of(*choices)).groups()
        attr = {".": "class", "#": "id", "@": "role"}.get(sep)
        return (f'<{tag} {attr}="{name}">' if attr else f"<{tag}>"), f"</{tag}>"

    def within(self, inner: str, *choices: str) -> str:
        start, end = self.open(*choices)
        return start + inner + end

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(low, high).capitalize()}</a>'

    def menu(self) -> str:
        links = [self.link() for _ in range(self.r.randint(2, 9))]
        inner = self.one_of("<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>", " | ".join(links), " ".join(links))
        return self.within(inner, "nav", "nav", "nav.menu", "div#menu", "div.navigation", "div.breadcrumbs", "ul.menu", "div@navigation")

    def advert(self) -> str:
        inner = self.one_of(self.sentences(self.r.randint(1, 3)), self.link(2, 6), f"<p>{self.sentences(2)}</p>")
        return self.within(inner, "div.ad", "div.ad", "div.advert", "div.ads", "aside.sponsored", "section.advertisement", "div#banner-ad", "div.promo")

    def notice(self) -> str:
        inner = f"<p>{self.sentences(self.r.randint(1, 3))}</p>" + self.maybe(0.5, f"<button>{self.words(1, 2)}</button>") + self.maybe(0.4, self.link())
        return self.within(inner, "div.cookie-notice", "div#cookie-banner", "div.notice", "section.consent", "div@alert", "div@dialog", "dialog", "div.popup", "div.newsletter", "aside.notice", "p.notice")

    def form(self) -> str:
        inner = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>" + self.maybe(0.5, f"<p>{self.sentences(1)}</p>")
        return self.within(inner, "form", "form", "form.search", "div.search-form", "form#login", "fieldset")

    def side(self) -> str:
        inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(self.one_of(f"<p>{self.sentences(1)}</p>", f"<ul><li>{self.link(2, 6)}</li><li>{self.link(2, 6)}</li></ul>", f"<p>{self.link(3, 9)}</p>")
                                                       for _ in range(self.r.randint(1, 4)))
        return self.within(inner, "aside", "aside", "div.sidebar", "div#sidebar", "section.related", "div.widget", "div@complementary")

    def comments(self) -> str:
        one = lambda: self.one_of("<li>{}</li>", '<div class="comment">{}</div>', "<div>{}</div>").format(
            self.maybe(0.5, f"<b>{self.words(1, 2)}</b> ") + self.one_of("<p>{}</p>", "{}").format(self.sentences(self.r.randint(1, 6))))
        inner = self.maybe(0.6, f"<h3>{self.words(1, 2)}</h3>") + "".join(one() for _ in range(self.r.randint(1, 6))) + self.maybe(0.4, self.form())
        return self.within(inner, "section.comments", "section#comments", "div.comments", "div#comments", "ol.commentlist", "ul.comments", "div#disqus", "div.comment")

    def foot(self) -> str:
        inner = self.one_of(f"&copy; {self.words(1, 3)} &middot; {self.sentences(1)}", f"<p>{self.sentences(self.r.randint(1, 2))}</p>", " | ".join(self.link() for _ in range(4)))
        return self.within(inner, "footer", "footer", "footer", "div.footer", "div#footer", "div@contentinfo", "div.copyright")

    def top(self) -> str:
        inner = self.one_of(f"<h1>{self.words(1, 4)}</h1>", self.link(1, 3), f"<p>{self.words(2, 8)}</p>", f"<div>{self.words(1, 5)}</div>") + self.maybe(0.5, self.menu())
        return self.within(inner, "header", "header", "div.header", "div#header", "div.masthead", "div@banner", "div.topbar")

    def paragraph(self) -> str:
        text = MARK + self.made(lambda: self.sentences(self.r.randint(1, 8)), lambda: self.sentences(self.r.randint(1, 3)), lambda: self.words(3, 40), lambda: self.words(1, 6) + ".")
        if self.r.random() < 0.1:
            text = text.replace(" ", self.one_of(" | ", "%% ", "!! ", " - ", " * "))
        if self.r.random() < 0.2:
            text += f" {self.link(1, 4)} {self.words(1, 5)}."
        if self.r.random() < 0.15:
            return self.linked()
        if self.r.random() < 0.2:
            return self.named(text)
        return self.one_of(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f"<div>{text}</div>", f"<blockquote>{text}</blockquote>",
                           f"<ul><li>{text}</li><li>{MARK}{self.words(2, 12)}</li></ul>", f"<pre>{text}</pre>", f"<h2>{MARK}{self.words(2, 7)}</h2><p>{text}</p>",
                           f"<table><tr><td>{text}</td><td>{MARK}{self.words(1, 3)}</td></tr></table>", f"<section><p>{text}</p></section>",
                           f"<figure><figcaption>{text}</figcaption></figure>")

    def linked(self) -> str:
        """Content that is all or mostly links: references, lists of works, a linked heading."""
        one = lambda low, high: f'<a href="/{self.words(1, 1)}">{MARK}{self.words(low, high).capitalize()}{self.maybe(0.3, ".")}</a>'
        items = "".join(f"<li>{one(1, 8)}{self.maybe(0.4, f' {self.words(1, 8)}.')}</li>" for _ in range(self.r.randint(1, 8)))
        return self.one_of(f"<p>{one(1, 14)}</p>", f"<p>{one(1, 14)}</p>", f"<ul>{items}</ul>", f"<ul>{items}</ul>", f"<ol>{items}</ol>", f"<h2>{one(2, 7)}</h2>", f"<div>{one(1, 9)}</div>",
                           f"<table><tr><td>{one(1, 4)}</td><td>{MARK}{self.words(1, 5)}</td></tr></table>", f"<figure><figcaption>{one(2, 9)}</figcaption></figure>", f"<section>{items}</section>")

    def named(self, text: str) -> str:
        """Content in elements whose class says nothing, or hints at something else."""
        name = self.one_of("lead", "quote", "code", "output", "highlight", "step", "note", "summary", "intro", "box", "figure", "left", *self.ODD.split())
        body = self.one_of(text, f"<p>{text}</p>", f"<p>{text}</p><p>{MARK}{self.sentences(self.r.randint(1, 4))}</p>")
        tag = self.one_of("div", "div", "section", "blockquote", "pre", "ul", "p", "span", "h2", "table")
        inner = {"pre": text, "p": text, "span": text, "h2": MARK + self.words(1, 8), "ul": f"<li>{text}</li><li>{MARK}{self.words(1, 9)}</li>",
                 "table": f"<tr><td>{text}</td><td>{MARK}{self.words(1, 4)}</td></tr>"}.get(tag, body)
        return f'<{tag} class="{name}">{inner}</{tag}>'

    def article(self) -> str:
        title = f"<h1>{MARK}{self.one_of(self.words(1, 3), self.words(2, 10), self.sentences(1))}</h1>"
        parts = [self.one_of(title, title, title, f"<header>{title}</header>", "")]
        for _ in range(self.r.randint(1, 14)):
            parts.append(self.paragraph())
            parts.append(self.made(self.advert, self.side, self.notice, self.form, chance=0.05))
        inner = "".join(parts) + self.made(self.comments, chance=0.12)
        kinds = ("article", "article", "article", "article.post", "main", "main", "div.content", "div#content", "div.post", "div.entry-content",
                 "section.article", "div#main", "div", "div", "div", "section")
        if self.r.random() < 0.35:  # bare wrappers
            inner = self.within(inner, "div", "div", "section", "div.row")
        body = self.within(inner, *kinds)
        if self.r.random() < 0.15:
            tag = self.one_of("article", "article", "main", "div", "section")
            body = f'<{tag} class="{self.one_of(*self.ODD.split())}">{inner}</{tag}>'
        return self.one_of(body, body, self.within(body, "main", "div#content", "div", "div.container"), inner)

    def page(self) -> str:
        r = self.r
        before = [f() for f, chance in ((self.notice, 0.25), (self.top, 0.5), (self.menu, 0.6), (self.form, 0.15), (self.advert, 0.4), (self.side, 0.15)) if r.random() < chance]
        after = [f() for f, chance in ((self.comments, 0.35), (self.side, 0.35), (self.advert, 0.25), (self.form, 0.15), (self.notice, 0.15), (self.menu, 0.15), (self.foot, 0.75)) if r.random() < chance]
        r.shuffle(before)
        middle = self.made(self.article, self.article, self.article, lambda: MARK + self.sentences(r.randint(1, 9)))
        whole = "".join(before) + middle + "".join(after)
        return self.one_of(f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{whole}</body></html>", f"<html><body>{self.within(whole, 'div', 'div#page', 'div.wrapper')}</body></html>")


def labelled(page: str) -> tuple[Tree, list[int]]:
    """The tree of a generated page and its nodes' labels, signs as they are without marks."""
    tree = parse(page)
    labels = [-1] * len(tree.parent)
    has = [[False, False] for _ in labels]
    for i in range(len(labels) - 1, -1, -1):
        if tree.text[i] is not None:
            has[i][MARK in tree.text[i]] = True
        labels[i] = MIXED if all(has[i]) else CONTENT if has[i][1] else FURNITURE
        if i:
            for k in (0, 1):
                has[tree.parent[i]][k] |= has[i][k]
    return tree, labels


def observations(page: str) -> Counter:
    tree, labels = labelled(page)
    seen: Counter = Counter({("root", "", str(labels[0])): 1})
    for i, y in enumerate(labels):
        kind = _kind(tree, i)
        seen[("label", kind, str(y))] += 1
        if i:
            for name in (kind, _tags(tree, i)):
                seen[("edge", name, f"{labels[tree.parent[i]]}{y}")] += 1
        for s in tree.signs[i]:
            if not s.startswith("tag="):
                seen[("sign", f"{kind} {s}", str(y))] += 1
    return seen


def train(spark: SparkSession, pages: int = TRAINING_PAGES, seed: int = 7) -> Model:
    """Count labels, signs and edges over ``pages`` labelled pages and smooth
    them into potentials. The counts are few: signs are a closed set."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for i in batch.column("id").to_pylist():
                seen.update(observations(_Pages(seed * 1_000_003 + i).page()))
            rows = [(*k, n) for k, n in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["what", "name", "label", "n"])

    counted = (spark.range(pages).mapInArrow(count, "what string, name string, label string, n long")
               .groupBy("what", "name", "label").agg(F.sum("n").alias("n")))
    seen = {(r.what, r.name, r.label): r.n for r in counted.collect()}
    names = {name for what, name, _ in seen if what == "sign"}
    labels = {k: [seen.get(("label", k, str(y)), 0) for y in range(3)] for k in ("element", "run")}
    # A sign given a tag is one of the values that its question takes below that tag.
    asked: dict[tuple[str, str, str], list[float]] = {}
    question = lambda name: (name.split(" ", 1)[0], *(lambda s: (s.partition("=")[0], s.partition("|")[2]))(name.split(" ", 1)[1]))
    for name in names:
        sums = asked.setdefault(question(name), [0.0, 0.0, 0.0])
        for y in range(3):
            sums[y] += seen.get(("sign", name, str(y)), 0) + 0.5
    sign = {}
    for name in names:
        kind, s = name.split(" ", 1)
        total = asked[question(name)] if "|" in s else [n + 1.0 for n in labels[kind]]
        sign[(kind, s)] = tuple(math.log((seen.get(("sign", name, str(y)), 0) + 0.5) / total[y]) for y in range(3))
    def rows_of(name: str, prior: tuple[tuple[float, ...], ...], weight: float) -> tuple[tuple[float, ...], ...]:
        counts = [[seen.get(("edge", name, f"{p}{y}"), 0) for y in range(3)] for p in range(3)]
        return tuple(tuple((n + weight * q) / (sum(row) + weight) for n, q in zip(row, before, strict=True)) for row, before in zip(counts, prior, strict=True))

    flat = ((1 / 3,) * 3,) * 3
    edge = {kind: rows_of(kind, flat, 0.3) for kind in ("element", "run")}
    for name in {name for what, name, _ in seen if what == "edge" and "|" in name}:
        edge[name] = rows_of(name, edge["run" if name.startswith("run|") else "element"], 0.5)
    root = [seen.get(("root", "", str(y)), 0) for y in range(3)]
    return Model(sign, edge, tuple((x + 1) / (sum(root) + 3) for x in root))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null or empty html, or a page without content, gives the empty text.
    Pages are read whole, however long; character references are decoded,
    white space inside a block is one space, blocks are joined by one space.
    Equal beliefs leave a run out. Repeated rows give repeated results, an
    empty table no rows; other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "html", 4_000_000):
            texts = [main_text(page, model) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
