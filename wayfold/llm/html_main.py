"""Main text of web pages by gradient-boosted trees over DOM nodes, with hierarchical decoding.

Each element of a page is a row of features: its tag, words of its class, id and role, depth, place among its
siblings and how many of them look alike, density of text, links and sentences in its subtree, its place in the
page's text, and some of the same for its parent and ancestors. Boosted trees give the probability that an
element belongs to the article. Decoding goes down from the root and keeps the best total of log odds under one
constraint: an element can be in only if no ancestor was left out for good, so an article cannot hold a menu's
parts, nor a menu an article's.

The trees learn from a bounded sample of pages with an article element. What is in it is known by where it
stands: its paragraphs are set anew into pages of varied layout (`laid_out`), among menus, notices, adverts, side
bars, footers and comments made of the page's words, with names from lists, made-up ones or none, so that no
feature tells the label. Fragments, the contents of an article without a wrapper, and the given pages are used too.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pages to train on, pages laid out of each, and elements taken of each.
SAMPLE_PAGES = 600
LAYOUTS, ELEMENTS = 4, 30
TREES, DEPTH, RATE = 40, 5, 0.25

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# A start tag of these closes an open p; li, dd, dt, option, tr, td, th close their like.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
}
# Element kinds from those that never hold an article to those that are one; others stand with div.
KINDS = (
    "head title script style noscript template iframe svg math textarea select button input form label nav footer aside header menu "
    "a ul ol li dl dt dd table tr td th div section center p blockquote pre figure figcaption h1 h2 h3 h4 h5 h6 main article"
).split()
_KIND = {tag: i for i, tag in enumerate(KINDS)}
_OTHER = _KIND["div"]

# Words of names that pages give to what is not the article, by what it is, and to the article.
NAMES = {
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs topbar tabs toolbar",
    "footer": "footer ft colophon copyright legal imprint bottom",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner adsense",
    "notice": "cookie consent notice alert popup modal gdpr message toast",
    "sidebar": "sidebar rail widget widgets aside side secondary",
    "comments": "comment comments discussion disqus replies respond responses reactions",
    "form": "newsletter subscribe signup login search register contact",
    "share": "share sharing social follow sharebar bookmarks",
    "related": "related recommended more teaser popular trending also",
    "article": "article content post entry story main text",
}
# Beside these a word says only that a page has such a thing, or has not.
MODIFIERS = frozenset("no not has have with without is enabled disabled hide hidden show layout page wrapper container".split())


def name_words(part: int | None = None) -> dict[str, list[str]]:
    """NAMES; of part 0 all but every third name of a list, of part 1 the others (to hold out)."""
    return {
        kind: [x for i, x in enumerate(names.split()) if part is None or (i % 3 == 2) == (part == 1)]
        for kind, names in NAMES.items()
    }


_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_UPTO = re.compile(r"[^>=]*")
_AFTER = re.compile(r"=\s*")
_SENTENCE = re.compile(r"[.!?。！？…](?=[\s\"')]|\Z)")
_WORD = re.compile(r"[^\W_]+")
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v  -     　 \u0085]+")


# Marks of laid-out pages, as a class: what stands in the article and what does not.
IN, OUT = "\x01in", "\x01out"


@dataclass
class Node:
    tag: str
    names: str
    parent: int
    depth: int
    place: int  # among the element children of its parent
    children: list = field(default_factory=list)  # numbers of elements, and texts
    elements_in: int = 0  # of the children
    begin: int = 0  # characters of text before it
    chars: int = 0  # of text in the subtree
    linked: int = 0  # of those, in links
    elements: int = 0  # in the subtree
    paragraphs: int = 0
    sentences: int = 0
    rights: int = 0  # copyright signs


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Place of the > that ends a tag, behind quoted values; -1 if there is none. `last` has the last quotes."""
    while True:
        at = _UPTO.match(page, at).end()
        if at >= len(page):
            return -1
        if page[at] == ">":
            return at
        at = _AFTER.match(page, at).end()
        quote = page[at : at + 1]
        if quote in last and at < last[quote]:
            at = page.index(quote, at + 1) + 1


def parsed(page: str) -> list[Node]:
    """The elements of a page in order; the first is the root. Unclosed elements end with their parent.

    Each character is looked at a bounded number of times. A tag without an end makes the rest of the page text.
    """
    nodes = [Node("", "", -1, 0, 0)]
    stack = [0]
    opened: dict[str, list[int]] = {}  # places in the stack
    last = {quote: page.rfind(quote) for quote in "\"'"}
    at = n_text = 0

    def add(text: str) -> None:
        nonlocal n_text
        if text:
            nodes[stack[-1]].children.append(text)
            n_text += len(text)

    def cut(k: int) -> None:
        for i in stack[k:]:
            opened[nodes[i].tag].pop()
        del stack[k:]

    def innermost(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    while True:
        m = _OPEN.search(page, at)
        begin = m.start() if m else len(page)
        add(html.unescape(page[at:begin]))
        if not m:
            return nodes
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        name = _NAME.match(page, begin + 1)
        end = _tag_end(page, name.end(), last) if name else page.find(">", begin)
        if end < 0:
            add(html.unescape(page[begin:]))
            return nodes
        at = end + 1
        if not name:
            continue
        tag = name[0].lower()
        if tag[0] == "/":
            if opened.get(tag[1:]):
                cut(opened[tag[1:]][-1])
            continue
        tags, within = ({"p"}, {"table", "button", "td", "th"}) if tag in CLOSES_P else CLOSES.get(tag, ((), ()))
        if tags and (k := innermost(tags)) > innermost(within):
            cut(k)
        attributes = page[name.end() : end]
        names = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(attributes)).lower() if attributes else ""
        parent = nodes[stack[-1]]
        parent.children.append(len(nodes))
        nodes.append(Node(tag, names, stack[-1], parent.depth + 1, parent.elements_in, begin=n_text))
        parent.elements_in += 1
        if tag in VOID or attributes.endswith("/") and tag not in INLINE:
            continue
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag in ("title", "textarea"):
                text = html.unescape(page[at : found.start() if found else len(page)])
                nodes[-1].children.append(text)
                n_text += len(text)
            at = found.end() if found else len(page)
            continue
        opened.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes) - 1)


def _names(names: str, lexicon: dict[str, int]) -> tuple[int, int]:
    """How many names speak for something other than the article, and for the article."""
    out = own = 0
    for name in names.split():
        words = _WORD.findall(name)
        if not MODIFIERS.intersection(words):
            found = [lexicon.get(w, 0) for w in words]
            out += -1 in found
            own += 1 in found and -1 not in found
    return out, own


def lexicon_of(words: dict[str, list[str]]) -> dict[str, int]:
    """1 for words of the article, -1 for others."""
    return {w: 1 if kind == "article" else -1 for kind, own in words.items() for w in own}


def measured(nodes: list[Node], lexicon: dict[str, int]) -> np.ndarray:
    """A row of features per element."""
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        for c in n.children:
            if isinstance(c, str):
                n.chars += len(c)
                n.sentences += len(_SENTENCE.findall(c))
                n.rights += "\u00a9" in c
        if n.tag == "a":
            n.linked = n.chars
        n.elements += 1
        n.paragraphs += n.tag == "p"
        if n.parent >= 0:
            p = nodes[n.parent]
            p.chars, p.linked, p.sentences = p.chars + n.chars, p.linked + n.linked, p.sentences + n.sentences
            p.elements, p.paragraphs, p.rights = p.elements + n.elements, p.paragraphs + n.paragraphs, p.rights + n.rights
    total = max(nodes[0].chars, 1)
    # What an element's ancestors and itself hand down: least and greatest kind, share and links of the nearest
    # one with a name that is not the article's, whether one has the article's, most like siblings, links, rights.
    down = [(_OTHER, _OTHER, 2.0, -1.0, 0, 0, 0.0, 0)]
    rows = np.zeros((len(nodes), 29), np.float32)
    alike: dict[tuple[int, str, str], int] = {}
    for n in nodes:
        key = (n.parent, n.tag, n.names)
        alike[key] = alike.get(key, 0) + 1
    before = [0] * len(nodes)  # characters of the sibling before
    after = [0] * len(nodes)
    for n in nodes:
        previous = -1
        for c in n.children:
            if not isinstance(c, str):
                if previous >= 0:
                    before[c], after[previous] = nodes[previous].chars, nodes[c].chars
                previous = c
    for i, n in enumerate(nodes):
        p = nodes[max(n.parent, 0)]
        kind = _KIND.get(n.tag, _OTHER)
        out, own = _names(n.names, lexicon) if n.names else (0, 0)
        same = alike[n.parent, n.tag, n.names] if n.names else 0
        links, share = n.linked / max(n.chars, 1), n.chars / total
        if i:
            low, high, named, named_links, inside, most, linked, rights = down[n.parent]
            low, high = min(low, kind), max(high, kind)
            if out:
                named, named_links = share, links
            if n.tag not in INLINE:
                most, linked, rights = max(most, same), max(linked, links), max(rights, int(bool(n.rights) and share < 0.2))
            down.append((low, high, named, named_links, inside + own, most, linked, rights))
        rows[i] = (
            kind, _KIND.get(p.tag, _OTHER), bool(n.names), out, own, n.depth, n.place, p.elements_in - 1 - n.place, same,
            n.chars, n.chars / n.elements, links, share, n.paragraphs, n.begin / total, 100 * n.sentences / max(n.chars, 1),
            before[i], after[i], p.linked / max(p.chars, 1), p.chars / total, p.paragraphs, *down[i],
        )
    return rows


def labelled(nodes: list[Node]) -> np.ndarray:
    """Whether each element is in what is marked as the article, and not in what is marked as out of it."""
    label = np.zeros(len(nodes), bool)
    for i, n in enumerate(nodes):
        marks = n.names.split()
        label[i] = (i > 0 and label[n.parent] or IN in marks) and OUT not in marks
        if IN in marks or OUT in marks:
            n.names = " ".join(x for x in marks if x not in (IN, OUT))
    return label


def article_of(page: str) -> list[str]:
    """The blocks of a page's article element, without markup that is not its own; none if it has none."""
    found = re.search(r"<article[^>]*>(.*?)(?:</article>|<footer|\Z)", page, re.S)
    if not found:
        return []
    return [x for x in re.split(r"(?=<(?:p|h[1-6])[\s>])", found[1]) if x.strip()]


def laid_out(blocks: list[str], rng: np.random.Generator, words: dict[str, list[str]]) -> str:
    """A page around the blocks of an article; elements of the article are marked IN, of other things OUT."""
    texts = re.sub(r"<[^>]*>|[<>&]", " ", " ".join(blocks[:20])).split() or ["text"]
    chance = rng.random

    def one(items):
        return items[int(rng.integers(len(items)))]

    def say(low: int, high: int) -> str:
        n, at = int(rng.integers(low, high)), int(rng.integers(len(texts)))
        return " ".join((texts[at:] + texts)[:n])

    def sentences(low: int, high: int) -> str:
        return " ".join(say(4, 18).capitalize().rstrip(".,") + one((".", ".", ".", "!", "?")) for _ in range(int(rng.integers(low, high))))

    def made_up() -> str:
        return "".join(one("bcdfglmnprstvx") + one("aeiou") for _ in range(int(rng.integers(1, 4)))) + one(("", "", "-1", "_x", "2"))

    def harmless() -> str:
        other = one(words[one([k for k in words if k != "article"])])
        return one((f"no-{other}", f"has-{other}", f"{other}-enabled", f"with-{other}", "container", "wrapper", "page", "row", "col-8", made_up()))

    def attributes(names: list[str], mark: str = "") -> str:
        own = [x for x in names if x] + ([mark] if mark else [])
        if not own:
            return ""
        return f' class="{" ".join(own)}"' if mark or chance() < 0.7 else f' id="{own[0]}"'

    def thing(kind: str, tags: tuple, inner: str) -> str:
        tag = one(tags)
        telling = tag in ("nav", "footer", "aside", "form", "header")
        draw = chance()
        name = one(words[kind]) if draw < 0.5 else "" if telling or draw > 0.85 else made_up()
        if name and chance() < 0.3:
            name = one((f"{name}-box", f"site-{name}", f"{name}_{made_up()}", f"{made_up()} {name}"))
        return f"<{tag}{attributes([name], OUT)}>{inner}</{tag}>"

    def links(low: int, high: int) -> list[str]:
        return [f'<a href="/{i}">{say(1, 6)}</a>' for i in range(int(rng.integers(low, high)))]

    def listed(items: list[str]) -> str:
        tag = one(("ul", "ul", "ol", "div"))
        each = "li" if tag != "div" else one(("div", "span"))
        return f"<{tag}>" + "".join(f"<{each}>{x}</{each}>" for x in items) + f"</{tag}>"

    def menu() -> str:
        return thing("menu", ("nav", "nav", "div", "ul"), one((listed, " | ".join))(links(3, 12)))

    def footer() -> str:
        rights = one(("&copy; ", "&copy; ", "Copyright ", "")) + say(2, 8) + "."
        inner = one((rights, f"<p>{rights}</p>", rights + " &middot; " + sentences(1, 4)))
        return thing("footer", ("footer", "footer", "div"), inner + (" ".join(links(1, 6)) if chance() < 0.5 else ""))

    def ad() -> str:
        inner = sentences(1, 3) if chance() < 0.6 else f'<a href="/x">{sentences(1, 2)}</a>'
        return thing("ad", ("div", "div", "aside", "ins"), inner if chance() < 0.7 else f"<p>{inner}</p>")

    def notice() -> str:
        return thing("notice", ("div", "div", "section"), f"<p>{sentences(1, 3)}</p>" + one(("", f"<button>{say(1, 3)}</button>", links(1, 2)[0])))

    def related() -> str:
        return thing("related", ("div", "aside", "section", "ul"), one((f"<h3>{say(1, 4)}</h3>", "")) + listed(links(2, 9)))

    def share() -> str:
        return thing("share", ("div", "ul", "p"), " ".join(links(2, 6)))

    def form() -> str:
        return thing("form", ("form", "form", "div"), f"<p>{sentences(1, 3)}</p><input type=text><button>{say(1, 3)}</button>")

    def sidebar() -> str:
        inner = "".join(one((related, ad, share, form, lambda: f"<h4>{say(1, 4)}</h4><p>{sentences(1, 4)}</p>"))() for _ in range(int(rng.integers(1, 5))))
        return thing("sidebar", ("aside", "div", "div"), inner)

    def comments() -> str:
        each, own = one(("div", "li", "article", "div")), one((one(words["comments"]), made_up()))
        body = []
        for _ in range(int(rng.integers(1, 16))):
            head = one((f"<a href='/u'>{say(1, 3)}</a> <time>{say(1, 3)}</time>", f"<b>{say(1, 3)}</b>", f"<span>{say(1, 3)}</span>", ""))
            tail = one(("", "<a href='#'>Reply</a>"))
            body.append(f'<{each} class="{own}">{head}<p>{sentences(1, 6)}</p>{tail}</{each}>')
        inner = "".join(body) if chance() < 0.8 else f"<p>{sentences(1, 4)}</p>"
        return thing("comments", ("section", "div", "div", "ol"), one((f"<h3>{say(1, 4)}</h3>", "")) + inner)

    def own_block(block: str) -> str:
        draw = chance()
        if draw < 0.8:
            return block
        text = re.sub(r"<[^>]*>", " ", block)
        return one((
            f"<div{attributes([one(('', made_up(), 'text'))])}>{block}</div>", f"<blockquote>{block}</blockquote>",
            "<ul>" + "".join(f"<li>{x}</li>" for x in text.split(". ")[:8]) + "</ul>", f"<h2>{say(2, 7)}</h2>{block}",
            f"<p>{text[:200]} <a href='/y'>{say(1, 5)}</a> {text[200:]}</p>", f"<div>{text}</div>",
        ))

    some = blocks[: int(rng.integers(1, 40))]
    inner = ""
    within = [ad, ad, share, related, notice, form, sidebar, comments, menu]
    for block in some:
        inner += own_block(block)
        if chance() < min(0.3, 1.5 / len(some)):
            inner += one(within)()
    tag = one(("article", "article", "main", "div", "div", "section"))
    name = one((one(words["article"]), made_up(), harmless(), ""))
    page = f"<{tag}{attributes([name, one(('', harmless()))], IN)}>{inner}</{tag}>"
    for made, likely in ((share, 0.3), (related, 0.4), (comments, 0.5)):
        page += made() if chance() < likely else ""
    page = (menu() if chance() < 0.2 else "") + page
    for _ in range(int(rng.integers(0, 3))):
        page = f"<{(w := one(('div', 'div', 'section', 'main')))}{attributes([one((harmless(), made_up(), ''))])}>{page}</{w}>"
        page = (sidebar() if chance() < 0.2 else "") + page + (sidebar() if chance() < 0.2 else "")
    top = (notice() if chance() < 0.3 else "") + (ad() if chance() < 0.4 else "")
    head = menu() if chance() < 0.7 else thing("menu", ("header", "div"), f"<a href='/'>{say(1, 4)}</a>" + menu())
    page = one((head + top, top + head)) + page + (footer() if chance() < 0.8 else "")
    body = attributes([one((harmless(), harmless(), ""))])
    return f"<!DOCTYPE html><html><head><title>{say(2, 9)}</title></head><body{body}>{page}</body></html>"


def fragment(blocks: list[str], rng: np.random.Generator) -> str:
    """The blocks without a wrapper, some of them as bare text."""
    bare = rng.random() if rng.random() < 0.7 else 1.0
    some = blocks[: int(rng.integers(1, 20))]
    return "".join(re.sub(r"^<p[^>]*>|</p>\s*$", " ", x) if x.startswith("<p") and rng.random() < bare else x for x in some)


def lessons(page: str, words: dict[str, list[str]], layouts: int = LAYOUTS) -> Iterator[tuple[list[Node], np.ndarray]]:
    """Elements of pages made of one, with their labels."""
    blocks = article_of(page)
    if not blocks:
        return
    rng = np.random.default_rng(zlib.crc32(page.encode()))
    for made in [re.sub(r"<article[^>]*>", f'<article class="{IN}">', page), *(laid_out(blocks, rng, words) for _ in range(layouts))]:
        nodes = parsed(made)
        yield nodes, labelled(nodes)
    nodes = parsed(fragment(blocks, rng))
    yield nodes, np.ones(len(nodes), bool)


@dataclass
class Trees:
    """Boosted regression trees as arrays; a node's children are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float
    lexicon: dict[str, int]

    def one(self, rows: np.ndarray, t: int) -> np.ndarray:
        """What tree t adds."""
        at_row, at = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (rows[at_row, self.feature[t, at]] > self.cut[t, at])
        return self.leaf[t, at - (2**DEPTH - 1)]

    def odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for t in range(TREES):
            total += self.one(rows, t)
        return total


def boosted(rows: np.ndarray, label: np.ndarray, lexicon: dict[str, int]) -> Trees:
    """Gradient boosting of the log loss, splits by gain over quantile cuts; each tree sees every other row in turn."""
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0.02, 0.98, 24))) for f in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(c, rows[:, f]) for f, c in enumerate(cuts)])
    width = max(map(len, cuts)) + 1
    # Gains are of cuts; a feature with fewer has none beyond its own.
    is_cut = np.arange(width - 1) < np.array([[len(c)] for c in cuts])
    share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    odds = np.full(len(rows), np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    trees = Trees(np.zeros((TREES, inner), int), np.zeros((TREES, inner)), np.zeros((TREES, leaves)), odds[0] if len(odds) else 0.0, lexicon)
    for t in range(TREES):
        half = slice(t % 2, None, 2) if len(rows) > 1 else slice(None)
        p = 1 / (1 + np.exp(-odds[half]))
        grad, curve = p - label[half], p * (1 - p)
        own = np.ascontiguousarray(bins[:, half])
        at = np.zeros(len(grad), np.int64)  # place within the level
        for level in range(DEPTH):
            n, first = 2**level, 2**level - 1
            sums = np.empty((2, len(cuts), n, width))
            for f in range(len(cuts)):
                key = at * width + own[f]
                for k, weight in enumerate((grad, curve)):
                    sums[k, f] = np.bincount(key, weight, minlength=n * width).reshape(n, width)
            left = sums.cumsum(axis=3)
            g, h = left[..., -1:]
            left_g, left_h = left[..., :-1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
            gain = np.where(is_cut[:, None], gain, 0.0).transpose(1, 0, 2).reshape(n, -1)
            best = gain.argmax(axis=1)
            feature, cut = best // (width - 1), best % (width - 1)
            split = gain[np.arange(n), best] > 1e-9
            trees.feature[t, first : first + n] = np.where(split, feature, 0)
            trees.cut[t, first : first + n] = [cuts[f][c] if ok else np.inf for f, c, ok in zip(feature, cut, split)]
            right = split[at] & (own[feature[at], np.arange(len(at))] > cut[at])
            at = 2 * at + right
        g, h = np.bincount(at, grad, minlength=leaves), np.bincount(at, curve, minlength=leaves)
        trees.leaf[t] = -RATE * g / (h + 1)
        odds += trees.one(rows, t)
    return trees


def decoded(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which elements' own text is in the article: the best total of log odds, weighted by own text,
    of a labelling in which, going down, an element may turn from "holds parts" to in or out once."""
    own = np.array([sum(len(c) for c in n.children if isinstance(c, str)) for n in nodes], float) + 0.5
    gain = np.clip(odds, -6, 6) * own
    inside = gain.copy()  # of a whole subtree that is in, less parts that go out
    best = np.zeros(len(nodes))
    for i in range(len(nodes) - 1, 0, -1):
        # Within an article a subtree may be left out; outside one a subtree may be an article, the root's as well.
        inside[i] = max(inside[i], 0.0)
        best[i] = max(best[i], inside[i])
        inside[nodes[i].parent] += inside[i]
        best[nodes[i].parent] += best[i]
    state = np.zeros(len(nodes), np.int8)  # 0 above the article, 1 in it, 2 left out
    state[0] = inside[0] > 0 and inside[0] >= best[0]
    for i, n in enumerate(nodes[1:], 1):
        above = state[n.parent]
        if above == 2:
            state[i] = 2
        elif above == 1:
            state[i] = 1 if inside[i] > 0 else 2
        else:
            state[i] = 1 if inside[i] > 0 and inside[i] >= best[i] else 0
    return state == 1


def main_text(nodes: list[Node], kept: np.ndarray) -> str:
    """The kept text, block by block: white space is one space, blocks are lines."""
    lines: list[str] = []
    parts: list[str] = []

    def end():
        line = _SPACE.sub(" ", "".join(parts)).strip(" ")
        if line:
            lines.append(line)
        parts.clear()

    # (element, place of the next child)
    stack = [(0, 0)]
    while stack:
        i, at = stack.pop()
        n = nodes[i]
        block = n.tag not in INLINE
        if at == 0 and block:
            end()
        while at < len(n.children):
            child = n.children[at]
            at += 1
            if isinstance(child, str):
                if kept[i]:
                    parts.append(child)
            elif nodes[child].tag == "br":
                parts.append(" ")
            else:
                stack.append((i, at))
                stack.append((child, 0))
                break
        else:
            if block:
                end()
    end()
    return "\n".join(lines)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, words: dict[str, list[str]] | None = None) -> Trees | None:
    """Trees from at most `sample_pages` pages, chosen by hash; None if none of them has an article element.

    `words` are the names that features know and that laid-out pages use, all of NAMES if not given.
    """
    words = words or name_words()
    lexicon = lexicon_of(words)
    pages = pages.where("html is not null").select("page_id", "html")
    n = pages.count()
    turn = F.pmod(F.xxhash64("page_id", F.lit(3)), F.lit(1 << 20))
    sample = pages.where(turn < min(1.0, 0.9 * sample_pages / max(n, 1)) * (1 << 20)).limit(sample_pages)

    def of(batches):
        for batch in batches:
            rows, labels = [], []
            for value in batch.column("html"):
                for nodes, label in lessons(value.as_py(), words):
                    own = measured(nodes, lexicon)
                    # Long pages teach as much as short ones: every k-th element.
                    keep = slice(None, None, max(1, len(nodes) // ELEMENTS))
                    rows += own[keep].tolist()
                    labels += label[keep].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float32())), pa.array(labels, pa.bool_())], ["row", "label"])

    table = sample.mapInArrow(of, "row array<float>, label boolean").toArrow()
    if not table.num_rows:
        return None
    return boosted(np.array(table.column("row").to_pylist(), np.float32), np.array(table.column("label").to_pylist(), float), lexicon)


def _pages(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def extracted(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of (page_id, url, html).

    Null and empty pages, and pages of whose elements (the root is one) the trees take none, have an empty text. Repeated rows give a row
    each; an empty table gives an empty result; other columns are ignored. Time follows the length of a page, also of a
    very long one. Where being in and being left out are worth the same (a tie), an element is left out.
    """

    def of(batches):
        for batch in batches:
            texts = []
            documents = [parsed(page) for page in _pages(batch.column("html"))]
            for a in range(0, len(documents), 500):
                some = documents[a : a + 500]
                rows = [measured(nodes, trees.lexicon if trees else {}) for nodes in some]
                odds = trees.odds(np.concatenate(rows)) if trees else np.full(sum(map(len, rows)), -1.0)
                begin = 0
                for nodes in some:
                    texts.append(main_text(nodes, decoded(nodes, odds[begin : begin + len(nodes)])))
                    begin += len(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(of, "page_id long, url string, text string, n_chars long")
