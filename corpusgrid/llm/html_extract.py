"""Main text of HTML pages by a tree-structured graphical model.

The page becomes a tree of block elements with runs of text as leaves. Each node has a
hidden state: outside the article, content, or a mixture of both below. Log-linear unary potentials look at the tag, the words of
class, id and role, those of the parent, and the length, links and punctuation of the text
below; parent-child potentials tie neighbours in the tree. One upward and one downward sweep of sum-product
messages give the exact marginal of every node, and the text leaves whose content
marginal is over one half are the main text, in page order.

The potentials are trained by maximum likelihood, with the same sweeps for the expected
counts, on labelled pages that ``labelled_pages`` makes: ``pages`` bounds how many. The
given tables have no labels, and a page's own markup is never used to label it.

Text of scripts, styles, the head, templates and the like is no text of the page.
Character references are decoded, white space (any Unicode white space, and ``<br>``) is
one space, blocks are trimmed, empty ones left out, and joined by two line breaks.

Defined results: a null or empty page has the empty text. Text outside every element
belongs to the body. Unclosed and stray tags are taken as browsers roughly do. Repeated
rows are read each. Other columns pass through; ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

from corpusgrid.llm.memory import small_batches

PAGES, ROUNDS, RATE, RIDGE = 300, 60, 0.5, 0.0003

#: Names of HTML elements by their role in the page.
SKIPPED = {"head", "title", "script", "style", "template", "noscript", "iframe", "svg", "canvas", "audio", "video"}
#: Elements that may stand in a head; any other one ends it.
IN_HEAD = {"base", "link", "meta", "title", "style", "script", "noscript", "template"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
         "hgroup", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section",
         "select", "summary", "table", "tbody", "td", "textarea", "tfoot", "th", "thead", "tr", "ul"}
#: Boxes that say nothing without a name, and names that say nothing.
PLAIN = {"div", "center", "tbody"}
NEUTRAL_NAMES = {"wrapper", "wrap", "container", "row", "col", "column", "inner", "outer", "site", "layout", "grid", "box", "block", "root", "app"}
#: Opening one of these ends an open element of the listed names, up to the given border.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"})}

#: Words that sites put into class, id and role, by what they mark.
CONTENT_NAMES = ["content", "article", "post", "entry", "story", "main", "text", "body", "page", "detail", "news", "blog", "prose"]
OTHER_NAMES = {
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "toc", "tabs", "links", "pagination", "pager"],
    "header": ["header", "masthead", "topbar", "banner", "branding", "logo", "hero"],
    "footer": ["footer", "bottom", "copyright", "legal", "colophon", "imprint", "contact"],
    "aside": ["sidebar", "aside", "widget", "related", "recommended", "popular", "trending", "more", "teaser", "rail"],
    "div": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adsense", "outbrain", "taboola"],
    "section": ["notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "banner", "message", "warning"],
    "form": ["form", "login", "signup", "newsletter", "subscribe", "subscription", "search", "register", "feedback", "poll"],
    "ul": ["comments", "comment", "reply", "replies", "discussion", "disqus", "respond", "reviews", "commentlist", "thread"],
    "p": ["share", "social", "follow", "tags", "meta", "byline", "caption", "print", "skip", "hidden", "toolbar"],
}
OTHERS = {w for words in OTHER_NAMES.values() for w in words}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "names", "text", "links", "size", "linked")

    def __init__(self, tag: str, parent: int, names: tuple = ()):
        self.tag, self.parent, self.names = tag, parent, names
        self.text, self.links, self.size, self.linked = "", 0, 0, 0


@lru_cache(maxsize=20_000)
def names_of(attributes: str) -> tuple:
    """Words of class, id and role, and whether the element is hidden."""
    found: list[str] = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        if name.lower() in ("class", "id", "role"):
            found += [w.lower() for w in NAME_PART.findall(value)]
        elif name.lower() == "style" and re.search(r"display\s*:\s*none", value):
            found.append("hidden")
    if re.search(r"\bhidden\b(?!\s*=)", attributes):
        found.append("hidden")
    return tuple(dict.fromkeys(found))


def parse(page: str) -> list[Node]:
    """Nodes in page order; text leaves have the tag ``#text``. The first node is the body."""
    nodes = [Node("body", -1)]
    stack = [("body", 0)]  # open block elements, and the node each one's text and children go to
    links, skipped = 0, []
    run: list[str] = []
    run_links = 0

    def flush() -> None:
        nonlocal run, run_links
        if run:
            text = " ".join("".join(run).split())
            if text:
                leaf = Node("#text", stack[-1][1])
                leaf.text, leaf.size, leaf.linked = text, len(text), min(run_links, len(text))
                nodes.append(leaf)
            run, run_links = [], 0

    def say(text: str) -> None:
        nonlocal run_links
        if text and not skipped:
            shown = html.unescape(text) if "&" in text else text
            run.append(shown)
            if links:
                run_links += len(shown.strip())

    def close(depth: int) -> None:
        flush()
        del stack[depth:]

    at, end, inside = 0, len(page), []  # inside: blocks open within what is skipped
    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = bool(found[1])
        if tag in RAW and not closing:
            shut = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            inner = page[at:shut.start() if shut else end]
            at = shut.end() if shut else end
            if tag == "textarea" and not skipped:
                flush()
                nodes.append(Node(tag, stack[-1][1], names_of(found[3])))
                stack.append((tag, len(nodes) - 1))
                say(inner)
                close(len(stack) - 1)
            continue
        if tag in SKIPPED:
            if closing:
                if tag in skipped:
                    del skipped[skipped.index(tag):]
            elif not found[3].rstrip().endswith("/"):
                if skipped in ([], ["head"]):
                    inside = []
                if skipped == ["head"] and tag not in IN_HEAD and tag != "head":
                    skipped = []
                skipped.append(tag)
            continue
        if skipped == ["head"]:
            if closing or tag in IN_HEAD or tag == "html":
                continue
            skipped = []  # a head without an end stops at the first element that cannot stand in it
        elif skipped:
            if tag not in BLOCK or tag in ("html", "body"):
                if tag == "body":
                    skipped = []
                else:
                    continue
            elif not closing:
                inside.append(tag)
                continue
            elif tag in inside:
                del inside[len(inside) - 1 - inside[::-1].index(tag):]
                continue
            elif any(name == tag for name, _ in stack[1:]):
                skipped = []  # one without an end stops where the element around it ends
            else:
                continue
        if tag in ("br", "hr"):
            run.append(" ")
            if tag == "hr":
                flush()
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCK:
            if tag in ("html", "body"):
                flush()
                nodes[0].names = nodes[0].names or (() if closing else names_of(found[3]))
            elif closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
                links = 0 if tag != "label" else links
            else:
                flush()
                ends, border = ENDS.get(tag, (set(), set()))
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = stack[depth][0]
                    if open_tag in ends or open_tag == "p":
                        close(depth)
                        if open_tag in ends and tag != "tr":
                            break
                    elif open_tag in border or not ends:
                        break
                names = tuple(w for w in names_of(found[3]) if w not in NEUTRAL_NAMES)
                if tag in PLAIN and not names:  # a box of the layout alone
                    stack.append((tag, stack[-1][1]))
                else:
                    nodes.append(Node(tag, stack[-1][1], names))
                    stack.append((tag, len(nodes) - 1))
        elif tag not in VOID and not closing and not found[3]:
            pass  # plain inline markup is part of the run
    flush()
    for i in range(len(nodes) - 1, 0, -1):
        above = nodes[nodes[i].parent]
        above.size += nodes[i].size
        above.linked += nodes[i].linked
    return nodes


def says(names: tuple) -> list[str]:
    """What kinds of part the names speak of."""
    return ["says other"] * any(w in OTHERS for w in names) + ["says content"] * any(w in CONTENT_NAMES for w in names)


def features(nodes: list[Node]) -> list[list[str]]:
    out = []
    for n in nodes:
        share = n.linked / n.size if n.size else 0.0
        found = ["one", f"tag {n.tag}", f"links {0 if share == 0 else 1 if share < 0.4 else 2 if share < 0.9 else 3}",
                 f"size {min(4, n.size // 80 if n.size < 160 else 2 + n.size // 400)}"]
        found += [f"name {w}" for w in n.names]
        found += says(n.names)
        if n.parent >= 0 and n.tag != "#text":
            found += [f"in {nodes[n.parent].tag}", *(f"in {w}" for w in nodes[n.parent].names)]
            found += [f"in {w}" for w in says(nodes[n.parent].names)]
        if n.tag == "#text":
            found.append("stop" if n.text[-1] in ".!?:;\"'”’»)" else "no stop")
        out.append(found)
    return out


OUTSIDE, CONTENT, MIXED = 0, 1, 2  # no content below, only content, both
STATES = 3


def tie(node: Node) -> int:
    """Which potentials join a node to its parent: text leaves, and elements."""
    return 0 if node.tag == "#text" else 1


def scaled(x: list[float]) -> list[float]:
    total = x[0] + x[1] + x[2]
    return [x[0] / total, x[1] / total, x[2] / total]


class Model:
    """Weights of the features in each state, and log potentials [kind of tie][parent][child]."""

    def __init__(self, weights: dict[str, list[float]], ties: np.ndarray):
        self.weights = weights
        self.ties = np.exp(ties).tolist()

    def unary(self, nodes: list[Node]) -> list[list[float]]:
        out = []
        for n, found in zip(nodes, features(nodes)):
            scores = [0.0, 0.0, 0.0]
            for f in found:
                w = self.weights.get(f)
                if w:
                    scores = [scores[0] + w[0], scores[1] + w[1], scores[2] + w[2]]
            out.append(potentials(n, scores))
        return out

    def sweep(self, nodes: list[Node], unary: list[list[float]]):
        """Exact marginals; and the evidence below and beside each node, for pair marginals."""
        n = len(nodes)
        inner, up = [list(u) for u in unary], [None] * n
        for i in range(n - 1, 0, -1):
            x, y, z = inner[i] = scaled(inner[i])
            up[i] = m = scaled([t[0] * x + t[1] * y + t[2] * z for t in self.ties[tie(nodes[i])]])
            above = inner[nodes[i].parent]
            inner[nodes[i].parent] = scaled([above[0] * m[0], above[1] * m[1], above[2] * m[2]])
        beliefs, rest = [None] * n, [None] * n
        beliefs[0] = scaled(inner[0])
        for i in range(1, n):
            above, m, t = beliefs[nodes[i].parent], up[i], self.ties[tie(nodes[i])]
            x, y, z = rest[i] = scaled([above[0] / m[0], above[1] / m[1], above[2] / m[2]])
            low = inner[i]
            beliefs[i] = scaled([low[k] * (x * t[0][k] + y * t[1][k] + z * t[2][k]) for k in range(STATES)])
        return beliefs, inner, rest

    def text(self, page: str | None) -> str:
        nodes = parse(page or "")
        beliefs = self.sweep(nodes, self.unary(nodes))[0]
        return "\n\n".join(n.text for n, b in zip(nodes, beliefs) if n.tag == "#text" and b[CONTENT] > 0.5)


def potentials(node: Node, scores: list[float]) -> list[float]:
    """A text leaf is never mixed; the floor keeps every product positive."""
    top = max(scores)
    out = [max(math.exp(s - top), 1e-12) for s in scores]
    if node.tag == "#text":
        out[MIXED] = 1e-12
    return out


def train(pages: list[tuple[str, set]], rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Maximum likelihood with a small ridge, by gradient ascent (Adagrad) on whole trees.

    A page comes with the texts of its article.
    """
    parsed = []
    names: dict[str, int] = {}
    for page, kept in pages:
        nodes = parse(page)
        good, leaves = [0] * len(nodes), [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            if nodes[i].tag == "#text":
                good[i], leaves[i] = int(nodes[i].text in kept), 1
            if i:
                good[nodes[i].parent] += good[i]
                leaves[nodes[i].parent] += leaves[i]
        state = [OUTSIDE if not g else CONTENT if g == a else MIXED for g, a in zip(good, leaves)]
        rows = [[names.setdefault(f, len(names)) for f in found] for found in features(nodes)]
        parsed.append((nodes, state, rows))
    weights, ties = np.zeros((len(names), STATES)), np.zeros((2, STATES, STATES))
    seen_w, seen_t = np.full(weights.shape, 1e-6), np.full(ties.shape, 1e-6)
    ones = np.eye(STATES)
    for _ in range(rounds):
        grad_w, grad_t = -RIDGE * len(parsed) * weights, -RIDGE * len(parsed) * ties
        model, factors = Model({}, ties), np.exp(ties)
        for nodes, state, rows in parsed:
            unary = [potentials(n, weights[r].sum(0).tolist()) for n, r in zip(nodes, rows)]
            beliefs, inner, rest = model.sweep(nodes, unary)
            error = ones[state] - np.array(beliefs)
            for i, r in enumerate(rows):
                grad_w[r] += error[i]
            kinds = np.array([tie(n) for n in nodes[1:]], int)
            if len(kinds):
                pair = np.array(rest[1:])[:, :, None] * factors[kinds] * np.array(inner[1:])[:, None, :]
                pair /= pair.sum((1, 2), keepdims=True)
                above = [state[n.parent] for n in nodes[1:]]
                np.add.at(pair, (np.arange(len(kinds)), above, state[1:]), -1.0)
                np.add.at(grad_t, kinds, -pair)
        seen_w += grad_w ** 2
        seen_t += grad_t ** 2
        weights += rate * grad_w / np.sqrt(seen_w)
        ties += rate * grad_t / np.sqrt(seen_t)
    return Model({f: weights[i].tolist() for f, i in names.items()}, ties)


def labelled_pages(n: int = PAGES, seed: int = 5) -> list[tuple[str, set]]:
    """Made pages of many layouts with the texts of their articles."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    serial = iter(range(10 ** 9))
    word = lambda: "".join(pick(list("abcdefghijklmnopqrstuvwxyz")) for _ in range(int(rng.integers(2, 9))))

    def sentence(short: bool = False) -> str:
        words = [word() for _ in range(int(rng.integers(1, 5) if short else rng.integers(4, 40)))]
        return f"{' '.join(words)} t{next(serial)}{pick(['.', '.', '.', '!', '?', ''])}"

    def junk_inner(kind: str) -> str:
        if kind in ("nav", "ul") or rng.random() < 0.25:
            items = "".join(f"<li>{pick(['<a href=x>%s</a>', '%s', '<p>%s</p>']) % sentence(rng.random() < 0.6)}</li>"
                            for _ in range(int(rng.integers(1, 6))))
            return f"<ul>{items}</ul>"
        if kind == "form":
            return f"<label>{sentence(True)}</label><input name=q><button>{sentence(True)}</button>" + (
                f"<p>{sentence()}</p>" if rng.random() < 0.5 else "")
        return "".join(pick(["<p>%s</p>", "%s", "<div>%s</div>", "<h3>%s</h3>", "<p><a href=x>%s</a></p>"]) % sentence(rng.random() < 0.3)
                       for _ in range(int(rng.integers(1, 4))))

    def junk(plain: bool = False) -> str:
        kind = pick(list(OTHER_NAMES))
        semantic = kind in ("nav", "header", "footer", "aside", "form") and (plain or rng.random() < 0.6)
        tag = kind if semantic else pick(["div", "div", "section", kind, "ul" if kind in ("nav", "ul") else "div"])
        named = "" if semantic and rng.random() < 0.7 else f' {pick(["class", "id", "class"])}="{pick(OTHER_NAMES[kind])}"'
        if tag == "ul":
            inner = "".join(f"<li>{pick(['<a href=x>%s</a>', '%s', '<p>%s</p>']) % sentence(rng.random() < 0.5)}</li>"
                            for _ in range(int(rng.integers(1, 5))))
        else:
            inner = sentence() if tag == "p" else junk_inner(kind)
        return f"<{tag}{named}>{inner}</{tag}>"

    out = []
    for _ in range(n):
        kept: set = set()

        def block() -> str:
            text = sentence(rng.random() < 0.25)
            kept.add(text)
            if rng.random() < 0.15 and " " in text:
                first, rest = text.split(" ", 1)
                return f"<p><a href=x>{first}</a> {rest}</p>"
            return pick(["<p>%s</p>"] * 8 + ["<p><b>%s<br>", "<h1>%s</h1>", "<h2>%s</h2>", "<ul><li>%s</li></ul>", "<blockquote>%s</blockquote>",
                         "<pre>%s</pre>", "<div>%s</div>", "<table><tr><td>%s</td></tr></table>", "<ol><li>%s</ol>"]) % text

        inner = []
        for _ in range(int(rng.integers(1, 12))):
            inner.append(block())
            if rng.random() < 0.25:
                inner.append(junk())
        tag = pick(["article", "article", "main", "div", "section", "div"])
        named = f' class="{pick(CONTENT_NAMES)}"' if tag in ("div", "section") and rng.random() < 0.85 or rng.random() < 0.3 else ""
        body = f"<{tag}{named}>{''.join(inner)}</{tag}>"
        if rng.random() < 0.3:
            body = f"<{pick(['main', 'div'])}>{junk() if rng.random() < 0.3 else ''}{body}{junk() if rng.random() < 0.5 else ''}</div>"
        before = "".join(junk() for _ in range(int(rng.integers(0, 4))))
        after = "".join(junk() for _ in range(int(rng.integers(0, 4))))
        out.append((f"<html><head><title>{word()}</title></head><body>{before}{body}{after}</body></html>", kept))
    return out


@lru_cache(maxsize=1)
def default_model() -> Model:
    """Trained once per driver; it depends on the made pages alone."""
    return train(labelled_pages())


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``pages`` with the main ``text`` and its ``n_chars``."""
    model = model or default_model()
    rows = pages.drop("text", "n_chars")
    schema = StructType(list(rows.schema)).add("text", StringType()).add("n_chars", LongType())
    shared, at = pages.sparkSession.sparkContext.broadcast((model.weights, np.log(model.ties))), rows.columns.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = [own.text(page.as_py()) for page in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=schema.names)

    return small_batches(rows).mapInArrow(run, schema)
