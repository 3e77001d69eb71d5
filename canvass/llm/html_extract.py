"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks (the text between two block tags). Each block has
features of its ancestors' tags and class or id words, of the innermost landmarks it lies
in, its own tag, length, links and punctuation. A CRF with the labels main and other, trained on labelled pages, scores
labels and neighbours; Viterbi decoding picks the best sequence of each page.

The labelled pages are built from page layouts with known parts (``labelled_pages``, a
bounded number); training is a few hundred steps of gradient ascent on the exact
likelihood (forward-backward over all pages at once).
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, table

PAGES = 800               # labelled pages
STEPS, RATE, PRIOR = 200, 0.5, 0.0005

# a quote opens a value only after '='; anywhere else it is an ordinary character of the tag
TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)>?", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
NAME = re.compile(r"[a-z]+")
# Tags by what they do to the text flow
HIDDEN = {"script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "textarea", "select", "title"}
# hidden elements whose content is no markup: it runs to their own end tag, whatever '<' or quotes it holds
RAW = {t: re.compile(rf"</{t}(?=[\t\n\f\r />]|\Z)", re.I | re.A)
       for t in ("script", "style", "noscript", "iframe", "textarea", "title")}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "dd", "details", "dialog", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
         "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section", "summary",
         "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"hr"}
LANDMARKS = {"article", "main", "nav", "header", "footer", "aside", "form"}
CLOSED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"}}


@dataclass
class Block:
    text: str
    features: list[str]


def _own(tag: str, attributes: str) -> list[str]:
    names = [f"in:{tag}"]
    if tag not in ("html", "body") and ("class" in attributes or "id" in attributes or "role" in attributes or "=" in attributes):
        for m in ATTRIBUTE.finditer(attributes):
            names += [f"as:{w}" for w in NAME.findall((m[1] or m[2] or m[3] or "").lower())]
    return names


def leaf_blocks(page: str) -> list[Block]:
    """The blocks with text of a page, in order, with features of their own."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    marks: list[str] = []                            # open landmarks
    named: list[list[str]] = []                      # class and id words of the open elements that have some
    within: Counter = Counter()                      # names of the open elements
    text: list[str] = []
    linked = size = 0
    links, at = 0, 0
    hidden: str | None = None
    depth = 0                                        # of the hidden element in others of its tag

    def flush() -> None:
        nonlocal linked, size
        if text:
            s = " ".join(html.unescape("".join(text)).split()) if size else ""
            text.clear()
            if s:
                n = len(s)
                f = list(within)
                f.append(f"tag:{stack[-1][0]}" if stack else "tag:")
                f += places()
                f.append(f"length:{min(n.bit_length(), 12)}")
                f.append(f"links:{min(4, 4 * linked // max(size, 1))}")
                f.append("ends" if s[-1] in ".!?…\"”»" else "open")
                if "©" in s:
                    f.append("copyright")
                out.append(Block(s, f))
        linked = size = 0

    def places() -> list[str]:
        """Innermost landmark alone and with the next one, words of the innermost named element."""
        inner = marks[-1] if marks else ""
        outer = marks[-2] if len(marks) > 1 else ""
        return [f"at:{inner}", f"at:{outer}>{inner}", *(f"by:{n}" for n in (named[-1] if named else ()))]

    def push(tag: str, attributes: str) -> None:
        names = _own(tag, attributes)
        stack.append((tag, names))
        within.update(names)
        if tag in LANDMARKS:
            marks.append(tag)
        if len(names) > 1:
            named.append(names[1:])

    def pop() -> None:
        tag, names = stack.pop()
        for n in names:
            within[n] -= 1
            if not within[n]:
                del within[n]
        if tag in LANDMARKS:
            marks.pop()
        if len(names) > 1:
            named.pop()

    def chars(s: str) -> None:
        nonlocal linked, size
        if s:
            text.append(s)
            n = len(s) if not s.isspace() else 0
            size += n
            linked += n if links else 0

    while m := TOKEN.search(page, at):
        if hidden is None:
            chars(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not m[1] and not m[3].endswith("/"):
            end = RAW[tag].search(page, at)
            at = end.start() if end else len(page)
        if hidden is not None:
            if tag == hidden and not m[3].endswith("/"):
                depth += -1 if m[1] else 1
                hidden = hidden if depth else None
            continue
        if tag in HIDDEN:
            if not m[1] and not m[3].endswith("/"):
                hidden, depth = tag, 1
            continue
        if tag == "a":
            links = 0 if m[1] else 1
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCK:
            flush()
            if m[1]:
                if within[f"in:{tag}"] > 0:
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                links = 0
            else:
                while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                    pop()
                if tag not in VOID:
                    push(tag, m[3])
    if hidden is None:
        chars(page[at:])
    flush()
    for i, b in enumerate(out):
        if i == 0:
            b.features.append("first")
        if i == len(out) - 1:
            b.features.append("last")
    return out


# --- labelled pages -----------------------------------------------------------------------

# Names under which layouts put their parts
MAIN_IN = [("article", ""), ("main", ""), ("div", "content"), ("div", "post-content"), ("div", "entry"), ("div", "article-body"),
           ("section", ""), ("div", "story"), ("div", "text"), ("", ""), ("article", "post"), ("div", "main"), ("div", ""),
           ("main", "content"), ("div", "entry-content"), ("div", "page-content"), ("div", "post"), ("section", "body")]
OTHER_IN = [("nav", ""), ("nav", "menu"), ("div", "menu"), ("div", "navbar"), ("ul", "nav"), ("header", ""), ("div", "header"),
            ("div", "banner"), ("footer", ""), ("div", "footer"), ("aside", ""), ("aside", "sidebar"), ("div", "sidebar"),
            ("div", "widget"), ("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "promo"), ("div", "sponsored"),
            ("div", "cookie"), ("div", "cookie-notice"), ("div", "notice"), ("div", "consent"), ("div", "popup"),
            ("form", ""), ("form", "search"), ("div", "newsletter"), ("div", "subscribe"), ("div", "login"),
            ("div", "comments"), ("section", "comments"), ("div", "comment"), ("ol", "comment-list"), ("div", "related"),
            ("div", "share"), ("div", "social"), ("div", "breadcrumb"), ("div", "tags"), ("div", "pagination")]
# Those that stand within an article as well
INSIDE = [("aside", ""), ("aside", "sidebar"), ("aside", "related"), ("div", "ad"), ("div", "advert"), ("div", "ads"), ("div", "promo"),
          ("form", ""), ("form", "subscribe"), ("nav", ""), ("nav", "toc"), ("div", "share"), ("div", "related"), ("div", "newsletter"),
          ("section", "comments"), ("div", "comments"), ("footer", ""), ("div", "tags"), ("div", "notice"), ("div", "sponsored")]
SYLLABLES = ["ka", "lo", "mi", "ter", "un", "ves", "da", "pri", "so", "nel", "ta", "gor", "é", "ñu", "ß", "ri", "om", "ex"]
OTHER = "\ue000"          # begins every sentence of a labelled page that is not main text


def _sentence(rng: random.Random, words: int, mark: str = "") -> str:
    w = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(max(1, words))]
    return mark + w[0].capitalize() + " " + " ".join(w[1:]) + rng.choice([".", ".", ".", "", "?", ":"])


def _part(rng: random.Random, tag: str, name: str, inner: str) -> str:
    if not tag:
        return inner
    attr = f' {rng.choice(["class", "class", "id"])}="{name}"' if name else ""
    return f"<{tag}{attr}>{inner}</{tag}>"


def _links(rng: random.Random, n: int, around: str) -> str:
    return "".join(f'<{around}><a href="/{i}">{_sentence(rng, rng.randint(1, 3), OTHER)}</a></{around}>' for i in range(n))


def _boilerplate(rng: random.Random, places: list[tuple[str, str]] = OTHER_IN) -> str:
    tag, name = rng.choice(places)
    other = lambda least, most: _sentence(rng, rng.randint(least, most), OTHER)
    shape = rng.random()
    if tag == "form":
        fields = "".join(f"<{t}>{other(1, 3)}</{t}>" for t in rng.choices(["label", "p", "div", "span"], k=rng.randint(0, 3)))
        inner = f"{other(1, 6) if shape < 0.6 else ''}{fields}<input><button>{other(1, 2)}</button>"
    elif tag == "header" and shape < 0.5:
        inner = f"<h1>{other(1, 4)}</h1>" + (f"<p>{other(1, 8)}</p>" if shape < 0.35 else "") \
            + (f"<nav><ul>{_links(rng, rng.randint(2, 5), 'li')}</ul></nav>" if shape < 0.2 else "")
    elif tag in ("nav", "ul", "header") or shape < 0.35:
        items = _links(rng, rng.randint(2, 7), "li")
        inner = items if tag in ("ul", "ol") else f"<ul>{items}</ul>" if shape < 0.8 else _links(rng, rng.randint(2, 5), "span")
    elif shape < 0.7:
        inner = other(1, 25)
    else:
        inner = (f"<h3>{other(1, 4)}</h3>" if shape < 0.8 else "") \
            + "".join(f"<p>{other(2, 45)}</p>" for _ in range(rng.randint(1, 4)))
    if (tag == "footer" or name == "footer") and rng.random() < 0.8:
        inner = f"&copy; {other(3, 3)} &middot; {inner}" if not inner.startswith("<") else f"<p>&copy; {other(4, 4)}</p>{inner}"
    return _part(rng, tag, name, inner)


def _unnamed(rng: random.Random) -> str:
    """A menu or a last line in a container without a name."""
    if rng.random() < 0.6:
        return f"<div>{_links(rng, rng.randint(2, 6), rng.choice(['span', 'b', 'p']))}</div>"
    return f"<{(t := rng.choice(['div', 'p']))}>&copy; {_sentence(rng, rng.randint(1, 5), OTHER)}</{t}>"


def _article(rng: random.Random, blocks: int, nested: bool) -> str:
    tag, name = rng.choice(MAIN_IN)
    body = []
    head = rng.random()
    if head < 0.55 and blocks > 1:
        body.append(f"<h1>{_sentence(rng, rng.randint(1, 10))}</h1>")
    elif head < 0.75 and blocks > 1 and tag in ("article", "main"):
        body.append(f"<header><h1>{_sentence(rng, rng.randint(1, 10))}</h1><p>{_sentence(rng, rng.randint(2, 20))}</p></header>")
    for _ in range(blocks):
        k, s = rng.random(), _sentence(rng, rng.choice([1, 2, 4, 8, 20, 40, 80, 150]))
        if k < 0.12 and blocks > 1:
            body.append(f"<h2>{_sentence(rng, rng.randint(1, 6))}</h2>")
        elif k < 0.2:
            body.append("<ul>" + "".join(f"<li>{_sentence(rng, rng.randint(2, 20))}</li>" for _ in range(3)) + "</ul>")
        elif k < 0.27:
            body.append(f"<blockquote>{s}</blockquote>")
        elif k < 0.35:
            body.append(f"<p><b>{s}<br>")
        elif k < 0.42:
            body.append(f'<p>{s} <a href="/x">{_sentence(rng, 2)}</a> {s}</p>')
        elif k < 0.46:
            body.append(f"<pre>{s}</pre>")
        elif k < 0.5:
            body.append(f"<table><tr><td>{_sentence(rng, 3)}</td><td>{_sentence(rng, 3)}</td></tr></table>")
        elif k < 0.54:
            body.append(f"<figure><img src=x><figcaption>{s}</figcaption></figure>")
        elif k < 0.58:
            body.append(f"<section><h2>{_sentence(rng, 3)}</h2><p>{s}</p></section>")
        else:
            body.append(f"<p>{s}</p>")
    if nested and tag:
        for _ in range(rng.randint(1, 3)):
            body.insert(rng.randint(1, len(body)), "</p>" + _boilerplate(rng, INSIDE + [p for p in OTHER_IN if p[1]]))
    return _part(rng, tag, name, "".join(body))


def labelled_pages(n: int = PAGES, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Pages as blocks with labels (1 main). The sentences of menus, adverts and the like begin
    with a mark, wherever they stand; the labels are read off the marked page, the blocks
    off the page without marks."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        article = _article(rng, rng.choice([1, 1, 2, 3, 4, 6, 9, 14]), rng.random() < 0.5)
        kind = rng.random()
        if kind < 0.15:                              # nothing beside the article
            before, after = [], []
        elif kind < 0.25:                            # no names at all
            before, after = [_unnamed(rng) for _ in range(rng.randint(0, 2))], [_unnamed(rng) for _ in range(rng.randint(0, 2))]
        else:
            before = [_boilerplate(rng) for _ in range(rng.randint(0, 3))]
            after = [_boilerplate(rng) for _ in range(rng.randint(0, 3))]
            if rng.random() < 0.4:
                before.insert(0, _boilerplate(rng, [("header", "")]))
            if rng.random() < 0.4:
                after.append(_boilerplate(rng, [("footer", "")]))
        page = "<html><body>" + ("<div id=wrapper>" if rng.random() < 0.3 else "") + "</p>".join([*before, article, *after])
        if rng.random() > 0.1:
            page += "</body></html>"
        out.append((leaf_blocks(page.replace(OTHER, "")), [int(OTHER not in b.text) for b in leaf_blocks(page)]))
    return out


# --- the field --------------------------------------------------------------------------------

@dataclass
class Field:
    """score(label sequence) = sum of state[feature][label] and change[label][label]."""

    state: dict[str, tuple[float, float]]
    change: list[list[float]]

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best label sequence (Viterbi)."""
        none = (0.0, 0.0)
        get, change = self.state.get, self.change
        back: list[tuple[int, int]] = []
        a0 = a1 = 0.0
        for i, b in enumerate(blocks):
            e0 = e1 = 0.0
            for f in b.features:
                w = get(f, none)
                e0 += w[0]
                e1 += w[1]
            if i:
                p0, q0, p1, q1 = a0 + change[0][0], a1 + change[1][0], a0 + change[0][1], a1 + change[1][1]
                back.append((int(q0 > p0), int(q1 > p1)))
                a0, a1 = max(p0, q0) + e0, max(p1, q1) + e1
            else:
                a0, a1 = e0, e1
        if not blocks:
            return []
        out = [int(a1 > a0)]
        for b in reversed(back):
            out.append(b[out[-1]])
        return out[::-1]


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, rate: float = RATE, prior: float = PRIOR) -> Field:
    """Maximum likelihood with a Gaussian prior, by AdaGrad over the whole set."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for blocks, _ in pages for b in blocks for f in b.features})
    index = {f: i for i, f in enumerate(names)}
    width, n = max(len(b) for b, _ in pages), len(pages)
    rows = [(p, t, index[f]) for p, (blocks, _) in enumerate(pages) for t, b in enumerate(blocks) for f in b.features]
    P, T, X = (np.array(c) for c in zip(*rows))
    place = P * width + T
    live = np.zeros((n, width), bool)
    gold = np.zeros((n, width), int)
    for p, (blocks, labels) in enumerate(pages):
        live[p, :len(blocks)] = True
        gold[p, :len(blocks)] = labels
    want_state = np.zeros((len(names), 2))
    np.add.at(want_state, (X, gold[P, T]), 1)
    both = live[:, 1:]
    want_change = np.zeros((2, 2))
    np.add.at(want_change, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    w, c = np.zeros((len(names), 2)), np.zeros((2, 2))
    sw, sc = np.full(w.shape, 1e-6), np.full(c.shape, 1e-6)
    for _ in range(steps):
        e = np.stack([np.bincount(place, w[X, y], n * width) for y in (0, 1)], axis=1).reshape(n, width, 2)
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for t in range(1, width):
            f[:, t] = np.where(live[:, t, None], e[:, t] + np.logaddexp.reduce(f[:, t - 1, :, None] + c, axis=1), f[:, t - 1])
        for t in range(width - 2, -1, -1):
            b[:, t] = np.where(live[:, t + 1, None], np.logaddexp.reduce(c + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2), 0)
        total = np.logaddexp.reduce(f[:, -1], axis=1)
        state = np.exp(f + b - total[:, None, None]) * live[:, :, None]
        pair = np.exp(f[:, :-1, :, None] + c + (e[:, 1:] + b[:, 1:])[:, :, None, :] - total[:, None, None, None])
        pair *= both[:, :, None, None]
        gw = want_state - prior * n * w
        gw -= np.stack([np.bincount(X, state[P, T, y], len(names)) for y in (0, 1)], axis=1)
        gc = want_change - pair.sum(axis=(0, 1)) - prior * n * c
        sw += gw * gw
        sc += gc * gc
        w += rate * gw / np.sqrt(sw)
        c += rate * gc / np.sqrt(sc)
    return Field({f: (float(a), float(b)) for f, (a, b) in zip(names, w)}, c.tolist())


def main_text(page: str, field: Field) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks)) if label)


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html, ...)``.

    Null html: empty text. Repeated rows each give a row; other columns are ignored; no
    rows: empty. Without ``field`` one is trained on the labelled pages (some seconds' work,
    the same in every run)."""
    field = field or train(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = [main_text(h or "", field) for h in b.column(2).to_pylist()]
            yield table(RESULT, b.column(0), b.column(1), texts, [len(t) for t in texts])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
