"""Main text of web pages by boosted trees over DOM features.

Every element gets features: its tag and attribute words and those above it
(hashed), depth, how much text, links and elements its subtree holds, and how it
stands among its siblings.  Boosted trees, learned here from a bounded sample of
pages, say how likely an element belongs to the article.  A dynamic programme
over the tree then keeps the likeliest set of elements in which nothing is kept
below what is dropped.
"""

from __future__ import annotations

import pickle
import random
import zlib
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_texts
from .html_dom import INLINE, UNSEEN, Page
from .trees import Boosted

# Pages learned from at most, and variants made of each.
PAGES, VARIANTS = 300, 5
BUCKETS = 192
# Elements whose features are there at a time.
ELEMENTS = 1 << 16

# Names that tell the parts of pages, for the labels to learn from.
OUTSIDE_TAGS = "nav header footer aside form".split()
OUTSIDE_NAMES = ("ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion banner sidebar side menu "
                 "nav navbar navigation breadcrumb breadcrumbs header masthead topbar top footer foot bottom copyright "
                 "legal cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login "
                 "search form comment comments reply replies respond discussion disqus thread share sharing social "
                 "related recommended more widget widgets pager pagination tags toolbar skip disclaimer").split()
INSIDE_NAMES = "article content main post entry story body text page".split()
_OUTSIDE, _INSIDE = set(OUTSIDE_NAMES), set(INSIDE_NAMES)


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """The elements of each depth from 1 on, in page order; one sort, however deep the pages are."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth)))[1:-1] if len(depth) else []


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(features, parent, depth)`` of all elements of all pages in a row."""
    held, parent, depth = _held(pages)
    return _spread(held, slice(None)), parent, depth


def _spread(held: tuple[np.ndarray, ...], part: slice) -> np.ndarray:
    numbers, marks, above = (h[part] for h in held)
    return np.concatenate([numbers, np.unpackbits(marks, axis=1), np.unpackbits(above, axis=1)], 1)


def _held(pages: list[Page]) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """``features`` with the hashed words as rows of bits."""
    sizes = np.array([len(p.tag) for p in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = int(sizes.sum())
    parent = np.concatenate([np.array(p.parent) for p in pages]) + base
    root = np.concatenate([np.array(p.parent) for p in pages]) < 0
    parent[root] = np.flatnonzero(root)
    depth = np.concatenate([np.array(p.depth) for p in pages])
    own = np.concatenate([np.array(p.own, float) for p in pages])
    tags = [t for p in pages for t in p.tag]
    link = np.array([t == "a" for t in tags])
    inline = np.array([t in INLINE for t in tags])
    slots: dict[str, int] = {}
    marks = np.zeros((n, BUCKETS // 8), np.uint8)
    for i, (tag, words) in enumerate(zip(tags, (w for p in pages for w in p.words), strict=True)):
        for word in (f"<{tag}", *words):
            if word not in slots:
                slots[word] = zlib.crc32(word.encode("utf-8")) % BUCKETS
            slot = slots[word]
            marks[i, slot >> 3] |= 128 >> (slot & 7)
    above = np.zeros_like(marks)
    words = [w for p in pages for w in p.words]
    named = np.stack([                               # how the element names itself, then those above it
        [t in OUTSIDE_TAGS for t in tags], [not _OUTSIDE.isdisjoint(w) for w in words],
        [t in ("article", "main") for t in tags], [not _INSIDE.isdisjoint(w) for w in words]], 1).astype(np.uint8)
    named = np.concatenate([named, np.zeros_like(named)], 1)
    text, nodes, links = own.copy(), np.ones(n), np.where(link, own, 0.0)
    anchors = link.astype(float)
    levels = _levels(depth)
    for at in levels:                                # from the page down
        above[at] = above[parent[at]] | marks[parent[at]]
        named[at, 4:] = named[parent[at], 4:] | named[parent[at], :4]
    linked = link.copy()
    for at in levels:
        linked[at] |= linked[parent[at]]
    links = np.where(linked, own, 0.0)
    for at in reversed(levels):                      # and up again
        for total in (text, nodes, links, anchors):
            np.add.at(total, parent[at], total[at])
    children = np.bincount(parent[~root], minlength=n)
    page = np.repeat(np.arange(len(pages)), sizes)
    whole = text[np.flatnonzero(root)][page] + 1
    before = np.cumsum(own) - own
    place = (before - before[np.flatnonzero(root)][page]) / whole
    order = np.argsort(parent * 2 + root, kind="stable")             # siblings, in page order
    first = np.concatenate(([True], np.diff(parent[order]) != 0)) if n else np.zeros(0, bool)
    number = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.zeros(n)
    rank[order] = number
    around = (text[parent] - own[parent]) / np.maximum(children[parent], 1)
    numbers = np.stack([
        depth, np.log2(own + 1), np.log2(text + 1), np.log2(nodes), text / nodes / 16, 16 * links / (text + 1),
        np.log2(anchors + 1), children, rank, children[parent] - rank, 4 * np.log2((text + 1) / (around + 1)) + 16,
        16 * text / whole, 16 * place, inline, 16 * links[parent] / (text[parent] + 1), np.log2(text[parent] + 1)], 1)
    return (np.concatenate([np.clip(numbers, 0, 31).astype(np.uint8), named], 1), marks, above), parent, depth


def decode(odds: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The likeliest set of elements without a kept one below a dropped one.

    Dropping an element costs all below it; keeping it gains its log odds and
    what its children gain, where that is positive."""
    value = np.clip(odds, -6, 6)
    levels = _levels(depth)
    for at in reversed(levels):
        np.add.at(value, parent[at], np.maximum(value[at], 0))
    kept = depth == 0
    for at in levels:
        kept[at] = kept[parent[at]] & (value[at] > 0)
    return kept


def _inside(page: Page) -> np.ndarray | None:
    """Labels of a real page: what is in its article or main element, and what
    holds these; nothing below an element that names itself as something else."""
    n = len(page.tag)
    chosen = next((t for t in ("article", "main") if t in page.tag), None)
    if chosen is None:
        return None
    label = np.zeros(n, bool)
    for i in range(1, n):
        outside = page.tag[i] in OUTSIDE_TAGS or page.tag[i] in UNSEEN or not set(page.words[i]).isdisjoint(OUTSIDE_NAMES)
        label[i] = not outside and (label[page.parent[i]] or page.tag[i] == chosen)
    holds = label.copy()
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] |= holds[i]
    return holds


def variant(texts: list[str], others: list[str], rng: random.Random) -> str:
    """A page made of a real page's blocks: the article under one of the usual
    names, other parts around and inside it; data-y says which is which."""
    def link(t: str) -> str:
        return f'<a href="/x">{escape(t[:30])}</a>'

    def outside() -> str:
        name, some = rng.choice(OUTSIDE_NAMES), rng.choice(others + texts)
        if rng.random() < 0.3:
            tag, attribute = rng.choice(OUTSIDE_TAGS), ""
        else:
            tag, attribute = rng.choice(["div", "section", "ul", "p", "div", "aside"]), (
                f' {rng.choice(["class", "id"])}="{name}{rng.choice(["", "-box", " wrap", "-1", "_list"])}"')
        words = some.split() or ["x"]
        inner = rng.choice([
            lambda: "".join(f"<li>{link(w)}</li>" for w in words[:6]),
            lambda: escape(some),
            lambda: "".join(f"<p>{escape(rng.choice(others + texts))}</p>" for _ in range(rng.randint(1, 4))),
            lambda: f"<div><b>{escape(words[0])}</b><p>{escape(some)}</p></div>" * rng.randint(1, 3),
            lambda: f"<h3>{escape(words[0])}</h3><ul>" + "".join(f"<li>{link(w)}</li>" for w in words[:5]) + "</ul>"])()
        return f'<{tag}{attribute} data-y="0">{inner}</{tag}>'

    def block(t: str) -> str:
        t = escape(t)
        if rng.random() < 0.2 and " " in t:
            a, b = t.split(" ", 1)
            t = f"{rng.choice(['<b>', '<em>', '<a href=/y>', '<i>'])}{a}</b> {b}".replace("</b>", "") if rng.random() < 0.3 else (
                f"<strong>{a}</strong> {b}")
        tag = rng.choice(["p"] * 8 + ["blockquote", "li", "h2", "pre", "div"])
        return f"<ul><li>{t}</li></ul>" if tag == "li" else f"<{tag}>{t}</{tag}>"

    if rng.random() < 0.4:                           # short articles too
        texts = [" ".join(t.split()[:rng.randint(2, 12)]) for t in texts[:rng.randint(1, 4)]]
    blocks = [block(t) for t in texts]
    if rng.random() < 0.7:
        blocks.insert(0, f"<h1>{escape(texts[0][:60])}</h1>")
    for _ in range(rng.randint(0, 2)):
        blocks.insert(rng.randint(1, len(blocks)), outside())
    opening, closing = "", ""
    for _ in range(rng.randint(1, 3)):
        tag = rng.choice(["article", "main", "div", "div", "section"])
        attribute = f' {rng.choice(["class", "id"])}="{rng.choice(INSIDE_NAMES)}"' * (rng.random() < 0.6)
        opening, closing = f'{opening}<{tag}{attribute} data-y="1">', f"</{tag}>{closing}"
    parts = [outside() for _ in range(rng.randint(1, 4))]
    parts.append(opening + "".join(blocks) + closing)
    parts += [outside() for _ in range(rng.randint(1, 4))]
    wrap = rng.random() < 0.4
    return ('<html data-y="1"><head><title>t</title></head><body data-y="1">' + '<div data-y="1">' * wrap
            + "".join(parts) + "</div>" * wrap + "</body></html>")


def _given(page: Page) -> np.ndarray:
    label = np.zeros(len(page.tag), bool)
    label[0] = True
    for i in range(1, len(label)):
        label[i] = label[page.parent[i]] and page.given[i] != "0" and page.tag[i] not in UNSEEN
    return label


def fit(htmls: list[str], variants: int = VARIANTS) -> Boosted | None:
    """Learn from pages with an article or main element; None without any."""
    pages, labels = [], []
    for html in htmls:
        page = Page(html)
        inside = _inside(page)
        if inside is None:
            continue
        texts = page.text(inside.tolist()).split("\n")
        seen = [not inside[i] and page.tag[i] not in UNSEEN for i in range(len(page.tag))]
        others = [t for t in page.text(seen).split("\n") if t] or ["Home"]
        if not texts[0]:
            continue
        pages.append(page)
        labels.append(inside)
        rng = random.Random(zlib.crc32(html.encode("utf-8", "replace")))
        for _ in range(variants):
            some = rng.sample(texts, rng.randint(1, min(len(texts), 12)))
            made = Page(variant(some, others, rng))
            pages.append(made)
            labels.append(_given(made))
    if not pages:
        return None
    x, _, depth = features(pages)
    y = np.concatenate(labels)
    return Boosted().fit(x[depth > 0], y[depth > 0].astype(float))


def train(pages: DataFrame, html: str = "html", rows: int = PAGES) -> bytes:
    """The model from at most ``rows`` pages, chosen by their hashes, fitted by
    one task.  Null and empty pages, and pages without an article or main
    element, teach nothing; without any other the model is empty."""
    some = pages.select(F.col(f"`{html}`").cast("string").alias("h")).where("length(h) > 0")
    some = bounded_sample(some, rows, "h")

    def learn(batches):
        htmls = [h for batch in batches for h in batch.column("h").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(htmls))], pa.binary())], names=["model"])

    found = some.repartition(1).sortWithinPartitions("h").mapInArrow(learn, "model binary").collect()
    return bytes(found[0].model) if found else pickle.dumps(None)


def main_texts(htmls: list[str], model: Boosted | None) -> list[str]:
    """Without a model, elements are judged by their names alone.  Pages are taken
    together up to ``ELEMENTS`` elements; a larger one by itself, scored in slices."""
    out, held, size = [], [], 0
    for html in htmls:
        held.append(Page(html))
        size += len(held[-1].tag)
        if size >= ELEMENTS:
            out += _texts(held, model)
            held, size = [], 0
    return out + (_texts(held, model) if held else [])


def _texts(pages: list[Page], model: Boosted | None) -> list[str]:
    x, parent, depth = _held(pages)
    tags = [t for p in pages for t in p.tag]
    if model is None:
        odds = np.array([-3.0 if t in OUTSIDE_TAGS or not set(w).isdisjoint(OUTSIDE_NAMES) else 3.0
                         for t, w in zip(tags, (w for p in pages for w in p.words), strict=True)])
    else:
        odds = np.concatenate([model.predict(_spread(x, slice(i, i + ELEMENTS))) for i in range(0, len(tags), ELEMENTS)])
    odds[[t in UNSEEN for t in tags]] = -1e6         # never shown as text
    kept = decode(odds, parent, depth)
    out, start = [], 0
    for page in pages:
        out.append(page.text(kept[start:start + len(page.tag)].tolist()))
        start += len(page.tag)
    return out


def extract(pages: DataFrame, model: bytes, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """The ``keep`` columns with ``text`` and ``n_chars`` (code points) of each page.

    Null and empty pages give an empty text.  Broken and unclosed markup is read
    as browsers mostly do; repeated rows and null keys stay rows of their own;
    an empty table gives an empty result; further columns are not read.
    """
    fields = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep)
    shared = pages.sparkSession.sparkContext.broadcast(model)    # of a fixed size

    def make(htmls: pa.Array) -> dict[str, object]:
        texts = main_texts(htmls.to_pylist(), pickle.loads(shared.value))
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return map_texts(pages, list(keep), html, f"{fields}, text string, n_chars bigint", make)
