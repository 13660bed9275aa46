"""Operator 5: main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (text between block-level tags). Each block has features of its ancestors (tags, words
of class, id and role) and of its text (words, link share, punctuation, digits, signs). The field's weights, for
features by label and for labels side by side, are trained on the labelled pages below, and Viterbi decoding picks a
page's best labels together. Blocks labelled as article are joined by one space.

White space in a block becomes one space; character references are decoded; scripts, styles, comments and markup are
never text; nor are templates and frames (never shown) and text areas. Formulas, drawings and fallbacks (math, svg, object, noscript)
are text of the block that they stand in. A page is read once from left to right, in time that grows with its length, however deep or broken it is: a quote
that never ends counts as no quote; a tag, comment or script that never ends takes the rest of the page; end tags without an
open element are ignored. A null or empty page, or one without an article block, gives an empty text; repeated rows stay; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Fixed values of HTML: elements that stand in a line of text, have no content, or hold no text to read.
INLINE = set("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
INLINE |= set("math semantics annotation mi mo mn ms mtext mspace mrow mstyle mfrac msqrt mroot msub msup msubsup munder mover munderover mpadded mphantom svg g text tspan textpath noscript object ruby rb rt rp rtc".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(f"</{t}(?![a-z0-9])", re.I) for t in "script style template iframe textarea title".split()}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
MARK = re.compile(r">|=\s*")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORD = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes) and ("close", tag, "") of a page, in order."""
    n, i = len(page), 0
    unclosed = set()  # quotes that don't occur any more
    while i < n:
        if page[i] != "<":
            j = page.find("<", i)
            j = n if j < 0 else j
            yield "text", page[i:j], ""
            i = j
            continue
        if page.startswith("<!--", i):
            j = page.find("-->", i + 4)
            i = n if j < 0 else j + 3
            continue
        if page[i + 1 : i + 2] in ("!", "?"):
            j = page.find(">", i)
            i = n if j < 0 else j + 1
            continue
        m = NAME.match(page, i + 1)
        if m is None:
            yield "text", "<", ""
            i += 1
            continue
        at = m.end()
        while True:
            mark = MARK.search(page, at)
            if mark is None:
                return
            at = mark.end()
            if mark[0] == ">":
                break
            if (quote := page[at : at + 1]) in ("'", '"') and quote not in unclosed:
                j = page.find(quote, at + 1)
                if j < 0:
                    unclosed.add(quote)
                else:
                    at = j + 1
        tag = m[2].lower()
        if m[1]:
            yield "close", tag, ""
        elif tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.start() if end else n
        else:
            yield "open", tag, page[m.end() : at - 1]
        i = at


def leaf_blocks(page: str, known: set[str] | None = None) -> list[tuple[str, list[str]]]:
    """(text, features) of each block of a page, in order. known: the only features of ancestors that count; a page may have
    any number of others."""
    out: list[tuple[str, list[str]]] = []
    stack: list[tuple[str, list[str]]] = []  # block-level elements that are open, and their features
    open_tags: Counter = Counter()
    above: dict[str, int] = {}  # how many open elements have each feature
    pieces: list[str] = []
    linked = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACES.sub(" ", "".join(pieces)).strip()
            if text:
                out.append((text, features(text, above, stack[-1][0] if stack else "", linked)))
            pieces.clear()
        linked = 0

    def pop() -> str:
        tag, own = stack.pop()
        open_tags[tag] -= 1
        for f in own:
            above[f] -= 1
            if not above[f]:
                del above[f]
        return tag

    for kind, tag, attributes in tokens(page):
        if kind == "text":
            text = html_lib.unescape(tag)  # each by itself: a tag ends a reference
            pieces.append(text)
            if in_link:
                linked += len(text)
            continue
        if tag in RAW:  # its end: the block goes on
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = kind == "open"
            continue
        flush()
        in_link = False
        if kind == "close":
            while open_tags[tag] and pop() != tag:
                pass
            continue
        if tag in VOID:
            continue
        while stack and (stack[-1][0] == "p" or stack[-1][0] in CLOSES.get(tag, ())):
            pop()
        own = ["in " + tag, *("named " + w for g in NAMES.findall(attributes) for w in WORD.findall("".join(g).lower()))]
        own = [f for f in own if known is None or f in known]
        for f in own:
            above[f] = above.get(f, 0) + 1
        stack.append((tag, own))
        open_tags[tag] += 1
    flush()
    return out


def features(text: str, above: dict[str, int], leaf: str, linked: int) -> list[str]:
    out = ["bias", *above]
    if leaf:
        out.append("leaf " + leaf)
    n = text.count(" ") + 1
    out.append(f"words {min(n.bit_length(), 7)}")
    out.append(f"linked {min(3, 4 * linked // max(1, len(text)))}")
    if text[-1] in ".!?…:;\"'»”)":
        out.append("stops")
    if "©" in text:
        out.append("sign")
    if sum(map(str.isdigit, text)) * 5 > len(text):
        out.append("digits")
    return out


class Field:
    """Labels 0 (other) and 1 (article): a weight for each feature (for 1 against 0) and for each pair of labels side by side."""

    def __init__(self, weights: dict[str, float], begin: np.ndarray, step: np.ndarray):
        self.weights, self.begin, self.step = weights, begin, step
        self.known = set(weights)

    def decode(self, blocks: list[tuple[str, list[str]]]) -> list[int]:
        """The most likely labels together (Viterbi)."""
        if not blocks:
            return []
        get, s = self.weights.get, self.step.tolist()
        first = sum(get(f, 0.0) for f in blocks[0][1])
        zero, one = float(self.begin[0]), float(self.begin[1]) + first
        back: list[tuple[int, int]] = []
        for _, fs in blocks[1:]:
            e = 0.0
            for f in fs:
                e += get(f, 0.0)
            from_zero, from_one = (zero + s[0][0], one + s[1][0]), (zero + s[0][1], one + s[1][1])
            back.append((int(from_zero[1] > from_zero[0]), int(from_one[1] > from_one[0])))
            zero, one = max(from_zero), max(from_one) + e
        at = int(one > zero)
        out = [at]
        for b in reversed(back):
            at = b[at]
            out.append(at)
        return out[::-1]


def train(pages: list[tuple[list[tuple[str, list[str]]], list[int]]], rounds: int = 150, rate: float = 0.3, decay: float = 0.01) -> Field:
    """Conditional log-likelihood of the labelled pages, by AdaGrad with gradients from forward-backward sums."""
    names = sorted({f for blocks, _ in pages for _, fs in blocks for f in fs})
    place = {f: k for k, f in enumerate(names)}
    longest, n = max(len(b) for b, _ in pages), len(pages)
    x = np.zeros((n, longest, len(names)), np.float32)
    y, real = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for p, (blocks, labels) in enumerate(pages):
        for k, (_, fs) in enumerate(blocks):
            x[p, k, [place[f] for f in fs]] = 1
            y[p, k], real[p, k] = labels[k], True
    w, begin, step = np.zeros(len(names)), np.zeros(2), np.zeros((2, 2))
    seen = [np.full_like(v, 1e-6) for v in (w, begin, step)]
    last = real.sum(1) - 1
    for _ in range(rounds):
        emit = np.stack([np.zeros((n, longest)), x @ w.astype(np.float32)], 2)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = begin + emit[:, 0]
        for k in range(1, longest):
            ahead[:, k] = np.logaddexp(ahead[:, k - 1, :1] + step[0], ahead[:, k - 1, 1:] + step[1]) + emit[:, k]
        behind = np.zeros((n, longest, 2))
        for k in range(longest - 2, -1, -1):
            nxt = emit[:, k + 1] + behind[:, k + 1]
            behind[:, k] = np.where((k < last)[:, None], np.logaddexp(step[:, 0] + nxt[:, :1], step[:, 1] + nxt[:, 1:]), 0)
        total = np.logaddexp.reduce(ahead[np.arange(n), last], axis=1)
        one = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]) * real
        grad_w = np.einsum("pkf,pk->f", x, ((y == 1) & real) - one) - decay * w
        grad_b = np.array([(y[:, 0] == 0).sum() - (1 - one[:, 0]).sum(), (y[:, 0] == 1).sum() - one[:, 0].sum()])
        grad_s = np.zeros((2, 2))
        both = real[:, 1:]
        for a in range(2):
            for b in range(2):
                p = np.exp(ahead[:, :-1, a] + step[a, b] + emit[:, 1:, b] + behind[:, 1:, b] - total[:, None]) * both
                grad_s[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum() - p.sum()
        for v, g, s in zip((w, begin, step), (grad_w, grad_b, grad_s), seen, strict=True):
            s += g * g
            v += rate * g / np.sqrt(s)
    return Field(dict(zip(names, w.tolist(), strict=True)), begin, step)


_SAID = "the river town kept its old mill while boats came up with grain and salt each spring people met there to trade news about roads weather and work".split()


def labelled_pages(count: int = 240, seed: int = 11) -> Iterator[tuple[str, list[int]]]:
    """Pages of many layouts, made by hand-written rules, with the label of each leaf block. They are training data only."""
    r = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(r.choice(_SAID) for _ in range(r.randint(low, high)))

    def sentence(low: int = 6, high: int = 18) -> str:
        said = words(low, high).capitalize()
        said = r.choice([said] * 14 + ["© " + said, f"{r.randint(10, 10**9)} {said}", said.replace(" ", " | "), said.replace(" ", "### ")])
        return said + r.choice([".", ".", ".", "!", "?", ""])

    def paragraph() -> str:
        return " ".join(sentence() for _ in range(r.randint(1, 6)))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{words(1, 2)}</a></li>' for k in range(n))

    def other() -> tuple[str, int]:
        """A piece that isn't article, and its number of blocks."""
        n = r.randint(2, 6)
        name = r.choice("ad ads advert advertisement promo banner sponsor sponsored".split())
        side = r.choice("sidebar side aside widget related recommended trending popular".split())
        note = r.choice("notice cookie cookies consent gdpr alert disclaimer message popup modal".split())
        menu = r.choice("menu nav navbar navigation breadcrumb topbar tabs".split())
        told = r.choice("comment comments reply replies responses discussion".split())
        box = r.choice("share social newsletter subscribe signup login search form tags pagination meta".split())
        return r.choice(
            [
                lambda: (f"<nav><ul>{links(n)}</ul></nav>", n),
                lambda: (f'<div class="{menu}"><ul>{links(n)}</ul></div>', n),
                lambda: (f"<header><h1>{words(1, 3)}</h1><p>{sentence(3, 8)}</p></header>", 2),
                lambda: (f'<div id="header"><div>{words(1, 3)}</div></div>', 1),
                lambda: (f'<div class="{name}">{paragraph()}</div>', 1),
                lambda: (f'<div class="{name}"><p>{sentence()}</p><p><a href="#">{words(1, 3)}</a></p></div>', 2),
                lambda: (f"<aside><h3>{words(1, 3)}</h3><p>{paragraph()}</p></aside>", 2),
                lambda: (f'<div class="{side}"><h3>{words(1, 3)}</h3><ul>{links(n)}</ul><p>{paragraph()}</p></div>', n + 2),
                lambda: (f'<div class="{note}"><p>{paragraph()}</p></div>', 1),
                lambda: (f'<form><label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button></form>', 2),
                lambda: (f'<section id="{told}"><h3>{words(1, 2)}</h3>' + f'<div class="{told}"><p>{paragraph()}</p></div>' * 2 + "</section>", 3),
                lambda: (f'<div class="{box}"><p>{sentence(2, 8)}</p><a href="#">{words(1, 2)}</a></div>', 2),
                lambda: (f"<footer>&copy; {words(1, 2)} &middot; {sentence()}</footer>", 1),
                lambda: (f'<div class="footer"><p>&copy; {r.randint(1990, 2030)} {words(1, 3)}</p><ul>{links(n)}</ul></div>', n + 1),
            ]
        )()

    def article() -> tuple[str, list[int]]:
        parts, labels = [f"<h1>{words(2, 9).capitalize()}{r.choice(['', '.'])}</h1>"], [1]
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.72:
                parts.append(r.choice([f"<p>{paragraph()}</p>", f"<p><b>{sentence(1, 6)}</b> {paragraph()}", f"<p>{sentence(1, 3)}</p>", f"<p>{sentence()} <a href='#'>{words(1, 2)}</a> {sentence()}</p>"]))
                labels.append(1)
            elif kind < 0.80:
                parts.append(f"<h2>{words(1, 6).capitalize()}</h2>")
                labels.append(1)
            elif kind < 0.86:
                parts.append(f"<blockquote><p>{paragraph()}</p></blockquote>")
                labels.append(1)
            elif kind < 0.92:
                n = r.randint(2, 4)
                parts.append("<ul>" + "".join(f"<li>{sentence(2, 9)}</li>" for _ in range(n)) + "</ul>")
                labels += [1] * n
            else:
                piece, n = other()
                parts.append(piece)
                labels += [0] * n
        if r.random() < 0.2:
            parts = parts[1:]
            labels = labels[1:]
        name = r.choice("content article post entry story main body text maincontent article-body post-content entry-content".split())
        head, tail = r.choice([("<article>", "</article>")] * 6 + [("<main>", "</main>"), ("<main><article>", "</article></main>"), (f'<div class="{name}">', "</div>"), (f'<div id="{name}">', "</div>"), (f'<section class="{name}">', "</section>"), ("<div>", "</div>")])
        return head + "".join(parts) + tail, labels

    for _ in range(count):
        body, labels = [], []
        for piece, n in (other() for _ in range(r.randint(1, 4))):
            body.append(piece)
            labels += [0] * n
        piece, own = article()
        body.append(piece)
        labels += own
        for piece, n in (other() for _ in range(r.randint(1, 4))):
            body.append(piece)
            labels += [0] * n
        yield f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title><style>p{{margin:0}}</style></head><body>{''.join(body)}</body></html>", labels


@lru_cache(1)
def trained_field() -> Field:
    pages = []
    for page, labels in labelled_pages():
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise ValueError("a labelled page's blocks and labels differ")
        pages.append((blocks, labels))
    return train(pages)


def main_text(page: str, field: Field) -> str:
    blocks = leaf_blocks(page, field.known)
    return " ".join(text for (text, _), label in zip(blocks, field.decode(blocks), strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    field = field or trained_field()
    asked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(p.as_py(), field) for p in b["html"]]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = asked.schema["page_id"].dataType.simpleString()
    return asked.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
