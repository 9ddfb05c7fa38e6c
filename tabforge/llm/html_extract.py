"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the document tree.

A block is a stretch of text between block-level tags. Its features are the tags
and the class, id and role words of its ancestors and properties of its text;
two labels, content or not, form a chain over the page. Weights are learned from
labelled pages (layouts written from the lists below, and pages whose own markup
names the article), and a page is decoded by Viterbi's algorithm.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.columns import hash_unit, without

# HTML elements by how they shape blocks.
DROPPED = "script|style|template|annotation-xml|annotation"  # never rendered
FOREIGN = frozenset(("svg", "math"))  # inside, a tag that ends in "/>" is closed
UNSEEN = frozenset(("title", "desc", "metadata"))  # never rendered inside an svg
APART = frozenset("noscript object iframe canvas text".split())  # inline, but no word reaches across their ends
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html input label legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({DROPPED})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # ancestors, outermost first: the tag, then the words of class, id and role
    text: str
    linked: float  # share of the characters inside links


def leaf_blocks(page: str | None) -> list[Block]:
    """The non-empty text blocks of a page in order; character references decoded, white space single, ends trimmed.

    Works on broken markup: a block start ends an open paragraph, unknown end
    tags are ignored, an unclosed comment or script runs to the end.
    """
    found: list[Block] = []
    stack: list[str] = []
    buffer: list[str] = []
    in_link, link_chars, at, foreign = 0, 0, 0, 0
    page = page or ""

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                found.append(Block(tuple(stack), text, min(1.0, link_chars / len(text))))
            buffer.clear()
        link_chars = 0

    while match := _TAG.search(page, at):
        if match.start() > at:
            piece = page[at : match.start()]
            piece = html.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            if in_link:
                link_chars += len(piece)
        at = match.end()
        tag = match[3]
        if tag is None:
            if foreign and match[1] and (opening := page[match.start() : page.find(">", match.start()) + 1]).endswith("/>"):
                at = match.start() + len(opening)
            continue
        tag = tag.lower()
        if tag in FOREIGN:
            foreign = max(0, foreign - 1) if match[2] else foreign + (not match[4].endswith("/"))
        elif foreign and tag in UNSEEN:
            end = None if match[2] or match[4].endswith("/") else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else at
        elif tag in APART:
            buffer.append(" ")
        elif tag == "br":
            buffer.append(" ")
        elif tag == "a":
            in_link = 0 if match[2] else 1
        elif tag in BLOCKS:
            flush()
            if match[2]:
                _close(stack, tag)
            elif tag not in VOID:
                if stack and stack[-1].split(" ", 1)[0] == "p":
                    stack.pop()
                if tag in CLOSED_BY_SAME and stack and stack[-1].split(" ", 1)[0] == tag:
                    stack.pop()
                stack.append(_element(tag, match[4]))
    if at < len(page):
        buffer.append(html.unescape(page[at:]))
    flush()
    return found


def _element(tag: str, attributes: str) -> str:
    if not attributes or "=" not in attributes:
        return tag
    names = " ".join("".join(m) for m in _NAMES.findall(attributes))
    return " ".join([tag, *_NAME_WORDS.findall(names.lower())])


def _close(stack: list[str], tag: str) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].split(" ", 1)[0] == tag:
            del stack[i:]
            return


# Cue words by what they hint at, in block texts.
_CUES = re.compile(
    r"(?P<legal>©|copyright|all rights reserved|privacy|terms of)|(?P<notice>cookie|consent|gdpr)|(?P<advert>advert|sponsored|promo)"
    r"|(?P<social>subscribe|newsletter|follow us|share this|sign in|log in)|(?P<comment>\breply\b|\bcomments?\b|posted by)",
    re.I,
)


def path_features(path: tuple[str, ...]) -> list[str]:
    found = set()
    for element in path:
        tag, *names = element.split(" ")
        found.add("in:" + tag)
        found.update("as:" + n for n in names)
    if path:
        found.add("at:" + path[-1].split(" ", 1)[0])
    return sorted(found)


def text_features(block: Block) -> list[str]:
    words = block.text.count(" ") + 1
    found = [f"words:{min(7, int(math.log2(words)))}", f"linked:{int(block.linked * 3.999)}"]
    if block.text[-1] in ".!?…:;\"'»”)":
        found.append("ends")
    if words <= 30:
        found += {"cue:" + m.lastgroup for m in _CUES.finditer(block.text)}
    return found


@dataclass
class ChainModel:
    """Weights in favour of content by feature, and scores of the first label, of neighbouring labels and of the last."""

    weights: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    moves: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def decoder(self) -> Callable[[list[Block]], list[int]]:
        """Viterbi decoding of a page; what a path contributes is computed once per path."""
        weights, paths = self.weights, {}
        (a00, a01), (a10, a11) = self.moves

        def path_score(path: tuple[str, ...]) -> float:
            if path not in paths:
                if len(paths) > 100_000:
                    paths.clear()
                paths[path] = sum(weights.get(f, 0.0) for f in path_features(path))
            return paths[path]

        def decode(blocks: list[Block]) -> list[int]:
            if not blocks:
                return []
            back = []
            s0 = s1 = 0.0
            for i, block in enumerate(blocks):
                e = path_score(block.path) + sum(weights.get(f, 0.0) for f in text_features(block)) + weights.get("bias", 0.0)
                if not i:
                    s0, s1 = self.start[0], self.start[1] + e
                    continue
                from0, from1 = s0 + a00 < s1 + a10, s0 + a01 < s1 + a11
                back.append((int(from0), int(from1)))
                s0, s1 = max(s0 + a00, s1 + a10), max(s0 + a01, s1 + a11) + e
            labels = [int(s1 > s0)]
            for choice in reversed(back):
                labels.append(choice[labels[-1]])
            return labels[::-1]

        return decode


def features_of(block: Block) -> list[str]:
    return ["bias", *path_features(block.path), *text_features(block)]


def fit_chain(
    pages: list[tuple[list[Block], list[int]]], importance: list[float] | None = None, l2: float = 1e-5, steps: int = 220, rate: float = 0.3
) -> ChainModel:
    """Weights that maximise the likelihood of the labels, by gradient steps on all pages; expectations by forward and backward passes.

    ``importance`` says how much each page counts (1 by default).
    """
    importance = np.array([u for u, p in zip(importance or [1.0] * len(pages), pages, strict=True) if p[0]])
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    at, cell, longest = [], [], max(len(b) for b, _ in pages)
    truth = np.zeros((len(pages), longest), int)
    there = np.zeros((len(pages), longest), bool)
    for i, (blocks, labels) in enumerate(pages):
        truth[i, : len(labels)], there[i, : len(labels)] = labels, True
        for j, block in enumerate(blocks):
            for f in features_of(block):
                at.append(names.setdefault(f, len(names)))
                cell.append(i * longest + j)
    at, cell, n, size = np.array(at), np.array(cell), len(pages), len(names)
    w = np.zeros(size + 6)
    m, v = np.zeros_like(w), np.zeros_like(w)
    pair = there[:, 1:]
    seen = np.zeros_like(w)
    seen[:size] = np.bincount(at, (truth * importance[:, None]).ravel()[cell], size)
    seen[size : size + 2] = np.bincount(truth[:, 0], importance, minlength=2)
    seen[size + 2 :] = np.bincount((2 * truth[:, :-1] + truth[:, 1:])[pair], np.broadcast_to(importance[:, None], pair.shape)[pair], minlength=4)
    for step in range(1, steps + 1):
        emit = np.zeros((n, longest, 2))
        emit[:, :, 1] = np.bincount(cell, w[at], n * longest).reshape(n, longest)
        start, moves = w[size : size + 2], w[size + 2 :].reshape(2, 2)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = start + emit[:, 0]
        for j in range(1, longest):
            new = np.logaddexp.reduce(ahead[:, j - 1, :, None] + moves, axis=1) + emit[:, j]
            ahead[:, j] = np.where(there[:, j, None], new, ahead[:, j - 1])
        for j in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(moves + (emit[:, j + 1] + behind[:, j + 1])[:, None, :], axis=2)
            behind[:, j] = np.where(there[:, j + 1, None], new, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        single = np.exp(ahead + behind - total[:, None, None]) * there[:, :, None] * importance[:, None, None]
        double = ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = np.zeros_like(w)
        expected[:size] = np.bincount(at, single[:, :, 1].ravel()[cell], size)
        expected[size : size + 2] = single[:, 0].sum(axis=0)
        moved = np.exp(np.where(pair[:, :, None, None], double, -np.inf)) * importance[:, None, None, None]
        expected[size + 2 :] = moved.sum(axis=(0, 1)).ravel()
        g = (expected - seen) / importance.sum() + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * (1 - step / (steps + 1))
    pairs = w[size + 2 :].tolist()
    return ChainModel({f: float(w[i]) for f, i in names.items()}, tuple(w[size : size + 2].tolist()), ((pairs[0], pairs[1]), (pairs[2], pairs[3])))


# Layouts of the labelled pages: opening tags of containers of content, and of what is not content.
CONTENT = (
    "article", "main", 'div class="content"', 'div id="content"', 'div class="post-body"', 'section class="article-text"', 'div class="entry-content"',
    'article class="post"', 'main id="main"', 'div class="story"', 'div itemprop="articleBody" class="body-text"',
)
AROUND = (
    "nav", "header", "footer", "aside", "form", 'div class="ad"', 'div class="advert"', 'div id="banner-ads"', 'div class="sponsored promo"',
    'div class="menu"', 'ul class="navigation menu"', 'div id="header"', 'div id="footer"', 'div class="sidebar"', 'div class="widget"',
    'div class="cookie-notice"', 'div class="alert notice"', 'div id="cookie-banner"', 'div class="newsletter-signup"', 'section id="comments"',
    'div class="comment-list"', 'ol class="comments"', 'div class="comment"', 'div class="social-share"', 'div class="related-posts"',
    'div class="breadcrumb"', 'div class="popup modal"', 'section class="reader-comments"', 'div role="navigation"', 'div role="banner"',
    'div class="comments"', 'ul class="comment-thread"', 'div class="share-bar"', 'div class="notice"', 'div class="advert box"', 'div class="replies"',
    'div role="complementary"', 'div role="contentinfo"', 'dialog class="consent"', 'fieldset class="login"', "menu",
)
_CUE_TEXTS = ("© All rights reserved", "This site uses cookies", "Subscribe to our newsletter", "Sponsored", "Reply", "Log in", "Privacy and terms of use")


def labelled_layouts(count: int, seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages made from the lists above with made-up words: the truth is where each block was put."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        some = ["".join(rng.choice(("ba", "ren", "to", "mil", "sa", "ku", "der", "lo", "ti", "en")) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(some).capitalize()

    def sentence(low: int, high: int) -> str:
        return words(low, high) + rng.choice((".", ".", ".", "!", "?", ""))

    def around(depth: int = 0) -> str:
        opening = rng.choice(AROUND)
        parts = []
        for _ in range(rng.randint(1, 5)):
            text = rng.choice((words(1, 4), sentence(3, 12), sentence(8, 60), rng.choice(_CUE_TEXTS)))
            text = f'<a href="/x">{text}</a>' if rng.random() < 0.4 else text
            parts.append(rng.choice(("<li>{}</li>", "<p>{}</p>", "<div>{}</div>", "{}<br>", "<h3>{}</h3>", "<button>{}</button>", "<label>{}</label>")).format(text))
        inside = around(1) if depth == 0 and rng.random() < 0.2 else ""
        return f"<{opening}>{inside}{''.join(parts)}</{opening.split(' ')[0]}>"

    def content() -> str:
        opening = rng.choice(CONTENT)
        parts = [f"<h1>{words(2, 12)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 14)):
            text = sentence(1, 120) if rng.random() < 0.8 else sentence(1, 6)
            if rng.random() < 0.05:
                text = f"{text} {rng.choice(_CUE_TEXTS).lower()}"
            if rng.random() < 0.15:
                text = f'{text} <a href="/y">{words(1, 5)}</a>'
            form = ("<p>{}</p>",) * 8 + ("<p><b>{}<br>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<div>{}</div>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>")
            parts.append("C" + rng.choice(form).format(text))
            if rng.random() < 0.25:
                parts.append(around(1))
        # Comments, notices, adverts and share bars often stand at the end of an article, or right under its headline.
        if rng.random() < 0.6:
            parts += [around(1) for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.2:
            parts.insert(1, around(1))
        return f"<{opening}>{''.join(parts)}</{opening.split(' ')[0]}>".replace(">C<", "><")

    found = []
    for _ in range(count):
        pieces = [("<html><head><title>" + words(2, 10) + "</title></head><body>", 0)]
        pieces += [(around(), 0) for _ in range(rng.randint(0, 4))] + [(content(), 1)] + [(around(), 0) for _ in range(rng.randint(0, 4))]
        found.append(labelled("".join(p for p, _ in pieces)))
    return found


_OUTSIDE = frozenset(a.split(" ")[0] for a in AROUND if " " not in a)
_OUTSIDE_NAMES = frozenset(n for a in AROUND for n in _NAME_WORDS.findall(" ".join(x for m in _NAMES.findall(a) for x in m)))
_INSIDE = frozenset(("article", "main"))
_INSIDE_NAMES = frozenset(("content", "post", "story", "entry", "body"))


def labelled(page: str) -> tuple[list[Block], list[int]]:
    """Blocks of a page with the labels that its own markup gives: inside the article, and in nothing that is set apart."""
    blocks = leaf_blocks(page)

    def is_content(path: tuple[str, ...]) -> int:
        inside = False
        for element in path:
            tag, *names = element.split(" ")
            if tag in _OUTSIDE or _OUTSIDE_NAMES.intersection(names):
                return 0
            inside = inside or tag in _INSIDE or bool(_INSIDE_NAMES.intersection(names)) or "text" in names
        return int(inside)

    return blocks, [is_content(b.path) for b in blocks]


def fit_extractor(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", layouts: int = 600, max_pages: int = 200, seed: int = 3) -> ChainModel:
    """Learn from ``layouts`` written pages and about ``max_pages`` pages of the table that mark their article.

    The pages are chosen by a hash of their id; ``max_pages`` bounds what the
    driver gets. Pages of one site look alike, so together they count for a
    fifth of the layouts at most: what they never show must not be forgotten.
    """
    marked = pages.where(F.col(html_col).contains("<article") & F.col(html_col).contains("</article>"))
    share = max_pages / max(marked.count(), 1)
    chosen = marked.where(hash_unit(seed, id_col) < share).select(F.col(id_col).cast("string").alias("id"), F.col(html_col).alias("html"))
    examples = [labelled(r["html"]) for r in sorted(chosen.collect(), key=lambda r: (r["id"] or "", r["html"]))]
    each = min(1.0, layouts / 5 / max(1, len(examples)))
    return fit_chain(labelled_layouts(layouts, seed) + examples, [1.0] * layouts + [each] * len(examples))


def extract_text(pages: DataFrame, model: ChainModel, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; input columns of these names are replaced.

    The blocks labelled as content, whole and in page order, joined by a line
    feed. Null and empty pages, and pages without content, give an empty text.
    Each page is a row of its own whatever its size or the number of its copies.
    """
    pages = pages.select(*without(pages, ["text", "n_chars"]))
    at = pages.columns.index(html_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model.decoder()
        for batch in batches:
            texts = []
            for page in batch.column(at).to_pylist():
                blocks = leaf_blocks(page)
                texts.append("\n".join(b.text for b, y in zip(blocks, decode(blocks), strict=True) if y))
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), counts], names=[*batch.schema.names, "text", "n_chars"])

    schema = pages.select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.mapInArrow(extract, schema)
