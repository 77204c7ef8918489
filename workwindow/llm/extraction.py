"""Main text of HTML pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with the
path of tags above it. Script, style and similar elements, comments and declarations
hold no text. A block is described by hashed tokens of its tag path (tags, class and id
words), hashed words and a few numbers; a bidirectional LSTM in numpy reads all blocks
of a page in order and classifies each as main text or not, so every decision sees the
whole page. Character references are decoded, white space inside a block becomes one
space, and main blocks are joined by line breaks in page order.

Training: at most ``SAMPLE`` whole pages, chosen by a
hash of the url, reach the driver. Pages whose tags name their parts give blocks with
labels; around their texts layouts are also drawn at random (menus, headers, adverts,
notices, sidebars, forms, comments, footers, with usual or meaningless names), labelled
as built. The weights are a few hundred KB, whatever the input is.

Defined results: a null, empty or tag-only page gives an empty text; pages of any length
are read whole; repeated rows stay; an empty table gives an empty result; only page_id,
url and html are read.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workwindow.llm.common import parts_of, word_hashes

SAMPLE, LAYOUTS = 150, 450
PATH_DIM, WORD_DIM, N_NUMBERS = 192, 48, 8
DIM = PATH_DIM + WORD_DIM + N_NUMBERS
HIDDEN = 16
EPOCHS, BATCH, RATE = 12, 24, 0.01
#: Blocks that go through the network at once.
AT_ONCE = 20_000

# Elements of HTML.
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "label legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td textarea tfoot th thead title tr ul".split()
)
_VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CLOSES_P = _BLOCK_TAGS - frozenset("body button html label legend option select title".split())
_SAME_LEVEL = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "body": ("head",),
}
_SCOPES = frozenset("ul ol dl table select menu".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<svg(?=[\s/>])(?:[^'\">]|\"[^\"]*\"|'[^']*')*/>"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|canvas)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^'\">]|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z][^<>]*(?:>|\Z)",
    re.I | re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Words in tags, classes and ids that say what a part of a page is.
OTHER_NAMES = frozenset(
    "nav menu navbar header masthead topbar banner breadcrumb breadcrumbs footer aside sidebar "
    "related widget ad ads advert advertisement sponsored promo notice cookie consent alert popup "
    "modal form search login subscribe newsletter comment comments commentlist reply respond share "
    "social title head copyright legal toolbar pagination".split()
)


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    link_chars: int


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order, with references decoded and white space made single."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    link_chars = in_link = at = 0

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1][1] if stack else (), text, link_chars))
            parts.clear()
            link_chars = 0

    def close(tag: str, scopes: frozenset = frozenset()) -> None:
        nonlocal in_link
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                if tag in _BLOCK_TAGS:
                    flush()
                for name, _ in stack[i:]:
                    in_link -= name == "a"
                del stack[i:]
                return
            if stack[i][0] in scopes:
                return

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if in_link > 0:
                link_chars += len(piece)
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            close(tag)
            continue
        if tag in _CLOSES_P:
            close("p", _SCOPES)
        for sibling in _SAME_LEVEL.get(tag, ()):
            close(sibling, _SCOPES)
        if tag in _BLOCK_TAGS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if tag in _VOID_TAGS or m["attrs"].endswith("/"):
            continue
        above = stack[-1][1] if stack else ()
        if tag in _BLOCK_TAGS:
            above = (*above, _described(tag, m["attrs"]))
        in_link += tag == "a"
        stack.append((tag, above))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def _described(tag: str, attrs: str) -> str:
    """A tag with the words of its class, id and role."""
    if "=" not in attrs:
        return tag
    words = [w.lower() for m in _NAMES.findall(attrs) for w in _NAME_WORDS.findall("".join(m))]
    return " ".join([tag, *words])


_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    found = _paths.get(path)
    if found is None:
        if len(_paths) > 20_000:
            _paths.clear()
        found = np.zeros(PATH_DIM, np.float32)
        for level in path:
            for word in level.split():
                found[zlib.crc32(word.encode()) % (PATH_DIM - 32)] = 1
        for level in path[-2:]:
            found[PATH_DIM - 32 + zlib.crc32(level.split()[0].encode()) % 32] += 0.5
        _paths[path] = found
    return found


def vectors(blocks: list[Block], bounds: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """One row per block; ``bounds``: where each page's blocks start, and the end. ``place``:
    how far down its page each block is, told by ``bounds`` if not given."""
    n = len(blocks)
    x = np.zeros((n, DIM), np.float32)
    for i, block in enumerate(blocks):
        x[i, :PATH_DIM] = _path_vector(block.path)
    raw = [b.text.encode() for b in blocks]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    hashes, first = word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)
    bucket = (hashes % np.uint64(WORD_DIM)).astype(np.int64)
    counts = np.bincount(owner * WORD_DIM + bucket, minlength=n * WORD_DIM).reshape(n, WORD_DIM)
    x[:, PATH_DIM : PATH_DIM + WORD_DIM] = 0.5 * np.sqrt(counts / np.maximum(n_words, 1)[:, None])
    chars = np.maximum(np.array([len(b.text) for b in blocks]), 1)
    if place is None:
        place = np.concatenate([np.linspace(0, 1, k) if k else [] for k in np.diff(bounds)]) if n else []
    last = np.array([r[-1] if r else 0 for r in raw], np.uint8)
    numbers = [
        np.log1p(n_words) / 5,
        n_words < 4,
        np.minimum(np.array([b.link_chars for b in blocks]) / chars, 1),
        np.isin(last, list(b'.!?"')),
        chars / np.maximum(n_words, 1) / 10,
        place,
        np.log1p(np.array([len(b.path) for b in blocks])) / 3,
        np.ones(n),
    ]
    for k, column in enumerate(numbers):
        x[:, PATH_DIM + WORD_DIM + k] = column
    return x


class Network:
    """Two LSTMs, one a direction, and a linear read-out that also sees the block itself."""

    SHAPES = {
        "wx": (2, DIM, 4 * HIDDEN), "wh": (2, HIDDEN, 4 * HIDDEN), "b": (2, 4 * HIDDEN),
        "out": (2, HIDDEN), "skip": (DIM,),
    }

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def start(cls, seed: int = 3) -> Network:
        draw = np.random.Generator(np.random.PCG64(seed))
        w = {k: draw.normal(0, 0.1, s).astype(np.float32) for k, s in cls.SHAPES.items()}
        w["b"][:, HIDDEN : 2 * HIDDEN] = 1  # remember at first
        w["skip"][:] = 0
        return cls(w)

    @staticmethod
    def _order(lengths: np.ndarray) -> np.ndarray:
        """Index that reverses each padded row within its length, and undoes it."""
        steps = np.arange(lengths.max())
        return np.where(steps < lengths[:, None], lengths[:, None] - 1 - steps, steps)

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Scores of a padded batch (pages, blocks, DIM)."""
        n, longest, _ = x.shape
        back = self._order(lengths)
        score = x @ self.w["skip"]
        memory = []
        for d in (0, 1):
            xd = x if d == 0 else np.take_along_axis(x, back[..., None], 1)
            z = xd @ self.w["wx"][d] + self.w["b"][d]
            h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            hs, trace = np.empty((n, longest, HIDDEN), np.float32), []
            for t in range(longest):
                a = z[:, t] + h @ self.w["wh"][d]
                gates = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
                i, f, o = np.split(gates, 3, 1)
                g = np.tanh(a[:, 3 * HIDDEN :])
                before = c
                c = f * c + i * g
                tc = np.tanh(c)
                if keep:
                    trace.append((i, f, o, g, before, tc, h))
                h = o * tc
                hs[:, t] = h
            if d == 1:
                hs = np.take_along_axis(hs, back[..., None], 1)
            score = score + hs @ self.w["out"][d]
            memory.append((xd, hs, trace))
        return (score, memory, back) if keep else score

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        score, memory, back = self.forward(x, lengths, keep=True)
        mask = np.arange(x.shape[1]) < lengths[:, None]
        ds = ((1 / (1 + np.exp(-score)) - y) * mask / mask.sum()).astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["skip"] = np.einsum("nt,ntd->d", ds, x)
        for d, (xd, hs, trace) in enumerate(memory):
            grad["out"][d] = np.einsum("nt,nth->h", ds, hs)
            dsd = ds if d == 0 else np.take_along_axis(ds, back, 1)
            dh, dc = np.zeros_like(trace[0][0]), np.zeros_like(trace[0][0])
            da = np.empty((*xd.shape[:2], 4 * HIDDEN), np.float32)
            for t in range(xd.shape[1] - 1, -1, -1):
                i, f, o, g, before, tc, h = trace[t]
                dh = dh + dsd[:, t, None] * self.w["out"][d]
                dc = dc + dh * o * (1 - tc * tc)
                da[:, t] = np.concatenate(
                    (dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), 1
                )
                grad["wh"][d] += h.T @ da[:, t]
                dh, dc = da[:, t] @ self.w["wh"][d].T, dc * f
            grad["wx"][d] = np.tensordot(xd, da, ((0, 1), (0, 1)))
            grad["b"][d] = da.sum((0, 1))
        return grad

    def label(self, blocks: list[Block], bounds: np.ndarray, at_once: int = AT_ONCE) -> np.ndarray:
        """Main text or not, for every block of the pages between ``bounds``. Pages of
        like length go through together, a page of more than ``at_once`` blocks in parts."""
        main = np.zeros(len(blocks), bool)
        lengths = np.diff(bounds)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * lengths[order[stop]] <= at_once:
                stop += 1
            pages = order[at:stop]
            spans = [(int(bounds[p]), int(bounds[p + 1])) for p in pages]
            if lengths[pages[-1]] > at_once:
                for a, b in spans:
                    main[a:b] = self.long_page(blocks[a:b], at_once) > 0
            else:
                ends = np.append(0, np.cumsum(lengths[pages]))
                x = vectors([block for a, b in spans for block in blocks[a:b]], ends)
                padded = np.zeros((len(pages), lengths[pages[-1]], DIM), np.float32)
                for k in range(len(pages)):
                    padded[k, : lengths[pages[k]]] = x[ends[k] : ends[k + 1]]
                score = self.forward(padded, lengths[pages])
                for k, (a, b) in enumerate(spans):
                    main[a:b] = score[k, : b - a] > 0
            at = stop
        return main

    def long_page(self, blocks: list[Block], at_once: int) -> np.ndarray:
        """Scores of one page's blocks. Each direction goes through the page in parts and hands
        its state from part to part, so only one part has vectors at a time."""
        n = len(blocks)
        score = np.zeros(n, np.float32)
        parts = [(a, min(a + at_once, n)) for a in range(0, n, at_once)]
        for d in (0, 1):
            h = c = np.zeros(HIDDEN, np.float32)
            for a, b in parts if d == 0 else reversed(parts):
                x = vectors(blocks[a:b], np.array([0, b - a]), np.arange(a, b) / max(n - 1, 1))
                if d == 0:
                    score[a:b] += x @ self.w["skip"]
                z = x @ self.w["wx"][d] + self.w["b"][d]
                steps = range(b - a) if d == 0 else reversed(range(b - a))
                for t in steps:
                    gates = z[t] + h @ self.w["wh"][d]
                    i, f, o = np.split(1 / (1 + np.exp(-gates[: 3 * HIDDEN])), 3)
                    c = f * c + i * np.tanh(gates[3 * HIDDEN :])
                    h = o * np.tanh(c)
                    score[a + t] += h @ self.w["out"][d]
        return score


def named_labels(blocks: list[Block]) -> list[bool] | None:
    """Labels where tags and names say what the parts are; None if none says main."""
    labels, sure = [], False
    for block in blocks:
        names = [set(level.split()) for level in block.path]
        main = any(level.split()[0] in ("article", "main") for level in block.path)
        sure |= main
        labels.append(main and not any(n & OTHER_NAMES for n in names))
    return labels if sure else None


_PARTS = {
    "header": (["header", "div"], ["header", "masthead", "topbar", "site-header", "banner"]),
    "menu": (["nav", "div", "ul"], ["nav", "menu", "navbar", "main-nav", "breadcrumb", "toolbar"]),
    "ad": (["div", "aside", "section"], ["ad", "ads", "advert", "sponsored", "promo", "banner-ad"]),
    "notice": (["div", "section"], ["notice", "cookie", "consent", "alert", "popup", "newsletter"]),
    "sidebar": (["aside", "div"], ["sidebar", "related", "widget", "side-col"]),
    "form": (["form"], ["search", "login", "subscribe", "contact", "form"]),
    "comments": (["section", "div", "ol"], ["comments", "comment-list", "responses", "discussion", "replies"]),
    "footer": (["footer", "div"], ["footer", "site-footer", "copyright", "legal"]),
    "share": (["div", "ul"], ["share", "social", "tags", "pagination"]),
}
_MAIN = (["article", "main", "div", "section"], ["content", "post", "entry", "story", "article-body", "main-text", ""])


def draw_layout(texts: list[str], dice: random.Random) -> tuple[list[Block], list[bool]]:
    """A page of random layout around given texts: its blocks and their labels."""

    def words(low: int, high: int) -> str:
        got = dice.choice(texts).split()
        n = dice.randint(low, high)
        start = dice.randrange(max(1, len(got) - n))
        if dice.random() < 0.06:  # one word again and again is a text like any other
            return " ".join(got[:1] * n) or "x"
        return " ".join(got[start : start + n]) or "x"

    def opened(kinds: list[str], names: list[str]) -> str:
        tag = dice.choice(kinds)
        # a tag that says nothing needs a name that does, or is left to context at times
        name = dice.choice(names) if dice.random() < (0.9 if tag in ("div", "section", "ul", "ol") else 0.5) else ""
        return f"{tag} {' '.join(_NAME_WORDS.findall(name))}".strip()

    page: list[tuple[Block, bool]] = []

    def add(path: tuple, text: str, main: bool, link: bool = False) -> None:
        page.append((Block(path, text, len(text) if link else 0), main))

    def other(kind: str, above: tuple) -> None:
        here = (*above, opened(*_PARTS[kind]))
        if kind in ("menu", "share", "sidebar") and dice.random() < 0.7 or kind == "menu":
            here = (*here, "ul") if dice.random() < 0.8 else here
            for _ in range(dice.randint(2, 9)):
                add((*here, dice.choice(["li", "div"])), words(1, 4), False, dice.random() < 0.9)
        elif kind == "form":
            for _ in range(dice.randint(1, 4)):
                add((*here, dice.choice(["label", "button", "option", "div", "p"])), words(1, 5), False)
        elif kind == "comments":
            for _ in range(dice.randint(1, 6)):
                inner = (*here, dice.choice(["li comment", "div comment", "div", "article comment"]))
                if dice.random() < 0.5:
                    add((*inner, "div author"), words(1, 3), False)
                add((*inner, "p") if dice.random() < 0.7 else inner, words(3, 60), False)
        else:
            for _ in range(dice.randint(1, 2)):
                add((*here, "p") if dice.random() < 0.4 else here, words(2, 25), False, dice.random() < 0.2)

    body = ("html", "body")
    if dice.random() < 0.9:
        add(("html", "head", "title"), words(3, 10), False)
    if dice.random() < 0.4:
        body = (*body, dice.choice(["div", "div wrapper", "div page", "div container"]))
    for kind in ("notice", "header", "menu", "ad", "form"):
        if dice.random() < 0.45:
            other(kind, body)
    if dice.random() < 0.3:
        other("sidebar", body)
    main = (*body, opened(*_MAIN)) if dice.random() < 0.95 else body
    if dice.random() < 0.4:
        main = (*main, dice.choice(["div", "section", "div text", "div body", "article", "div content"]))
    if dice.random() < 0.7:
        add((*main, dice.choice(["h1", "header", "h2"])) if dice.random() < 0.9 else (*main, "div headline"), words(3, 10), True)
    for _ in range(dice.randint(1, 12)):
        roll = dice.random()
        if roll < 0.06:
            other(dice.choice(["ad", "share", "notice", "sidebar", "form"]), main)
        elif roll < 0.14:
            add((*main, dice.choice(["h2", "h3", "h4"])), words(1, 8), True)
        elif roll < 0.2:
            for _ in range(dice.randint(2, 4)):
                add((*main, "ul", "li"), words(2, 30), True)
        elif roll < 0.24:
            add((*main, dice.choice(["blockquote", "pre", "figcaption", "td"])), words(3, 60), True)
        else:
            add((*main, "p") if dice.random() < 0.9 else main, words(1, 120), True)
    for kind in ("share", "comments", "sidebar", "ad", "form", "menu", "footer"):
        if dice.random() < 0.4:
            other(kind, main if kind in ("comments", "share") and dice.random() < 0.3 else body)
    return [b for b, _ in page], [m for _, m in page]


def fit(pages: list[str], seed: int = 7) -> Network:
    """Train on sampled pages and layouts drawn around their texts."""
    dice = random.Random(seed)
    examples, texts = [], []
    for page in pages:
        blocks = blocks_of(page)
        texts.extend(b.text for b in blocks if len(b.text) > 20)
        labels = named_labels(blocks)
        if labels:
            examples.append((blocks, labels))
    texts = texts or ["A plain sentence, to begin with.", "Some more words follow here."]
    examples += [draw_layout(texts, dice) for _ in range(LAYOUTS)]
    data = [(vectors(b, np.array([0, len(b)])), np.array(y, np.float32)) for b, y in examples if b]
    network = Network.start()
    m = {k: np.zeros_like(v) for k, v in network.w.items()}
    v = {k: np.zeros_like(w) for k, w in network.w.items()}
    t = 0
    for _ in range(EPOCHS):
        # like lengths together, batches in random order
        order = sorted(range(len(data)), key=lambda i: (len(data[i][1]) + dice.random() * 4))
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        dice.shuffle(batches)
        for batch in batches:
            lengths = np.array([len(data[i][1]) for i in batch])
            x = np.zeros((len(batch), lengths.max(), DIM), np.float32)
            y = np.zeros(x.shape[:2], np.float32)
            for k, i in enumerate(batch):
                x[k, : lengths[k]], y[k, : lengths[k]] = data[i]
            t += 1
            for k, g in network.gradients(x, lengths, y).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                step = m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
                network.w[k] = (network.w[k] - RATE * step).astype(np.float32)
    return network


def train(pages: DataFrame, sample: int = SAMPLE) -> Network:
    """Fit on a bounded sample of ``pages``."""
    key = F.xxhash64("url", "page_id")
    there = pages.filter("html IS NOT NULL")
    keys = [r.k for r in there.select(key.alias("k")).distinct().orderBy("k").limit(sample).collect()]
    # keys first: else every task would send as many pages to the driver
    chosen = (
        there.filter(key.isin(keys))
        .groupBy(key.alias("k"))
        .agg(F.min("html").alias("html"))
    )
    return fit([r.html for r in sorted(chosen.collect(), key=lambda r: r.k)])


def extract(pages: DataFrame, network: Network) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""

    def main_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, "html"):
            found = [blocks_of(h or "") for h in part.column("html").to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(b) for b in found])))
            blocks = [b for page in found for b in page]
            main = network.label(blocks, bounds) if blocks else []
            texts = [
                "\n".join(b.text for b, yes in zip(blocks[i:j], main[i:j]) if yes)
                for i, j in zip(bounds.tolist(), bounds[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return pages.select("page_id", "url", "html").mapInArrow(
        main_text, ", ".join([*kinds, "text string", "n_chars bigint"])
    )
