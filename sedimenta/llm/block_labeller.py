"""Main text of web pages by a recurrent labeller of blocks.

A page is a sequence of leaf blocks (``html_blocks``). A block is read as all
hashed names on its path, its hashed words and a few lengths; a bidirectional
LSTM, in numpy, carries what stands before and after through the whole page
and calls every block text or not. Pages of a task take each step together.

No page comes with labels, so the network learns from what pages say of
themselves: blocks in ``article`` or ``main`` that are in no part named otherwise are
text. It learns from ``rows`` pages of the table, those whose ids have the smallest hashes,
and from two copies of each laid out anew, with other elements, names and kinds of
surroundings, half of them with many elements in between, and with some names left out, so that it has to use words, lengths and context too.

Defined results: a null, empty or blank page has an empty text. Equal pages have equal texts, ids may be null or
repeated. An empty table gives no rows. Pages of any length are read whole: blocks are read ``BLOCKS_AT_ONCE``, and
what stands before and after is carried on. A page over ``STRETCH`` blocks is learned from in stretches. If no page of the sample
says where its text is, the copies laid out anew are all that is learned from; without any page, every block is text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import least_hashed, text_blocks, within_bytes, words_of
from sedimenta.llm.html_blocks import Leaf, Path, leaves

TRAINING_ROWS, TRAINING_BYTES = 400, 64 << 20
PATH, WORDS, NUMBERS, HIDDEN = 48, 16, 8, 24
INPUTS = PATH + WORDS + NUMBERS
EPOCHS, PAGES_A_STEP = 14, 32
NAMES_AT_FULL = 12
# Blocks read together, and blocks of a page learned from in one stretch.
BLOCKS_AT_ONCE, STRETCH = 1 << 14, 1 << 11
# Names of page parts that are no text, and words that stand in them.
TEXT_PARTS = frozenset("article main".split())
OTHER_PARTS = frozenset(
    "nav footer aside form menu navbar sidebar ad ads advert advertisement banner promo sponsored comment comments "
    "respond reply replies notice cookie consent popup modal newsletter subscribe share social related recommended "
    "breadcrumb breadcrumbs pagination widget toolbar masthead copyright legal login search tags".split())
SURROUNDINGS = {
    "nav": ("nav", ("menu", "navbar", "topnav", "navigation"), "Home About Contact News Products Blog Archive Help".split()),
    "header": ("header", ("masthead", "site-header", "top", "logo"), "Welcome to our daily site of the year".split()),
    "aside": ("aside", ("sidebar", "widget", "related", "rail"), "Related Popular Recent posts Read more Trending".split()),
    "notice": ("div", ("notice", "cookie", "consent", "alert"), "We use cookies Accept all Privacy policy".split()),
    "ad": ("div", ("ad", "ads", "advert", "banner", "promo", "sponsored"), "Buy now Sale offer Sponsored Save".split()),
    "form": ("form", ("newsletter", "subscribe", "login", "search"), "Email Name Send Subscribe Search Password".split()),
    "comments": ("section", ("comments", "comment-list", "replies", "respond"), "says Reply ago Great post wrote".split()),
    "footer": ("footer", ("footer", "site-footer", "legal", "copyright"), "All rights reserved Terms Imprint".split()),
}
INNER = ((), (), ("p",), ("p",), ("div",), ("h3",), ("h4",), ("span",), ("div", "p"))
# Names of elements that only lay a page out.
WRAPPERS = ".container .row .col .md .inner .wrap .box .item .list .block .grid .cell .content .text .unstyled ul li".split()
HOLDERS = (("article", ""), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "post entry"),
           ("section", "story"), ("div", "main"), ("div", ""), ("td", "text"))


@lru_cache(maxsize=1 << 16)
def _bucket(token: str, size: int) -> tuple[int, float]:
    code = zlib.crc32(token.encode())
    return code % size, 1.0 if code >> 31 else -1.0


def _add_name(vector: np.ndarray, token: str, weight: float) -> None:
    # Two places for a name, so that two names seldom look the same.
    for salt in "ab":
        at, sign = _bucket(salt + token, PATH)
        vector[at] += sign * weight


def path_vector(path: tuple[str, ...] | Path, known: dict) -> np.ndarray:
    """All names of a path, the outermost too; those of a path of more than ``NAMES_AT_FULL`` weigh less each.

    A name weighs the root of its count. A ``Path`` takes over the vector of the path around it and adds what its own names change.
    """
    if isinstance(path, Path):
        fresh = []
        for here in path.up():
            if here in known:
                break
            fresh.append(here)
        for here in reversed(fresh):
            vector = known[here.parent][0].copy() if here.parent else np.zeros(PATH)
            for token, count in zip(here.names, here.counts, strict=True):
                _add_name(vector, token, count**0.5 - (count - 1)**0.5)
            known[here] = vector, _scaled(vector, here.distinct)
    elif path not in known:
        vector, counts = np.zeros(PATH), Counter(path)
        for token, count in counts.items():
            _add_name(vector, token, count**0.5)
        known[path] = vector, _scaled(vector, len(counts))
    return known[path][1]


def _scaled(vector: np.ndarray, distinct: int) -> np.ndarray:
    return vector if distinct <= NAMES_AT_FULL else vector * np.sqrt(NAMES_AT_FULL / distinct)


def block_inputs(pages: list[list[Leaf]], before: int = 0, of_blocks: int | None = None, known: dict | None = None) -> np.ndarray:
    """One row for every block of the pages, in order; of a stretch of a page with ``before`` blocks before it.

    ``known`` keeps the vectors of paths for the next stretch of the same page.
    """
    blocks = [leaf for page in pages for leaf in page]
    out = np.zeros((len(blocks), INPUTS))
    if not blocks:
        return out
    known = {} if known is None else known
    out[:, :PATH] = [path_vector(leaf.path, known) for leaf in blocks]
    codes, words, offsets = words_of(pa.array([leaf.text for leaf in blocks], pa.large_string()))
    places = [_bucket("w" + w.lower(), WORDS) for w in words.to_pylist()]
    at = np.array([p for p, _ in places])[codes]
    sign = np.array([s for _, s in places])[codes]
    count = np.diff(offsets).astype(float)
    row = np.repeat(np.arange(len(blocks)), np.diff(offsets))
    hashed = np.bincount(row * WORDS + at, sign, len(blocks) * WORDS).reshape(-1, WORDS)
    out[:, PATH:PATH + WORDS] = np.clip(hashed / np.sqrt(count)[:, None], -1, 1) / 2
    length = np.array([len(leaf.text) for leaf in blocks], float)
    linked = np.array([leaf.linked for leaf in blocks], float)
    sizes = np.array([len(page) for page in pages])
    place = before + np.arange(len(blocks)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    of = np.repeat(np.maximum(of_blocks or sizes, 1), sizes)
    stops = np.array([leaf.text.count(".") + leaf.text.count(",") for leaf in blocks], float)
    out[:, PATH + WORDS:] = np.column_stack([
        np.log1p(length) / 4, np.log1p(count) / 3, linked / length, stops / count, place / of,
        [leaf.text[-1:] in ".!?" for leaf in blocks], np.log1p(np.array([len(leaf.path) for leaf in blocks])) / 2,
        np.ones(len(blocks))])
    return out


@dataclass
class Labeller:
    """Weights of the two directions (inputs, state, and their gates side by side) and of the label."""

    inputs: np.ndarray  # (2, INPUTS, 4 * HIDDEN)
    states: np.ndarray  # (2, HIDDEN, 4 * HIDDEN)
    label: np.ndarray  # (2 * HIDDEN + 1,)

    @staticmethod
    def start(seed: int = 7) -> Labeller:
        draw = np.random.default_rng(seed)
        inputs = draw.normal(0, 1 / np.sqrt(INPUTS), (2, INPUTS, 4 * HIDDEN))
        inputs[:, -1, HIDDEN:2 * HIDDEN] = 1.0  # gates that keep the state are open at first
        return Labeller(inputs, draw.normal(0, 1 / np.sqrt(HIDDEN), (2, HIDDEN, 4 * HIDDEN)),
                        draw.normal(0, 0.1, 2 * HIDDEN + 1))

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.label]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Run:
    """A forward pass over pages laid side by side: step t is the t-th block of every page that has one."""

    def __init__(self, model: Labeller, x: np.ndarray, sizes: np.ndarray):
        self.model, self.x, self.sizes = model, x, sizes
        pages, steps = len(sizes), int(sizes.max(initial=0))
        starts = np.cumsum(sizes) - sizes
        t = np.arange(steps)
        self.steps = steps
        # Numbers of the blocks by step, forwards and backwards, and which pages still have one.
        self.at = np.stack([starts[None] + t[:, None], (starts + sizes - 1)[None] - t[:, None]])
        self.live = t[:, None] < sizes[None]
        self.gates = np.zeros((2, steps, pages, 4 * HIDDEN))
        self.cells = np.zeros((2, steps + 1, pages, HIDDEN))
        self.hidden = np.zeros((2, steps + 1, pages, HIDDEN))
        self.out = np.zeros((len(x), 2 * HIDDEN + 1))
        self.out[:, -1] = 1
        for way in range(2):
            fed = x @ model.inputs[way]
            for s in range(steps):
                live = np.flatnonzero(self.live[s])
                block = self.at[way, s, live]
                z = fed[block] + self.hidden[way, s, live] @ model.states[way]
                g = np.hstack([_sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])])
                i, f, o, c = np.split(g, 4, axis=1)
                cell = f * self.cells[way, s, live] + i * c
                state = o * np.tanh(cell)
                self.gates[way, s, live], self.cells[way, s + 1, live], self.hidden[way, s + 1, live] = g, cell, state
                self.out[block, way * HIDDEN:(way + 1) * HIDDEN] = state
        self.probability = _sigmoid(self.out @ model.label)

    def gradients(self, truth: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        model = self.model
        error = (self.probability - truth) * weight
        d_label = self.out.T @ error
        d_out = error[:, None] * model.label[None]
        d_inputs, d_states = np.zeros_like(model.inputs), np.zeros_like(model.states)
        for way in range(2):
            pages = len(self.sizes)
            d_h, d_c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
            d_z_all = np.zeros((len(self.x), 4 * HIDDEN))
            for s in range(self.steps - 1, -1, -1):
                live = np.flatnonzero(self.live[s])
                block = self.at[way, s, live]
                i, f, o, c = np.split(self.gates[way, s, live], 4, axis=1)
                cell = np.tanh(self.cells[way, s + 1, live])
                back = d_h[live] + d_out[block, way * HIDDEN:(way + 1) * HIDDEN]
                d_cell = d_c[live] + back * o * (1 - cell**2)
                d_z = np.hstack([d_cell * c * i * (1 - i), d_cell * self.cells[way, s, live] * f * (1 - f),
                                 back * cell * o * (1 - o), d_cell * i * (1 - c**2)])
                d_z_all[block] = d_z
                d_states[way] += self.hidden[way, s, live].T @ d_z
                d_h[live], d_c[live] = d_z @ model.states[way].T, d_cell * f
            d_inputs[way] = self.x.T @ d_z_all
        return [d_inputs, d_states, d_label]


def _steps(model: Labeller, fed: np.ndarray, at: np.ndarray, first: np.ndarray, hidden: np.ndarray, cells: np.ndarray,
           logits: np.ndarray) -> None:
    """Take the steps ``at`` (way, step, page) over what is fed in, for the pages from ``first`` of each step on.

    Changes the states and fills what each way adds to the label of a block; no step is kept.
    """
    # With half of its input, a tanh is a sigmoid: one call gives all gates.
    states, label = model.states.copy(), model.label[:-1].reshape(2, 1, HIDDEN)
    states[:, :, :3 * HIDDEN] /= 2
    ways = np.arange(2)[:, None]
    for s, begin in enumerate(first.tolist()):
        block = at[:, s, begin:]
        g = np.tanh(fed[ways, block] + hidden[:, begin:] @ states)
        i, f, o = ((g[:, :, k * HIDDEN:(k + 1) * HIDDEN] + 1) / 2 for k in range(3))
        cell = f * cells[:, begin:] + i * g[:, :, 3 * HIDDEN:]
        state = o * np.tanh(cell)
        cells[:, begin:], hidden[:, begin:] = cell, state
        logits[ways, block] = (state * label).sum(2)


def _fed(model: Labeller, x: np.ndarray, way: int) -> np.ndarray:
    fed = x @ model.inputs[way]
    fed[:, :3 * HIDDEN] /= 2
    return fed


def probabilities(model: Labeller, pages: list[list[Leaf]], most: int | None = None) -> np.ndarray:
    """The probability of every block of pages in order of length to be text, as ``Run`` has it.

    Only the states of the step at hand are held. One page of more than ``most`` blocks is read in stretches, from
    both ends at a time.
    """
    most = most or BLOCKS_AT_ONCE
    sizes = np.array([len(p) for p in pages], int)
    total = int(sizes.sum())
    logits = np.zeros((2, total))
    hidden, cells = np.zeros((2, 2, len(pages), HIDDEN))
    if len(pages) == 1 and total > most:
        known: dict = {}
        for begin in range(0, total, most):
            end = min(begin + most, total)
            fed = np.stack([_fed(model, block_inputs([pages[0][a:b]], a, total, known), way)
                            for way, (a, b) in enumerate([(begin, end), (total - end, total - begin)])])
            t = np.arange(end - begin)
            part = np.zeros((2, end - begin))
            _steps(model, fed, np.stack([t, t[::-1]])[:, :, None], np.zeros_like(t), hidden, cells, part)
            logits[0, begin:end], logits[1, total - end:total - begin] = part
    elif total:
        x = block_inputs(pages)
        starts, t = np.cumsum(sizes) - sizes, np.arange(sizes[-1])
        at = np.stack([starts[None] + t[:, None], (starts + sizes - 1)[None] - t[:, None]])
        _steps(model, np.stack([_fed(model, x, way) for way in range(2)]), at,
               np.searchsorted(sizes, t, side="right"), hidden, cells, logits)
    return _sigmoid(logits.sum(0) + model.label[-1])


def own_labels(page: list[Leaf]) -> np.ndarray | None:
    """What a page says of its blocks; None if it has no part for its text."""
    marked: dict = {}
    said = [_parts(leaf.path, marked) for leaf in page]
    if not any(text for text, _ in said):
        return None
    return np.array([text and not other for text, other in said], float)


def _parts(path: tuple[str, ...] | Path, marked: dict) -> tuple[bool, bool]:
    """Whether a part of text and whether another part is named on a path."""
    fresh = []
    for here in path.up() if isinstance(path, Path) else (path,):
        if here in marked:
            break
        fresh.append(here)
    for here in reversed(fresh):
        own = {t.lstrip(".") for t in (here.names if isinstance(here, Path) else here)}
        text, other = marked[here.parent] if isinstance(here, Path) and here.parent else (False, False)
        marked[here] = text or bool(own & TEXT_PARTS), other or bool(own & OTHER_PARTS)
    return marked[path]


def laid_out_anew(page: list[Leaf], labels: np.ndarray, draw: np.random.Generator) -> tuple[list[Leaf], np.ndarray]:
    """The text of a page in another layout, with surroundings made of other words; as blocks and labels."""
    texts = [leaf.text for leaf, y in zip(page, labels, strict=True) if y]
    vocabulary = " ".join(leaf.text for leaf in page).split()
    tag, names = HOLDERS[draw.integers(len(HOLDERS))]
    base = ("html", "body", *(("div", f".{draw.choice(['page', 'wrapper', 'container', 'layout'])}") if draw.random() < 0.6 else ()))
    holder = (*base, tag, *(f".{n}" for n in names.replace("-", " ").split()))
    deep = draw.random() < 0.5

    def wrappers() -> tuple[str, ...]:
        """Elements between a part and its blocks that say nothing, on the copies that are deep."""
        if not deep:
            return ()
        return tuple(n for _ in range(int(draw.integers(0, 8)))
                     for n in ("div", *draw.choice(WRAPPERS, int(draw.integers(0, 4))).tolist()))

    def around(kind: str, inside: tuple[str, ...]) -> list[Leaf]:
        element, classes, words = SURROUNDINGS[kind]
        named = draw.random() < 0.75
        plain = draw.random() < 0.4
        outer = (*inside, "div" if plain and named else element,
                 *(f".{w}" for w in (str(draw.choice(classes)).replace("-", " ").split() if named else ())), *wrappers())
        made = []
        for _ in range(int(draw.integers(1, 9 if kind in ("nav", "comments") else 5))):
            own = list(draw.choice(words, min(len(words), int(draw.integers(1, 5)))))
            size = int(draw.integers(3, 40 if kind in ("comments", "ad", "aside") else 9))
            mixed = own if draw.random() < 0.3 or not vocabulary else own + list(draw.choice(vocabulary, size))
            text = " ".join(mixed)
            child = ("ul", "li") if kind == "nav" or draw.random() < 0.3 else INNER[draw.integers(len(INNER))]
            made.append(Leaf((*outer, *child), text, len(text) if kind == "nav" or draw.random() < 0.3 else 0))
        return made

    pick = {k: draw.random() < 0.55 for k in SURROUNDINGS}
    before = [b for k in ("notice", "header", "nav", "ad") if pick[k] for b in around(k, base)]
    if pick["aside"] and draw.random() < 0.5:
        before += around("aside", base)
    inner = [("h1", "h2", "h3", "p")[draw.integers(4)] if n == 0 or draw.random() < 0.05 else "p" if draw.random() < 0.8
             else str(draw.choice(["div", "blockquote", "li", "pre", "td", "section", "dd", "figcaption"]))
             for n in range(len(texts))]
    between = wrappers()
    body = [(Leaf((*holder, *between, tag), t, 0), 1.0) for tag, t in zip(inner, texts, strict=True)]
    if draw.random() < 0.3 and len(body) > 1:
        body[int(draw.integers(1, len(body))):0] = [(b, 0.0) for b in around("ad", holder)]
    if pick["comments"]:
        body += [(b, 0.0) for b in around("comments", holder if draw.random() < 0.5 else base)]
    after = [b for k in ("form", "aside", "footer") if pick[k] for b in around(k, base)]
    if draw.random() < 0.5:  # names that mean nothing
        noise = f".{''.join(draw.choice(list('bcdfghjklmnpqrstvwxz'), 5))}"
        body = [(b._replace(path=(*holder, noise, *b.path[len(holder):])), y) if y else (b, y) for b, y in body]
    every = [*before, *(b for b, _ in body), *after]
    return every, np.array([0.0] * len(before) + [y for _, y in body] + [0.0] * len(after))


def _stretches(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[k:k + STRETCH] for k in range(0, len(rows), STRETCH)]


def fit_labeller(pages: list[list[Leaf]], seed: int = 7, epochs: int = EPOCHS, rate: float = 0.01) -> Labeller | None:
    """Learn from the pages' own words about their parts, and from two new layouts of each."""
    draw = np.random.default_rng(seed)
    examples = []
    for page in filter(None, pages):
        labels = own_labels(page)
        if labels is not None:
            examples.append((page, labels))
        source = labels if labels is not None and labels.any() else np.array([len(b.text) > 80 for b in page], float)
        examples += [laid_out_anew(page, source, draw) for _ in range(2)]
    examples = [(p, y) for p, y in examples if p]
    if not examples:
        return None
    model = Labeller.start(seed)
    # A very long page is learned from in stretches, all of them, each with the places it has in the page.
    inputs = [x for p, _ in examples for x in _stretches(block_inputs([p]))]
    truths = [y for _, labels in examples for y in _stretches(labels)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in model.parameters()]
    step = 0
    for epoch in range(epochs):
        order = draw.permutation(len(inputs))
        order = order[np.argsort([len(inputs[e]) // 16 for e in order], kind="stable")]  # pages of like length together
        parts = [order[k:k + PAGES_A_STEP] for k in range(0, len(order), PAGES_A_STEP)]
        for at in draw.permutation(len(parts)):
            x = np.vstack([inputs[e] for e in parts[at]])
            x[:, :PATH] *= draw.random((len(x), 1)) > 0.1
            x[:, PATH:PATH + WORDS] *= draw.random((len(x), 1)) > 0.4
            truth = np.concatenate([truths[e] for e in parts[at]])
            run = Run(model, x, np.array([len(inputs[e]) for e in parts[at]]))
            slopes = run.gradients(truth, np.full(len(truth), 1 / len(truth)))
            step += 1
            pace = rate * (1 - epoch / epochs)
            for p, g, (m, v) in zip(model.parameters(), slopes, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(pages: DataFrame, rows: int = TRAINING_ROWS, max_bytes: int = TRAINING_BYTES) -> Labeller | None:
    """Learn from ``rows`` pages and ``max_bytes`` of them at most, the only ones that come to the driver."""
    keyed = pages.where("html is not null").select(F.xxhash64("page_id", "html").alias("key"), "html")
    chosen = least_hashed(keyed.select("key").distinct(), F.col("key"), rows)
    sizes = keyed.join(F.broadcast(chosen), "key").groupBy("key").agg(F.max(F.octet_length("html")).alias("size"))
    chosen = within_bytes(sizes, "key", "size", max_bytes)
    # Copies of a page are one; what is joined and collected is at most ``rows`` pages.
    some = keyed.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("html").alias("html")).collect()
    return fit_labeller([leaves(r.html) for r in sorted(some, key=lambda r: r.key)])


def main_texts(sources: list[str | None], model: Labeller | None, side_by_side: int = 256) -> list[str]:
    """The blocks called text of each page, joined by one space."""
    root = Path()
    pages = [leaves(s, root) for s in sources]
    out = [""] * len(pages)
    order = [p for p in sorted(range(len(pages)), key=lambda p: len(pages[p])) if pages[p]]
    first = 0
    while first < len(order):
        last, blocks = first + 1, len(pages[order[first]])
        while last < min(first + side_by_side, len(order)) and blocks + len(pages[order[last]]) <= BLOCKS_AT_ONCE:
            blocks += len(pages[order[last]])
            last += 1
        part = order[first:last]
        chosen = [pages[p] for p in part]
        good = np.ones(blocks, bool) if model is None else probabilities(model, chosen) >= 0.5
        at = 0
        for p, page in zip(part, chosen, strict=True):
            out[p] = " ".join(leaf.text for leaf, g in zip(page, good[at:at + len(page)], strict=True) if g)
            at += len(page)
        first = last
    return out


def _extract(batches: Iterator[pa.RecordBatch], model: Labeller | None) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "html", 2 << 20):
        texts = main_texts(block.column("html").to_pylist(), model)
        yield pa.record_batch({
            "page_id": block.column("page_id"), "url": block.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def extract(pages: DataFrame, model: Labeller | None) -> DataFrame:
    """page_id, url, the main text and its number of characters, for every page; no shuffle."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          "html")
    return narrow.mapInArrow(partial(_extract, model=model), "page_id long, url string, text string, n_chars long")
