"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of leaf blocks: runs of text between block-level tags, each
with the path of open tags above it (names, classes, ids). Each block is a vector: its
path's names hashed, its words hashed, and its length, links, stops and place. A
bidirectional LSTM in numpy reads the whole sequence, so every block is labelled with the
page before and after it in view, as main text or not. The main text is the blocks that
it labels so, in page order.

The weights are fitted here, on a bounded sample of pages (`sample_pages`, taken by a
hash of page_id; pages of more than `sample_blocks` blocks are left out of it, and the
others are learned whole). Labels of the sample come from the names of tags that say what a block
is; the same pages are also learned with other names, places and kinds of notices,
comments, forms and menus, and without any container, so that what is learned does not
hang on one layout. Names say nothing when pages are labelled: only the network does.

Labelling is one pass without a shuffle; pages of a batch with like numbers of blocks run
through the network together, so memory is that of one batch.

Defined results: null or empty html: empty text; a page without blocks of main text:
empty text; blocks of any length and pages of any number of blocks are read whole; tags
that are never closed end where their container ends, those of raw text (scripts, styles,
titles, text areas, inline frames) with the page; a quote in a tag counts after an equals
sign only, and not if it would keep the tag open to the end of the page; reading takes time
that grows with the page's length, however its tags are broken; the text of a template is not part of a page; repeated rows give repeated
results; other columns are not looked at; nothing to learn from: learned from built-in
layouts of no words.
"""

from __future__ import annotations

import html as characters
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obstar.llm.common import Remembered, only, prepare

PATH, WORDS, SIZES = 256, 64, 7
INPUT = PATH + WORDS + SIZES
HIDDEN = 12
SAMPLE_PAGES, SAMPLE_CHARS, SAMPLE_BLOCKS, EPOCHS = 240, 200_000, 400, 7
REMEMBERED = 200_000

# What HTML says of its tags.
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html
    legend li main menu nav ol option p pre search section select summary table tbody td tfoot th
    thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is no markup, and ends with their end tag only.
RAW = frozenset("script style iframe title textarea".split())
#: Their end tag ends the blocks inside too, and a block inside ends none outside.
SCOPES = frozenset("object svg math noscript template".split())
#: A start tag of the first kind ends an open one of the second, up to the containers after it.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Names of tags, classes and ids that hold an article, and of what is not part of it.
HOLDS = """article main content post entry story text body-text article-body post-content
entry-content main-content article-content page-content blog-post news-article""".split()
NOT_PART = """nav menu navbar navigation breadcrumb header banner masthead top-bar footer copyright
aside sidebar widget related recommended ad ads advert advertisement sponsored promo form login
search-box newsletter subscribe comments comment reply discussion disqus respond notice cookie
cookie-notice cookie-banner consent gdpr alert modal popup share social tags pager pagination
disclaimer legal""".split()
PLAIN = "wrapper container row col inner outer block box section page site layout grid left center".split()

# possessive: a tag is read once, from left to right
_ATTRIBUTES = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+)*+"""
_OPENING = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>")
#: A tag that ends at the next sign for it, also within quotes.
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_TEMPLATE = re.compile("<template", re.I)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Path:
    """The open tags above a block, each with what is above it: blocks share what they have
    in common, and what is known of the names is known of the path without going up it."""

    __slots__ = ("names", "above", "places")

    def __init__(self, names: str, above: Path | None):
        self.names, self.above = names, above
        self.places: int = name_places(names) | (above.places if above else 0)

    @classmethod
    def of(cls, parts: Iterable[str]) -> Path | None:
        found = None
        for names in parts:
            found = cls(names, found)
        return found


@dataclass(slots=True)
class Block:
    at: Path | None
    text: str
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        """The names from the page down to the block."""
        found, at = [], self.at
        while at:
            found.append(at.names)
            at = at.above
        return tuple(found[::-1])


def names_of(tag: str, attributes: str) -> str:
    """A tag with its classes and ids, as it stands in a path."""
    if not attributes or "=" not in attributes:
        return tag
    found = [tag]
    for kind, a, b, c in _NAMED.findall(attributes):
        mark = "#" if kind.lower() == "id" else "."
        found += [mark + x for x in characters.unescape(a or b or c).lower().split()]
    return " ".join(found)


class _Open:
    """The open tags, with where each name is open: no tag is looked for by going through them."""

    def __init__(self):
        self.tags: list[tuple[str, Path]] = []
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def innermost(self, *names: str) -> int:
        """Where one of the names is open innermost, -1 if none is."""
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=-1)

    def push(self, tag: str, attributes: str) -> None:
        place = len(self.tags)
        self.tags.append((tag, Path(names_of(tag, attributes), self.path())))
        self.where.setdefault(tag, []).append(place)
        if tag in BLOCK:
            self.blocks.append(place)
        if tag in SCOPES:
            self.scopes.append(place)

    def pop_to(self, place: int) -> None:
        while len(self.tags) > place:
            tag, _ = self.tags.pop()
            self.where[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            if tag in SCOPES:
                self.scopes.pop()

    def path(self) -> Path | None:
        return self.tags[-1][1] if self.tags else None

    def end(self, tag: str) -> None:
        """An end tag; an inline one does not end a block."""
        place = self.innermost(tag)
        inline = tag not in BLOCK and tag not in SCOPES
        if place >= 0 and not (inline and self.blocks and self.blocks[-1] > place):
            self.pop_to(place)

    def begin_block(self, tag: str) -> None:
        """A block ends an open paragraph, and what is open inside it."""
        ended, within = CLOSES.get(tag, ((), ()))
        place = self.innermost("p", *ended)
        scope = self.scopes[-1] if self.scopes else -1
        if ended:
            stop = max(scope, self.innermost(*within))
        else:
            stop = max(scope, self.blocks[-1] if self.blocks else -1)
        if place >= 0 and place >= stop:
            self.pop_to(place)


def page_blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page, in order, in time that grows with its length.

    A tag that only a quote keeps open to the end of the page ends at the next sign for it,
    and so do those after it; where no such sign follows, what looks like a tag is text.
    """
    html = html or ""
    open_ = _Open()
    out: list[Block] = []
    pieces: list[str] = []
    linked, at, end = 0, 0, len(html)
    templates = _TEMPLATE.search(html) is not None
    reads, last_sign = _TAG, html.rfind(">")

    def close_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(characters.unescape("".join(pieces)).split())
            if text:
                out.append(Block(open_.path(), text, linked))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not (templates and open_.where.get("template")):
            pieces.append(text)
            if any(name == "a" for name, _ in open_.tags[-4:]):
                linked += len(text)

    while at < end:
        opening = _OPENING.search(html, at)
        if opening is None:
            add(html[at:])
            break
        begin = opening.start()
        add(html[at:begin])
        kind = opening[0]
        if kind == "<!--":
            ending = html.find("-->", opening.end())
            at = ending + 3 if ending >= 0 else end
            continue
        if begin > last_sign:  # nothing ends a tag any more
            add(kind)
            at = opening.end()
            continue
        if kind in ("<!", "<?"):
            at = html.find(">", begin) + 1
            continue
        found = reads.match(html, begin)
        if found is None:
            reads = _LOOSE
            found = reads.match(html, begin)
        at = found.end()
        tag = found[2].lower()
        if found[1]:
            if tag in BLOCK or tag in SCOPES and open_.tags and open_.tags[-1][0] in BLOCK:
                close_block()
            open_.end(tag)
            continue
        if tag in RAW:
            if not found[3].rstrip().endswith("/"):
                ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                sign = html.find(">", ending.end()) if ending else -1
                at = sign + 1 if sign >= 0 else end
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            close_block()
            open_.begin_block(tag)
        if tag not in VOID and not found[3].endswith("/"):
            open_.push(tag, found[3])
    close_block()
    return out


# --- vectors -------------------------------------------------------------------------


def word_place(word: str) -> bytes:
    """The place of a word's hash, as a byte."""
    return bytes([zlib.crc32(word.lower().encode("utf-8", "replace")) % WORDS])


def word_places() -> Remembered:
    return only(("places",), lambda: Remembered(word_place, REMEMBERED))


@lru_cache(maxsize=20_000)
def name_places(part: str) -> int:
    """Where the names of a tag are in a path's part of the vector, as bits."""
    names = set(part.split())
    # words of a compound name count, too
    parts = {"-" + x for n in names if n[0] in ".#" for x in re.split(r"[-_]", n[1:]) if x}
    found = 0
    for name in names | parts:
        found |= 1 << zlib.crc32(name.encode("utf-8", "replace")) % PATH
    return found


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row per block."""
    out = np.zeros((len(blocks), INPUT), np.float32)
    places = word_places()
    for i, block in enumerate(blocks):
        bits = (block.at.places if block.at else 0).to_bytes(PATH // 8, "little")
        out[i, :PATH] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        words = block.text.split()
        found = np.frombuffer(b"".join(map(places.__getitem__, words)), np.uint8)
        counts = np.bincount(found, minlength=WORDS)
        out[i, PATH : PATH + WORDS] = np.sqrt(counts / len(words))
        chars = len(block.text)
        out[i, PATH + WORDS :] = (
            np.log1p(len(words)) / 4,
            np.log1p(chars) / 6,
            min(1.0, block.linked / chars),
            block.text.count(".") / len(words),
            block.text.count(",") / len(words),
            i / len(blocks),
            1.0,
        )
    return out


# --- the network ---------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Labeller:
    """A bidirectional LSTM with one output per block."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)

        def some(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.weights: dict[str, np.ndarray] = {"out": some(2 * HIDDEN, scale=0.3), "bias": some(1, scale=0)}
        for way in "fb":
            self.weights["x" + way] = some(INPUT, 4 * HIDDEN, scale=0.1)
            self.weights["h" + way] = some(HIDDEN, 4 * HIDDEN, scale=0.2)
            self.weights["b" + way] = some(4 * HIDDEN, scale=0)
            self.weights["b" + way][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def _run(self, way: str, x: np.ndarray, used: np.ndarray, traced: bool = False):
        """States of one direction; x: pages, blocks, numbers. used marks blocks that are there.

        `traced` keeps what learning needs of every step.
        """
        w, (pages, steps, _) = self.weights, x.shape
        given = x @ w["x" + way] + w["b" + way]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        states, trace = np.zeros((pages, steps, HIDDEN), np.float32), []
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        for t in order:
            gates = given[:, t] + h @ w["h" + way]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            here = used[:, t, None]
            new = f * c + i * g
            shown = np.tanh(new)
            if traced:
                trace.append((t, h, c, i, f, o, g, shown))
            c = np.where(here, new, c)
            h = np.where(here, o * shown, h)
            states[:, t] = h
        return states, trace

    def logits(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(way, x, used)[0] for way in "fb"], axis=2)
        return both @ self.weights["out"] + self.weights["bias"]

    def gradients(self, x: np.ndarray, used: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the blocks that are there."""
        w = self.weights
        runs = {way: self._run(way, x, used, traced=True) for way in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        error = (_sigmoid(both @ w["out"] + w["bias"]) - labels) * used / max(1, used.sum())
        found = {"out": np.einsum("pt,pth->h", error, both), "bias": error.sum(keepdims=True)[0]}
        for k, way in enumerate("fb"):
            above = error[:, :, None] * w["out"][k * HIDDEN : (k + 1) * HIDDEN]
            d_given = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            d_own = np.zeros_like(w["h" + way])
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, shown in reversed(runs[way][1]):
                here = used[:, t, None]
                dh = dh + above[:, t]
                d_new = np.where(here, dc + dh * o * (1 - shown**2), 0)
                gates = np.concatenate(
                    (
                        d_new * g * i * (1 - i),
                        d_new * c * f * (1 - f),
                        np.where(here, dh * shown * o * (1 - o), 0),
                        d_new * i * (1 - g**2),
                    ),
                    axis=1,
                )
                d_given[:, t] = gates
                d_own += h.T @ gates
                dc = np.where(here, d_new * f, dc)
                dh = np.where(here, 0, dh) + gates @ w["h" + way].T
            found["x" + way] = x.reshape(-1, INPUT).T @ d_given.reshape(-1, 4 * HIDDEN)
            found["h" + way] = d_own
            found["b" + way] = d_given.sum(axis=(0, 1))
        return found

    def label(self, pages: list[np.ndarray], at_once: int = 20_000) -> list[np.ndarray]:
        """Whether each block is main text; pages of like lengths run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            until = at + 1
            while until < len(order) and len(pages[order[until]]) * (until + 1 - at) <= at_once:
                until += 1
            some = order[at:until]
            at = until
            x, used = padded([pages[i] for i in some])
            if x.shape[1]:
                main = self.logits(x, used) > 0
                for i, row in zip(some, main):
                    out[i] = row[: len(pages[i])]
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max((len(p) for p in pages), default=0)
    x = np.zeros((len(pages), steps, INPUT), np.float32)
    used = np.zeros((len(pages), steps), bool)
    for i, page in enumerate(pages):
        x[i, : len(page)] = page
        used[i, : len(page)] = True
    return x, used


# --- learning ------------------------------------------------------------------------


def named_label(path: tuple[str, ...]) -> bool:
    """What the names of a path say: within something that holds an article, and nothing else."""
    held = False
    for part in path:
        names = {n.lstrip(".#") for n in part.split()}
        if names & set(NOT_PART):
            return False
        held = held or bool(names & set(HOLDS))
    return held


def relaid(blocks: list[Block], draw: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The same page with other names, and with what is not part of the article put in."""

    def pick(names: list[str]) -> str:
        return names[draw.integers(len(names))]

    def named(names: list[str]) -> str:
        name, how = pick(names), draw.integers(3)
        tag = pick(["div", "div", "section", "ul", "span"])
        return f"{tag} .{name}" if how == 0 else f"{tag} #{name}" if how == 1 else name

    around = tuple(f"div .{pick(PLAIN)}" for _ in range(draw.integers(0, 3)))
    holder = () if draw.random() < 0.15 else (named(HOLDS),)
    words = [w for b in blocks for w in b.text.split()] or ["the"]
    out, labels = [], []

    def foreign(before: tuple[str, ...]) -> None:
        """A few blocks of one kind that is not part of the article."""
        kind = named(NOT_PART)
        links = draw.random() < 0.4
        for _ in range(draw.integers(1, 6)):
            n = int(draw.integers(1, 5 if links else 40))
            start = int(draw.integers(len(words)))
            text = " ".join(words[start : start + n]) or "more"
            tail = ("li", "a") if links else (pick(["p", "div", "p", "h3"]),)
            out.append(Block(Path.of((*before, kind, *tail)), text, len(text) if links else 0))
            labels.append(False)

    base = ("html", "body")
    begun = False
    for block in blocks:
        main = named_label(block.path)
        if main and not begun:
            begun = True
            for _ in range(draw.integers(0, 3)):
                foreign((*base, *around))
        if main:
            tail = (block.at.names,) if block.at.names.split()[0] in BLOCK else ("p",)
            if tail[0].split()[0] not in ("p", "h1", "h2", "h3", "li", "pre", "blockquote", "td"):
                tail = ("p",)
            out.append(Block(Path.of((*base, *around, *holder, *tail)), block.text, block.linked))
            labels.append(True)
            if draw.random() < 0.12:
                foreign((*base, *around, *holder))
        else:
            out.append(block)
            labels.append(False)
    for _ in range(draw.integers(0, 3)):
        foreign((*base, *around, *(holder if draw.random() < 0.3 else ())))
    return out, labels


def train(
    pages: Iterable[str], epochs: int = EPOCHS, seed: int = 7, sample_blocks: int = SAMPLE_BLOCKS
) -> Labeller:
    """Fit a labeller to a bounded list of pages, those of at most `sample_blocks` blocks.

    A page that is learned is learned to its end, as the ends of pages are not like their
    beginnings.
    """
    draw = np.random.default_rng(seed)
    examples: list[tuple[np.ndarray, np.ndarray]] = []
    for page in pages:
        blocks = page_blocks(page)
        if not 0 < len(blocks) <= sample_blocks:
            continue
        plain = np.array([named_label(b.path) for b in blocks], np.float32)
        if plain.any():
            examples.append((vectors(blocks), plain))
            for _ in range(3):
                changed, labels = relaid(blocks, draw)
                examples.append((vectors(changed), np.array(labels, np.float32)))
    if not examples:
        layout = [Block(Path.of(("html", "body", h, "p")), "text", 0) for h in (*HOLDS, *NOT_PART)]
        labels = np.array([named_label(b.path) for b in layout], np.float32)
        examples = [(vectors(layout), labels)] * 8
    network = Labeller(seed)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for _ in range(epochs):
        # pages of like lengths together, groups in any order
        order = sorted(range(len(examples)), key=lambda i: len(examples[i][0]) + draw.random() * 8)
        groups = [order[i : i + 16] for i in range(0, len(order), 16)]
        draw.shuffle(groups)
        for group in groups:
            x, used = padded([examples[i][0] for i in group])
            labels = np.zeros(used.shape, np.float32)
            for row, i in enumerate(group):
                labels[row, : len(examples[i][1])] = examples[i][1]
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in network.gradients(x, used, labels).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                network.weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return network


def fit(
    pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_blocks: int = SAMPLE_BLOCKS
) -> Labeller:
    """Learn from at most `sample_pages` pages, of at most SAMPLE_CHARS characters each.

    Of these, pages of more than `sample_blocks` blocks are left out.

    The sample is bounded, so one task can learn from it; only the weights come back.
    """
    usable = pages.where(F.length("html") <= SAMPLE_CHARS).select("page_id", "html")
    order = [F.xxhash64("page_id"), "page_id"]
    drawn = usable.select("page_id").where("page_id IS NOT NULL").orderBy(*order).limit(sample_pages)
    ids = [r["page_id"] for r in drawn.collect()]
    # rows that repeat a page_id could be many: the limit holds for them, too
    sample = usable.where(F.col("page_id").isin(ids)).orderBy(*order, "html").limit(sample_pages)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [page for batch in batches for page in batch.column("html").to_pylist()]
        network = train(held, sample_blocks=sample_blocks)
        names, values = zip(*network.weights.items())
        shapes = [list(v.shape) for v in values]
        columns = [list(names), [v.tobytes() for v in values], shapes]
        types = [pa.string(), pa.binary(), pa.list_(pa.int32())]
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["name", "data", "shape"]
        )

    network = Labeller()
    trained = sample.repartition(1).sortWithinPartitions(*order, "html")
    for row in trained.mapInArrow(learn, "name string, data binary, shape array<int>").collect():
        data = np.frombuffer(bytes(row["data"]), np.float32)
        network.weights[row["name"]] = data.reshape(row["shape"])
    return network


def main_texts(network: Labeller, pages: Iterable[str | None]) -> list[str]:
    blocks = [page_blocks(p) for p in pages]
    main = network.label([vectors(b) for b in blocks])
    return ["\n\n".join(b.text for b, m in zip(own, marks) if m) for own, marks in zip(blocks, main)]


def main_text(html: Column, network: Labeller) -> Column:
    """The main text of each page."""

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array(main_texts(network, pages.to_pylist()), pa.string())

    return extracted(html)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    prepare(pages.sparkSession)
    found = pages.select("page_id", "url", main_text(F.col("html"), fit(pages)).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
