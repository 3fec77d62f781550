"""Main text of web pages: blocks in page order, labelled by a bidirectional LSTM.

A page is cut into leaf blocks (text between block-level tags). Each block is a
vector of its tag path (tags, class and id words, hashed), its words (hashed), its
links and its form; a numpy LSTM reads the sequence in both directions, so that each
label rests on the whole page. Blocks labelled as content are joined.

The network is trained here on a bounded sample of pages (``TRAIN_PAGES``): on their
own blocks, labelled by the elements that hold them, and on pages put together anew
from their texts with other elements and class names, whose labels are known.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayline.llm.blocks import SPACED, byte_rows, map_arrow, slices, words_of

#: Pages that the network is trained on at most (those with the smallest hash of the id), and blocks of each.
TRAIN_PAGES, TRAIN_BLOCKS = 300, 60
#: Sizes of the vectors and of the hidden state.
PATH_DIMS, WORD_DIMS, FORM_DIMS, HIDDEN = 128, 16, 8, 16
DIMS = PATH_DIMS + WORD_DIMS + FORM_DIMS
#: Elements of a path that its vector is made of: the innermost ones (a feature only, no text is cut).
PATH_DEPTH = 32

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
#: Drawings, form choices and what is not part of the page; fallback texts, formulas and the like are text.
HIDDEN_ELEMENTS = frozenset("template svg select datalist".split())
#: An open element that a new one of the same kind ends.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")

Block = tuple[tuple[str, ...], str, int]  # path, text, characters in links


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter = Counter()
    parts: list[str] = []
    links = in_link = hidden = 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            out.append((tuple(w for _, words in stack[-PATH_DEPTH:] for w in words), text, min(links, len(text))))
        links = 0

    def pop() -> None:
        nonlocal hidden
        tag = stack.pop()[0]
        opened[tag] -= 1
        hidden -= tag in HIDDEN_ELEMENTS

    while at < n:
        lt = page.find("<", at)
        text = page[at:] if lt < 0 else page[at:lt]
        if text and not hidden:
            parts.append(text)
            links += len(text) if in_link else 0
        if lt < 0:
            break
        tag = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not tag:
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif page[lt + 1 : lt + 2] in ("!", "?") or re.match(r"</?[a-zA-Z]", page[lt : lt + 3]):
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:  # a plain "<"
                if not hidden:
                    parts.append("<")
                at = lt + 1
            continue
        at = tag.end()
        closing, name, rest = tag.group(1), tag.group(2).lower(), tag.group(3)
        if name in INLINE:
            in_link = int(not closing) if name == "a" else in_link
            continue
        flush()
        in_link = 0
        if closing:
            if opened[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name == "xmp":  # text as it stands, without tags and character references
            end = re.compile(r"</xmp\b[^>]*>", re.IGNORECASE).search(page, at)
            if not hidden:
                parts.append((page[at : end.start()] if end else page[at:]).replace("&", "&amp;"))
                flush()
            at = end.end() if end else n
        elif name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and not rest.endswith("/"):
            while stack and stack[-1][0] in CLOSES.get(name, ()):
                pop()
            words = [name]
            if rest:
                for m in _NAMED.finditer(rest):
                    words += [f".{w}" for w in _WORD.findall((m.group(1) or m.group(2) or m.group(3) or "").lower())]
            stack.append((name, tuple(words)))
            opened[name] += 1
            hidden += name in HIDDEN_ELEMENTS
    flush()
    return out


_PATHS: dict[tuple[str, ...], np.ndarray] = {}


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    found = _PATHS.get(path)
    if found is None:
        found = np.zeros(PATH_DIMS)
        for i, word in enumerate(reversed(path)):
            h = zlib.crc32(word.encode())
            # two places a word, so that words rarely share both
            found[h % PATH_DIMS] += 1.0 / (1 + 0.1 * i)
            found[(h >> 12) % PATH_DIMS] += 1.0 / (1 + 0.1 * i)
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        _PATHS[path] = found
    return found


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages."""
    texts = [b[1] for page in pages for b in page]
    n = len(texts)
    out = np.zeros((n, DIMS))
    if not n:
        return out
    data, offsets = byte_rows(pa.array(texts, pa.string()))
    words = words_of(data, offsets, SPACED)
    counts = np.bincount(words.doc * WORD_DIMS + (words.hash % np.uint64(WORD_DIMS)).astype(np.int64), minlength=n * WORD_DIMS)
    per_block = np.maximum(1, np.diff(words.first))
    out[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = counts.reshape(n, WORD_DIMS) / per_block[:, None]
    k = 0
    for page in pages:
        for i, (path, text, links) in enumerate(page):
            row = out[k]
            row[:PATH_DIMS] = path_vector(path)
            size = len(text)
            row[-FORM_DIMS:] = (
                1.0, np.log1p(size) / 8, np.log1p(per_block[k]) / 6, links / size, text[-1] in ".!?",
                i == 0, i == len(page) - 1, i / len(page),
            )
            k += 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BiLstm:
    """Weights of both directions (input, hidden, bias; gates in, forget, out, cell) and of the output."""

    wf: np.ndarray
    uf: np.ndarray
    bf: np.ndarray
    wb: np.ndarray
    ub: np.ndarray
    bb: np.ndarray
    v: np.ndarray
    c: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 11) -> BiLstm:
        rng = np.random.default_rng(seed)
        def one():
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1
            return rng.normal(0, 0.1, (DIMS, 4 * HIDDEN)), rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)), bias
        return cls(*one(), *one(), rng.normal(0, 0.1, 2 * HIDDEN), np.zeros(1))

    @staticmethod
    def _run(x, mask, w, u, b):
        """x: steps, pages, DIMS. The state stays where a page has ended (mask 0)."""
        steps, pages, _ = x.shape
        h, c, kept = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)), []
        hs = np.zeros((steps, pages, HIDDEN))
        inputs = x @ w + b
        for t in range(steps):
            z = inputs[t] + h @ u
            gate = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            m = mask[t][:, None]
            kept.append((h, c, i, f, o, g, tc, m))
            h, c = m * o * tc + (1 - m) * h, m * c_new + (1 - m) * c
            hs[t] = h
        return hs, kept

    @staticmethod
    def _back(x, u, kept, dhs):
        dw, du, db = np.zeros((x.shape[2], 4 * HIDDEN)), np.zeros_like(u), np.zeros(4 * HIDDEN)
        dh, dc = np.zeros_like(dhs[0]), np.zeros_like(dhs[0])
        for t in range(len(kept) - 1, -1, -1):
            h, c, i, f, o, g, tc, m = kept[t]
            dh = dh + dhs[t]
            live, dcl = dh * m, dc * m
            dcell = dcl + live * o * (1 - tc * tc)
            dz = np.hstack([dcell * g * i * (1 - i), dcell * c * f * (1 - f), live * tc * o * (1 - o), dcell * i * (1 - g * g)])
            dw += x[t].T @ dz
            du += h.T @ dz
            db += dz.sum(0)
            dh, dc = dh * (1 - m) + dz @ u.T, dc * (1 - m) + dcell * f
        return dw, du, db

    def forward(self, x, mask):
        hf, kf = self._run(x, mask, self.wf, self.uf, self.bf)
        hb, kb = self._run(x[::-1], mask[::-1], self.wb, self.ub, self.bb)
        both = np.concatenate([hf, hb[::-1]], axis=2)
        return _sigmoid(both @ self.v + self.c), both, kf, kb

    def train(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, steps: int = 350, batch: int = 48, seed: int = 5) -> None:
        """Cross-entropy by backpropagation through time, Adam."""
        rng, names = np.random.default_rng(seed), [f.name for f in fields(self)]
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        for step in range(1, steps + 1):
            pick = rng.choice(x.shape[1], min(batch, x.shape[1]), replace=False)
            xb, yb, mb = x[:, pick], y[:, pick], mask[:, pick]
            p, both, kf, kb = self.forward(xb, mb)
            dout = (p - yb) * mb / max(1, mb.sum())
            dboth = dout[:, :, None] * self.v
            grads = dict(zip(("wf", "uf", "bf"), self._back(xb, self.uf, kf, dboth[:, :, :HIDDEN])))
            grads |= zip(("wb", "ub", "bb"), self._back(xb[::-1], self.ub, kb, dboth[::-1, :, HIDDEN:]))
            grads |= {"v": np.einsum("tp,tph->h", dout, both), "c": np.array([dout.sum()])}
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.99 * second[k] + 0.01 * grads[k] ** 2
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                setattr(self, k, getattr(self, k) - 0.02 * move)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of content for each block, pages of like length together."""
        rows = vectors(pages)
        ends = np.cumsum([len(p) for p in pages])
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            stop, longest = start + 1, len(pages[order[start]])
            while stop < len(order) and len(pages[order[stop]]) <= 1.3 * longest + 4 and (stop - start) * longest < 20_000:
                stop += 1
            group = order[start:stop]
            x, mask = padded([rows[ends[i] - len(pages[i]) : ends[i]] for i in group])
            p = self.forward(x, mask)[0]
            for j, i in enumerate(group):
                out[i] = p[: len(pages[i]), j]
            start = stop
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max((len(p) for p in pages), default=0)
    x, mask = np.zeros((steps, len(pages), DIMS)), np.zeros((steps, len(pages)))
    for j, page in enumerate(pages):
        x[: len(page), j] = page
        mask[: len(page), j] = 1
    return x, mask


#: Fixed: words in tags, classes and ids that tell what an element holds.
ASIDE_WORDS = (
    "nav menu navbar navigation breadcrumb breadcrumbs header masthead footer copyright aside sidebar widget ad ads advert "
    "advertisement sponsor sponsored promo banner cookie cookies consent notice notification alert popup modal form search "
    "login subscribe newsletter signup comment comments reply replies disqus discussion related recommended share social tags "
    "pagination pager toolbar legal"
).split()
ASIDE_TAGS = "nav header footer aside form button dialog menu fieldset".split()
BODY_WORDS = "article content post entry story body main text page single prose".split()
BODY_TAGS = "article main".split()
_ASIDE = frozenset(ASIDE_TAGS) | {f".{w}" for w in ASIDE_WORDS}
_BODY = frozenset(BODY_TAGS) | {f".{w}" for w in BODY_WORDS}


def held_by(path: tuple[str, ...]) -> bool:
    """Whether the elements that hold a training block make it content."""
    return not _ASIDE.intersection(path) and bool(_BODY.intersection(path))


def composed(rng: np.random.Generator, texts: list[str], asides: list[str]) -> tuple[list[Block], list[bool]]:
    """A page put together anew: a content element, other elements before, within and after it."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    outer = ("html", "body", *(("div", f".{pick(['wrapper', 'container', 'site', 'page', 'layout'])}") if rng.random() < 0.5 else ()))
    if rng.random() < 0.6:
        body = (*outer, pick(BODY_TAGS))
    else:
        body = (*outer, pick(["div", "section"]), f".{pick(BODY_WORDS)}")
    if rng.random() < 0.3:
        body = (*body, "div", f".{pick(BODY_WORDS)}")
    out, labels = [], []

    def aside(where: tuple[str, ...]) -> None:
        if rng.random() < 0.5:
            holder = (*where, pick(ASIDE_TAGS))
            holder += (f".{pick(ASIDE_WORDS)}",) if rng.random() < 0.3 else ()
        else:
            holder = (*where, pick(["div", "section", "ul", "ol", "p"]), f".{pick(ASIDE_WORDS)}")
            holder += (f".{pick(['box', 'list', 'item', 'main', 'content', 'text', 'body'])}",) if rng.random() < 0.3 else ()
        inner = pick([(), (), ("ul", "li"), ("p",), ("div",), ("h",), ("h3",), ("div", "p")])
        linked = rng.random() < 0.5
        for _ in range(int(rng.integers(1, 6))):
            long = rng.random() < 0.4
            text = pick(texts if long else asides)
            text = text if long else " ".join(text.split()[: int(rng.integers(1, 9))])
            out.append(((*holder, *inner), text or "x", len(text) if linked else 0))
            labels.append(False)

    for _ in range(int(rng.integers(0, 5))):
        aside(outer)
    if rng.random() < 0.8:
        out.append(((*body, "h1"), pick(asides), 0))
        labels.append(True)
    for _ in range(int(rng.integers(1, 12))):
        inner = pick([("p",), ("p",), ("p",), ("p",), ("h2",), ("ul", "li"), ("blockquote", "p"), ("table", "tbody", "tr", "td"), ("div",), ("pre",), ()])
        short = rng.random() < 0.3
        text = pick(texts)
        text = " ".join(text.split()[: int(rng.integers(1, 6))]) if short else text
        out.append(((*body, *inner), text, 0))
        labels.append(True)
        if rng.random() < 0.12:
            aside(body)
    for _ in range(int(rng.integers(0, 5))):
        aside(outer if rng.random() < 0.7 else body)
    return out, labels


def train_labeller(sample: list[str], composed_pages: int = 900, seed: int = 3) -> BiLstm:
    """The network for a list of sample pages; without any block it is trained on nothing and keeps blocks by chance."""
    pages = [blocks_of(p)[:TRAIN_BLOCKS] for p in sample]
    pages = [p for p in pages if p]
    rng = np.random.default_rng(seed)
    labels = [[held_by(path) for path, _, _ in page] for page in pages]
    texts = [t for page, own in zip(pages, labels) for (_, t, _), y in zip(page, own) if y] or ["text of an article."]
    asides = [t for page in pages for _, t, _ in page if len(t) < 200] or ["menu"]
    for _ in range(composed_pages):
        page, own = composed(rng, texts, asides)
        pages.append(page[:TRAIN_BLOCKS])
        labels.append(own[:TRAIN_BLOCKS])
    rows = vectors(pages)
    ends = np.cumsum([len(p) for p in pages])
    x, mask = padded([rows[e - len(p) : e] for e, p in zip(ends, pages)])
    y = np.zeros_like(mask)
    for j, own in enumerate(labels):
        y[: len(own), j] = own
    network = BiLstm.fresh()
    network.train(x, y, mask)
    return network


def train_on(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = TRAIN_PAGES) -> BiLstm:
    """Train on at most ``most`` pages of a table."""
    slim = pages.where(F.col(html_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col).distinct()
    chosen = slim.orderBy(F.xxhash64(id_col), id_col).limit(most)
    # at most ``most`` ids
    rows = pages.select(id_col, html_col).join(F.broadcast(chosen), id_col).dropDuplicates([id_col])
    return train_labeller([r[html_col] for r in sorted(rows.collect(), key=lambda r: r[id_col])])


def extract(pages: DataFrame, network: BiLstm, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the content blocks) instead of their html.

    NULL and empty pages and pages without content give an empty text; repeated rows
    give the same text; an own column named ``text`` is replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(network)
    names = [c for c in pages.columns if c not in (html_col, "text")]
    schema = StructType([pages.schema[c] for c in names] + StructType.fromDDL("text string").fields)

    def run(batches):
        for batch in batches:
            for part in slices(batch, html_col):
                blocks = [blocks_of(p or "") for p in part.column(html_col).to_pylist()]
                labels = shared.value.label(blocks)
                texts = [" ".join(b[1] for b, y in zip(page, own.tolist()) if y > 0.5) for page, own in zip(blocks, labels)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(texts, pa.string())], names=[*names, "text"])

    return map_arrow(pages, run, schema)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    text = extract(pages, train_on(pages))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUERIES = {"op7_html_text": op7_html_text}
ORACLES: dict[str, str] = {}
