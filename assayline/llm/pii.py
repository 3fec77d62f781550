"""Personal data: base patterns, and a skip-chain conditional random field that spreads their labels.

Tokens with a digit or an at sign are the variables of the field; all other tokens
can only be "none", which cuts the chain exactly there. Neighbouring variables are
linked (chain), and so are repeated or similar ones anywhere in the document (skip):
equal tokens, equal digit strings, equal names before the at sign. Repeats are linked
one to the next, so a token repeated n times has n - 1 links, and to the evidence among
them, however far off (one link a label). Loopy message passing makes the labels of a
document consistent; tokens inside base spans are evidence.

The weights are trained here, by pseudo-likelihood, on a bounded sample of documents
whose labels are their base spans (without the checks that made them spans, so that
form and context decide). Every whole text is then read where it lies: no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayline.llm.blocks import map_arrow, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents that the weights are trained on at most (those with the smallest hash of the id), and tokens of each.
TRAIN_DOCS, TRAIN_TOKENS = 4_000, 200
#: The belief from which a token is a find of its own, and the change of a message that still counts.
SURE, STILL = 0.8, 1e-6
#: Variables from which a graph is closed (a document is never cut), and messages made at a time: memory, not results.
GRAPH_VARIABLES, ROUND_MESSAGES = 1 << 15, 1 << 15

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits that failed from its first digit fails from the others as well
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_WHITE = "\x20\t\n\r\x0b\x0c"
_GAP = re.compile(r"[\x20\x09-\x0D]")
_EDGE = "()[]{}<>\"'#$%&*|,;:!?.`="


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches in linear time: around each at sign, the run before it and the domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            out.append((start, free))
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind as a place in ``KINDS``, end), by start, then kind; matches that fail a check are dropped."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = (p.lstrip("0") for p in m.group().split("."))
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def variables(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign, without the punctuation around them."""
    out, free, m = [], 0, _ANCHOR.search(text)
    while m:
        at = m.start()
        left = max(free, 1 + max(text.rfind(c, free, at) for c in _WHITE))
        gap = _GAP.search(text, at)
        right = gap.start() if gap else len(text)
        core = text[left:right]
        end = left + len(core.rstrip(_EDGE))
        start = left + len(core) - len(core.lstrip(_EDGE))
        if start < end:
            out.append((start, end))
        free, m = right, _ANCHOR.search(text, right)
    return out


#: Feature numbers: digits by count, dots, hyphens and signs by presence, neighbours, length.
N_FEATURES = 26


def features(token: str, left: bool, right: bool, opened: bool) -> list[int]:
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    size = next(i for i, top in enumerate((0, 1, 3, 4, 6, 9, 13, 19, 1 << 60)) if digits <= top)  # 0..8
    out = [0, 1 + size, 10 + min(3, token.count(".")), 14 + min(3, token.count("-"))]
    flags = ("@" in token, token.startswith("+"), "@" in token and "." in token.split("@")[-1], letters > 0)
    out += [18 + i for i, f in enumerate((*flags, left, right, opened, letters > digits)) if f]
    return out


def keys_of(token: str) -> list[str]:
    """What a token shares with others that are the same or similar."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    out = [f"t{token.lower()}"] if len(token) >= 6 else []
    if len(digits) >= 6:
        out.append(f"d{digits}")
    if "@" in token and len(token.split("@")[0]) >= 4:
        out.append(f"n{token.split('@')[0].lower()}")
    return out


@dataclass
class Graph:
    """Variables of one or more documents: features, evidence (-1: none), chain and skip links.

    ``far`` are (variable, label) for evidence with a key of the variable that no link joins to it.
    """

    rows: list
    seen: list
    chain: list
    skip: list
    far: list = field(default_factory=list)

    @classmethod
    def empty(cls) -> Graph:
        return cls([], [], [], [])

    def add(self, text: str, spans: list[tuple[int, int, int]], most: int | None = None) -> list[tuple[int, int]]:
        """Append a document's variables; the label of a span that a token overlaps is its evidence."""
        tokens = variables(text)[:most]
        first, k, latest = len(self.rows), 0, {}
        linked, labels, keyed = len(self.skip), {}, []
        near = [0 <= b - a <= 3 for (_, a), (b, _) in zip(tokens, tokens[1:])]
        by_end = sorted(spans, key=lambda s: s[2])
        for i, (start, end) in enumerate(tokens):
            left, right = i > 0 and near[i - 1], i < len(near) and near[i]
            token = text[start:end]
            self.rows.append(features(token, left, right, start > 0 and text[start - 1] in "(+"))
            while k < len(by_end) and by_end[k][2] <= start:
                k += 1
            inside = next((s for s in by_end[k : k + 4] if s[0] < end and s[2] > start), None)
            self.seen.append(inside[1] + 1 if inside else -1)
            at = first + i
            if left:
                self.chain.append((at - 1, at))
            keys = keys_of(token)
            for key in keys:
                if latest.get(key, at) < at and (latest[key], at) not in self.skip[-3:]:
                    self.skip.append((latest[key], at))
                latest[key] = at
                if inside:
                    labels.setdefault(key, set()).add(inside[1] + 1)
            if keys and not inside:
                keyed.append((at, keys))
        if labels:
            told = {(a, self.seen[b]) for pair in self.skip[linked:] for a, b in (pair, pair[::-1])}
            for at, keys in keyed:
                of_keys = {label for key in keys for label in labels.get(key, ())}
                self.far += [(at, label) for label in sorted(of_keys) if (at, label) not in told]
        return tokens

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.rows), N_FEATURES))
        for i, row in enumerate(self.rows):
            out[i, row] = 1
        return out

    def weighed(self, weights: np.ndarray) -> np.ndarray:
        """``matrix() @ weights`` without the matrix."""
        parts = []
        for at in range(0, len(self.rows), ROUND_MESSAGES):
            rows = self.rows[at : at + ROUND_MESSAGES]
            first = np.cumsum([0, *map(len, rows[:-1])])
            parts.append(np.add.reduceat(weights[[i for row in rows for i in row]], first))
        return np.concatenate(parts)


def _pairs(links: list) -> np.ndarray:
    return np.array(links, np.int64).reshape(-1, 2)


def _reach(n: int, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each link, how many links the longest way through its connected part has, and whether that has loops."""
    up, depth, loops = list(range(n)), [0] * n, []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    # links lead to later variables, so all ways to a variable are known when it is left
    for a, b in links[np.lexsort((links[:, 0], links[:, 1]))].tolist():
        depth[b] = max(depth[b], depth[a] + 1)
        ra, rb = root(a), root(b)
        up[max(ra, rb)] = min(ra, rb)
        loops += [a] if ra == rb else []
    part = np.array([root(a) for a in links[:, 0].tolist()], np.int64)
    longest = np.zeros(n, np.int64)
    ends = np.array(depth, np.int64)
    np.maximum.at(longest, part, np.maximum(ends[links[:, 0]], ends[links[:, 1]]))
    return longest[part], np.isin(part, [root(a) for a in loops])


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


@dataclass
class SkipChain:
    """Weights of the field: tokens, chain links, skip links."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def train(cls, graph: Graph, steps: int = 400, rate: float = 1.0, decay: float = 1e-3) -> SkipChain:
        """Maximise the pseudo-likelihood: each label given its token and its neighbours' labels."""
        n, k = len(graph.rows), len(LABELS)
        if not n:
            return cls(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)))
        x, y = graph.matrix(), np.maximum(np.array(graph.seen), 0)
        around = []
        for links in (_pairs(graph.chain), _pairs(graph.skip)):
            counts = np.zeros((n, k))
            np.add.at(counts, (links[:, 0], y[links[:, 1]]), 1)
            np.add.at(counts, (links[:, 1], y[links[:, 0]]), 1)
            around.append(counts)
        full = np.hstack([x, *around])
        truth = np.eye(k)[y]
        weights, speed = np.zeros((full.shape[1], k)), np.zeros((full.shape[1], k))
        for _ in range(steps):
            slope = full.T @ (truth - _softmax(full @ weights)) / n - decay * weights
            speed = 0.9 * speed + slope
            weights += rate * speed / 4
        a, b = weights[N_FEATURES : N_FEATURES + k], weights[N_FEATURES + k :]
        return cls(weights[:N_FEATURES], (a + a.T) / 2, (b + b.T) / 2)

    def beliefs(self, graph: Graph, use_evidence: bool = True) -> np.ndarray:
        """Label probabilities of each variable by loopy sum-product until the messages stand still.

        Messages are damped where there are loops and need about two rounds a link there; the
        bound, which only loops that never settle reach, follows the longest way through a variable's own part of the
        graph, so that documents beside each other do not change one another's labels.
        """
        n = len(graph.rows)
        if not n:
            return np.zeros((0, len(LABELS)))
        own = graph.weighed(self.unary)
        seen = np.array(graph.seen)
        if use_evidence:
            # a link to evidence always carries the same message
            far = _pairs(graph.far)
            np.add.at(own, far[:, 0], self.skip[far[:, 1]])
            known = seen >= 0
            own[known] = -50.0
            own[known, seen[known]] = 0.0
        chain, skip = _pairs(graph.chain), _pairs(graph.skip)
        source = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
        target = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
        m = len(source) // 2
        kind = np.repeat([0, 1], [len(chain), len(skip)])
        kind = np.concatenate([kind, kind])
        tables = np.stack([self.chain, self.skip])
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        sent = np.zeros((2 * m, len(LABELS)))
        longest, loops = _reach(n, np.concatenate([chain, skip]))
        bound, pace = np.tile(100 + 4 * longest, 2), np.tile(np.where(loops, 0.5, 1.0)[:, None], (2, 1))
        total, active, done = own.copy(), np.arange(2 * m), 0
        while len(active):
            # only messages whose grounds have changed are made again; a round is made in parts and sent as a whole
            step = np.empty((len(active), len(LABELS)))
            for at in range(0, len(active), ROUND_MESSAGES):
                now = active[at : at + ROUND_MESSAGES]
                out = total[source[now]] - sent[back[now]]
                out = out[:, :, None] + tables[kind[now]]
                top = out.max(1)
                out = top + np.log(np.exp(out - top[:, None, :]).sum(1))
                step[at : at + ROUND_MESSAGES] = pace[now] * (out - out.max(1, keepdims=True) - sent[now])
            sent[active] += step
            np.add.at(total, target[active], step)
            moved = active[np.abs(step).max(1) > STILL]
            again, stirred = np.zeros(2 * m, bool), np.zeros(n, bool)
            again[moved] = stirred[target[moved]] = True
            done += 1
            active = np.flatnonzero((again | stirred[source]) & (done < bound))
        return _softmax(total)


def find_spans(texts: list[str], field: SkipChain) -> list[tuple[list, list]]:
    """For each text its base spans and all spans (with the field's own finds), as (start, kind, end)."""
    out: list[tuple[list, list]] = []
    graph, places, based = Graph.empty(), [], []
    for text in texts:
        base = base_spans(text)
        based.append(base)
        places.append(graph.add(text, base))
        if len(graph.rows) >= GRAPH_VARIABLES:
            out += _spans_of(graph, places, based, field)
            graph, places, based = Graph.empty(), [], []
    return out + _spans_of(graph, places, based, field)


def _spans_of(graph: Graph, places: list, based: list, field: SkipChain) -> list[tuple[list, list]]:
    """The same for the texts of one graph, from their variables and base spans."""
    belief = field.beliefs(graph)
    best = belief.argmax(1) if len(belief) else np.zeros(0, np.int64)
    linked = {b for _, b in graph.chain}
    out, at = [], 0
    for base, tokens in zip(based, places):
        added: list[tuple[int, int, int]] = []
        for start, end in tokens:
            label = int(best[at])
            if label and graph.seen[at] < 0 and belief[at, label] >= SURE:
                joins = added and at in linked and added[-1][1] == label - 1 and last == at - 1
                added[-1:] = [(added[-1][0], label - 1, end)] if joins else [*added[-1:], (start, label - 1, end)]
                last = at
            at += 1
        out.append((base, sorted(base + added)))
    return out


def train_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> SkipChain:
    """Weights from the base spans of at most ``most`` documents with variables."""
    slim = docs.where(F.col(text_col).rlike("[0-9@]")).select(id_col).distinct()
    chosen = slim.orderBy(F.xxhash64(id_col), id_col).limit(most)
    # at most ``most`` ids
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)

    def read(batches):
        for batch in batches:
            rows = []
            for text in batch.column(text_col).to_pylist():
                graph = Graph.empty()
                graph.add(text or "", base_spans(text or ""), TRAIN_TOKENS)
                rows.append({"rows": graph.rows, "seen": graph.seen, "chain": graph.chain, "skip": graph.skip})
            kind = pa.list_(pa.list_(pa.int64()))
            schema = pa.schema([("rows", kind), ("seen", pa.list_(pa.int64())), ("chain", kind), ("skip", kind)])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    got = map_arrow(texts, read, "rows array<array<long>>, seen array<long>, chain array<array<long>>, skip array<array<long>>")
    whole = Graph.empty()
    # the order of arrival must not change the weights
    for r in sorted(got.collect(), key=lambda r: (r["rows"], r["seen"], r["chain"], r["skip"])):
        base = len(whole.rows)
        whole.rows += r["rows"]
        whole.seen += r["seen"]
        whole.chain += [(a + base, b + base) for a, b in r["chain"]]
        whole.skip += [(a + base, b + base) for a, b in r["skip"]]
    return SkipChain.train(whole)


SPAN = "array<struct<kind:string,start:int,end:int>>"
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_pii(docs: DataFrame, field: SkipChain, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: base spans and all spans (kind, start, end in code points, end exclusive).

    NULL and empty texts have none; repeated rows are marked alike; an own column
    of that name is replaced. Spans of different kinds may overlap.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = [c for c in docs.columns if c != out_col]
    schema = StructType([docs.schema[c] for c in names] + StructType.fromDDL(f"`{out_col}` struct<base:{SPAN},spans:{SPAN}>").fields)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                found = find_spans([t or "" for t in part.column(text_col).to_pylist()], shared.value)
                columns = [
                    pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f[i]] for f in found], _SPAN_ARROW)
                    for i in (0, 1)
                ]
                pii = pa.StructArray.from_arrays(columns, ["base", "spans"])
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pii], names=[*names, out_col])

    return map_arrow(docs, run, schema)


def redact(text: str | None, spans) -> str | None:
    """A text with each span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def redact_all(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with personal data replaced, same columns; a NULL text stays NULL."""
    shared = docs.sparkSession.sparkContext.broadcast(train_field(docs, id_col, text_col))
    names = docs.columns

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                found = find_spans([t or "" for t in texts], shared.value)
                clean = [redact(t, [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f[1]]) for t, f in zip(texts, found)]
                column = pa.array(clean, part.column(text_col).type)
                yield pa.RecordBatch.from_arrays([column if c == text_col else part.column(c) for c in names], names=names)

    return map_arrow(docs, run, docs.schema)


def op4_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the base spans, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs, train_field(docs))

    def joined(column: str):
        cells = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(cells, ",")

    def counted(kind: str):
        return F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(counted, KINDS), F.sha2(joined("pii.base").cast("binary"), 256).alias("base_sha256"), joined("pii.spans").alias("spans"),
        (F.size("pii.spans") - F.size("pii.base")).cast("long").alias("n_added"),
    )


QUERIES = {"op4_pii_skip_chain": op4_pii_skip_chain}
ORACLES: dict[str, str] = {}
