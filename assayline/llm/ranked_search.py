"""Ranked lexical search: Block-Max MaxScore over shards of an inverted index, shard heaps merged.

The documents stay where they are: each task turns its own into shards of bounded size
and writes them to the shared folder. A shard holds a list of postings for each term of
the queries, in blocks of ``BLOCK`` postings packed to one or two bytes a document and
one or four bytes a frequency, and, unpacked, for each block its competitive pairs
(frequency, length of the document): those that no other posting of the block beats in
both. So a block's exact maximum is known for any average length, which only the whole
table tells, without unpacking it.

A query meets a shard list by list. The lists' maxima, in rising order, are summed until
they could reach the query's tenth best score so far: lists before that are not
essential, as no document can enter the heap by them alone. The essential lists are
unpacked and summed; a candidate's sum plus the maxima of the blocks that hold its
number in the other lists rejects it, or decides which blocks are unpacked. Heaps go on
over all shards of a task; the tasks' heaps are merged in two steps.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from assayline.llm.blocks import LOWER, byte_rows, map_arrow, slices, stored, words_of

TOP = 10
#: Postings of a block.
BLOCK = 64
#: A shard is closed at so many documents or postings; a document's number in it fits two bytes.
SHARD_DOCS = 16_384
SHARD_POSTINGS = 1_000_000
#: Terms of the items that are searched in one round over the documents; more items go in further rounds.
ROUND_TERMS = 1_000_000
#: Parts that the tasks' heaps of one item are merged in first.
PARTS = 64

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of terms after A-Z are lower-cased: digits, letters, everything beyond ASCII.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[0x30:0x3A] = TERM_BYTES[0x61:0x7B] = TERM_BYTES[0x80:] = True
_LOWERED = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Arrays of a shard that are kept as bytes, with their types.
ARRAYS = {
    "lengths": np.int64, "list_blocks": np.int64, "first": np.int32, "last": np.int32, "size": np.int32,
    "doc_wide": np.bool_, "doc_at": np.int32, "docs8": np.uint8, "docs16": np.uint16,
    "tf_wide": np.bool_, "tf_at": np.int32, "tfs8": np.uint8, "tfs32": np.uint32,
    "pair_at": np.int64, "pair_tf": np.int64, "pair_n": np.int64,
}
SHARD = (
    "docs_with_terms long, all_terms long, doc_ids array<long>, terms array<int>, dfs array<long>, "
    + ", ".join(f"{name} binary" for name in ARRAYS)
)


def terms_of(text: str | None) -> list[str]:
    """Distinct terms of a text, in order of first use."""
    return list(dict.fromkeys(TERM.findall((text or "").translate(_LOWERED))))


class Terms:
    """The terms that are indexed, found in texts by hash and verified byte by byte."""

    def __init__(self, terms: list[str]):
        data, offsets = byte_rows(pa.array(terms, pa.string()))
        # hashes as the documents' words get them
        hashes = words_of(data, offsets, TERM_BYTES).hash
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.data, self.offsets = data, offsets

    def find(self, data: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
        """(word places, terms) of all words that are terms."""
        if not len(self.hashes) or not len(words.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[low] == words.hash)
        term = self.order[low[at]]
        same = self._same(data, words, at, term)
        if not same.all():
            # two terms of one hash, or a word that only shares it: try the terms behind
            at, term = self._others(data, words, at, term, same, low)
        return at, term

    def _same(self, data, words, at, term) -> np.ndarray:
        size = self.offsets[term + 1] - self.offsets[term]
        out = words.end[at] - words.start[at] == size
        rows = np.flatnonzero(out)
        size = size[rows]
        if not len(rows):
            return out
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        within = np.arange(size.sum()) - np.repeat(begin, size)
        ours = data[np.repeat(words.start[at[rows]], size) + within]
        theirs = self.data[np.repeat(self.offsets[term[rows]], size) + within]
        out[rows] = np.logical_and.reduceat(ours == theirs, begin)
        return out

    def _others(self, data, words, at, term, same, low):
        keep_at, keep_term = [at[same]], [term[same]]
        place, left = low[at[~same]] + 1, at[~same]
        while len(left):
            more = (place < len(self.hashes)) & (self.hashes[np.minimum(place, len(self.hashes) - 1)] == words.hash[left])
            left, place = left[more], place[more]
            found = self.order[place]
            ok = self._same(data, words, left, found) if len(left) else np.zeros(0, bool)
            keep_at.append(left[ok])
            keep_term.append(found[ok])
            left, place = left[~ok], place[~ok] + 1
        at, term = np.concatenate(keep_at), np.concatenate(keep_term)
        order = np.argsort(at, kind="stable")
        return at[order], term[order]


class ShardWriter:
    """Documents and postings of a shard that is being filled."""

    def __init__(self) -> None:
        self.doc_ids: list = []
        self.lengths: list[np.ndarray] = []
        self.postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, ids: list, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray) -> None:
        """Documents with the place (within them) and the term of every hit."""
        key, tf = np.unique(term * np.int64(len(ids)) + doc, return_counts=True)
        self.postings.append((key // len(ids), key % len(ids) + len(self.doc_ids), tf))
        self.doc_ids += ids
        self.lengths.append(lengths)
        self.held += len(key)

    def full(self) -> bool:
        return len(self.doc_ids) >= SHARD_DOCS or self.held >= SHARD_POSTINGS

    def row(self) -> dict:
        lengths = np.concatenate(self.lengths)
        term, doc, tf = (np.concatenate(c) for c in zip(*self.postings))
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        made = pack(term, doc, tf, lengths)
        return {
            "docs_with_terms": int((lengths > 0).sum()),
            "all_terms": int(lengths.sum()),
            "doc_ids": self.doc_ids,
            "terms": made.pop("terms").tolist(),
            "dfs": made.pop("dfs").tolist(),
            **{name: made[name].astype(kind).tobytes() for name, kind in ARRAYS.items()},
        }


def pack(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks of postings that are sorted by term and document."""
    n = len(term)
    new_list = np.ones(n, bool)
    new_list[1:] = term[1:] != term[:-1]
    starts = np.flatnonzero(new_list)
    dfs = np.diff(np.append(starts, n))
    place = np.arange(n) - np.repeat(starts, dfs)
    block_start = np.flatnonzero(place % BLOCK == 0)
    sizes = np.diff(np.append(block_start, n))
    block = np.repeat(np.arange(len(block_start)), sizes)
    delta = np.zeros(n, np.int64)
    delta[1:] = doc[1:] - doc[:-1]
    delta[block_start] = 0

    def streams(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which blocks are wide, each one's place in its stream, the narrow and the wide stream."""
        wide = np.maximum.reduceat(values, block_start) > 255 if n else np.zeros(0, bool)
        at = np.zeros(len(wide), np.int64)
        for kind in (False, True):
            own = sizes[wide == kind]
            at[wide == kind] = np.cumsum(own) - own
        return wide, at, values[~wide[block]], values[wide[block]]

    doc_wide, doc_at, docs8, docs16 = streams(delta)
    tf_wide, tf_at, tfs8, tfs32 = streams(tf)
    # competitive pairs: from high frequencies to low, those of a length below all before
    own_n = lengths[doc]
    order = np.lexsort((own_n, -tf, block))
    far = np.int64(1) << 40  # beyond any length in terms
    falling = own_n[order] - block[order] * far
    least = np.minimum.accumulate(falling)
    kept = np.ones(n, bool)
    kept[1:] = falling[1:] < least[:-1]
    kept = order[kept]
    return {
        "terms": term[starts], "dfs": dfs, "lengths": lengths,
        "list_blocks": np.append(np.searchsorted(block_start, starts), len(block_start)),
        "first": doc[block_start], "last": doc[block_start + sizes - 1], "size": sizes,
        "doc_wide": doc_wide, "doc_at": doc_at, "docs8": docs8, "docs16": docs16,
        "tf_wide": tf_wide, "tf_at": tf_at, "tfs8": tfs8, "tfs32": tfs32,
        "pair_at": np.searchsorted(block[kept], np.arange(len(block_start))),
        "pair_tf": tf[kept], "pair_n": own_n[kept],
    }


def impact(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """A posting's part of the score before the term's weight; whole numbers."""
    m = 10 + 90 * n * docs // terms
    return 1_000_000_000 * tf // (1_000 * tf + 8 * m)


class Shard:
    """A shard that is searched. Blocks are unpacked when asked for and kept while it is."""

    def __init__(self, row: dict, docs: int, terms: int):
        for name, kind in ARRAYS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.docs, self.all_terms = docs, terms
        self.doc_ids = row["doc_ids"]
        self.lists = {t: i for i, t in enumerate(row["terms"])}
        best = impact(self.pair_tf, self.pair_n, docs, terms)
        self.block_max = np.maximum.reduceat(best, self.pair_at) if len(self.pair_at) else np.zeros(0, np.int64)
        at = self.list_blocks
        self.list_max = np.maximum.reduceat(self.block_max, at[:-1]) if len(at) > 1 else np.zeros(0, np.int64)
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        have = self.blocks.get(b)
        if have is None:
            self.unpacked += 1
            size, at, tf_at = int(self.size[b]), int(self.doc_at[b]), int(self.tf_at[b])
            delta = (self.docs16 if self.doc_wide[b] else self.docs8)[at : at + size]
            tf = (self.tfs32 if self.tf_wide[b] else self.tfs8)[tf_at : tf_at + size].astype(np.int64)
            doc = np.cumsum(delta, dtype=np.int64) + self.first[b]
            have = self.blocks[b] = (doc, impact(tf, self.lengths[doc], self.docs, self.all_terms))
        return have

    def list(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """All documents and impacts of a list."""
        have = self.whole.get(i)
        if have is None:
            parts = [self.block(b) for b in range(self.list_blocks[i], self.list_blocks[i + 1])]
            have = self.whole[i] = tuple(np.concatenate(c) for c in zip(*parts))
        return have

    def some(self, i: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each (rising) document the number of the block of list i that may hold it (-1: none) and its maximum."""
        a, b = self.list_blocks[i], self.list_blocks[i + 1]
        at = a + np.searchsorted(self.last[a:b], docs)
        inside = at < b
        inside[inside] = self.first[at[inside]] <= docs[inside]
        return np.where(inside, at, -1), np.where(inside, self.block_max[np.minimum(at, b - 1)], 0)


@dataclass
class Heap:
    """The best (score, document id) so far; ids NULL are last among equals."""

    top: int
    rows: list[tuple[int, bool, int]] = field(default_factory=list)  # -score, id is NULL, id

    @property
    def least(self) -> int:
        """A document below this score cannot enter; one at it may, by its id."""
        return -self.rows[-1][0] if len(self.rows) >= self.top else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows = sorted(self.rows + [(-s, i is None, i or 0) for s, i in zip(scores.tolist(), ids)])[: self.top]


def search_shard(shard: Shard, weights: list[tuple[int, int]], heap: Heap) -> None:
    """Block-Max MaxScore of one query, given as (term, weight), in one shard."""
    lists = sorted((w * int(shard.list_max[i]), i, w) for t, w in weights if w > 0 and (i := shard.lists.get(t)) is not None)
    if not lists:
        return
    least, below, essential = heap.least, 0, 0
    while essential < len(lists) and below + lists[essential][0] < least:
        below += lists[essential][0]
        essential += 1
    if essential == len(lists):
        return
    total = np.zeros(len(shard.doc_ids), np.int64)
    for _, i, w in lists[essential:]:
        docs, impacts = shard.list(i)
        total[docs] += w * impacts
    docs = np.flatnonzero(total + below >= max(least, 1 + below))
    known, bound = total[docs], total[docs] + below
    others = lists[:essential][::-1]
    blocks: list[tuple[np.ndarray, np.ndarray]] = []
    for most, i, w in others:
        at, high = shard.some(i, docs)
        bound = bound - most + w * high
        stay = bound >= least
        docs, known, bound = docs[stay], known[stay], bound[stay]
        blocks = [(a[stay], h[stay]) for a, h in blocks] + [(at[stay], w * high[stay])]
        if not len(docs):
            return
    for k, (_, _, w) in enumerate(others):
        at, high = blocks[k]
        found = np.zeros(len(docs), np.int64)
        for b in np.unique(at[at >= 0]).tolist():
            own, impacts = shard.block(b)
            rows = np.flatnonzero(at == b)
            place = np.minimum(np.searchsorted(own, docs[rows]), len(own) - 1)
            found[rows] = np.where(own[place] == docs[rows], w * impacts[place], 0)
        known = known + found
        bound = bound - high + found
        stay = bound >= least
        docs, known, bound = docs[stay], known[stay], bound[stay]
        blocks = [(a[stay], h[stay]) for a, h in blocks]
        if not len(docs):
            return
    if len(docs) > heap.top:
        # ties of the last place are all kept: ids decide
        edge = np.partition(known, len(known) - heap.top)[len(known) - heap.top]
        docs, known = docs[known >= edge], known[known >= edge]
        if len(docs) > 4 * heap.top:
            ids = [(shard.doc_ids[d] is None, shard.doc_ids[d] or 0) for d in docs.tolist()]
            order = sorted(range(len(docs)), key=lambda r: (-known[r], ids[r]))[: heap.top]
            docs, known = docs[order], known[order]
    heap.add(known, [shard.doc_ids[d] for d in docs.tolist()])


# -- on Spark


def build_index(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of all documents with lists for ``terms``, written to the shared folder; documents do not shuffle.

    Every row is a document; NULL and empty texts count as documents without terms.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Terms(terms))
    schema = StructType.fromDDL(SHARD)
    made = to_arrow_schema(schema)

    def run(batches):
        writer = ShardWriter()
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = byte_rows(part.column("text"))
                data = LOWER[data]
                words = words_of(data, offsets, TERM_BYTES)
                at, term = shared.value.find(data, words)
                writer.add(part.column("id").to_pylist(), np.diff(words.first), words.doc[at], term)
                if writer.full():
                    yield pa.RecordBatch.from_pylist([writer.row()], made)
                    writer = ShardWriter()
        if writer.doc_ids:
            yield pa.RecordBatch.from_pylist([writer.row()], made)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return stored(map_arrow(rows, run, schema), "shards")


def weights_of(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, all their terms, and the weight of each indexed term that occurs."""
    docs, terms = index.agg(F.sum("docs_with_terms"), F.sum("all_terms")).first()
    # one number a term of this round
    pairs = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p"))
    rows = pairs.groupBy("p.terms").agg(F.sum("p.dfs").alias("df")).collect()
    return docs or 0, terms or 0, {r["terms"]: math.floor(1000 * math.log((2 * docs + 2) / (2 * r["df"] + 1))) for r in rows}


def _rounds(items: DataFrame, item_id: str, item_text: str, limit: int):
    """Items as (id, terms) in rounds of bounded size, streamed through the driver one round at a time."""
    held, size = [], 0
    rows = items.select(F.col(f"`{item_id}`"), F.col(f"`{item_text}`")).orderBy(*(f"`{c}`" for c in (item_id, item_text)))
    for own, text in rows.toLocalIterator():
        terms = terms_of(text)
        if held and size + len(terms) > limit:
            yield held
            held, size = [], 0
        held.append((own, terms))
        size += len(terms)
    if held:
        yield held


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    round_terms: int = ROUND_TERMS,
) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score.

    Equal scores are ordered by document id, NULL last; scores of 0 are no results.
    Every row of ``items`` is an item, also where ids repeat or are NULL; items and
    documents without terms have no results. The items' terms are broadcast, at most
    ``round_terms`` of them at a time, a round over the documents for each.
    """
    out = None
    for number, held in enumerate(_rounds(items, item_id, item_text, round_terms)):
        found = _round(docs, held, items.schema[item_id].dataType, top, doc_id, text_col)
        found = found.withColumn("round", F.lit(number))
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = StructType().add("item_id", items.schema[item_id].dataType).add("rank", "integer")
        return docs.sparkSession.createDataFrame([], empty.add("doc_id", "long").add("score", "long"))
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["round", "item", "part"], ["round", "item"]):
        own = Window.partitionBy(*keys).orderBy(*best)
        out = out.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)
    return out.select("item_id", "rank", "doc_id", "score")


def _round(docs: DataFrame, held: list, id_type, top: int, doc_id: str, text_col: str) -> DataFrame:
    numbers = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in held for t in terms))}
    index = build_index(docs, list(numbers), doc_id, text_col)
    n_docs, n_terms, weights = weights_of(index)
    queries = [[(numbers[t], weights[numbers[t]]) for t in terms if numbers[t] in weights] for _, terms in held]
    shared = docs.sparkSession.sparkContext.broadcast((queries, [own for own, _ in held]))
    schema = StructType.fromDDL("item int, part int, doc_id long, score long").add("item_id", id_type)
    made = to_arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        queries, ids = shared.value
        heaps = [Heap(top) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], n_docs, n_terms)
                for query, heap in zip(queries, heaps):
                    search_shard(shard, query, heap)
        part = TaskContext.get().partitionId() % PARTS
        rows = [
            {"item": item, "part": part, "doc_id": None if none else own, "score": -score, "item_id": ids[item]}
            for item, heap in enumerate(heaps)
            for score, none, own in heap.rows
        ]
        yield pa.RecordBatch.from_pylist(rows, made)

    if not n_terms:
        return docs.sparkSession.createDataFrame([], schema)
    return map_arrow(index.drop("docs_with_terms", "all_terms", "dfs"), run, schema)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(docs, items)


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

QUERIES = {"op13_ranked_search": op13_ranked_search}
ORACLES = {
    "op13_ranked_search": rf"""
WITH doc AS (SELECT row_number() OVER () AS d, doc_id, {_SPLIT} AS words FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT d, doc_id, CAST(len(words) AS BIGINT) AS n FROM doc WHERE len(words) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(words) AS term FROM doc) GROUP BY d, term),
item AS (SELECT row_number() OVER () AS i, item_id, {_SPLIT} AS words FROM benchmark WHERE text IS NOT NULL),
wanted AS (SELECT DISTINCT i, item_id, term FROM (SELECT i, item_id, unnest(words) AS term FROM item)),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM tf, whole GROUP BY term),
scored AS (
  SELECT i, item_id, doc_id, d,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN sizes USING (d), whole
  GROUP BY i, item_id, doc_id, d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
}
