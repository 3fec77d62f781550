"""Benchmark decontamination: a broadcast hash set of the items' word windows, then verification.

The items are small and their size is measured: their windows are broadcast in
blocks of at most ``BLOCK_WORDS`` words (about 8 bytes each plus the words
themselves), a round over the documents for each block. Documents never shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayline.llm.blocks import LOWER, byte_rows, free_name, map_arrow, slices, stored, windows_of, words_of

#: Window length in words.
WINDOW = 10
#: Words of benchmark text that one broadcast holds at most; further items go in further rounds.
BLOCK_WORDS = 4_000_000

#: Word bytes after lower-casing: digits, letters, everything beyond ASCII.
ITEM_WORDS = np.zeros(256, bool)
ITEM_WORDS[0x30:0x3A] = ITEM_WORDS[0x61:0x7B] = ITEM_WORDS[0x80:] = True

LEAK = "leak"
LEAK_TYPE = "struct<n_words:long,n_hit:long,item_ids:array<long>,spans:array<struct<start:int,end:int>>>"
LEAK_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("item_ids", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


class ItemWindows:
    """Windows of items by length: sorted hashes, the words behind each, the item of each."""

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        keep = [(i, t) for i, t in zip(ids, texts) if t]
        # an item without an id hits like any other, and is not listed
        self.item_ids = [i for i, _ in keep]
        data, offsets = byte_rows(pa.array([t for _, t in keep], pa.string()))
        data = LOWER[data]
        words = words_of(data, offsets, ITEM_WORDS)
        sizes = np.diff(words.first)
        raw = data.tobytes()
        self.words = [raw[s:e] for s, e in zip(words.start.tolist(), words.end.tolist())]
        for length in sorted({min(window, n) for n in sizes.tolist() if n}):
            at, hashes = windows_of(words, length)
            whole = sizes[words.doc[at]]
            used = whole >= window if length == window else whole == length
            at, hashes = at[used], hashes[used]
            order = np.argsort(hashes, kind="stable")
            self.by_length[length] = (hashes[order], at[order], words.doc[at[order]])

    def find(self, data: np.ndarray, offsets: np.ndarray):
        """Words of the documents and, for each verified hit, (document, word place, length, item)."""
        data = LOWER[data]
        words = words_of(data, offsets, ITEM_WORDS)
        raw, hits = data, []
        for length, (hashes, places, items) in self.by_length.items():
            at, found = windows_of(words, length)
            if not len(at) or not len(hashes):
                continue
            low = np.searchsorted(hashes, found, "left")
            candidate = np.flatnonzero(hashes[np.minimum(low, len(hashes) - 1)] == found)
            for c in candidate.tolist():
                place = int(at[c])
                own = [
                    raw[words.start[w] : words.end[w]].tobytes() for w in range(place, place + length)
                ]
                k = int(low[c])
                while k < len(hashes) and hashes[k] == found[c]:
                    if self.words[places[k] : places[k] + length] == own:
                        hits.append((int(words.doc[place]), place, length, int(items[k])))
                    k += 1
        return words, hits


def _marks(items: ItemWindows, column: pa.Array) -> list[dict]:
    data, offsets = byte_rows(column)
    words, hits = items.find(data, offsets)
    covered = np.zeros(len(words.start) + 1, np.int64)
    found: dict[int, set[int]] = {}
    for doc, place, length, item in hits:
        covered[place] += 1
        covered[place + length] -= 1
        found.setdefault(doc, set()).add(item)
    inside = np.cumsum(covered[:-1]) > 0
    out = []
    counts = np.diff(words.first).tolist()
    for doc, n in enumerate(counts):
        if doc not in found:
            out.append({"n_words": n, "n_hit": 0, "item_ids": [], "spans": []})
            continue
        lo, hi = int(words.first[doc]), int(words.first[doc + 1])
        mask = inside[lo:hi]
        edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
        text = data[offsets[doc] : offsets[doc + 1]]
        points = np.cumsum((text & 0xC0) != 0x80)
        spans = [
            {
                "start": int(points[words.start[lo + a] - offsets[doc]]) - 1,
                "end": int(points[words.end[lo + b - 1] - offsets[doc] - 1]),
            }
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
        ]
        ids = sorted({items.item_ids[i] for i in found[doc]} - {None})
        out.append({"n_words": n, "n_hit": int(mask.sum()), "item_ids": ids, "spans": spans})
    return out


def _item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int):
    """Items in blocks of bounded size, streamed through the driver one block at a time."""
    ids, texts, size = [], [], 0
    for item_id, text in items.select(id_col, text_col).orderBy(id_col).toLocalIterator():
        words = len(text or "") // 2 + 1
        if ids and size + words > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += words
    yield ids, texts


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
    out_col: str = LEAK,
    cut_above: float | None = None,
) -> DataFrame:
    """``docs`` with one column ``out_col``: n_words, n_hit, item_ids (sorted), hit spans (code points).

    NULL and empty texts have no words and no hits; items without words match nothing;
    items without an id hit but are not listed, and a repeated id is listed once; repeated rows are marked alike. Beyond ``block_words``
    the items are dealt over several rounds, whose marks are merged per document.
    With ``cut_above`` there is no such column: documents with a larger share of hit
    words go, and the others lose their hit spans.
    """
    blocks = _item_blocks(items, item_id, item_text, block_words)
    out, later, block = docs.drop(out_col), False, next(blocks)
    while block is not None:
        following = next(blocks, None)
        # the last round cuts, if that is asked
        share = cut_above if following is None else None
        # a further round starts from a written table: one broadcast is alive at a time
        out = _round(stored(out, "leaks") if later else out, text_col, ItemWindows(*block), later, out_col, share)
        later, block = True, following
    return out


def _round(docs: DataFrame, text_col: str, items: ItemWindows, later: bool, out_col: str, cut_above: float | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = [c for c in docs.columns if c != out_col]
    made = StructType.fromDDL(f"`{out_col}` {LEAK_TYPE}").fields if cut_above is None else []
    schema = StructType([docs.schema[c] for c in names] + made)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                column = part.column(text_col)
                rows = _marks(shared.value, column)
                if later:
                    before = part.column(out_col).to_pylist()
                    rows = [_merged(a, b, column, i) for i, (a, b) in enumerate(zip(before, rows))]
                if cut_above is None:
                    columns = [part.column(c) for c in names] + [pa.array(rows, LEAK_ARROW)]
                else:
                    clean = [cut_spans(t, r["spans"]) for t, r in zip(column.to_pylist(), rows)]
                    stays = pa.array([r["n_hit"] <= cut_above * r["n_words"] for r in rows], pa.bool_())
                    columns = [pa.array(clean, column.type) if c == text_col else part.column(c) for c in names]
                    columns = [c.filter(stays) for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs, run, schema)


def _merged(a: dict, b: dict, column: pa.Array, row: int) -> dict:
    """One document's marks of two rounds: the union of spans, its words counted again."""
    spans: list[dict] = []
    for s in sorted(a["spans"] + b["spans"], key=lambda s: s["start"]):
        if spans and s["start"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], s["end"])
        else:
            spans.append(dict(s))
    text = column[row].as_py() or ""
    data, offsets = byte_rows(pa.array([text[s["start"] : s["end"]] for s in spans], pa.string()))
    hit = len(words_of(LOWER[data], offsets, ITEM_WORDS).start)
    ids = sorted({*a["item_ids"], *b["item_ids"]})
    return {"n_words": a["n_words"], "n_hit": hit, "item_ids": ids, "spans": spans}


def cut_spans(text: str | None, spans) -> str | None:
    """A text without its hit spans; what stays is joined without the words between."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for s in spans:
        out.append(text[at : s["start"]])
        at = s["end"]
    out.append(text[at:])
    return "".join(out)


def remove_hits(docs: DataFrame, items: DataFrame, drop_share: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without benchmark passages, same columns.

    A document with more than ``drop_share`` of its words hit is removed whole;
    otherwise only the hit spans go. A NULL text stays NULL.
    """
    return find_items(docs, items, text_col, out_col=free_name(docs, LEAK), cut_above=drop_share)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark windows in all documents, one row per document row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    leak = find_items(docs, items)
    # ids as strings in string order, so that 10 stands before 9
    ordered = F.array_sort(F.transform("leak.item_ids", lambda i: i.cast("string")))
    return leak.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ordered, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


QUERIES = {"op5_decontaminate": op5_decontaminate}
ORACLES: dict[str, str] = {}
