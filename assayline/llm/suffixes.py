"""Exact substring dedup by longest previous factors: later copies of long byte strings go, the first stays.

For every byte position the longest previous factor is the longest string that starts
there and also starts in a document of a smaller id. Suffix order gives it: among the
sorted suffixes the nearest earlier and the nearest later one of a smaller document
share the most with a suffix. A position is hit if that is at least ``LEAST`` bytes.

Only strings that can be hit are sorted, found in four questions (see ``chunks``):

1. The window of ``LEAST`` bytes at a position is filed under the smallest hash of the
   ``GRAM``-byte strings in it. Equal windows have equal hashes, and neighbouring
   windows mostly share one, so windows come in runs. Which hashes are in two documents?
2. Runs of such hashes: which are equal, as a whole, to a run of an earlier document?
   All their windows are hit.
3. The first of each of these runs: which of its windows are in two documents (the
   hashes of the windows are asked)?
4. Those windows' suffixes, dealt by their first ``LEAST`` bytes, are sorted, and
   previous and next smaller documents tell the longest previous factor of each.

Every question is keyed by content as long as what it asks about, so a passage that
very many documents share costs one entry per chunk, whatever stands around it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.blocks import BYTE_VALUES, map_arrow, mix, powers, shares
from assayline.llm.chunks import Chunk, Question, answers_of, ask, bucket_count, later, pack_chunks, read_chunk, starts_of

#: Bytes of the shortest string that is removed, and of the strings whose hashes file it.
LEAST, GRAM = 50, 24
WORDS = -(-LEAST // 8)

RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def smaller_neighbours(ranks: list[int]) -> tuple[list[int], list[int]]:
    """For each place the nearest earlier and later place of a smaller rank (-1, len: none), with a stack."""
    n = len(ranks)
    before, after, stack = [-1] * n, [n] * n, []
    for i, rank in enumerate(ranks):
        while stack and ranks[stack[-1]] > rank:
            after[stack.pop()] = i
        # equal ranks do not count as smaller: pass over them
        j = stack[-1] if stack else -1
        before[i] = before[j] if j >= 0 and ranks[j] == rank else j
        stack.append(i)
    return before, after


def previous_factors(suffixes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Longest previous factors, in bytes, of suffixes given by their first bytes (rows of uint8).

    Rows that start with the same bytes are sorted side by side; the common prefix
    with a place further off is the smallest common prefix on the way.
    """
    n, width = suffixes.shape
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = suffixes
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    sorted_rows = suffixes[order]
    differs = sorted_rows[1:] != sorted_rows[:-1]
    common = np.where(differs.any(1), differs.argmax(1), width)
    # places without any common byte with the next one cut the order in groups
    cuts = np.flatnonzero(common == 0) + 1
    for group in np.split(np.arange(n), cuts):
        if len(group) > 1:
            place = order[group]
            _fill(out, place, ranks[place].tolist(), common[group[0] : group[-1]].tolist())
    return out


def _fill(out: np.ndarray, place: np.ndarray, ranks: list[int], common: list[int]) -> None:
    before, after = smaller_neighbours(ranks)
    n = len(ranks)
    best = [0] * n
    # smallest common prefix to the smaller neighbour, along the chain of places in between
    for neighbour, step, run in ((before, -1, range(n)), (after, 1, range(n - 1, -1, -1))):
        reach = [0] * n
        for i in run:
            j = i + step
            if not 0 <= j < n:
                continue
            low = common[min(i, j)]
            while j != neighbour[i]:
                low = min(low, reach[j])
                j = neighbour[j]
                if not 0 <= j < n:
                    low = 0
                    break
            reach[i] = low
            best[i] = max(best[i], low)
    out[place] = best


@dataclass
class Runs:
    """Runs of windows with one smallest hash: first window, number, document, hash, hash of all bytes."""

    start: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    whole: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray

    def hashes(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[at + size] - self.sums[at]) * self.inverse[at] + np.asarray(size, np.uint64))


def runs_of(chunk: Chunk) -> Runs:
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(n), out=sums[1:])
    inverse = powers(n + 1, inverse=True)
    none = np.zeros(0, np.int64)
    if n < LEAST:
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64), sums, inverse)
    low = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    # smallest of LEAST - GRAM + 1 neighbours by doubling
    span, width = 1, LEAST - GRAM + 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    sizes = np.diff(offsets)
    valid = np.ones(n - LEAST + 1, bool)
    # windows that would reach over the end of a document
    for end in offsets[1:].tolist():
        valid[max(0, end - LEAST + 1) : end] = False
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    start = np.flatnonzero(new)
    doc = np.searchsorted(offsets, start, "right") - 1
    next_start = np.append(start[1:], len(valid))
    count = np.minimum(next_start, offsets[doc] + sizes[doc] - LEAST + 1) - start
    # smallest hashes lie near 0; spread them again over all bits
    runs = Runs(start, count, doc, mix(low[start] + np.uint64(1)), none, sums, inverse)
    runs.whole = runs.hashes(start, count + LEAST - 1)
    return runs


class Questions:
    """What chunks send and how buckets answer; a chunk's own answers are read back in the same order."""

    def __init__(self, bits: int):
        #: leading bits of the hashes that the first and third question send
        self.mask = np.uint64(((1 << bits) - 1) << (64 - bits))

    def _shared_keys(self, key: np.ndarray, ids: np.ndarray):
        """Columns of distinct leading bits, sorted; the order of the rows; where each begins."""
        key = key & self.mask
        order = np.argsort(key, kind="stable")
        first = starts_of(key[order])
        many = np.zeros(0, np.uint8)
        if len(first):
            many = (np.minimum.reduceat(ids[order], first) != np.maximum.reduceat(ids[order], first)).astype(np.uint8)
        return {"key": key[order][first], "many": many}, order, first

    @staticmethod
    def shared(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
        """1 for keys of two documents, in one chunk or in two."""
        order = np.argsort(columns["key"], kind="stable")
        first = starts_of(columns["key"][order])
        sizes = np.diff(np.append(first, len(order)))
        yes = (sizes > 1) | (np.maximum.reduceat(columns["many"][order], first) > 0)
        out = np.zeros(len(order), np.uint8)
        out[order] = np.repeat(yes, sizes)
        return out

    @staticmethod
    def of_two(columns: dict[str, np.ndarray], first: np.ndarray) -> dict[str, np.ndarray]:
        """``many`` of keys that several senders have become one."""
        sizes = np.diff(np.append(first, len(columns["key"])))
        return {"many": np.maximum(np.maximum.reduceat(columns["many"], first), sizes > 1)}

    # 1: hashes in two documents
    def hashes(self, chunk: Chunk, _=None) -> dict[str, np.ndarray]:
        runs = runs_of(chunk)
        return self._shared_keys(runs.key, chunk_ids(chunk, runs.doc))[0]

    # 2: runs equal to earlier ones
    def contents(self, chunk: Chunk, answers: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return self._contents(chunk, runs_of(chunk), answers)[0]

    def _contents(self, chunk: Chunk, runs: Runs, answers):
        """Columns of distinct runs; chosen runs in their order; the place of each in the columns."""
        _, order, first = self._shared_keys(runs.key, chunk_ids(chunk, runs.doc))
        chosen = order[np.repeat(answers["shared"] > 0, np.diff(np.append(first, len(order))))]
        ids = chunk_ids(chunk, runs.doc[chosen])
        inner = np.lexsort((runs.start[chosen], ids, runs.key[chosen], runs.whole[chosen]))
        chosen, ids = chosen[inner], ids[inner]
        at = starts_of(runs.whole[chosen], runs.key[chosen])
        columns = {"key": runs.whole[chosen][at], "check": runs.key[chosen][at], "id": ids[at]}
        return columns, chosen, np.repeat(np.arange(len(at)), np.diff(np.append(at, len(chosen))))

    @staticmethod
    def compared(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
        """1 where a smaller document has the whole run."""
        key, check, ids = columns["key"], columns["check"], columns["id"]
        order = np.lexsort((ids, check, key))
        first = starts_of(key[order], check[order])
        least = np.repeat(ids[order][first], np.diff(np.append(first, len(order))))
        out = np.zeros(len(order), np.uint8)
        out[order] = least < ids[order]
        return out

    # 3: windows of the first runs that are in two documents
    def windows(self, chunk: Chunk, answers: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        runs = runs_of(chunk)
        _, ids, key = self._windows(chunk, runs, self._contents(chunk, runs, answers), answers)
        return self._shared_keys(key, ids)[0]

    def _windows(self, chunk: Chunk, runs: Runs, contents, answers):
        """Place, document id and hash of the windows in runs that no smaller document has as a whole."""
        columns, chosen, place = contents
        open_ = chosen[(answers["compared"] == 0)[place] & (chunk_ids(chunk, runs.doc[chosen]) == columns["id"][place])]
        at = np.repeat(runs.start[open_], runs.count[open_]) + _counted(runs.count[open_])
        ids = chunk_ids(chunk, np.repeat(runs.doc[open_], runs.count[open_]))
        return at, ids, runs.hashes(at, LEAST) if len(at) else np.zeros(0, np.uint64)

    # 4: longest previous factors of the suffixes at those windows
    def suffixes(self, chunk: Chunk, answers: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        runs = runs_of(chunk)
        return self._suffixes(chunk, runs, self._contents(chunk, runs, answers), answers)[0]

    def _suffixes(self, chunk: Chunk, runs: Runs, contents, answers):
        """Columns of distinct suffixes; all suffixes in their order; the place of each in the columns."""
        at, ids, key = self._windows(chunk, runs, contents, answers)
        _, order, first = self._shared_keys(key, ids)
        chosen = order[np.repeat(answers["windows"] > 0, np.diff(np.append(first, len(order))))]
        at, ids, key = at[chosen], ids[chosen], key[chosen]
        order = np.lexsort((at, ids, key))
        at, ids, key = at[order], ids[order], key[order]
        first = starts_of(key)
        rows = np.zeros((len(first), WORDS * 8), np.uint8)
        if len(first):
            rows[:, :LEAST] = chunk.data[at[first][:, None] + np.arange(LEAST)]
        words = rows.view("<u8")
        out = {"key": key[first], "id": ids[first]} | {f"w{i}": np.ascontiguousarray(words[:, i]) for i in range(WORDS)}
        return out, at, ids, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))

    @staticmethod
    def factors(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
        """1 where the longest previous factor has ``LEAST`` bytes."""
        key = columns["key"]
        # suffixes without a partner under their key have no factor of that length
        order = np.argsort(key, kind="stable")
        first = starts_of(key[order])
        sizes = np.diff(np.append(first, len(order)))
        rows = order[np.repeat(sizes > 1, sizes)]
        out = np.zeros(len(key), np.uint8)
        if len(rows):
            words = np.stack([columns[f"w{i}"][rows] for i in range(WORDS)], axis=1)
            prefix = np.ascontiguousarray(words).view(np.uint8)[:, :LEAST]
            out[rows] = previous_factors(prefix, columns["id"][rows]) >= LEAST
        return out

    # all of a chunk's bytes that go
    def removed(self, chunk: Chunk, answers: dict[str, np.ndarray]) -> np.ndarray:
        runs = runs_of(chunk)
        contents = self._contents(chunk, runs, answers)
        columns, chosen, place = contents
        ids = chunk_ids(chunk, runs.doc[chosen])
        earlier = (answers["compared"] > 0)[place] | (ids > columns["id"][place])
        cover = np.zeros(len(chunk.data) + 1, np.int64)
        np.add.at(cover, runs.start[chosen[earlier]], 1)
        np.add.at(cover, runs.start[chosen[earlier]] + runs.count[chosen[earlier]] + LEAST - 1, -1)
        suffixes, at, owners, row = self._suffixes(chunk, runs, contents, answers)
        hit = (answers["factors"] > 0)[row] | (owners > suffixes["id"][row])
        np.add.at(cover, at[hit], 1)
        np.add.at(cover, at[hit] + LEAST, -1)
        return np.cumsum(cover[:-1]) > 0


def chunk_ids(chunk: Chunk, docs: np.ndarray) -> np.ndarray:
    return chunk.doc_ids()[docs] if len(docs) else np.zeros(0, np.int64)


def _counted(counts: np.ndarray) -> np.ndarray:
    """0..count-1 for each count, one after another."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


def remove_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: bytes, removed spans (bytes, end exclusive, ascending) and the bytes that stay.

    A byte goes if a string of ``LEAST`` bytes that covers it also starts in a document
    of a smaller id. NULL and short texts lose nothing; rows with equal ids are not
    earlier than one another; NULL ids rank after all others. What stays need not be
    valid UTF-8 where a span cuts a character.
    """
    buckets = bucket_count(docs)
    questions = Questions(min(64, (shares(docs, 1, 1) << 22).bit_length() + 10))
    shared = Question(Questions.shared, total=Questions.of_two)
    compared = Question(Questions.compared, ("key", "check"), ("id",), others=later)
    factors = Question(Questions.factors, ("key", *(f"w{i}" for i in range(WORDS))), ("id",), others=later)
    chunks = pack_chunks(docs, id_col, text_col)
    chunks = ask(chunks, "shared", questions.hashes, shared, buckets)
    chunks = ask(chunks, "compared", questions.contents, compared, buckets)
    chunks = ask(chunks, "windows", questions.windows, shared, buckets)
    chunks = ask(chunks, "factors", questions.suffixes, factors, buckets)

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = read_chunk(batch, i)
                gone = questions.removed(chunk, answers_of(batch, i))
                rows = []
                for d, doc_id in enumerate(chunk.ids):
                    lo, hi = int(chunk.offsets[d]), int(chunk.offsets[d + 1])
                    edge = np.diff(np.concatenate(([0], gone[lo:hi].view(np.int8), [0])))
                    spans = [
                        {"start": s, "end": e}
                        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
                    ]
                    kept = chunk.data[lo:hi][~gone[lo:hi]].tobytes()
                    rows.append({"doc_id": doc_id, "n_bytes": hi - lo, "spans": spans, "kept": kept})
                yield pa.RecordBatch.from_pylist(rows, schema=_RESULT)

    return map_arrow(chunks, cut, RESULT)


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def op9_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings that an earlier document has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_copies(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op9_previous_factors": op9_previous_factors}
ORACLES: dict[str, str] = {}
