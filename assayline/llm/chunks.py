"""Documents packed in chunks, and questions about keys that the chunks ask one another.

A chunk is a run of whole documents (about ``SLICE_BYTES`` of text, or one longer
document), written once, compressed, to the shared folder. Operators that compare
all documents with all others ask in steps, so that neither texts nor hot keys
gather in one task:

1. each chunk sends its *distinct* keys (already combined in the chunk), dealt to
   buckets by their leading bits;
2. where a table needs more buckets than a chunk should send to, cells of some chunks each
   combine equal keys once more and deal on by the next bits, level by level;
3. a bucket answers each sender's entries with a number, and answers go back the same way.

A key that every document holds costs one entry per chunk on the first level, one per
cell on the next. Chunk ids are made when
the chunks are written, so a task that runs again sees the same ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.blocks import SLICE_BYTES, byte_rows, map_arrow, scratch_path, shares, stored

CHUNK_TYPE = "chunk string, ids array<long>, sizes array<long>, data binary"


@dataclass
class Chunk:
    """Documents of one chunk: ids (None for NULL), their bytes, n+1 offsets."""

    ids: list
    data: np.ndarray
    offsets: np.ndarray

    def doc_ids(self) -> np.ndarray:
        """Ids as numbers; NULL ranks after all others."""
        return np.array([np.iinfo(np.int64).max if i is None else i for i in self.ids], np.int64)


def pack_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the chunks of a table; NULL texts are empty, NULL ids stay NULL."""

    def row(ids: list, parts: list[np.ndarray], sizes: list[int]) -> pa.RecordBatch:
        zipped = zstandard.ZstdCompressor(level=1)
        raw = np.concatenate(parts).tobytes() if parts else b""
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([zipped.compress(raw)], pa.binary()),
            ],
            names=["chunk", "ids", "sizes", "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, sizes, total = [], [], [], 0
        for batch in batches:
            data, offsets = byte_rows(batch.column(1))
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                size = int(offsets[i + 1] - offsets[i])
                if ids and total + size > SLICE_BYTES:
                    yield row(ids, parts, sizes)
                    ids, parts, sizes, total = [], [], [], 0
                ids.append(doc_id)
                parts.append(data[offsets[i] : offsets[i + 1]].copy())
                sizes.append(size)
                total += size
        if ids:
            yield row(ids, parts, sizes)

    rows = map_arrow(docs.select(F.col(id_col).cast("long"), text_col), run, CHUNK_TYPE)
    return _stored_by_chunk(rows, max(bucket_count(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _stored_by_chunk(rows: DataFrame, parts: int) -> DataFrame:
    """Write to the shared folder in ``parts`` files by chunk id, so that later joins leave the texts where they are."""
    spark = rows.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    out = rows.repartition(parts, "chunk").write.bucketBy(parts, "chunk").format("parquet")
    out.option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved now; only the catalog's entry goes, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table


def read_chunk(batch: pa.RecordBatch, i: int) -> Chunk:
    sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
    raw = batch.column("data")[i].as_py()
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return Chunk(batch.column("ids")[i].as_py(), data, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """Columns of one length; the sorted ``key`` as differences, all as byte planes, compressed."""
    parts, head = [], [str(len(arrays["key"]))]
    for name, array in arrays.items():
        if name == "key":
            array = np.diff(array, prepend=np.zeros(1, array.dtype))
        head.append(f"{name}:{array.dtype.str}")
        parts.append(array.view(np.uint8).reshape(len(array), array.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(";".join(head).encode() + b"\n" + b"".join(parts))


def unpack_arrays(blob: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = raw.index(b"\n")
    n, *columns = raw[:at].decode().split(";")
    n, at, out = int(n), at + 1, {}
    for column in columns:
        name, kind = column.split(":")
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        array = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        out[name] = np.cumsum(array, dtype=array.dtype) if name == "key" else array
        at += n * width
    return out


@dataclass(frozen=True)
class Question:
    """What is answered to entries, and how equal ones become one on the way to their bucket.

    ``answer(columns, source)`` sees all entries of a bucket with the number of the
    sender each came from and returns one number for each. Entries equal in ``same``
    (``key`` first) are one entry from then on: the smallest by ``rank`` (ties: the first
    sender) stands for them, with the columns that ``total(columns, starts)`` gives of all of
    them. Its answer is theirs too, or ``others(columns, standing, answers)`` makes theirs.
    """

    answer: Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]
    same: tuple[str, ...] = ("key",)
    rank: tuple[str, ...] = ()
    total: Callable[[dict[str, np.ndarray], np.ndarray], dict[str, np.ndarray]] | None = None
    others: Callable[[dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray], np.ndarray] | None = None


def refused(columns: dict[str, np.ndarray], standing: dict[str, np.ndarray], answers: np.ndarray) -> np.ndarray:
    """``others`` where only the first of equal entries is chosen."""
    return np.zeros_like(answers)


def later(columns: dict[str, np.ndarray], standing: dict[str, np.ndarray], answers: np.ndarray) -> np.ndarray:
    """``others`` where a smaller document with an equal entry is a yes."""
    return np.maximum(answers, columns["id"] > standing["id"])


class Gathered:
    """Entries of several senders, the distinct ones among them, and the way back."""

    def __init__(self, question: Question, blobs: list[bytes]):
        parts = [unpack_arrays(b) for b in blobs]
        self.question = question
        self.sizes = np.array([len(p["key"]) for p in parts])
        self.columns = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        # the sort is stable: of entries alike in all of these the first sender's comes first
        order = np.lexsort([self.columns[c] for c in (*question.same, *question.rank)][::-1])
        ordered = {k: v[order] for k, v in self.columns.items()}
        first = starts_of(*(ordered[c] for c in question.same))
        self.stands = order[first]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        self.distinct = {k: v[first] for k, v in ordered.items()}
        if question.total:
            self.distinct |= question.total(ordered, first)

    def back(self, answers: np.ndarray) -> list[np.ndarray]:
        """From the answers to the distinct entries to those of each sender."""
        out = answers[self.place]
        if self.question.others:
            rest = np.ones(len(out), bool)
            rest[self.stands] = False
            standing = {k: v[self.place[rest]] for k, v in self.distinct.items()}
            out[rest] = self.question.others({k: v[rest] for k, v in self.columns.items()}, standing, out[rest])
        return np.split(out, np.cumsum(self.sizes)[:-1])


#: A sender deals its entries to at most 2 to this power places at a time.
STEP_BITS = 6
SENT, REPLIES = "bucket int, chunk string, entries binary", "bucket int, chunk string, reply binary"
CELLS = "chunk string, sources array<string>, entries array<binary>, bucket int"


def ask(
    chunks: DataFrame,
    name: str,
    emit: Callable[[Any, dict[str, np.ndarray]], dict[str, np.ndarray]],
    question: Question,
    buckets: int,
    read: Callable[[pa.RecordBatch, int], Any] = read_chunk,
) -> DataFrame:
    """``chunks`` with a column ``name``: the answers to their entries, in the order of their keys.

    ``emit(chunk, earlier answers by name)`` gives columns sorted by ``key`` (uint64,
    spread over all 64 bits). ``read`` makes the chunk of a row; columns from the fifth on
    are earlier answers.

    A chunk never sends to all buckets of a large table: entries go by the first bits of
    their keys to cells of about as many chunks as there are places, equal ones become one
    there, and the cells deal on by the next bits. So rows are (chunks x places x levels), which
    grows with the table, and a key of all chunks arrives as few entries.
    """
    bits = max(1, (buckets - 1).bit_length())
    step = -(-bits // -(-bits // STEP_BITS))
    senders = 1 if bits <= step else chunks.select("chunk").count()
    sent = send(chunks, lambda batch, i: (emit(read(batch, i), answers_of(batch, i)), 0), 0, step)
    by_chunk = _by_chunk(_answered(sent, question, step, bits, step, senders), name)
    return chunks.join(by_chunk, "chunk", "left")


def send(chunks: DataFrame, entries: Callable, used: int, step: int) -> DataFrame:
    """Rows (bucket, chunk, entries): ``entries(batch, row)`` are columns and the ``used`` bits all their keys begin with."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                columns, prefix = entries(batch, i)
                places = (np.uint64(prefix) << np.uint64(step)) + np.arange(1 << step, dtype=np.uint64)
                edges = places[1:] << np.uint64(64 - used - step)
                cuts = [0, *np.searchsorted(columns["key"], edges).tolist(), len(columns["key"])]
                full = [b for b in range(1 << step) if cuts[b + 1] > cuts[b]]
                if not full:
                    continue
                blobs = [pack_arrays({k: v[cuts[b] : cuts[b + 1]] for k, v in columns.items()}) for b in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(places[full].astype(np.int32)),
                        pa.array([batch.column("chunk")[i].as_py()] * len(full), pa.string()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["bucket", "chunk", "entries"],
                )

    return map_arrow(chunks, run, SENT)


def _answered(sent: DataFrame, question: Question, used: int, bits: int, step: int, senders: int) -> DataFrame:
    """Rows (bucket, chunk, reply) for entries dealt by their first ``used`` of ``bits`` bits."""
    if used >= bits:
        return sent.groupBy("bucket").applyInArrow(_reply(question), REPLIES)
    cells = gather(sent, step, senders)
    step = min(step, bits - used)

    def distinct(batch, i):
        return Gathered(question, batch.column("entries")[i].as_py()).distinct, batch.column("bucket")[i].as_py()

    onward = send(cells, distinct, used, step)
    answers = _answered(onward, question, used + step, bits, step, -(-senders >> step))

    def back(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = Gathered(question, batch.column("entries")[i].as_py()).back(answers_of(batch, i)["reply"])
                sources = batch.column("sources")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("bucket")[i].as_py()] * len(sources), pa.int32()),
                        pa.array(sources, pa.string()),
                        pa.array(_zipped(found), pa.binary()),
                    ],
                    names=["bucket", "chunk", "reply"],
                )

    return map_arrow(cells.join(_by_chunk(answers, "reply"), "chunk"), back, REPLIES)


def gather(sent: DataFrame, step: int, senders: int) -> DataFrame:
    """Cells, as chunks that can ask: what about 2 to the power ``step`` senders have for one bucket."""
    group = F.pmod(F.xxhash64("chunk"), F.lit(max(1, senders >> step)))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        bucket, group = key[0].as_py(), key[1].as_py()
        return pa.table(
            {
                "chunk": pa.array([f"{bucket}.{group}"]),
                "sources": pa.array([table.column("chunk").to_pylist()], pa.list_(pa.string())),
                "entries": pa.array([table.column("entries").to_pylist()], pa.list_(pa.binary())),
                "bucket": pa.array([bucket], pa.int32()),
            }
        )

    return stored(sent.groupBy("bucket", group.alias("group")).applyInArrow(run, CELLS), "cells")


def _reply(question: Question) -> Callable[[pa.Table], pa.Table]:
    def reply(table: pa.Table) -> pa.Table:
        # a fixed order, so that a task that runs again answers alike
        table = table.sort_by("chunk")
        blobs = [unpack_arrays(b.as_py()) for b in table.column("entries")]
        sizes = np.array([len(b["key"]) for b in blobs])
        columns = {k: np.concatenate([b[k] for b in blobs]) for k in blobs[0]}
        del blobs
        answers = question.answer(columns, np.repeat(np.arange(len(sizes)), sizes))
        parts = _zipped(np.split(answers, np.cumsum(sizes)[:-1]))
        return pa.table(
            {"bucket": table.column("bucket"), "chunk": table.column("chunk"), "reply": pa.array(parts, pa.binary())}
        )

    return reply


def _zipped(answers: list[np.ndarray]) -> list[bytes]:
    zipped = zstandard.ZstdCompressor(level=1)
    return [zipped.compress(a.dtype.str.encode() + b"\n" + a.tobytes()) for a in answers]


def _by_chunk(replies: DataFrame, name: str) -> DataFrame:
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "reply"))), lambda r: r["reply"])
    return stored(replies.groupBy("chunk").agg(in_order.alias(name)), "replies")


def answers_of(batch: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    """A chunk's answers by question, one for each of its entries in key order."""
    unzipped, out = zstandard.ZstdDecompressor(), {}
    for name in batch.schema.names[4:]:
        parts = [unzipped.decompress(r).split(b"\n", 1) for r in batch.column(name)[i].as_py() or []]
        arrays = [np.frombuffer(data, kind.decode()) for kind, data in parts]
        out[name] = np.concatenate(arrays) if arrays else np.zeros(0, np.uint8)
    return out


def bucket_count(docs: DataFrame) -> int:
    """One bucket for every 16 MB of the table's files, a power of two, at least 64."""
    return 1 << (shares(docs, 16, 64) - 1).bit_length()


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in columns sorted together."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)
