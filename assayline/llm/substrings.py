"""Substring dedup by units: normalise lines or sentences, group digests over all documents, keep the first.

A unit's rank is (doc_id, place in the document). Of equal units the one of the
smallest rank stays; the others are removed, with their places in the original text
retained. Only 128-bit digests and ranks travel, one entry per chunk and distinct
unit (see ``chunks``), and one byte comes back.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.blocks import map_arrow
from assayline.llm.chunks import Chunk, Question, answers_of, ask, bucket_count, pack_chunks, read_chunk, refused

#: Units with fewer words are never removed: short ones recur in unrelated documents.
MIN_WORDS = 6
#: Where units end; the one character that ends a unit belongs to none.
BREAKS = {"line": re.compile(r"\n"), "sentence": re.compile(r"\n|(?<=[.!?])[\x20\x09]")}
PARAGRAPH = re.compile(r"\n[\x20\x09]*\n")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

MARK_TYPE = "doc_id long, n_units long, n_removed long, removed_chars long, spans array<struct<start:int,end:int>>"


def units_of(text: str, unit: str = "sentence", min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of each unit with enough words, in code points of the text.

    Normalised: A-Z in lower case, white space runs as one space, trimmed.
    """
    out, start = [], 0
    breaks = PARAGRAPH if unit == "paragraph" else BREAKS[unit]
    for end, after in [*((m.start(), m.end()) for m in breaks.finditer(text)), (len(text), len(text))]:
        plain = _SPACE.sub(" ", text[start:end].translate(_LOWER)).strip(" ")
        if plain.count(" ") + 1 >= min_words and plain:
            out.append((start, end, hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest()))
        start = after
    return out


def _table(chunk: Chunk, unit: str, min_words: int):
    """All units of a chunk: document, start, end, and the two halves of the digest."""
    docs, starts, ends, digests = [], [], [], []
    for d in range(len(chunk.ids)):
        text = chunk.data[chunk.offsets[d] : chunk.offsets[d + 1]].tobytes().decode("utf-8", "replace")
        for s, e, digest in units_of(text, unit, min_words):
            docs.append(d)
            starts.append(s)
            ends.append(e)
            digests.append(digest)
    halves = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return np.array(docs, np.int64), np.array(starts, np.int64), np.array(ends, np.int64), halves[:, 0], halves[:, 1]


def _first_of_each(chunk: Chunk, unit: str, min_words: int):
    """Units in rank order within equal digests, and where each distinct digest starts."""
    docs, starts, ends, key, check = _table(chunk, unit, min_words)
    ids = chunk.doc_ids()[docs] if len(docs) else np.zeros(0, np.int64)
    order = np.lexsort((starts, ids, check, key))
    k, c = key[order], check[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return docs, starts, ends, key, check, ids, order, new


def _earliest(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
    """1 for the entry of the smallest rank among equal digests (ties: the first chunk), else 0."""
    order = np.lexsort((source, columns["start"], columns["id"], columns["check"], columns["key"]))
    k, c = columns["key"][order], columns["check"][order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    out = np.zeros(len(order), np.uint8)
    out[order[new]] = 1
    return out


def repeated_units(
    docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document row: how many units it has and which of them repeat an earlier one.

    ``spans`` are code points of the original text, end exclusive, ascending. NULL and
    empty texts have no units; a repeated row loses its units to the first of them
    (rows with equal ids: the first place in the table as read); NULL ids rank last.
    """

    def emit(chunk: Chunk, _):
        _, starts, _, key, check, ids, order, new = _first_of_each(chunk, unit, min_words)
        first = order[new]
        return {"key": key[first], "check": check[first], "id": ids[first], "start": starts[first].astype(np.int32)}

    def mark(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = read_chunk(batch, i)
                docs, starts, ends, _, _, _, order, new = _first_of_each(chunk, unit, min_words)
                owner = answers_of(batch, i)["first"]
                keep = np.zeros(len(order), bool)
                keep[order[new]] = owner == 1
                rows = [
                    {"doc_id": doc_id, "n_units": 0, "n_removed": 0, "removed_chars": 0, "spans": []}
                    for doc_id in chunk.ids
                ]
                for d, n in enumerate(np.bincount(docs, minlength=len(rows)).tolist()):
                    rows[d]["n_units"] = n
                for d, s, e in zip(docs[~keep].tolist(), starts[~keep].tolist(), ends[~keep].tolist()):
                    row = rows[d]
                    row["n_removed"] += 1
                    row["removed_chars"] += e - s
                    row["spans"].append({"start": s, "end": e})
                yield pa.RecordBatch.from_pylist(rows, schema=_MARKS)

    chunks = pack_chunks(docs, id_col, text_col)
    earliest = Question(_earliest, ("key", "check"), ("id", "start"), others=refused)
    asked = ask(chunks, "first", emit, earliest, bucket_count(docs))
    return map_arrow(asked, mark, MARK_TYPE)


_MARKS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_units", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed_chars", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated sentences and lines of all documents: what each document loses, with the places."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = repeated_units(docs.select("doc_id", "text"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return marks.select("doc_id", "n_units", "n_removed", "removed_chars", F.array_join(spans, ",").alias("spans"))


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
#: The same rule in SQL: cut after sentence ends (one character each, so places stay), normalise, rank, keep the first.
ORACLES = {
    "op3_substring_dedup": r"""
WITH parts AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?])[\x20\x09]', '\1' || chr(10), 'g'), chr(10)) AS p
  FROM documents),
cells AS (
  SELECT doc_id, unnest(p) AS u, generate_subscripts(p, 1) AS place FROM parts),
placed AS (
  SELECT doc_id, place, u,
    sum(length(u) + 1) OVER (PARTITION BY doc_id ORDER BY place) - length(u) - 1 AS start,
    trim(regexp_replace(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM cells),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, place) AS r
  FROM placed WHERE plain <> '' AND length(plain) - length(replace(plain, ' ', '')) + 1 >= 6)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
  coalesce(removed_chars, 0) AS removed_chars, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (r > 1) AS n_removed,
    CAST(sum(length(u)) FILTER (r > 1) AS BIGINT) AS removed_chars,
    string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + length(u) AS BIGINT) AS VARCHAR), ','
      ORDER BY place) FILTER (r > 1) AS spans
  FROM ranked GROUP BY doc_id) USING (doc_id)"""
}
