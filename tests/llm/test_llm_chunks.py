"""Questions among chunks: the same answers over any number of levels, rows that grow with the table."""

import hashlib

import numpy as np
import pytest
from llm_rows import frame
from test_llm_documents import ROWS, TOP, plain_components, plain_removed, rows_of

from assayline.llm import chunks, ngram_join, substrings, suffixes


@pytest.fixture(scope="module")
def scattered(spark):
    """The rows in many small chunks."""
    return frame(spark, ROWS, 24).cache()


def test_answers_over_levels(scattered, monkeypatch):
    """64 buckets in three levels; ties and repeated rows lie in chunks of their own."""
    plain_units = rows_of(substrings.repeated_units(scattered.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])))
    monkeypatch.setattr(chunks, "STEP_BITS", 2)
    got = [(r.doc_id, r.n_bytes, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffixes.remove_copies(scattered).collect()]
    assert sorted(got, key=repr) == plain_removed(ROWS)
    expected = [(i, n, None if c == TOP else c) for i, n, c in plain_components(ROWS)]
    assert rows_of(ngram_join.join_documents(scattered)) == sorted(expected, key=repr)
    assert rows_of(substrings.repeated_units(scattered.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))) == plain_units


def test_one_copy_stays_over_levels(spark, monkeypatch):
    """A unit of 60 equal rows, without order among them, stays once."""
    monkeypatch.setattr(chunks, "STEP_BITS", 2)
    docs = frame(spark, [(7, "one line that every one of these rows has.", None, None, None)] * 60, 30)
    found = [r.n_removed for r in substrings.repeated_units(docs).collect()]
    assert sorted(found) == [0] + [1] * 59


HOT = np.uint64(0x1234567890ABCDEF)


def _sent(spark, monkeypatch, n):
    """Chunks, rows sent on all levels, entries of the common key that reach the last one, and the answers."""

    def keys(chunk, _):
        # five keys of the chunk's own and one that all have
        own = np.frombuffer(hashlib.sha512(chunk.data.tobytes()).digest()[:40], "<u8")
        key = np.unique(np.append(own, HOT))
        return {"key": key, "n": np.ones(len(key), np.uint8)}

    monkeypatch.setattr(chunks, "STEP_BITS", 2)
    levels, plain_send = [], chunks.send
    monkeypatch.setattr(chunks, "send", lambda *a: levels.append(plain_send(*a)) or levels[-1])
    rows = spark.range(n).selectExpr("id AS doc_id", "concat('document ', id) AS text").repartition(n, "doc_id")
    packed = chunks.pack_chunks(rows.repartitionByRange(n, "doc_id"))
    senders = packed.count()
    question = chunks.Question(ngram_join.Questions.counted, total=ngram_join.Questions.added)
    asked = chunks.ask(packed, "df", keys, question, n).collect()
    hot = 0
    for row in levels[-1].collect():
        hot += int((chunks.unpack_arrays(bytes(row.entries))["key"] == HOT).sum())
    answers = [np.frombuffer(b"".join(chunks.zstandard.decompress(r).split(b"\n", 1)[1] for r in row.df), np.uint8) for row in asked]
    monkeypatch.undo()
    return senders, sum(level.count() for level in levels), hot, answers


def test_rows_grow_with_the_table(spark, monkeypatch):
    """As many buckets as chunks: a chunk must not send to each of them, and a common key is combined on the way."""
    per_chunk, hot = [], []
    for n in (16, 64, 256):
        senders, sent, common, answers = _sent(spark, monkeypatch, n)
        per_chunk.append(sent / senders)
        hot.append(common / senders)
        # the common key is in all chunks, the others in one
        assert all(sorted(a.tolist()) == [1] * 5 + [min(senders, 255)] for a in answers)
    # at most four places a level; the square would be 16, 64, 256 a chunk, but for empty ones
    levels = (2, 3, 4)
    assert all(x <= 5 * k for x, k in zip(per_chunk, levels))
    assert per_chunk[2] < 3 * per_chunk[0]
    assert hot[2] < hot[1] < hot[0] < 1


def test_gathered():
    """Equal entries become one and go back to all; only the first of those chosen once is chosen."""
    rng = np.random.default_rng(3)
    for others in (None, chunks.refused, chunks.later):
        for _ in range(40):
            blobs, all_rows = [], []
            for source in range(int(rng.integers(1, 6))):
                key = np.unique(rng.integers(0, 12, int(rng.integers(1, 8)))).astype(np.uint64)
                ids = rng.integers(0, 4, len(key))
                blobs.append(chunks.pack_arrays({"key": key, "id": ids}))
                all_rows.append(list(zip(key.tolist(), ids.tolist())))
            question = chunks.Question(lambda c, s: None, rank=("id",), others=others)
            met = chunks.Gathered(question, blobs)
            best = {}
            for source, rows in enumerate(all_rows):
                for key, i in rows:
                    best[key] = min(best.get(key, (9, 9)), (i, source))
            assert met.distinct["key"].tolist() == sorted(best)
            assert met.distinct["id"].tolist() == [best[k][0] for k in sorted(best)]
            back = met.back(np.full(len(best), 1 if others is not chunks.later else 0, np.uint8))
            for source, rows in enumerate(all_rows):
                for (key, i), got in zip(rows, back[source].tolist()):
                    if others is None:
                        assert got == 1
                    elif others is chunks.refused:
                        assert got == (best[key] == (i, source))
                    else:
                        assert got == (i > best[key][0])
