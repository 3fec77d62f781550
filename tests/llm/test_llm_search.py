"""Ranked search: packed shards, skipping that loses nothing, the operator against plain scores, odd rows."""

import math
import random
import re

import llm_rows
import numpy as np
import pyarrow as pa

from assayline.llm import ranked_search as r
from assayline.llm.blocks import LOWER, byte_rows, words_of


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(llm_rows.LOWER))


def plain_ranks(docs, items, top=10):
    """(item number, rank, doc_id, score) by scoring every document."""
    texts = [(i, plain_terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    out = []
    for number, (_, text) in enumerate(items):
        terms = set(plain_terms(text))
        df = {t: sum(t in w for _, w in texts) for t in terms}
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scores = []
        for own, words in texts:
            if words:
                m = 100 - 90 + (90 * len(words) * n_docs) // n_terms
                tf = {t: words.count(t) for t in terms & set(words)}
                score = sum(w[t] * ((1_000_000_000 * n) // (1000 * n + 8 * m)) for t, n in tf.items())
                if score > 0:
                    scores.append((-score, own is None, own or 0))
        for rank, (score, none, own) in enumerate(sorted(scores)[:top], 1):
            out.append((number, rank, None if none else own, -score))
    return out


def shards_of(docs, terms, sizes=(7, 50, 1000)):
    index, found, rest = r.Terms(terms), [], list(docs)
    for size in sizes:
        part, rest = rest[:size], rest[size:]
        if part:
            writer = r.ShardWriter()
            data, offsets = byte_rows(pa.array([t for _, t in part], pa.string()))
            data = LOWER[data]
            words = words_of(data, offsets, r.TERM_BYTES)
            at, term = index.find(data, words)
            writer.add([i for i, _ in part], np.diff(words.first), words.doc[at], term)
            found.append(writer.row())
    return found


def zipf_docs(seed, n):
    """Words of very different frequency, some repeated often in one text, many equal texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40, 400]))) for _ in range(n // 2)]
    texts += [rng.choice(texts) for _ in range(n - len(texts))]
    ids = rng.sample(range(10 * n), n)
    return list(zip(ids, texts))


def test_shards_hold_all_postings():
    docs = zipf_docs(1, 400) + [(9999, "w3 " * 70_000)]
    terms = [f"w{i}" for i in range(0, 300, 3)]
    counts = {}
    for row in shards_of(docs, terms):
        shard = r.Shard(row, 10, 1000)
        for term, i in shard.lists.items():
            found, impacts = shard.list(i)
            assert (np.diff(found) > 0).all() and shard.list_max[i] == impacts.max()
            at, high = shard.some(i, found)
            assert (at >= 0).all() and (high >= impacts).all()
            for b in range(shard.list_blocks[i], shard.list_blocks[i + 1]):
                assert shard.block_max[b] == shard.block(b)[1].max()  # the bound is exact
            for d in found.tolist():
                counts[row["doc_ids"][d], terms[term]] = counts.get((row["doc_ids"][d], terms[term]), 0) + 1
    assert counts == {(i, t): 1 for i, x in docs for t in set(terms) & set(x.split())}


def test_search_skips_but_loses_nothing():
    docs, rng = zipf_docs(2, 3000), random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(12)) + " w0 w1 w2") for i in range(20)]
    terms = sorted({t for _, x in items for t in plain_terms(x)})
    rows = shards_of(docs, terms, (300, 300, 1200, 1200))
    texts = [plain_terms(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, texts)), sum(map(len, texts))
    want = plain_ranks(docs, items)
    unpacked = held = 0
    for number, (_, text) in enumerate(items):
        heap = r.Heap(10)
        for row in rows:
            shard = r.Shard(row, n_docs, n_terms)
            weights = []
            for t in set(plain_terms(text)):
                df = sum(t in w for w in texts)
                weights.append((terms.index(t), math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))))
            r.search_shard(shard, weights, heap)
            own = [shard.lists[t] for t, _ in weights if t in shard.lists]
            unpacked += shard.unpacked
            held += sum(int(shard.list_blocks[i + 1] - shard.list_blocks[i]) for i in own)
        got = [(number, k, None if none else i, -s) for k, (s, none, i) in enumerate(heap.rows, 1)]
        assert got == [x for x in want if x[0] == number]
    assert unpacked < held  # some blocks are never unpacked


def test_terms_of_one_hash(monkeypatch):
    """Words are verified by their bytes, whatever their hashes."""
    index = r.Terms(["alpha", "beta", "gamma"])
    data, offsets = byte_rows(pa.array(["beta x gamma alpha delta", "gamma"], pa.string()))
    words = words_of(data, offsets, r.TERM_BYTES)
    words.hash[:] = 5
    index.hashes[:] = 5
    at, term = index.find(data, words)
    found = [(data[words.start[a] : words.end[a]].tobytes().decode(), int(t)) for a, t in zip(at, term)]
    assert found == [("beta", 1), ("gamma", 2), ("alpha", 0), ("gamma", 2)]


def test_operator(spark):
    docs = llm_rows.documents(60) + llm_rows.odd_rows()
    rng = random.Random(8)
    items = [(i % 7, " ".join(rng.choice(docs)[1].split()[:40]) if rng.choice(docs)[1] else "") for i in range(12)]
    items += [(None, "one two"), (99, None), (98, "- , -"), (97, "ONE ONE two"), (97, "nowhere-to-be-found")]
    items = sorted(items, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    frame = llm_rows.frame(spark, docs, 5).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "score")
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((items[i][0], k, d, s) for i, k, d, s in plain_ranks([x[:2] for x in docs], items)), key=repr)
    assert sorted(map(tuple, r.search(frame, asked).collect()), key=repr) == want
    # the same in many rounds
    assert sorted(map(tuple, r.search(frame, asked, round_terms=30).collect()), key=repr) == want


def test_empty(spark):
    docs = llm_rows.frame(spark, [])
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert r.search(docs, items).collect() == []
    assert r.search(llm_rows.frame(spark, llm_rows.odd_rows()), items.limit(0)).collect() == []
    assert r.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
