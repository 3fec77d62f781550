"""Registered queries: against their SQL, against plain versions of their contracts; the pipeline stage by stage."""

import base64
import hashlib
import re
import zlib

import duckdb
import llm_rows
import numpy as np
import pytest
import test_llm_documents as plain

import __spark_entry__ as entry_point
import corpus_pipeline
import oracle
from assayline.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def result(spark, name):
    return {r[0]: r for r in catalog.QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_sql(spark, name):
    rows, difference = oracle.compare(catalog.QUERIES[name](spark, SF), oracle.connect(SF), catalog.ORACLES[name])
    assert difference is None and rows > 0


def test_registered():
    names = set(entry_point.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {re.match(r"op\d+_", n)[0] for n in names if n.startswith("op")}
    assert "pipeline" in names


def test_op1(spark, docs):
    got = result(spark, "op1_ngram_join")
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (n, c) for i, n, c in plain.plain_components(docs)}


def test_op2(spark, docs):
    got = result(spark, "op2_minimax_shards")
    assert {(i, r.size, r.text_crc32, r.law, r.grown_shard) for i, r in got.items()} == {
        (i, len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None) for i, t in docs
    }


def test_op4(spark, docs):
    got = result(spark, "op4_pii_skip_chain")
    kinds = list(plain.PATTERNS)
    for i, t in docs:
        base = plain.plain_base(t)
        cells = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        assert got[i].base_sha256 == hashlib.sha256(",".join(cells).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(k == kinds[b] for _, b, _ in base) for k in kinds]
        assert set(cells) <= set(got[i].spans.split(",")) | {""}


def test_op5(spark, docs):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = result(spark, "op5_decontaminate")
    for i, t in docs:
        n, hit, found = plain.plain_hits(t, items)
        ids = ",".join(sorted(map(str, found)))
        assert tuple(got[i]) == (i, n, hit, len(found), hashlib.sha256(ids.encode()).hexdigest(), hit > 0)


def test_op6(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = result(spark, "op6_warc_writer")
    for i, t in pages:
        low = min(j for j, u in pages if u == t)
        digest = base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
        assert tuple(got[i]) == (i, len(t.encode()), digest, "response" if low == i else "revisit", None if low == i else low)


def test_op8(spark, docs):
    got = result(spark, "op8_quality_rules")
    for i, t in docs:
        stats = plain.plain_stats(t)
        failed = stats[0] < 20 or 100 * stats[4] > 30 * stats[0]
        assert tuple(got[i])[1:7] == (*stats, failed) and not (failed and got[i].kept)


def test_op9(spark, docs):
    got = result(spark, "op9_previous_factors")
    assert sorted(((i, r.n_bytes, r.kept_sha256) for i, r in got.items()), key=repr) == plain.plain_removed(docs)
    assert all((r.n_removed == 0) == (r.n_spans == 0) for r in got.values())


def test_op10(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = result(spark, "op10_bpe")
    for i, t in docs:
        ids = library.encode(t, add_special_tokens=False).ids
        assert tuple(got[i]) == (
            i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
        )


# -- pipeline

@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage over a small table with odd rows."""
    folder = tmp_path_factory.mktemp("pipeline")
    rows = llm_rows.documents(80, seed=9) + llm_rows.odd_rows()
    docs = llm_rows.frame(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(t.count("|") <= 10), 0) for i, t, *_ in rows if i is not None and 0 <= i < 60]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(plain.some_items()[:6], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen, now = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(folder))
        out.write.parquet(f"{folder}/{name}")
        seen[name] = (now.collect(), spark.read.parquet(f"{folder}/{name}"))
        now = seen[name][1]
    return folder, seen


def test_stage_columns(spark, stages):
    folder, seen = stages
    documents = spark.read.parquet(f"{folder}/documents.parquet").dtypes
    for name, (_, out) in list(seen.items())[:-1]:
        assert out.dtypes == documents, name
    assert list(seen) == [n for n, _ in corpus_pipeline.STAGES]


def test_stage_quality(stages):
    before, out = stages[1]["quality_rules"]
    kept = {r.doc_id for r in out.collect()}
    for r in before:
        stats = plain.plain_stats(r.text)
        if stats[0] < 20 or 100 * stats[4] > 30 * stats[0] or (r.text or "").count("|") > 10:
            assert r.doc_id not in kept
    assert len(kept) > 30


def test_stage_near_duplicates(stages):
    before, out = stages[1]["near_duplicates"]
    first = {i for i, _, c in plain.plain_components([(r.doc_id, r.text) for r in before]) if i == c}
    assert sorted(r.doc_id for r in out.collect()) == sorted(first)


def test_stage_decontaminate(stages):
    before, out = stages[1]["decontaminate"]
    items = plain.some_items()[:6]
    after = {r.doc_id: r for r in out.collect()}
    for r in before:
        n, hit, _ = plain.plain_hits(r.text, items)
        assert (r.doc_id in after) == (hit <= 0.5 * n)
        if hit == 0:
            assert after[r.doc_id] == r
        elif r.doc_id in after:
            assert plain.plain_hits(after[r.doc_id].text, items)[1] == 0


def test_stage_personal_data(stages):
    before, out = stages[1]["personal_data"]
    after = {r.doc_id: r.text for r in out.collect()}
    for r in before:
        if plain.plain_base(r.text):
            assert plain.plain_base(after[r.doc_id]) == []
        elif not re.search("[0-9@]", r.text):
            assert after[r.doc_id] == r.text


def test_stage_encode(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, out = stages[1]["encode"]
    after = {r.doc_id: r for r in out.collect()}
    assert len(after) == len(before)
    for r in before:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert np.frombuffer(after[r.doc_id].token_ids, "<u4").tolist() == ids


def test_run(spark, stages):
    folder, seen = stages
    got = corpus_pipeline.run(spark, str(folder))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, seen["encode"][1].collect()))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], llm_rows.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    turns = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([], turns).write.parquet(f"{tmp_path}/conversations.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for name, query in catalog.QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name
