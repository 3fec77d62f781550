"""Operators on documents against plain versions, with odd rows and empty tables."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import llm_rows
import numpy as np
import pytest
from pyspark.sql import functions as F

from assayline.llm import decontamination, ngram_join, pii, quality, sharding, substrings, suffixes, tokens

ROWS = llm_rows.documents() + llm_rows.odd_rows()
TOP = (1 << 63) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return llm_rows.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], llm_rows.SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 1: n-gram Jaccard join

def shingles(text):
    w = llm_rows.words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    sets = [(TOP if i is None else i, shingles(t)) for i, t, *_ in rows]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i in range(len(sets)):
        least[root(i)] = min(least.get(root(i), TOP), sets[i][0])
    return [(r[0], len(s), least[root(i)]) for i, (r, (_, s)) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("task_tokens", [2_000_000, 150])
def test_join(docs, task_tokens):
    got = ngram_join.join_documents(docs, task_tokens=task_tokens)
    expected = [(i, n, None if c == TOP else c) for i, n, c in plain_components(ROWS)]
    assert rows_of(got) == sorted(expected, key=repr)


def test_join_empty(empty):
    assert ngram_join.join_documents(empty).collect() == []
    assert ngram_join.keep_one(empty).collect() == []


def test_join_boundary(spark):
    """Eight of ten shingles link, 79 of 100 do not; a link may need a third set."""
    base = [f"w{i}" for i in range(400)]
    # 396 shingles; a changed word breaks five
    at = [50 * k + 20 for k in range(8)]
    near = [w if i not in at else f"x{i}" for i, w in enumerate(base)]  # 356 shared of 436: 81.7 %
    far = [w if i not in [*at, 10] else f"x{i}" for i, w in enumerate(base)]  # 351 of 441: 79.6 %
    rows = [(3, " ".join(base), None, None, None), (2, " ".join(near), None, None, None), (9, " ".join(far), None, None, None)]
    got = {r.doc_id: r.component_id for r in ngram_join.join_documents(llm_rows.frame(spark, rows)).collect()}
    # far is linked to near, which shares more with it
    assert got == {3: 2, 2: 2, 9: 2}
    got = {r.doc_id: r.component_id for r in ngram_join.join_documents(llm_rows.frame(spark, [rows[0], rows[2]])).collect()}
    assert got == {3: 3, 9: 9}


def test_keep_one(docs):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {i for i, _, c in plain_components(ROWS) if i == c}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == expected | {None} and ids.count(None) == 1  # two equal texts without an id


def test_ids_do_not_link(spark):
    """Rows without an id, or of one id, are linked by their texts only; no text is lost."""
    a, b, c, d = (llm_rows.sentence(random.Random(s), 60) for s in range(4))
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = [(1, a), (2, b), (None, near(a)), (None, near(b)), (3, c), (3, d), (5, near(c)), (4, near(d)), (None, "x y z a b c"), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], llm_rows.SCHEMA).repartition(3)
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.join_documents(docs).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 2), (None, 1), (None, 2), (3, 3), (3, 3), (5, 3), (4, 3), (None, None), (7, 7), (7, 7)], key=repr)
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (3, c), (3, d), (None, "x y z a b c"), (7, None), (7, None)], key=repr)


def test_link_sets_skips_but_loses_nothing():
    rng = np.random.default_rng(2)
    pool = rng.permutation(4000).astype(np.uint64)
    sets = []
    for g in range(25):
        centre = rng.choice(pool, 60, replace=False)
        for _ in range(8):
            own = centre.copy()
            k = int(rng.integers(0, 14))
            own[:k] = rng.choice(pool, k)
            sets.append(np.unique(own))
    df = Counter(int(t) for s in sets for t in s)
    ordered = [np.array(sorted((t for t in s if df[int(t)] > 1), key=lambda t: (df[int(t)], t)), np.uint64) for s in sets]
    roots = ngram_join.link_sets([len(s) for s in sets], ordered, list(range(len(sets))))
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
                up[max(root(i), root(j))] = min(root(i), root(j))
    same = lambda labels: {frozenset(np.flatnonzero(np.array(labels) == x).tolist()) for x in set(labels)}
    assert same(roots) == same([root(i) for i in range(len(sets))])


def test_blocks_are_skipped_by_place():
    class Unread(list):
        def __getitem__(self, _):
            raise AssertionError("a block without enough shingles left was read")

    places = {40: Unread([(100, 1)]), 90: [(70, 2), (80, 3), (100, 4), (110, 5)]}
    # 100 and 80 share 80 at least, 100 and 100 share 89, 100 and 110 share 94
    assert list(ngram_join.open_entries(places, 100, 80, 95)) == [(80, 3), (100, 4)]
    assert list(ngram_join.open_entries({90: Unread([(100, 1)])}, 100, 80, 79)) == []


# -- 2: sharding

@pytest.mark.parametrize("zoom", [16_384, 8])
def test_shards(docs, zoom):
    got = sharding.assign_shards(docs, zoom=zoom).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").encode()) + 1) for i, t, *_ in ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    groups = defaultdict(int)
    for _, t, *_ in ROWS:
        groups["0" * 64 if t is None else hashlib.sha256(t.encode()).hexdigest()] += len((t or "").encode()) + 1
    sizes = [groups[k] for k in sorted(groups)]

    def runs(capacity):
        n, held = 1, 0
        for s in sizes:
            if s > capacity:
                return 99
            if held + s > capacity:
                n, held = n + 1, 0
            held += s
        return n

    best = next(c for c in sorted({sum(sizes[a:b]) for a in range(len(sizes)) for b in range(a + 1, len(sizes) + 1)}) if runs(c) <= 8)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) == best


def test_shards_keep_equal_texts(docs):
    got = sharding.assign_shards(docs).select("doc_id", "shard").distinct()
    text = docs.select("doc_id", "text").where("doc_id IS NOT NULL").distinct()
    assert got.join(text, "doc_id").groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_shards_empty(empty, spark):
    assert sharding.assign_shards(empty).collect() == []
    one = sharding.assign_shards(llm_rows.frame(spark, [(1, "a", None, None, None)] * 3)).collect()
    assert sorted((r.shard, r.slot) for r in one) == [(0, 0), (0, 1), (0, 2)]


# -- 3: units

@pytest.mark.parametrize("unit", ["sentence", "line", "paragraph"])
def test_units(docs, unit):
    got = substrings.repeated_units(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), unit)
    seen, expected = set(), []
    for i, t in sorted({r[0]: r[1] for r in ROWS if r[0] is not None}.items()):
        units = substrings.units_of(t or "", unit)
        spans = []
        for s, e, digest in units:
            if digest in seen:
                spans.append((s, e))
            seen.add(digest)
        expected.append((i, len(units), len(spans), sum(e - s for s, e in spans), spans))
    plain = [(r.doc_id, r.n_units, r.n_removed, r.removed_chars, [tuple(s) for s in r.spans]) for r in got.collect()]
    assert sorted(plain) == expected


def test_units_by_hand():
    text = "One two three four five six.  ONE two\tthree four five six. short.\nseven eight nine ten eleven twelve"
    found = substrings.units_of(text)
    assert [text[s:e] for s, e, _ in found] == [
        "One two three four five six.", " ONE two\tthree four five six.", "seven eight nine ten eleven twelve"
    ]
    assert found[0][2] == found[1][2] != found[2][2]


def test_whole_lines_of_any_length():
    text = "All rights reserved.\n\none two three. four\nALL rights  reserved."
    found = substrings.units_of(text, "line", min_words=1)
    assert [text[s:e] for s, e, _ in found] == ["All rights reserved.", "one two three. four", "ALL rights  reserved."]
    assert found[0][2] == found[2][2] != found[1][2]


def test_units_repeated_rows(docs, empty):
    got = substrings.repeated_units(docs).where("doc_id IS NULL").collect()
    assert sorted(r.n_removed for r in got) == [0, 1]
    assert substrings.repeated_units(empty).collect() == []


# -- 4: personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for k, pattern in enumerate(PATTERNS.values()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (
                True,
                k != 1 or all(int(p) <= 255 for p in m.group().split(".")),
                k != 2 or (14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0),
                k != 3 or 10 <= len(digits) <= 15,
            )
            if all(good):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_fuzz():
    import random

    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice("ab1.@+- (9)54\n%é") for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_spans_long_runs_are_linear():
    for run in ("a" * 400_000, "1" * 400_000, "a@" * 200_000, "1." * 200_000, "+1" * 200_000, "1 " * 200_000):
        pii.base_spans(run)
        pii.variables(run)


def test_pii(docs):
    field = pii.train_field(docs)
    got = {r.text: r.pii for r in pii.find_pii(docs, field).collect()}
    for _, t, *_ in ROWS:
        base = [(s.start, pii.KINDS.index(s.kind), s.end) for s in got[t].base]
        assert base == plain_base(t or "")
        assert {tuple(s) for s in got[t].base} <= {tuple(s) for s in got[t].spans}


def test_field_learns_held_out(spark):
    """Labels of documents that it was not trained on, without their base spans as evidence."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[0-9@]'")
    texts = [r.text for r in table.orderBy("doc_id").collect()]
    train, held = pii.Graph.empty(), pii.Graph.empty()
    for i, t in enumerate(texts):
        (held if i % 3 == 0 else train).add(t, pii.base_spans(t))
    assert len(held.rows) > 200
    field = pii.SkipChain.train(train)
    truth = np.maximum(np.array(held.seen), 0)
    assert (field.beliefs(held, use_evidence=False).argmax(1) == truth).mean() > 0.85


def test_skip_links_spread_labels():
    """A number that is a card once is the same card where a typing slip of another token stands beside it."""
    field = pii.SkipChain(np.zeros((pii.N_FEATURES, 5)), np.zeros((5, 5)), 6 * np.eye(5))
    text = "card 4111111111111111 then words and more words and 4111-1111-1111-1111x again"
    (base, spans), = pii.find_spans([text], field)
    assert [(k, text[s:e]) for s, k, e in base] == [(2, "4111111111111111"), (2, "4111-1111-1111-1111")]
    text = "id +49 (170) 1234567 and later (170) 1234567"
    (base, spans), = pii.find_spans([text], field)
    assert [text[s:e] for s, _, e in base] == ["+49 (170) 1234567"]
    assert [text[s:e] for s, k, e in spans if (s, k, e) not in base] == ["1234567"]


@pytest.mark.parametrize("n", [1, 50, 500])
@pytest.mark.parametrize("evidence_last", [False, True])
@pytest.mark.parametrize("prior", [0.0, 1.0])
def test_evidence_reaches_all_repeats(n, evidence_last, prior):
    field = pii.SkipChain(np.zeros((pii.N_FEATURES, 5)), np.zeros((5, 5)), 6 * np.eye(5))
    field.unary[0, 0] = prior
    cells = ["491701234567 words"] * n
    cells.insert(n if evidence_last else 0, "+491701234567 words")
    text = " and ".join(cells)
    # another document beside it does not change it
    (base, spans), _ = pii.find_spans([text, "at 12:30 " * 40], field)
    assert len(base) == 1 and len(spans) == n + 1 and {k for _, k, _ in spans} == {3}
    assert "1234567" not in pii.redact(text, [{"kind": "phone", "start": s, "end": e} for s, _, e in spans])


def test_beliefs_are_exact_on_a_chain():
    """Messages run until they stand still: forward and backward sums give the same beliefs."""
    rng = np.random.default_rng(4)
    for n in (2, 12, 60, 200):
        rows, links = [[int(i)] for i in rng.integers(0, pii.N_FEATURES, n)], [(i, i + 1) for i in range(n - 1)]
        field = pii.SkipChain(rng.normal(0, 0.1, (pii.N_FEATURES, 5)), np.zeros((5, 5)), 8 * np.eye(5))
        graph = pii.Graph(rows, [3] + [-1] * (n - 1), [], links)
        own, table = np.exp([field.unary[r[0]] for r in rows]), np.exp(field.skip)
        own[0] = np.eye(5)[3]
        ahead, behind = [own[0]], [np.ones(5)]
        for i in range(1, n):
            ahead.append(own[i] * (ahead[-1] / ahead[-1].sum() @ table))
            behind.append(table @ (own[n - i] * behind[-1] / behind[-1].sum()))
        exact = np.array(ahead) * np.array(behind[::-1])
        exact /= exact.sum(1, keepdims=True)
        assert np.abs(field.beliefs(graph) - exact).max() < 1e-3


def test_pii_memory_follows_parts_of_a_slice(monkeypatch):
    rng = np.random.default_rng(3)
    field = pii.SkipChain(rng.normal(0, 1, (pii.N_FEATURES, 5)), np.zeros((5, 5)), np.zeros((5, 5)))
    texts = [" ".join(map(str, rng.integers(0, 10, 1000))) for _ in range(150)]
    tracemalloc.start()
    pii.find_spans(texts, field)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 120 << 20, f"{most >> 20} MB for 300 kB of one-digit words"

    words = ["1", "22", "+4912345678", "a.b@c.de", "a.b@x.yz", "10.0.0.1", "123456", "foo", "4111111111111111"]
    texts = [" ".join(rng.choice(words, n)) for n in (90, 0, 40, 3, 70)]
    field = pii.SkipChain(*(rng.normal(0, 1, s) for s in ((pii.N_FEATURES, 5), (5, 5), (5, 5))))
    whole = pii.find_spans(texts, field)
    monkeypatch.setattr(pii, "GRAPH_VARIABLES", 50)
    monkeypatch.setattr(pii, "ROUND_MESSAGES", 7)
    assert pii.find_spans(texts, field) == whole == [found for t in texts for found in pii.find_spans([t], field)]
    assert any(spans != base for base, spans in whole)


def test_redact(docs, empty):
    out = pii.redact_all(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    assert out.where("text rlike '@mail|4111 1111'").count() == 0
    assert pii.redact_all(empty).collect() == []
    assert pii.redact("a b@c.de f", [{"kind": "email", "start": 2, "end": 8}]) == "a [EMAIL] f"


# -- 5: decontamination

def test_items_without_id_and_repeated_ids(spark):
    texts = ["alpha beta gamma delta", "one two three four", "red green blue"]
    items = spark.createDataFrame([(None, texts[0]), (7, texts[1]), (7, texts[2])], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {texts[0]} y"), (2, f"{texts[1]} and {texts[2]}")], "doc_id long, text string")
    for block_words in (decontamination.BLOCK_WORDS, 1):
        got = {r.doc_id: r.leak for r in decontamination.find_items(docs, items, block_words=block_words).collect()}
        assert [(got[i].n_hit, got[i].item_ids) for i in (1, 2)] == [(4, []), (7, [7])]
    assert {r.text for r in decontamination.remove_hits(docs, items, drop_share=0.7).collect()} == {"x  y"}


ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_hits(text, items):
    w = llm_rows.words(text, ITEM)
    hit, found = set(), set()
    for item_id, item in items:
        v = llm_rows.words(item, ITEM)
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item_id)
    return len(w), len(hit), sorted(found)


def some_items():
    texts = [t for _, t, *_ in ROWS if t and len(t) < 5000]
    cut = [" ".join(t.split()[3:20]) for t in texts[:12]]
    return [(i, t) for i, t in enumerate(cut)] + [(100, "one TWO"), (101, ""), (102, None), (103, "né! 日本語の文"), (104, cut[0]), (None, cut[1])]


@pytest.mark.parametrize("block_words", [4_000_000, 60])
def test_decontamination(spark, docs, block_words):
    items = some_items()
    got = decontamination.find_items(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    known = [(i, t) for i, t in items if i is not None]
    expected = sorted(((i, *plain_hits(t, known)) for i, t, *_ in ROWS), key=repr)
    assert sorted(((r.doc_id, r.leak.n_words, r.leak.n_hit, r.leak.item_ids) for r in got.collect()), key=repr) == expected


def test_remove_hits(spark, docs, empty):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")], "item_id long, text string")
    passage = "Alpha, beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(1, f"before it {'word ' * 30}{passage}. After it", None, None, None), (2, passage, None, None, None), (3, None, None, None, None)]
    out = decontamination.remove_hits(llm_rows.frame(spark, rows), items)
    assert {r.doc_id: r.text for r in out.collect()} == {1: f"before it {'word ' * 30}. After it", 3: None}
    assert decontamination.remove_hits(empty, items).collect() == []
    assert decontamination.remove_hits(docs, items.limit(0)).count() == len(ROWS)


# -- 8: quality rules

def plain_stats(text):
    text = text or ""
    w = llm_rows.words(text, lower=False)
    lines = [x for x in text.split("\n") if llm_rows.words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeat = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat)


def test_statistics(docs):
    forest = quality.IsolationForest.grow(np.zeros((0, len(quality.FEATURES))), np.ones(len(quality.FEATURES)))
    got = quality.judge(docs, forest).collect()
    plain = {t: plain_stats(t) for _, t, *_ in ROWS}
    assert len(got) == len(ROWS)
    for r in got:
        assert tuple(r.rules)[:5] == plain[r.text]
        n, *_, repeat = plain[r.text]
        assert r.rules.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert r.rules.kept == (not r.rules.base_failed)


def test_forest_held_out(spark):
    """Fitted on one half of the labelled rows, judged on the other."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    forest = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    other = quality.judge(docs.select("doc_id", "text"), forest).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT rules.base_failed")
    rate = {r.quality: r.kept for r in other.groupBy("quality").agg(F.avg(F.col("rules.kept").cast("int")).alias("kept")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.05


def test_quality_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(docs, none).columns == docs.columns
    assert quality.keep_good(empty, none).collect() == []


# -- 9: longest previous factors

def plain_removed(rows, least=50):
    first = {}
    texts = [(TOP if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in texts:
        for j in range(len(b) - least + 1):
            s = b[j : j + least]
            first[s] = min(first.get(s, TOP + 1), i)
    out = []
    for (i, b), row in zip(texts, rows):
        gone = np.zeros(len(b) + 1, np.int64)
        for j in range(len(b) - least + 1):
            if first[b[j : j + least]] < i:
                gone[j] += 1
                gone[j + least] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        out.append((row[0], len(b), hashlib.sha256(np.frombuffer(b, np.uint8)[keep].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def test_previous_factor_removal(docs, empty):
    got = suffixes.remove_copies(docs)
    plain = [(r.doc_id, r.n_bytes, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got.collect()]
    assert sorted(plain, key=repr) == plain_removed(ROWS)
    for r in got.collect():
        assert r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.spans)
    assert suffixes.remove_copies(empty).collect() == []


def test_previous_factors_small():
    rng = np.random.default_rng(4)
    for _ in range(60):
        rows = rng.integers(97, 99, (int(rng.integers(0, 14)), 6)).astype(np.uint8)
        ranks = rng.integers(0, 5, len(rows))
        expected = []
        for i, row in enumerate(rows):
            lengths = [int(np.argmin(np.append(row == other, False))) for other, r in zip(rows, ranks) if r < ranks[i]]
            expected.append(max(lengths, default=0))
        assert suffixes.previous_factors(rows, ranks).tolist() == expected


# -- 10: tokens

def test_tokens(spark, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = tokens.decode(tokens.encode(docs, path), path).collect()
    assert len(got) == len(ROWS)
    texts = sorted({r.text or "" for r in got})
    expected = dict(zip(texts, library.encode_batch(texts, add_special_tokens=False)))
    for r in got:
        ids = np.frombuffer(r.token_ids, "<u4").tolist()
        assert ids == expected[r.text or ""].ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert tokens.encode(empty, path).collect() == []


def test_codec_fuzz():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), random.Random(2)
    vocabulary = tokens.Vocabulary(path)
    some = {w: np.array(vocabulary.merge(w), '<u4').tobytes() for w in (b" the", b" then", b"the", b" a", b"\n", b" sand", b" hand")}
    codec = tokens.Codec(vocabulary, tokens.Lexicon.mapped(tokens.pack(tokens.compile_lexicon(some))))
    alphabet = ["the", " then", "a", " ", "  ", "\n", "\t", "　", "'s", "'", ",", "12", "é", "漢", "🙂", "<|endoftext|>", "\x00", "²", "́"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["x" * 5000, "ab" * 3000, " " * 1000 + "a"]
    for ids, encoding in zip(codec.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.ids


def test_codec_cuts_pieces_together():
    """The pattern runs over the new pieces of a batch at once, and gives each piece the words that it has alone."""
    import public_tokenizers

    rng = random.Random(7)
    vocabulary = tokens.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    codec = tokens.Codec(vocabulary, tokens.Lexicon.mapped(tokens.pack(tokens.compile_lexicon({}))))
    calls, plain = [], codec.split_early
    codec.split_early = lambda s: calls.append(s) or plain(s)
    codec.encode([" ".join(f"word{i}.\nNext," for i in range(at, at + 200)) for at in range(0, 2000, 200)])
    assert len(calls) < 30, f"{len(calls)} calls for 2,000 pieces"

    parts = ["a", "the", ".", ",", "\n", "\t", "\xa0", "\u3000", "'s", "'", "1", "\x1c", "\x00", "é", "漢", "²", "\n\n"]
    for late in ("", "\u1c89\u088f"):
        pieces = [" " + "".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) for _ in range(3000)] + [f" x{late}", " "]
        assert codec.cut(pieces) == [codec.split(p) for p in pieces]
    assert codec.cut([]) == []


def test_codec_all_code_points():
    """Letter, digit and space classes are the library's for every code point."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, vocabulary = Tokenizer.from_file(path), tokens.Vocabulary(path)
    codec = tokens.Codec(vocabulary, tokens.Lexicon.mapped(tokens.pack(tokens.compile_lexicon({}))))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        text = "".join(f"a{c}! {c}1{c}" for c in points[at : at + 50_000])
        expected, end = [to for _, (_, to) in library.pre_tokenizer.pre_tokenize_str(text)], 0
        for word, to in zip(codec.split(text), expected, strict=True):
            end += len(word)
            assert end == to
        # text without a late code point takes the plain pattern
        plain = "".join(c for c in text if not codec.late(c))
        assert codec.split(plain) == codec.split_late(plain)
    late = [c for c in points if codec.late(c)][::40]
    texts = [f"x{c}'s {c}{c} 7{c}" for c in late]
    for ids, encoding in zip(codec.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.ids


def test_transducer_is_minimal_and_exact():
    words = {w.encode(): np.array([i, i + 1], '<u4').tobytes() for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", ""])}
    arrays = tokens.compile_lexicon(words)
    lexicon = tokens.Lexicon.mapped(tokens.pack(arrays))
    found = lexicon.find([*words, b"ta", b"x", b"stopsx"])
    assert [lexicon.ids(p) for p in found[:7].tolist()] == list(words.values())
    assert found[7:].tolist() == [-1, -1, -1]
    # t, ta/to/sto share what follows: fewer states than letters
    assert len(arrays["final"]) == 7


# -- all: other columns with the names that operators use inside

def test_clashing_columns(spark, docs):
    names = "leak rules pii token_ids decoded chunk ids sizes data key family label node component digest part shard slot size place range".split()
    clashing = docs
    for name in names:
        clashing = clashing.withColumn(name, F.lit("own"))
    items = spark.createDataFrame(some_items(), "item_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    small = clashing.where("length(text) < 5000")
    n = small.count()
    assert decontamination.remove_hits(small, items, drop_share=1.0).count() == n
    assert pii.redact_all(small).count() == n
    assert ngram_join.join_documents(small).count() == n
    assert ngram_join.keep_one(small).columns == small.columns
    assert sharding.assign_shards(small).count() == n
    assert substrings.repeated_units(small).count() == n
    assert suffixes.remove_copies(small).count() == n
    assert quality.keep_good(small, none).columns == small.columns
