"""Secret scans: base spans against plain patterns, the battery against its formulas, held-out tokens, odd rows."""

import hashlib
import math
import random
import re
import string

import duckdb
import llm_rows
from pyspark.sql import functions as F

from assayline.llm import secret_scan as s

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def plain_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)


def found(spark, texts):
    return {r.id: [tuple(x) for x in r.secrets] for r in s.find_secrets(frame(spark, texts)).collect()}


def test_base_spans(spark):
    rng = random.Random(1)
    parts = ["token", "toKen=", "api_key: ", "APIKEY", "passwd'", "=", ":", " ", '"', "abc", "abcdef", "AKIA", "0A" * 9,
             "0a" * 12, "f" * 23, "f" * 24, "\n", "é", "🙂", "ſecret=abcdef", "Z" * 17, "secret==x/y.z", "-"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(400)]
    texts += ["token=token:abcdefgh", "AKIAAKIA" + "B" * 15, "AKIA" + "b" * 30, "password: ", None, ""]
    texts += [" ".join(["token=abcdef", "deadbeef" * 3] * 700)]  # more matches than a chunk of sums
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert [x for x in got[i] if x[1] < 3] == plain_base(text), text


def plain_battery(token):
    """p of the three tests and of all, by their formulas."""
    encoding, alphabet = next((i, a) for i, (_, p, a) in enumerate(s.ENCODINGS) if re.match(p, token))
    n, k = len(token), len(alphabet)
    tail = lambda z: math.erfc(z / 2**0.5) / 2
    x = k * sum(token.count(c) ** 2 for c in alphabet) / n - n
    spread = 2 / (9 * (k - 1) * n / (n - 1))
    uniform = tail(((x / (k - 1)) ** (1 / 3) - (1 - spread)) / spread**0.5)
    codes = [alphabet.index(c) for c in token]
    high = [c >= k // 2 for c in codes]
    n1, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * n1 * (n - n1) / n + 1
    sd = ((mean - 1) * (mean - 2) / (n - 1)) ** 0.5
    run = 0 if n1 in (0, n) else min(1, 2 * tail(max(0, abs(runs - mean) - 0.5) / sd))
    up = [c + 1 for c in codes]
    below = n * sum(c * c for c in up) - sum(up) ** 2
    r = (n * sum(a * b for a, b in zip(up, up[1:] + up[:1])) - sum(up) ** 2) / below if below else 0
    serial = min(1, 2 * tail(abs(r + 1 / (n - 1)) / (n / ((n - 1) * (n - 2) ** 0.5)))) if below else 0
    h = -sum(math.log(max(p, 1e-300)) for p in (uniform, run, serial))
    return encoding, math.exp(-h) * (1 + h + h * h / 2)


def noise(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_battery(spark):
    rng = random.Random(2)
    tokens = [noise(rng, a, rng.randrange(20, 80)) for _, _, a in s.ENCODINGS for _ in range(12)]
    tokens += ["getElementByIdentifierName", "abcdefghij0123456789klmno", "a1" * 20, "A" * 19 + "b2", "Ab" * 5000]
    fits = [t for t in tokens if any(re.match(p, t) for _, p, _ in s.ENCODINGS)]
    rows = frame(spark, fits).select("text", s.battery(F.col("text")).alias("b")).collect()
    assert len(rows) > 90
    for text, b in rows:
        encoding, p = plain_battery(text)
        assert b.encoding == encoding and abs(b.p - p) < 1e-4
    plain = ["onlylowercaseletters", "1234567890123456789012", "UPPERCASELETTERSONLYHERE", "snake_case_and/path+x-y"]
    assert all(b is None for _, b in frame(spark, plain).select("text", s.battery(F.col("text")).alias("b")).collect())


def test_held_out(spark):
    """Random tokens are found, also among many ordinary ones of the same length; those stay."""
    rng = random.Random(3)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.digits + string.ascii_lowercase]
    tokens = [noise(rng, rng.choice(alphabets), rng.choice([24, 32, 40, 64])) for _ in range(400)]
    syllables = ["get", "set", "Page", "Name", "User", "Item", "Value", "List", "Index", "Table", "For", "By", "Of"]
    names = []
    while len(names) < 400:
        name = "".join(rng.choice(syllables) for _ in range(9))[: rng.choice([24, 32, 40])]
        names.append(name + str(rng.randrange(10)))
    got = found(spark, [f"see {t} here" for t in tokens + names])
    caught = sum(got[i] == [(4, 3, 4 + len(t))] for i, t in enumerate(tokens))
    wrong = sum(bool(got[400 + i]) for i in range(400))
    assert caught >= 0.95 * 400 and wrong <= 0.05 * caught


def test_bounds(spark):
    """By brute force over the possible bounds; copies of a token count once."""
    rng = random.Random(4)
    rows = [(f"d{i}", st, p) for i in range(600) for st, p in [(i % 3, rng.random() ** (1 + 3 * (i % 3)))]]
    tokens = spark.createDataFrame(rows + rows[:200] * 3, "digest string, stratum int, p double")
    got = s.bounds(tokens)
    for stratum in range(3):
        bins = [min(49, math.floor(p * 50)) for _, st, p in rows if st == stratum]
        above = lambda t: sum(b >= t for b in bins)  # noqa: B023, E731
        random_ones = above(25) / 0.5
        fits = [t for t in range(26) if above(t) - random_ones * (1 - t / 50) <= 0.05 * above(t)]
        assert got[stratum] == min(fits) / 50
    assert s.bounds(tokens.limit(0)) == {}


def test_redacted(spark):
    key = "k3J9" * 3 + "Zp0qW7xR"
    texts = [f'a token = "{"0f" * 20}" b {key} é', None, "plain"]
    rows = s.find_secrets(frame(spark, texts)).select("id", s.redacted(F.col("text"), F.col("secrets")).alias("t")).collect()
    out = {r.id: r.t for r in rows}
    assert out[0].startswith("a [assign]\" b ") and "0f0f" not in out[0]
    assert out[1] is None and out[2] == "plain"


def test_query(spark):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = s.op11_secret_scan(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        cells = [f"{s.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(cells).encode()).hexdigest()
        assert [c for c in r.spans.split(",") if c and not c.startswith("random")] == cells


def test_odd_rows_and_names(spark):
    rows = llm_rows.documents(20) + llm_rows.odd_rows()
    docs = llm_rows.frame(spark, rows).withColumnRenamed("lang", "scan").withColumnRenamed("source", "__base")
    out = s.find_secrets(docs)
    assert out.columns == [*docs.columns, "secrets"]
    assert sorted(map(repr, (tuple(r)[:-1] for r in out.collect()))) == sorted(map(repr, rows))
    assert s.find_secrets(docs.limit(0)).collect() == []


def test_native(spark):
    """No Python worker in any plan."""
    plan = s.find_secrets(llm_rows.frame(spark, llm_rows.documents(5)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
