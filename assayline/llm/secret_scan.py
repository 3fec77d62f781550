"""Secrets in texts: three plain patterns, and long tokens that pass a battery of randomness tests.

DataFrame functions only. A token is a run of at least ``MIN_TOKEN`` letters, digits,
``+ / _ -``. Its encoding is the smallest alphabet that holds it and of which it shows
every kind of character; tokens that fit none (words, numbers, snake_case) are no
candidates. Under the hypothesis that a token is uniform noise in its encoding three
tests give p-values:

* chi-squared of the character counts, fitted by its exact mean and variance (a token
  is shorter than its alphabet, so the asymptotic distribution would not do);
* runs above and below the middle of the alphabet (Wald and Wolfowitz);
* circular serial correlation of neighbouring characters.

Fisher's sum combines them. Short tokens pass such tests more easily than long ones,
so what to accept is decided for each encoding and length class apart, over the
distinct tokens of all documents: the tokens above ``LAMBDA`` tell how many random
ones there are, what is accepted beyond their share is false, and the lowest p-value
bound whose estimated share of false ones stays within ``FALSE_SHARE`` is taken. Where
nearly all tokens are random that would let in a few that plainly are not, so no token
below ``LEAST_P`` is accepted anywhere.

Nothing but one bin count a token shuffles, combined map-side; the driver sees one
bound for each encoding and length class (at most ``len(ENCODINGS) * 64`` numbers).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.blocks import free_name, stored

# fixed values: the patterns of the plain kinds
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
LEAST_VALUE = 6

#: Order of kinds where two spans start at one place.
KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

MIN_TOKEN = 20
TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}+"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Name, what a token must show, its alphabet in order; the first that fits is taken.
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", _DIGITS + _LOWER),
    ("BASE36", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", _DIGITS + _UPPER),
    ("base62", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
]

#: Estimated share of false ones among the accepted tokens of a length class.
FALSE_SHARE = 0.05
LAMBDA = 0.5
BINS = 50
#: Of the random tokens one in a thousand is this unlikely.
LEAST_P = 0.001

_CHUNK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda n, x: n + x)


def _sums_before(values: Column) -> Column:
    """For each element the sum of those before it, in chunks: linear work for any realistic length."""

    def cut(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.ceil(F.size(v) / _CHUNK).cast("int") - 1)
        return F.transform(starts, lambda c: F.slice(v, c * _CHUNK + 1, _CHUNK))

    def of_chunks(chunks: Column) -> Column:
        totals = F.transform(chunks, _sum)
        offsets = let(totals, lambda t: F.transform(t, lambda _, i: _sum(F.slice(t, 1, i))))
        return F.flatten(
            F.zip_with(
                chunks,
                offsets,
                lambda chunk, at: F.transform(chunk, lambda _, i: at + _sum(F.slice(chunk, 1, i))),
            )
        )

    return let(let(values, cut), of_chunks)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost matches that do not overlap: array of (start, end, value), code points, end exclusive.

    ``value`` is the group asked for. The pattern must not match the empty text.
    Places come from the lengths of the matches and of what lies between them.
    """
    whole, value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    parts = F.zip_with(
        F.zip_with(
            F.split(text, pattern, -1),
            whole,
            lambda gap, m: F.struct(F.char_length(gap).cast("long").alias("gap"), F.char_length(m).cast("long").alias("size")),
        ),
        value,
        lambda part, v: F.struct(part["gap"].alias("gap"), part["size"].alias("size"), v.alias("value")),
    )

    def placed(rows: Column) -> Column:
        before = _sums_before(F.transform(rows, lambda r: r["gap"] + r["size"]))
        return F.zip_with(
            rows,
            before,
            lambda r, at: F.struct(
                (at + r["gap"]).alias("start"), (at + r["gap"] + r["size"]).alias("end"), r["value"].alias("value")
            ),
        )

    # the last piece has no match behind it
    found = let(F.filter(parts, lambda p: p["size"].isNotNull()), placed)
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(none)


def _spans(found: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), m["end"].alias("end")))


def _blanked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """The text with spaces in place of its matches (those whose group is long enough); places stay."""
    whole, value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    fill = F.zip_with(
        whole,
        value,
        lambda m, v: F.when(F.char_length(v) >= least, F.repeat(F.lit(" "), F.char_length(m))).otherwise(m),
    )
    pieces = F.zip_with(F.split(text, pattern, -1), fill, lambda gap, f: F.concat(gap, F.ifnull(f, F.lit(""))))
    return F.when(F.rlike(text, F.lit(pattern)), F.array_join(pieces, "")).otherwise(text)


def base_spans(text: Column) -> Column:
    """Matches of the three plain kinds: array of (start, rank, end) by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.char_length(m["value"]) >= LEAST_VALUE)
    return F.array_sort(
        F.concat(_spans(assign, "assign"), _spans(matches(text, ACCESS), "access"), _spans(matches(text, HEX), "hex"))
    )


# -- the battery


def _upper_tail(z: Column) -> Column:
    """P(normal > z), to seven places; a polynomial in 1 / (1 + 0.23 |z|)."""

    def side(a: Column) -> Column:
        t = 1 / (1 + F.lit(0.2316419) * a)
        # fixed values: the polynomial's coefficients
        terms = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]
        poly = reduce(lambda acc, c: (acc + F.lit(c)) * t, reversed(terms), F.lit(0.0))
        return F.exp(-a * a / 2) / F.lit((2 * 3.141592653589793) ** 0.5) * poly

    return let(z, lambda x: F.when(x >= 0, side(F.abs(x))).otherwise(1 - side(F.abs(x))))


def _uniform(token: Column, alphabet: Column, n: Column, k: Column) -> Column:
    squares = F.aggregate(
        F.split(alphabet, ""),
        F.lit(0).cast("long"),
        lambda acc, c: acc + F.pow(n - F.char_length(F.replace(token, c, F.lit(""))), F.lit(2)).cast("long"),
    )
    statistic = k * squares / n - n
    # its mean is k - 1 and its variance 2 (k - 1) (n - 1) / n: a scaled chi-squared with this many degrees
    degrees = (k - 1) * n / (n - 1)
    spread = F.lit(2.0) / (F.lit(9.0) * degrees)
    cube = F.pow(F.greatest(statistic, F.lit(0.0)) / (k - 1), F.lit(1 / 3))
    return _upper_tail((cube - (1 - spread)) / F.sqrt(spread))


def _runs(halves: Column, n: Column) -> Column:
    """p of the number of runs in a text of 0 and 1."""
    ups = (n - F.char_length(F.replace(halves, F.lit("01"), F.lit("")))) / 2
    downs = (n - F.char_length(F.replace(halves, F.lit("10"), F.lit("")))) / 2
    zeros = F.char_length(F.replace(halves, F.lit("1"), F.lit("")))

    def p(s: Column) -> Column:
        mean = 2.0 * s["zeros"] * (n - s["zeros"]) / n + 1
        sd = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
        off = F.greatest(F.abs(s["runs"] - mean) - 0.5, F.lit(0.0))
        one_kind = (s["zeros"] == 0) | (s["zeros"] == n)
        return F.when(one_kind, F.lit(0.0)).otherwise(F.least(F.lit(1.0), 2 * _upper_tail(off / sd)))

    return let(F.struct(zeros.alias("zeros"), (ups + downs + 1).alias("runs")), p)


def _serial(token: Column, alphabet: Column, n: Column) -> Column:
    """p of the circular correlation of neighbours."""

    def summed(codes: Column) -> Column:
        start = F.struct(
            F.element_at(codes, -1).alias("last"), *[F.lit(0).cast("long").alias(name) for name in ("s", "ss", "sn")]
        )
        return F.aggregate(
            codes,
            start,
            lambda acc, c: F.struct(
                c.alias("last"),
                (acc["s"] + c).alias("s"),
                (acc["ss"] + c * c).alias("ss"),
                (acc["sn"] + acc["last"] * c).alias("sn"),
            ),
        )

    def p(t: Column) -> Column:
        square = t["s"].cast("double") * t["s"]
        below = n * t["ss"] - square
        r = (n * t["sn"] - square) / below
        sd = n / ((n - 1) * F.sqrt(n - 2.0))
        z = F.abs(r + 1 / (n - 1.0)) / sd
        return F.when(below <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), 2 * _upper_tail(z)))

    codes = F.transform(F.split(token, ""), lambda c: F.position(c, alphabet).cast("long"))
    return let(codes, lambda c: let(summed(c), p))


def _fisher(p_values: list[Column]) -> Column:
    """Of three p-values: the tail of a chi-squared with six degrees, which has a closed form."""
    half = reduce(lambda a, b: a + b, [-F.ln(F.greatest(p, F.lit(1e-300))) for p in p_values])
    return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))


def _first_fit(token: Column, values: list[Column]) -> Column:
    out = F.lit(None)
    for (_, pattern, _), value in reversed(list(zip(ENCODINGS, values))):
        out = F.when(F.rlike(token, F.lit(pattern)), value).otherwise(out)
    return out


def battery(token: Column) -> Column:
    """(encoding number, p) of a token of at least three characters; NULL if no encoding fits."""
    halves = [F.translate(token, a, "0" * (len(a) // 2) + "1" * (len(a) // 2)) for _, _, a in ENCODINGS]
    fit = _first_fit(
        token,
        [
            F.struct(F.lit(i).alias("encoding"), F.lit(a).alias("alphabet"), halves[i].alias("halves"))
            for i, (_, _, a) in enumerate(ENCODINGS)
        ],
    )

    def tested(f: Column) -> Column:
        n, k = F.char_length(token).cast("long"), F.char_length(f["alphabet"]).cast("long")
        p = _fisher([_uniform(token, f["alphabet"], n, k), _runs(f["halves"], n), _serial(token, f["alphabet"], n)])
        return F.when(f.isNotNull(), F.struct(f["encoding"].alias("encoding"), p.alias("p")))

    return let(fit, tested)


# -- the operator


def scored(docs: DataFrame, text_col: str = "text", out_col: str = "scan") -> DataFrame:
    """``docs`` with ``out_col``: base spans and candidate tokens with their digest, stratum and p-value.

    What base spans cover is blanked before tokens are looked for: it is reported
    already. No token's text is in the result.
    """
    base, rest = free_name(docs, "__base"), free_name(docs, "__rest")
    text = F.ifnull(F.col(f"`{text_col}`"), F.lit(""))

    def row(m: Column) -> Column:
        length_class = F.floor(2 * F.log2(F.char_length(m["value"]))).cast("int")
        return let(
            battery(m["value"]),
            lambda b: F.when(
                b.isNotNull(),
                F.struct(
                    m["start"].alias("start"),
                    m["end"].alias("end"),
                    F.sha2(m["value"], 256).alias("digest"),
                    (b["encoding"] * 64 + length_class).alias("stratum"),
                    b["p"].alias("p"),
                ),
            ),
        )

    rows = docs.drop(out_col).withColumn(base, base_spans(text))
    rows = rows.withColumn(rest, _blanked(text, ASSIGN, 2, LEAST_VALUE))
    rows = rows.withColumn(rest, _blanked(F.col(rest), ACCESS)).withColumn(rest, _blanked(F.col(rest), HEX))
    tokens = F.filter(F.transform(matches(F.col(rest), TOKEN), row), lambda t: t.isNotNull())
    return rows.withColumn(out_col, F.struct(F.col(base).alias("base"), tokens.alias("tokens"))).drop(base, rest)


def bounds(tokens: DataFrame, false_share: float = FALSE_SHARE) -> dict[int, float]:
    """The least p-value that counts as random, for each stratum of ``tokens`` (digest, stratum, p).

    Copies of a token count once. With ``a(t)`` tokens at or above t and ``r`` random
    ones in all, estimated as ``a(LAMBDA) / (1 - LAMBDA)``, the false ones are
    ``a(t) - r (1 - t)``.
    """
    bin_of = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")
    distinct = tokens.groupBy("digest").agg(F.any_value("stratum").alias("stratum"), F.any_value("p").alias("p"))
    counts = distinct.groupBy("stratum", bin_of.alias("bin")).agg(F.count("*").alias("n"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(int(LAMBDA * BINS))))
    # at most BINS rows for a stratum; every possible bound is tried
    rows = counts.groupBy("stratum").agg(F.collect_list(F.struct("bin", "n")).alias("bins"))

    def above(at: Column) -> Column:
        return F.aggregate(
            F.filter("bins", lambda b: b["bin"] >= at), F.lit(0).cast("long"), lambda acc, b: acc + b["n"]
        )

    tried = rows.withColumn("at", steps).select(
        "stratum",
        "at",
        above(F.col("at")).alias("accepted"),
        (above(F.lit(int(LAMBDA * BINS))) / (1 - LAMBDA)).alias("random"),
    )
    false = F.col("accepted") - F.col("random") * (1 - F.col("at") / BINS)
    fits = tried.where(false <= false_share * F.col("accepted")).groupBy("stratum").agg(F.min("at").alias("at"))
    return {r["stratum"]: r["at"] / BINS for r in fits.collect()}


def decided(rows: DataFrame, least: dict[int, float], scan_col: str = "scan") -> DataFrame:
    """``rows`` of ``scored`` with all spans in place of the scan: array of (start, rank, end), by start, then kind."""
    known = [x for item in sorted(least.items()) for x in (F.lit(item[0]), F.lit(item[1]))]
    bound = F.create_map(*known) if known else F.create_map().cast("map<int,double>")
    random = F.filter(
        F.col(scan_col)["tokens"],
        lambda t: t["p"] >= F.greatest(F.lit(LEAST_P), F.ifnull(F.try_element_at(bound, t["stratum"]), F.lit(LAMBDA))),
    )
    return rows.withColumn(scan_col, F.array_sort(F.concat(F.col(scan_col)["base"], _spans(random, "random"))))


def find_secrets(
    docs: DataFrame, text_col: str = "text", out_col: str = "secrets", false_share: float = FALSE_SHARE
) -> DataFrame:
    """``docs`` with ``out_col``: array of (start, rank, end) of all secrets; ``KINDS[rank]`` is the kind.

    NULL counts as empty; repeated rows are marked alike and count once in the
    bounds; an empty table stays empty. The texts are scanned twice: for the bounds
    and for the result. Other columns stay, whatever their names.
    """
    scan = scored(docs.select(F.col(f"`{text_col}`").alias("text")))
    least = bounds(scan.select(F.explode("scan.tokens").alias("t")).select("t.*"), false_share)
    return decided(scored(docs, text_col, out_col), least, out_col)


def redacted(text: Column, spans: Column) -> Column:
    """A text with every secret replaced by its kind in brackets; overlapping spans are replaced once."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def add(acc: Column, s: Column) -> Column:
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        more = F.concat(acc["parts"], F.array(between, F.element_at(names, s["rank"] + 1)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], more).otherwise(acc["parts"]).alias("parts"),
        )

    def done(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, done)).otherwise(text)


def _cells(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ","
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, one row per document row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    # spans and digests are written once, without texts
    scan = stored(scored(docs).drop("text"), "secrets")
    least = bounds(scan.select(F.explode("scan.tokens").alias("t")).select("t.*"))
    spans = decided(scan, least).withColumnRenamed("scan", "found")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["rank"] < len(BASE_KINDS))
    return spans.select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(_cells(base).cast("binary"), 256).alias("base_sha256"),
        _cells(F.col("found")).alias("spans"),
        count("random"),
    )


QUERIES = {"op11_secret_scan": op11_secret_scan}
ORACLES: dict[str, str] = {}
