"""Operators on pages: archives and main text."""

import base64
import hashlib
import html
import pathlib
import re
import zlib

import numpy as np
import pytest

from assayline.llm import html_text, warc

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (5, "http://a.example/", "<p>same</p>"),
    (3, "http://b.example/x y\r\nz", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (9, "http://c.example/", "<p>other</p>"),
    (None, "http://d.example/", "<p>same</p>"),
    (1, "http://e.example/é", None),
    (2, "http://f.example/", ""),
    (2**62, "http://g.example/", "né" * 200_000),
    (-4, "http://h.example/", "\r\n\r\nWARC/1.1\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def folder_of(tmp_path, name):
    return f"file://{tmp_path}/{name}"


@pytest.mark.parametrize("least_bytes", [0, 12])
def test_round_trip(spark, pages, tmp_path, least_bytes):
    folder = folder_of(tmp_path, "a")
    manifest = warc.write_warc(pages, folder, least_bytes=least_bytes)
    got = warc.read_warc(manifest, folder).collect()
    first = {}
    for i, _, t in ROWS:
        first.setdefault(t or "", []).append(2**63 if i is None else i)
    expected = []
    for i, url, t in ROWS:
        payload = (t or "").encode()
        low = min(first[t or ""])
        revisit = len(payload) >= least_bytes and low != (2**63 if i is None else i)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected.append((i, len(payload), digest, "revisit" if revisit else "response", low if revisit else None, None if revisit else payload))
    plain = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in got]
    assert sorted(plain, key=repr) == sorted(expected, key=repr)
    assert manifest.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_same_bytes_whatever_the_partitions(spark, pages, tmp_path):
    def files(name, parts):
        warc.write_warc(pages.repartition(parts), folder_of(tmp_path, name), roll_bytes=600, range_bytes=900)
        return {f.name: f.read_bytes() for f in pathlib.Path(tmp_path, name).glob("*.warc.gz")}

    one, two = files("one", 1), files("two", 7)
    assert one == two and len(one) > 3
    assert not list(pathlib.Path(tmp_path, "one", "_temporary").iterdir())
    for name, data in one.items():
        sizes = []
        while data:
            member = zlib.decompressobj(31)
            assert member.decompress(data).startswith(b"WARC/1.1\r\n")
            sizes.append(len(data) - len(member.unused_data))
            data = member.unused_data
        # beyond the limit only with a single page's record
        assert sum(sizes) <= 600 or len(sizes) == 2, name


def test_sorted_by_id(spark, pages, tmp_path):
    folder = folder_of(tmp_path, "s")
    manifest = warc.write_warc(pages, folder, roll_bytes=600, range_bytes=900)
    ids = []
    for row in manifest.orderBy("file").collect():
        with warc.open_folder(folder)[0].open_input_stream(f"{tmp_path}/s/{row.file}", compression=None) as stream:
            ids += [r["page_id"] for r in map(warc.parse_record, warc._members(stream)) if r]
    numbers = [i for i in ids if i is not None]
    assert numbers == sorted(numbers) and ids[-1] is None


def test_broken_digest_is_noticed():
    record = warc.make_record(1, "http://a.example/", b"payload")
    assert warc.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"payl0ad"))


def test_range_cuts(spark):
    keys = spark.range(1000).selectExpr("id * id AS page_id", "10L AS size")
    cuts = warc.range_cuts(keys, 1000)
    ids = np.arange(1000) ** 2
    loads = np.bincount(np.searchsorted(cuts, ids, "left")) * 10
    assert loads.max() <= 1000 and len(cuts) < 25
    # one id with everything, and ids at both ends of the range
    keys = spark.createDataFrame([(-(2**62), 1), (2**62, 1)] + [(7, 500)] * 5, "page_id long, size long")
    assert len(warc.range_cuts(keys, 100)) == 2
    assert warc.range_cuts(keys.limit(0), 100) == []


def test_range_cuts_leave_nothing_heavy(spark, monkeypatch):
    monkeypatch.setattr(warc, "BINS", 16)
    even = np.arange(400)
    # more heavy intervals than a pass takes: six runs of ids, far apart
    skewed = np.concatenate([k * 10**6 + np.arange(30) for k in range(6)])
    for ids in (even, skewed):
        keys = spark.createDataFrame([(int(i), 10) for i in ids], "page_id long, size long").coalesce(1)
        cuts = warc.range_cuts(keys, 100)
        assert np.bincount(np.searchsorted(cuts, ids, "left")).max() * 10 <= 100


def test_no_pages(spark, pages, tmp_path):
    folder = folder_of(tmp_path, "e")
    assert warc.read_warc(warc.write_warc(pages.limit(0), folder), folder).collect() == []


# -- main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=x>Menu</a></li></ul></nav>
<div id="cookie-banner">We use cookies.</div><!-- a <p>comment</p> -->
<main><article><h1>Title &amp;
 more</h1><p>First <b>bo</b>ld&nbsp;para<br>next &lt;tag&gt; 1 < 2.<p>Second para, <a href="y>z">a link</a>.</p>
<form><label>Mail</label><input name=q></form><ul><li>one item</li><li>two</li></ul>
<div class="comments"><p>Nice post! I liked it very much indeed.</p></div></article></main>
<aside><p>Some other story.</p></aside><footer>&copy; 2000</footer></body></html>"""


@pytest.fixture(scope="module")
def network(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    return html_text.train_on(table.where("page_id % 2 = 0"))


def test_blocks():
    blocks = html_text.blocks_of(PAGE)
    texts = [t for _, t, _ in blocks]
    assert "Title & more" in texts and "First bold para" in texts and "next <tag> 1 < 2." in texts
    assert "Second para, a link." in texts
    assert not any("no" == t or "var a" in t or "p{}" in t or t == "T" or "comment" == t for t in texts)
    assert next(n for _, t, n in blocks if t == "Menu") == 4


def test_odd_markup():
    for page in ("", "<", "a < b", "<p", "<p>a</p", "</x><p>a", "<script>x", "<!-- x", "<a href='", "<p class=\"x>y", "&amp", "<" * 5000, "<div>" * 20_000 + "a"):
        html_text.blocks_of(page)
    assert [b[1] for b in html_text.blocks_of("a &amp b<td>c<td>d")] == ["a & b", "c", "d"]


def test_extract(spark, network):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", PAGE), (4, "u", "<article>" + "<p>word word word.</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = html_text.extract(pages.selectExpr("*", "'own' AS text"), network).collect()
    expected = "Title & more First bold para next <tag> 1 < 2. Second para, a link. one item two"
    assert [r.text for r in got if r.page_id in (1, None)] == [expected] * 3
    assert [r.text for r in got if r.page_id in (2, 3)] == ["", ""]
    assert [len(r.text.split()) for r in got if r.page_id == 4] == [60_000]
    assert html_text.extract(pages.limit(0), network).collect() == []


def test_held_out_pages(spark, network):
    """Pages that the network has not seen, against their article element as text."""
    table = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id % 2 = 1")
    wrong = 0
    got = {r.page_id: r.text for r in html_text.extract(table, network).collect()}
    for r in table.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S).group(1)
        article = re.sub(r"</?[bi]>", "", article)
        plain = " ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", article)).split())
        wrong += plain != got[r.page_id]
    assert wrong <= 0.005 * len(got)


def test_held_out_compositions(network):
    rng = np.random.default_rng(77)
    texts, asides = ["A text of an article that goes on for a while, and on."] * 3, ["Menu", "More of this", "Sign up now"]
    pages = [html_text.composed(rng, texts, asides) for _ in range(300)]
    labels = network.label([p for p, _ in pages])
    right = np.concatenate([(y > 0.5) == np.array(own) for y, (_, own) in zip(labels, pages)])
    assert right.mean() > 0.97


def test_lstm_gradient():
    """Backpropagation against differences."""
    rng = np.random.default_rng(1)
    network = html_text.BiLstm.fresh()
    x = rng.normal(size=(4, 2, html_text.DIMS))
    mask = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    y = np.array([[1, 0], [0, 1], [1, 0], [0, 0]], float)

    def loss():
        p = network.forward(x, mask)[0]
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum()

    p, both, kf, kb = network.forward(x, mask)
    dboth = ((p - y) * mask)[:, :, None] * network.v
    forward = network._back(x, network.uf, kf, dboth[:, :, : html_text.HIDDEN])
    backward = network._back(x[::-1], network.ub, kb, dboth[::-1, :, html_text.HIDDEN :])
    for name, grad in (("wf", forward[0]), ("uf", forward[1]), ("bf", forward[2]), ("wb", backward[0]), ("ub", backward[1])):
        weights = getattr(network, name)
        at = tuple(int(rng.integers(s)) for s in weights.shape)
        keep = weights[at]
        weights[at] = keep + 1e-5
        up = loss()
        weights[at] = keep - 1e-5
        down = loss()
        weights[at] = keep
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-5


def test_fallbacks_and_formulas_are_text():
    page = (
        "<article><p>a <math><mi>x</mi></math> b</p><object><p>fallback</p></object><noscript>plain</noscript>"
        "<xmp>c <b> &amp; d</xmp><svg><text>s</text></svg><select><option>o</option></select><p>end</p></article>"
    )
    assert " ".join(text for _, text, _ in html_text.blocks_of(page)) == "a x b fallback plain c <b> &amp; d end"
    assert html_text.blocks_of("<xmp>never closed")[0][1] == "never closed"
