"""Deterministic WARC writer: range-sorted records, files rolled by compressed size, commit by rename and manifest.

The cut points of the id ranges come from exact sums over the whole table, so the
same table gives the same files, byte for byte, whatever the partitions were. A task
writes each file under a temporary name and renames it when it is complete; a task
that runs again makes the same bytes under the same name. The manifest lists the
files that belong to the archive; readers open no others.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.blocks import map_arrow, scratch_path, shares, stored

#: Compressed bytes at which a file is closed, and raw bytes that one range of ids holds about.
ROLL_BYTES = 256 << 20
RANGE_BYTES = 64 << 20
#: Ranges that even a small table is cut into.
LEAST_RANGES = 64
#: Id intervals that a pass over the ids sums up.
BINS = 4_096
#: Stated in every record: capture times are not in the table, and runs must not differ.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-records")

MANIFEST = "file string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def _uri(url: str) -> str:
    """Header values are one line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def make_record(page_id, url, payload: bytes, refers_to=None, refers_url=None, revisit: bool = False) -> bytes:
    """One response or revisit record; digests and lengths are made from the payload."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_uri(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
        head += [f"X-Refers-To-Page: {refers_to}"]
        if refers_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_uri(refers_url)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(record: bytes) -> bytes:
    """One gzip member without a time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """A folder in any store that its URI names."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class _Roller:
    """Writes members to files of one folder; gives a manifest row for each file it closes."""

    def __init__(self, uri: str, roll: int):
        self.store, self.folder = open_folder(uri)
        self.roll, self.out, self.name = roll, None, None
        self.store.create_dir(f"{self.folder}/_temporary", recursive=True)

    def add(self, range_no: int, member: bytes) -> Iterator[tuple]:
        if self.out and (range_no != self.range_no or self.bytes + len(member) > self.roll):
            yield self.close()
        if not self.out:
            same = self.name is not None and range_no == self.range_no
            self.range_no, self.part = range_no, self.part + 1 if same else 0
            self.name = f"pages-{range_no:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out, self.records, self.bytes, self.sha = self.store.open_output_stream(self.temporary), 0, 0, hashlib.sha256()
            info = f"software: range-sorted writer\r\nfilename: {self.name}\r\n".encode()
            head = (
                f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id(self.name, '')}\r\nWARC-Date: {DATE}\r\n"
                f"WARC-Filename: {self.name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
            )
            self._put(_gzip(head.encode() + info + b"\r\n\r\n"))
        self._put(member)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)
        self.sha.update(data)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        final = f"{self.folder}/{self.name}"
        if self.store.get_file_info(final).type == fs.FileType.NotFound:
            self.store.move(self.temporary, final)
        else:  # another attempt of the same task was first; its bytes are the same
            self.store.delete_file(self.temporary)
        return self.name, self.records, self.bytes, self.sha.hexdigest()


def range_cuts(keys: DataFrame, target: int) -> list[int]:
    """Upper ids (inclusive) of ranges with about ``target`` bytes, from exact sums of ``size`` by ``page_id``.

    Sums are taken over ``BINS`` equal intervals (or two for each target in all bytes, if
    those are more); intervals heavier than the target are summed again more finely until
    they are light or a single id, the heaviest first, those beyond a pass in a later one.
    """
    edge = keys.where("page_id IS NOT NULL").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b"), F.sum("size").alias("n")).first()
    if edge["a"] is None:
        return []
    bins = max(BINS, -(-2 * int(edge["n"]) // target))
    heavy, light = [(int(edge["a"]), int(edge["b"]), int(edge["n"]))], []
    while heavy:
        # a pass asks for about as many intervals as the first; each span is a branch of its expression
        heavy.sort(key=lambda x: -x[2])
        spans, heavy = heavy[: BINS // 8], heavy[BINS // 8 :]
        cell = F.lit(None).cast("struct<lo:long,hi:long>")
        for a, b, _ in spans:
            width = max(1, -(-(b - a + 1) // max(2, bins // len(spans))))
            # in decimals: ids may be further apart than a long holds
            number = lambda n: f"CAST('{n}' AS DECIMAL(20,0))"
            place = f"(CAST(page_id AS DECIMAL(20,0)) - {number(a)}) div {number(width)}"
            lo = f"{number(a)} + CAST({place} AS DECIMAL(10,0)) * {number(width)}"
            hi = f"least({lo} + {number(width - 1)}, {number(b)})"
            own = F.expr(f"named_struct('lo', CAST({lo} AS BIGINT), 'hi', CAST({hi} AS BIGINT))")
            cell = F.when(F.col("page_id").between(a, b), own).otherwise(cell)
        sums = keys.select(cell.alias("cell"), "size").where("cell IS NOT NULL").groupBy("cell").agg(F.sum("size").alias("n"))
        for row in sums.collect():
            lo, hi = row["cell"]["lo"], row["cell"]["hi"]
            (heavy if row["n"] > target and hi > lo else light).append((lo, hi, row["n"]))
    cuts, held = [], 0
    for lo, hi, n in sorted(light):
        if held and held + n > target:
            cuts.append(lo - 1)
            held = 0
        held += n
    return cuts


def write_warc(
    pages: DataFrame, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to ``folder``; the manifest, one row per file, is stored there too.

    Of equal payloads of at least ``least_bytes`` bytes the smallest page_id is the
    response, rows with other ids revisit it (a row without id revisits any other).
    NULL html is the empty payload; rows with equal ids and payloads are all written;
    an empty table gives an empty manifest.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    keys = stored(
        source.select(
            "page_id", "url", F.sha2("payload", 256).alias("digest"), (F.octet_length("payload") + 500).cast("long").alias("size")
        ),
        "payloads",
    )
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    firsts = (
        keys.where(F.col("size") - 500 >= least_bytes).groupBy("digest")
        .agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
        .select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"))
    )
    # one slim row per (id, payload) that revisits; it travels ahead of its page instead of being joined to it
    revisits = keys.join(firsts, "digest").where("NOT page_id <=> refers_to")
    revisits = revisits.groupBy("page_id", "digest").agg(F.first("refers_to").alias("refers_to"), F.first("refers_url").alias("refers_url"))

    total = keys.agg(F.sum("size")).first()[0] or 0
    cuts = range_cuts(keys, max(1, min(range_bytes, -(-total // LEAST_RANGES))))
    upper = pages.sparkSession.sparkContext.broadcast(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def place_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(upper.value, ids.to_numpy(), "left").astype("int32"))

    # rows without an id make a range of their own; a NULL would turn the ids into floats
    range_of = F.when(F.col("page_id").isNull(), len(cuts) + 1).otherwise(place_of(F.coalesce("page_id", F.lit(0))))
    columns = ["page_id", "digest", "kind", "url", "payload", "refers_to", "refers_url"]
    records = source.select(
        "page_id", F.sha2("payload", 256).alias("digest"), F.lit(1).alias("kind"), "url", "payload",
        F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"),
    ).unionByName(
        revisits.select(
            "page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
            F.lit(None).cast("binary").alias("payload"), "refers_to", "refers_url",
        )
    )
    ranges = shares(pages, 16, 64)
    ordered = (
        records.select(range_of.alias("range"), *columns)
        .repartition(ranges, "range").sortWithinPartitions("range", "page_id", "digest", "kind", "url")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, done, ahead = _Roller(folder, roll_bytes), [], None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in ("range", *columns)}
                if r["kind"] == 0:
                    ahead = (r["page_id"], r["digest"], r["refers_to"], r["refers_url"])
                    continue
                again = ahead is not None and ahead[:2] == (r["page_id"], r["digest"])
                record = make_record(
                    r["page_id"], r["url"], r["payload"], *(ahead[2:] if again else (None, None)), revisit=again
                )
                done += roller.add(r["range"], _gzip(record))
        if roller.out:
            done.append(roller.close())
        names, counts, sizes, shas = zip(*done) if done else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())],
            names=["file", "records", "bytes", "sha256"],
        )

    map_arrow(ordered, write, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(stream) -> Iterator[bytes]:
    """Records of a gzip file with one member each, read in pieces."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 20)
        rest = b""
        if not data:
            return
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts, rest = zlib.decompressobj(31), [], unpacker.unused_data


def parse_record(record: bytes) -> dict | None:
    """A page's record; None for others. Digests and lengths are checked against what is there."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = block[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    if kind == "response" and (digest != base32_sha1(payload) or size != len(payload)):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": size,
        "payload_digest": digest, "refers_to": number("X-Refers-To-Page"), "payload": payload if kind == "response" else None,
    }


def read_warc(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per page record of the manifest's files; ``payloads=False`` leaves the payload NULL."""
    names = [c.split(" ")[0] for c in RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in RECORD.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        row = parse_record(record)
                        if row is None:
                            continue
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 300
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = manifest.select("file").repartition(shares(manifest, 1, 64), "file")
    return map_arrow(files, run, RECORD).select(*names)


def op6_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files to the shared folder and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    manifest = write_warc(pages, folder)
    return read_warc(manifest, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {"op6_warc_writer": op6_warc_writer}
#: Five bits of a hexadecimal digest (five digits hold four letters) as a letter of base 32.
_LETTER = (
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "1 + CAST((CAST('0x' || substr(h, {at}, 5) AS BIGINT) >> {shift}) & 31 AS INT), 1)"
)
_BASE32 = " || ".join(_LETTER.format(at=1 + 5 * (i // 4), shift=15 - 5 * (i % 4)) for i in range(32))
ORACLES = {
    "op6_warc_writer": f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS h,
  min(page_id) OVER (PARTITION BY sha256(b)) AS f FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM d"""
}
