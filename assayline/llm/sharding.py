"""Sharding by a minimax contiguous partition of atomic groups, with DataFrame functions only.

Rows with equal texts are one atomic group. Groups are ordered by their digest and
cut into ``shards`` contiguous runs so that the largest run is as small as possible:
a binary search finds the smallest capacity for which a greedy walk over the ordered
sizes needs no more than ``shards`` runs.

The walk only asks "where is the last group boundary at or before this offset". It
is answered on a bounded list of boundaries (``ZOOM`` of them), which gives a bracket
for the capacity and for each cut; the groups within the brackets are then listed
more finely, until every bracket holds neighbouring boundaries. So the answer is
exact, each listing is one aggregate over the stored groups, and the driver never
holds more than ``ZOOM`` numbers a level, whatever the number of groups.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayline.llm.blocks import shares, stored

#: Group boundaries listed on the driver at a time.
ZOOM = 16_384
#: Digest prefixes that running totals are cut into: rows of the one small table that is summed in order.
PREFIXES = 4_096
SHARDS = 8


def _boundaries(groups: DataFrame, ranges: list[tuple[int, int]], gap: int, zoom: int) -> dict[int, int]:
    """Rank -> bytes up to and with that group, for about ``zoom`` groups spread over the rank ranges.

    The step is below ``gap``, the largest number of ranks between known boundaries,
    so that each listing halves it at least.
    """
    total = sum(b - a for a, b in ranges)
    step = max(1, min(-(-total // zoom), gap // 2))
    inside = F.lit(False)
    for a, b in ranges:
        inside = inside | F.col("rank").between(a, b)
    cell = F.floor(F.col("rank") / step)
    rows = groups.where(inside).groupBy(cell.alias("cell")).agg(F.max("rank").alias("rank"), F.max("upto").alias("upto"))
    return {r["rank"]: r["upto"] for r in rows.select("rank", "upto").collect()}


class _Walk:
    """Greedy walks over the boundaries known so far (rank 0 and the last one always are)."""

    def __init__(self, known: dict[int, int]):
        self.ranks = sorted(known)
        self.upto = [known[r] for r in self.ranks]

    def cuts(self, capacity: int, shards: int, late: bool) -> list[tuple[int, int, int]]:
        """For each cut: (offset, rank of the boundary before it, rank of the boundary after it).

        ``late`` assumes a boundary at the very offset where one may still be hidden,
        otherwise only known boundaries are used.
        """
        at, out = 0, []
        for _ in range(shards):
            aim = at + capacity
            i = bisect_right(self.upto, aim) - 1
            known = self.upto[i]
            hidden = i + 1 < len(self.ranks) and self.ranks[i + 1] > self.ranks[i] + 1
            at = aim if late and hidden else max(at, known)
            after = self.ranks[min(i + 1, len(self.ranks) - 1)]
            out.append((at, self.ranks[i], after))
        return out

    def enough(self, capacity: int, shards: int, late: bool) -> bool:
        return self.cuts(capacity, shards, late)[-1][0] >= self.upto[-1]

    def smallest(self, shards: int, late: bool) -> int:
        low, high = 0, max(1, self.upto[-1])
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if self.enough(middle, shards, late) else (middle, high)
        return high


def minimax_cuts(groups: DataFrame, shards: int = SHARDS, zoom: int = ZOOM) -> tuple[int, list[int], list[int]]:
    """(capacity, last byte offset, last rank of each shard) for ``groups`` with rank (from 1) and upto.

    ``rank`` is a group's place in order, ``upto`` the bytes of all groups up to and
    with it. An empty table gives capacity 0 and empty shards.
    """
    last = groups.agg(F.max("rank").alias("rank"), F.max("upto").alias("upto")).first()
    if last["rank"] is None:
        return 0, [0] * shards, [0] * shards
    known = {0: 0, last["rank"]: last["upto"]}
    ranges, gap = [(1, last["rank"])], last["rank"]
    while True:
        known |= _boundaries(groups, ranges, gap, zoom)
        walk = _Walk(known)
        least, most = walk.smallest(shards, late=True), walk.smallest(shards, late=False)
        first, final = walk.cuts(least, shards, late=False), walk.cuts(most, shards, late=True)
        ranges, gap = [], 0
        for (_, before, _), (_, _, after) in zip(first, final):
            ordered = walk.ranks[bisect_right(walk.ranks, before) - 1 : bisect_right(walk.ranks, after)]
            widest = max((b - a for a, b in zip(ordered, ordered[1:])), default=1)
            if widest > 1:
                ranges.append((before, after))
                gap = max(gap, widest)
        if not ranges:
            cuts = walk.cuts(most, shards, late=False)
            return most, [offset for offset, _, _ in cuts], [rank for _, rank, _ in cuts]


def text_groups(rows: DataFrame) -> DataFrame:
    """One row per digest in digest order: n rows, bytes, rank, rows and bytes up to and with it.

    Running totals are made in two steps: digest prefixes (a bounded table, as digests
    are spread evenly) are summed in order, then the groups within each prefix.
    """
    groups = rows.groupBy("digest").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    groups = groups.withColumn("prefix", F.conv(F.substring("digest", 1, 3), 16, 10).cast("int"))
    groups = stored(groups, "groups")
    ordered = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.groupBy("prefix").agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
    )
    before = before.select(
        "prefix", *[F.coalesce(F.sum(c).over(ordered), F.lit(0)).alias(f"before_{c}") for c in ("g", "n", "bytes")]
    )
    inner = Window.partitionBy("prefix").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    # PREFIXES rows at most
    joined = groups.join(F.broadcast(before), "prefix")
    return joined.select(
        "digest",
        "n",
        "bytes",
        (F.col("before_g") + F.count("*").over(inner)).alias("rank"),
        (F.col("before_n") + F.sum("n").over(inner)).alias("rows_upto"),
        (F.col("before_bytes") + F.sum("bytes").over(inner)).alias("upto"),
    )


def _shard(rank: Column, last: list[int]) -> Column:
    """The number of shards that end before the group."""
    return sum(((rank > F.lit(r)).cast("int") for r in last[:-1]), F.lit(0))


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", zoom: int = ZOOM
) -> DataFrame:
    """One row per document row: doc_id, size, text_crc32, shard, slot.

    size: UTF-8 bytes of the text plus 1. Equal texts (all NULLs are equal, and differ
    from the empty text) share a shard. Slots count the rows of a shard from 0
    without gaps, group by group. Rows with equal ids and texts get slots of their
    own. An empty table gives no rows; with fewer groups than shards the last shards
    stay empty.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = source.select(
        "doc_id",
        F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("0" * 64)).alias("digest"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows = stored(rows, "sizes")
    groups = stored(text_groups(rows), "ordered")
    _, _, last = minimax_cuts(groups, shards, zoom)
    first_row = groups.select(
        "digest",
        _shard(F.col("rank"), last).cast("int").alias("shard"),
        (F.col("rows_upto") - F.col("n")).alias("row"),
    )
    starts = first_row.groupBy("shard").agg(F.min("row").alias("shard_row"))
    # at most one row a shard
    first_row = first_row.join(F.broadcast(starts), "shard").select(
        "digest", "shard", (F.col("row") - F.col("shard_row")).alias("first_slot")
    )
    # places within a group: a group of any size is cut into parts by the id's hash
    parts = shares(docs, 4, 64)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part")
    cells = rows.withColumn("part", part)
    counts = cells.groupBy("digest", "part").count()
    by_part = Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(first_row, "digest").select(
        "digest", "part", "shard",
        (F.col("first_slot") + F.coalesce(F.sum("count").over(by_part), F.lit(0))).alias("offset"),
    )
    within = Window.partitionBy("digest", "part").orderBy("doc_id")
    numbered = cells.withColumn("place", F.row_number().over(within))
    return numbered.join(offsets, ["digest", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place") - 1).cast("long").alias("slot")
    )


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to shards 0 to 7 of near equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op2_minimax_shards": op2_minimax_shards}
ORACLES: dict[str, str] = {}
