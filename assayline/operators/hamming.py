"""64-bit hashes that differ in a few bits, by an index over several pieces of them.

Cut a hash in m pieces: two that differ in at most d bits agree in at least m - d of
them. So each distinct hash is filed once for every choice of m - d pieces, and only
hashes of one file are compared. More pieces make longer file keys and more files; m
follows the number of hashes so that a file holds a few. Files that are large all the
same are laid out on a grid of cells. Nothing is dropped, whatever m is.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.operators.components import connected
from assayline.operators.joins import hot_keys, lookup_join
from assayline.operators.quality import Rule, flag_all
from assayline.sources.scratch import stored

BITS = 64
#: Bits in which the hashes of one image may differ.
DISTANCE = 3
#: Hashes that a file should hold on average, and files a hash is filed in at most.
FILE_HASHES = 32
MOST_FILES = 100
#: Hashes of one side of a cell.
CELL = 4_000


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def piece_masks(pieces: int) -> list[int]:
    """A mask for each of ``pieces`` runs of bits, as even as possible, that cover all of them."""
    ends = [BITS * i // pieces for i in range(pieces + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(ends, ends[1:])]


def choose_pieces(hashes: int, distance: int) -> int:
    """The fewest pieces whose files hold ``FILE_HASHES`` evenly spread hashes on average."""
    pieces = distance + 1
    while hashes > FILE_HASHES << (BITS * (pieces - distance) // pieces) and comb(pieces + 1, distance) <= MOST_FILES:
        pieces += 1
    return pieces


def _is_first(x: Column, pieces: list[int], choice: tuple[int, ...]) -> Column:
    """Whether ``choice`` are the first pieces in which two hashes (xor: x) agree; so a pair is found once."""
    earlier = [j for j in range(max(choice)) if j not in choice]
    return reduce(lambda a, b: a & b, [x.bitwiseAND(F.lit(_signed(pieces[j]))) != 0 for j in earlier], F.lit(True))


def near_pairs(rows: DataFrame, column: str, distance: int = DISTANCE, pieces: int | None = None, cell: int = CELL) -> DataFrame:
    """(a, b, distance): all pairs a < b of distinct values of a long column at most ``distance`` bits apart.

    NULLs are left out. ``pieces`` (more than ``distance``) is chosen from the number of
    distinct values if not given; it changes the work, not the result.
    """
    if not 0 <= distance < BITS:
        raise ValueError("distance must be within 0 and 63")
    distinct = stored(rows.select(F.col(column).alias("h")).where("h IS NOT NULL").distinct(), "hashes")
    pieces = pieces or choose_pieces(distinct.count(), distance)
    if not distance < pieces <= BITS:
        raise ValueError("pieces must be more than distance")
    masks = piece_masks(pieces)
    choices = list(combinations(range(pieces), pieces - distance))
    keys = [F.col("h").bitwiseAND(F.lit(_signed(sum(masks[i] for i in c)))) for c in choices]
    filed = distinct.select("h", F.posexplode(F.array(*keys)).alias("file", "key"))

    hot = hot_keys(filed, ["file", "key"], cell).keys
    on = ["file", "key"]
    if hot is None:
        left, right = filed, filed
    else:
        # as few rows as hot_keys bounds
        sized = filed.join(F.broadcast(hot.withColumnRenamed("__slices", "side")), on, "left").fillna(1, subset=["side"])
        own = F.pmod(F.xxhash64("h"), F.col("side"))
        all_ = F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1))
        left = sized.withColumn("x", own).withColumn("y", all_).drop("side")
        right = sized.withColumn("y", own).withColumn("x", all_).drop("side")
        on = [*on, "x", "y"]
    pairs = left.withColumnRenamed("h", "a").join(right.withColumnRenamed("h", "b"), on)
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = reduce(lambda p, q: p | q, [(F.col("file") == i) & _is_first(x, masks, c) for i, c in enumerate(choices)])
    near = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(x) <= distance) & first)
    return near.select("a", "b", F.bit_count(x).alias("distance"))


def image_classes(rows: DataFrame, column: str, distance: int = DISTANCE) -> DataFrame:
    """(hash, image): the smallest hash that each hash with a near one is tied to, over any number of steps."""
    return connected(near_pairs(rows, column, distance), "a", "b").withColumnsRenamed({"node": column, "component": "image"})


def flag_reused_images(rows: DataFrame, row_id: str, seller: str, column: str, distance: int = DISTANCE) -> DataFrame:
    """``rows`` (quality columns) with image, first_listing and first_seller; IMAGE_HASH_REUSED where it is another seller's.

    The first listing of an image is the one of the smallest id. A row without a hash has
    no image; a NULL seller is never another's. An image on a third of all rows is joined
    in slices.
    """
    met = lookup_join(rows, image_classes(rows, column, distance), column, spread_by=[row_id])
    met = stored(met.withColumn("image", F.ifnull("image", column)), "images")
    first = met.where("image IS NOT NULL").groupBy("image").agg(F.min(F.struct(row_id, seller)).alias("f"))
    first = first.select("image", F.col(f"f.{row_id}").alias("first_listing"), F.col(f"f.{seller}").alias("first_seller"))
    met = lookup_join(met, first, "image", spread_by=[row_id])
    reused = F.col("first_seller") != F.col(seller)
    return flag_all(met, [Rule(reused, "IMAGE_HASH_REUSED", certainty="ESTIMATED")])
