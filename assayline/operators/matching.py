"""Marketplace listings against the catalogue: exact, missing and fuzzy.

Catalogue frames carry ``sku``, ``product_name``, ``brand_key``,
``category_key``, ``condition_code_key``, ``standard_cost`` and ``rrp`` (the
output of ``plans.products.build_products``). Listing frames carry
``listing_id``, ``seller_id``, ``seller_sku_ref``, ``seller_product_name`` and
``asking_price`` (the output of ``listing_columns``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assayline.functions.keys import surrogate_key
from assayline.functions.words import sorted_words
from assayline.operators.joins import BROADCAST_BYTES, lookup_join
from assayline.registry import FUZZY_MOST, FUZZY_PERCENT
from assayline.sources.scratch import kept, scratch_tables, stored

EXACT, UNKNOWN, FUZZY = "EXACT_SKU", "SKU_NOT_IN_CATALOGUE", "FUZZY"

CATALOGUE_COLUMNS = (
    "sku",
    "product_name",
    "brand_key",
    "category_key",
    "condition_code_key",
    "standard_cost",
    "rrp",
)


LISTING_COLUMNS = (
    "listing_id",
    "seller_id",
    "seller_sku_ref",
    "seller_product_name",
    "asking_price",
)


def listing_columns(
    listings: DataFrame,
    sku_ref: str = "sku_ref",
    title: str = "seller_product_title",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Project raw listings to the columns that matching needs."""
    return listings.select(
        "listing_id",
        "seller_id",
        F.col(sku_ref).alias("seller_sku_ref"),
        F.col(title).alias("seller_product_name"),
        "asking_price",
        *extra,
    )


def pair_columns(confidence: Column, match_pass: Column) -> list[Column]:
    """The 13 columns of a match row.

    Where the row has a catalogue ``sku``, name, keys and prices are the
    catalogue's; elsewhere it stands for itself and has no catalogue keys.
    """
    matched = F.col("sku").isNotNull()
    sku = F.coalesce("sku", "seller_sku_ref")
    return [
        surrogate_key(sku).alias("canonical_product_key"),
        sku.alias("sku"),
        F.when(matched, F.col("product_name"))
        .otherwise(F.col("seller_product_name"))
        .alias("product_name"),
        "brand_key",
        "category_key",
        "condition_code_key",
        F.col("standard_cost").cast("double").alias("cogs"),
        F.when(matched, F.col("rrp")).otherwise(F.col("asking_price")).cast("double").alias("list_price"),
        F.col("listing_id").alias("match_source_listing_id"),
        F.col("seller_id").alias("match_source_seller_id"),
        F.col("seller_product_name").alias("seller_product_name_raw"),
        confidence.cast("double").alias("match_confidence"),
        match_pass.alias("match_pass"),
    ]


def catalogue_by_sku(catalogue: DataFrame) -> DataFrame:
    """Catalogue columns plus the join key, without rows that can never match."""
    return catalogue.select("sku", *CATALOGUE_COLUMNS[1:]).withColumn("seller_sku_ref", F.col("sku"))


def with_catalogue(
    listings: DataFrame,
    catalogue: DataFrame,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    catalogue_bytes: int | None = None,
) -> DataFrame:
    """Listings with the catalogue row of their SKU (``sku`` NULL if there is none)."""
    return lookup_join(
        listings,
        catalogue_by_sku(catalogue),
        "seller_sku_ref",
        how,
        ["listing_id"],
        catalogue_bytes,
        broadcast_bytes,
    )


def exact_sku_pairs(
    catalogue: DataFrame,
    listings: DataFrame,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    catalogue_bytes: int | None = None,
) -> DataFrame:
    """One row per (catalogue SKU, listing of that SKU), confidence 1.0.

    ``how='left'`` also keeps catalogue rows nobody lists: listing columns NULL,
    confidence 0.0, no pass name. They are found by an anti join with the
    distinct listed SKUs, so a SKU with very many listings costs one row there.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    pairs = with_catalogue(
        listings, catalogue, "inner", broadcast_bytes, catalogue_bytes
    ).select(pair_columns(F.lit(1.0), F.lit(EXACT)))
    if how == "inner":
        return pairs
    listed = listings.select(F.col("seller_sku_ref").alias("sku")).na.drop().distinct()
    unlisted = catalogue.select(*CATALOGUE_COLUMNS).join(listed, "sku", "left_anti")
    nobody = {c: F.lit(None).cast(listings.schema[c].dataType) for c in LISTING_COLUMNS}
    return pairs.unionByName(
        unlisted.withColumns(nobody).select(pair_columns(F.lit(0.0), F.lit(None).cast("string")))
    )


def listings_without_sku(
    listings: DataFrame,
    catalogue: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    catalogue_bytes: int | None = None,
) -> DataFrame:
    """Listings whose SKU is missing or not in the catalogue."""
    return lookup_join(
        listings,
        catalogue.select(F.col("sku").alias("seller_sku_ref")),
        "seller_sku_ref",
        "left_anti",
        ["listing_id"],
        catalogue_bytes,
        broadcast_bytes,
    )


def unknown_skus(
    catalogue: DataFrame, listings: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Match rows, confidence 0.0, for listings whose SKU the catalogue lacks."""
    alone = listings_without_sku(listings, catalogue, broadcast_bytes)
    return without_catalogue(alone, catalogue).select(pair_columns(F.lit(0.0), F.lit(UNKNOWN)))


def without_catalogue(listings: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Listings with all catalogue columns NULL."""
    return listings.withColumns(
        {c: F.lit(None).cast(catalogue.schema[c].dataType) for c in CATALOGUE_COLUMNS}
    )


def match_rows(
    catalogue: DataFrame, listings: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Exact pairs and unknown SKUs together.

    A left join yields just the rows of the inner and the anti join, so the
    listings are read and shuffled once instead of twice.
    """
    joined = with_catalogue(listings, catalogue, "left", broadcast_bytes)
    found = F.col("sku").isNotNull()
    return joined.select(
        pair_columns(
            F.when(found, 1.0).otherwise(0.0),
            F.when(found, EXACT).otherwise(UNKNOWN),
        )
    )


# ---- fuzzy titles -----------------------------------------------------------

PAIRS_PER_TASK = 20_000_000
MOST_CELLS = 250_000  # a cell has at least this fraction of all pairs, so no more grams than this need a grid
PLACED_UP_TO = 100  # pieces of longer texts are filed by a run of places, or shorter texts would have too many
RUN = 32  # places of such a run
PAIRS_PER_TEXT = 2_000  # a block with no more pairs a text is compared whole: a text's index rows cost as much
TEXTS_PER_SHAPE = 4  # texts that share a shape, on average, where shapes are compared first
NAMES_AT_A_TIME = 200_000  # names of large blocks that are broadcast at once
ROWS_AT_A_TIME = 20_000_000  # index rows that are on disk at once
PAIRS_PER_ROW = 100  # pairs whose masks are compared in the time that an index row takes
SHORTEST_PIECE = 6  # shorter pieces are in a great part of all texts


def _edits(length: str, percent: int) -> str:
    """Edits allowed when the longer text has this length."""
    return f"(((100 - {percent}) * {length}) div 100)"


def _piece(length: str, percent: int) -> str:
    """Characters per piece when a text of this length is cut into edits+1 pieces."""
    return f"({length} div ({_edits(length, percent)} + 1))"


def _exploded(df: DataFrame, name: str, low: str, high: str) -> DataFrame:
    """A row for every whole number from ``low`` to ``high``; none if there is none."""
    df = df.withColumns({"__low": F.expr(low), "__high": F.expr(high)}).where("__low <= __high")
    return df.withColumn(name, F.explode(F.sequence("__low", "__high"))).drop("__low", "__high")


_KEEP = ["id", "n", "c1", "c2", "c3"]


def _filed(df: DataFrame, role: str, place: Sequence[str]) -> DataFrame:
    """Index rows: the gram of ``q`` characters at ``p`` with all it must agree in, as one number.

    Two files of one number only make a candidate more, which is compared like any other.
    """
    gram = F.expr("substring(t, int(p + 1), int(q))")
    return df.select(*_KEEP, F.col("p").cast("int").alias("p"), "i", F.xxhash64("block", F.lit(role), *place, gram).alias("key"))


def _pieces(texts: DataFrame, percent: int, role: str, far: bool = True) -> DataFrame:
    """Index rows of the text as the longer one: disjoint pieces, one more than the edits it may undergo.

    ``far``: whether there are texts beyond ``PLACED_UP_TO`` at all.
    """
    cut = texts.withColumns({"k": F.expr(_edits("n", percent)), "q": F.expr(_piece("n", percent))})
    cut = _exploded(cut, "i", "0L", "k").withColumn("p", F.expr("i * q")).withColumn("i", F.col("i").cast("int"))
    short = _filed(cut.where(f"n <= {PLACED_UP_TO}"), role, ["k", "q", "i"])
    if not far:
        return short
    long = cut.where(f"n > {PLACED_UP_TO}").withColumn("run", F.expr(f"p div {RUN}"))
    return short.unionByName(_filed(long, role, ["q", "run"]))


def _grams(texts: DataFrame, percent: int, role: str, far: bool = True) -> DataFrame:
    """Index rows of the text as the shorter one: substrings that could be piece ``i`` of a longer (or equal) text.

    A longer text of length m allows k edits and has pieces of q characters. Its piece i,
    at ``i * q``, moved by at most i places, and so that what follows it differs by at
    most ``k - i``. Lengths of one k and q are handled together, so k is part of the file:
    texts meet only at lengths that allow their edits. Texts beyond ``PLACED_UP_TO`` have
    too many such places; their pieces are filed by runs of places that cover them.
    """
    slack = 100 - percent
    most = f"((100 * n) div {percent})"  # the longest text this one can match
    top = f"least({most}, {PLACED_UP_TO}L)"

    def length(k: str) -> str:
        """The least length that allows k edits."""
        return f"((100 * {k} + {slack - 1}) div {slack})"

    rows = _exploded(texts.where(f"n <= {PLACED_UP_TO}"), "k", _edits("n", percent), _edits(top, percent))
    rows = rows.withColumns({"a": F.expr(f"greatest(n, {length('k')})"), "b": F.expr(f"least({top}, {length('(k + 1)')} - 1)")})
    rows = _exploded(rows, "q", "a div (k + 1)", "least(n, b div (k + 1))")
    rows = rows.withColumns({"a": F.expr("greatest(a, q * (k + 1))"), "b": F.expr("least(b, q * (k + 1) + k)")})
    rows = _exploded(rows.where("a <= b"), "i", "0L", "k")
    low = "greatest(0L, i * q - i, i * q + n - b - (k - i))"
    high = "least(n - q, i * q + i, i * q + n - a + (k - i))"
    rows = _exploded(rows, "p", low, high).withColumn("i", F.col("i").cast("int"))
    placed = _filed(rows, role, ["k", "q", "i"])
    if not far:
        return placed

    long = texts.where(f"{most} > {PLACED_UP_TO}").withColumn("k", F.expr(_edits(most, percent)))
    lengths = f"sequence(greatest(n, {PLACED_UP_TO + 1}L), {most})"
    sizes = F.expr(f"array_distinct(transform({lengths}, m -> {_piece('m', percent)}))")
    long = _exploded(long.withColumn("q", F.explode(sizes)), "p", "0L", "n - q")
    # a piece of the longer text lies at most half its edits before, and half of edits and lengths behind
    before, behind = "greatest(0L, p - (k + 1) div 2)", f"p + (k + {most} - n + 1) div 2"
    long = _exploded(long, "run", f"{before} div {RUN}", f"({behind}) div {RUN}")
    return placed.unionByName(_filed(long.withColumn("i", F.lit(-1)), role, ["q", "run"]))


def _signatures(texts: DataFrame, percent: int, longer: str, shorter: str, far: bool = True) -> DataFrame:
    """Index rows of texts (id, block, t, n, c1, c2, c3) in both roles; ``i`` is -1 where only the other side knows it."""
    return _pieces(texts, percent, longer, far).withColumn("role", F.lit(longer)).unionByName(
        _grams(texts, percent, shorter, far).withColumn("role", F.lit(shorter))
    )


def _count_masks(text: str) -> Column:
    """Three 64-bit masks: characters (by code modulo 64) that occur at least once, twice, three times."""
    none = F.lit(0).cast("long")
    start = F.struct(none.alias("c1"), none.alias("c2"), none.alias("c3"))

    def add(m: Column, c: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(64)))
        return F.struct(
            m["c1"].bitwiseOR(bit).alias("c1"),
            m["c2"].bitwiseOR(m["c1"].bitwiseAND(bit)).alias("c2"),
            m["c3"].bitwiseOR(m["c2"].bitwiseAND(bit)).alias("c3"),
        )

    return F.aggregate(F.split(text, ""), start, add)


def _surplus(a: str, b: str) -> Column:
    """At least the characters that ``a`` has more often than ``b``: each takes an edit of its own."""
    return F.expr(" + ".join(f"bit_count({a}{i} & ~{b}{i})" for i in (1, 2, 3)))


_PAIR_WORDS = 4


def _pair_masks(text: str) -> Column:
    """256 bits: the pairs of neighbouring characters, by a hash of each."""
    chars, none = F.split(text, ""), F.lit(0).cast("long")
    places = F.zip_with(
        chars, F.slice(chars, 2, F.size(chars)), lambda c, d: F.when(d.isNotNull(), F.pmod(F.xxhash64(c, d), F.lit(64 * _PAIR_WORDS)))
    )

    def add(words: Column, place: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        own = lambda i: F.when(F.floor(place / 64) == i, bit).otherwise(none)
        return F.struct(*[words[f"g{i}"].bitwiseOR(own(i)).alias(f"g{i}") for i in range(_PAIR_WORDS)])

    start = F.struct(*[none.alias(f"g{i}") for i in range(_PAIR_WORDS)])
    return F.aggregate(F.filter(places, lambda p: p.isNotNull()), start, add)


def _lost_pairs(a: str, b: str) -> Column:
    """At least the pairs of neighbours that ``a`` has and ``b`` has not: an edit undoes two of them at most."""
    return F.expr(" + ".join(f"bit_count({a}{i} & ~{b}{i})" for i in range(_PAIR_WORDS)))


def _grid_sizes(left: DataFrame, right: DataFrame, keys: list[str], pairs_per_task: int) -> DataFrame | None:
    """Grams whose candidate pairs exceed a cell's share, with their grid side (None: there are none).

    A cell has ``pairs_per_task`` pairs, or 1/250,000 of all pairs if that is more:
    the list is short by arithmetic and no heavy gram is missing from it. Counts are
    combined map-side; the list is written, not collected.
    """
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("b"))
    load, seen = F.col("a").cast("double") * F.col("b"), Observation()
    loads = a.join(b, keys).withColumn("load", load).observe(seen, F.ifnull(F.sum(load), F.lit(0.0)).alias("all"))
    heavy = stored(loads.where(F.col("load") > pairs_per_task), "grams")
    cell = max(pairs_per_task, seen.get["all"] / MOST_CELLS)
    heavy = heavy.where(F.col("load") > cell)
    return heavy.select(*keys, F.ceil(F.sqrt(F.col("load") / cell)).cast("long").alias("side")) if heavy.head(1) else None


def _grid_join(titles: DataFrame, names: DataFrame, hot: DataFrame | None, parts: int) -> DataFrame:
    """Join on ``key``, hot keys (key, side) spread over a square grid of cells.

    A title goes to one grid row and all its columns, a name to one grid column
    and all its rows, so every pair meets in exactly one cell.
    """
    keys = ["key"]
    if hot is None:
        return titles.repartition(parts, *keys).join(names.repartition(parts, *keys), keys)

    def laid_out(df: DataFrame, own: str, other: str, text: str) -> DataFrame:
        sized = df.join(F.broadcast(hot), keys, "left").fillna(1, subset=["side"])  # at most MOST_CELLS rows
        return (
            sized.withColumn(own, F.pmod(F.xxhash64(text), F.col("side")))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1)))
            .drop("side")
            .repartition(parts, *keys, "gx", "gy")
        )

    return laid_out(titles, "gx", "gy", "id").join(laid_out(names, "gy", "gx", "name"), [*keys, "gx", "gy"])


def _parts(df: DataFrame, pairs: int, pairs_per_task: int) -> int:
    """Partitions of a join: they follow the pairs, not the bytes, which say little about the work."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-pairs // pairs_per_task))


def _gram_join(titles: DataFrame, names: DataFrame, total_pairs: int, pairs_per_task: int) -> DataFrame:
    """Join index rows on their key, see ``_grid_join``."""
    hot = None
    if total_pairs > pairs_per_task:  # else no gram can be hot
        titles, names = stored(titles, "title-grams"), stored(names, "name-grams")
        hot = _grid_sizes(titles, names, ["key"], pairs_per_task)
    return _grid_join(titles, names, hot, _parts(titles, total_pairs, pairs_per_task))


def _load_join(titles: DataFrame, names: DataFrame, loads: DataFrame, pairs_per_task: int) -> DataFrame:
    """Join on ``key`` where the pairs of each key are known: ``loads(key, load)``, a stored table."""
    pairs = loads.agg(F.ifnull(F.sum("load"), F.lit(0.0))).first()[0]
    cell = max(pairs_per_task, pairs / MOST_CELLS)
    heavy = loads.where(F.col("load") > cell)
    hot = heavy.select("key", F.ceil(F.sqrt(F.col("load") / cell)).cast("long").alias("side")) if heavy.head(1) else None
    return _grid_join(titles, names, hot, _parts(titles, int(pairs), pairs_per_task))


_COUNTS, _NEIGHBOURS = ["c1", "c2", "c3"], [f"g{i}" for i in range(_PAIR_WORDS)]
_MARKS = ["t", "n", "e", "c", *_COUNTS, "g", *_NEIGHBOURS]


Round = Callable[[], DataFrame]  # the pairs of one round of a comparison; what it needs is made when it is called


def _marked(df: DataFrame, number: str, value: Column, name: str, *more: str) -> DataFrame:
    """Texts with a number, their length, masks and the bits set in them (c, g), as a stored table."""
    marks = [F.char_length("t").cast("long").alias("n"), _count_masks("t").alias("cs"), _pair_masks("t").alias("gs")]
    df = stored(df.select(value.alias(number), "block", "t", *more, *marks), name)
    df = df.select(number, "block", "t", *more, "n", "cs.*", "gs.*")
    return df.withColumns({m: F.expr(" + ".join(f"bit_count({x})" for x in xs)) for m, xs in (("c", _COUNTS), ("g", _NEIGHBOURS))})


def _theirs(names: DataFrame) -> DataFrame:
    """Names with the columns they share with titles renamed."""
    return names.drop("block").withColumnsRenamed({c: f"name_{c}" for c in _MARKS})


def _allowed(percent: int) -> Column:
    return F.expr(f"int({_edits('greatest(n, name_n)', percent)})")


def _masks_agree(mask: str, words: Sequence[str], an_edit: int) -> Column:
    """Neither text has more bits to itself than its edits explain; ``e`` has the edits of each length.

    Written by the bits both have, which makes half the code: this runs for every pair.
    """
    both = " + ".join(f"bit_count({w} & name_{w})" for w in words)
    return F.expr(f"{both} >= greatest({mask}, name_{mask}) - {an_edit} * greatest(e, name_e)")


def _close_masks() -> Column:
    """Whether lengths and masks allow the pair."""
    return _masks_agree("g", _NEIGHBOURS, 2) & F.expr("abs(n - name_n) <= greatest(e, name_e)") & _masks_agree("c", _COUNTS, 1)


def _distance(percent: int) -> Column:
    """Edits between ``t`` and ``name_t``; -1 if there are more than allowed."""
    return F.call_function("levenshtein", F.col("t"), F.col("name_t"), _allowed(percent))


_PAIR = ["block", "id", "t", "n", "name", "name_t", "name_n"]


def _whole_blocks(titles: DataFrame, names: DataFrame, blocks: DataFrame, percent: int, pairs_per_task: int) -> DataFrame:
    """Every pair of a block whose lengths and masks agree: no index, no pair leaves its task."""
    key, edits = F.xxhash64("block"), F.expr(f"int({_edits('n', percent)})")
    loads = blocks.groupBy(key.alias("key")).agg(F.sum("load").alias("load"))
    titles, names = titles.withColumns({"key": key, "e": edits}), names.withColumns({"key": key, "e": edits})
    return _load_join(titles, _theirs(names), loads, pairs_per_task).where(_close_masks())


def _compared(titles: DataFrame, names: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs of one key whose lengths and masks agree: the names are broadcast, the titles stay where they are."""
    edits = F.expr(f"int({_edits('n', percent)})")
    theirs = _theirs(names.withColumns({"e": edits, "__at": F.col(key)})).drop("key")
    return titles.withColumn("e", edits).join(F.broadcast(theirs), F.col(key) == F.col("__at")).where(_close_masks())


def _part(df: DataFrame, number: str, part: int, parts: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(number), F.lit(parts)) == part) if parts > 1 else df


def _by_names(titles: DataFrame, names: DataFrame, more: Sequence[str], percent: int) -> list[Round]:
    """Every pair of a block whose lengths and masks agree, so many names at a time; nothing is written for a pair."""
    rounds = -(-names.count() // NAMES_AT_A_TIME)

    def pairs(r: int) -> DataFrame:
        return _compared(titles, _part(names, "name", r, rounds), "block", percent).select(*_PAIR, *more)

    return [partial(pairs, r) for r in range(rounds)]


def _by_shapes(
    titles: DataFrame, names: DataFrame, more: Sequence[str], percent: int, pairs_per_task: int, broadcast_bytes: int
) -> list[Round] | None:
    """Pairs by way of their shapes: texts with every digit read as 0 (None: too many shapes for that).

    Replacing characters by others adds no edits, so texts are never closer than their
    shapes, which have the same lengths. Model numbers make many texts of few shapes.
    A round takes the names of some shapes: title shapes are compared with those, and
    titles with the names of the shapes near theirs, which are broadcast.
    """

    def shaped(df: DataFrame) -> DataFrame:
        shape = F.translate("t", "123456789", "0" * 9)
        return df.withColumns({"shape": shape, "key": F.xxhash64("block", shape)})

    titles, names = shaped(titles), shaped(names)
    counted = [
        stored(df.groupBy("key", "block", F.col("shape").alias("t")).agg(F.count(F.lit(1)).alias(many)), "shapes")
        for df, many in ((titles, "titles"), (names, "names"))
    ]
    sums = [df.agg(F.count(F.lit(1)).alias("a"), F.sum(df.columns[-1]).alias("b")).first() for df in counted]
    if any(a and b < TEXTS_PER_SHAPE * a for a, b in sums):
        return None
    ours = _marked(counted[0], "id", F.col("key"), "title-shapes")
    theirs = _marked(counted[1], "name", F.col("key"), "name-shapes")
    rounds = -(-(sums[1]["b"] or 0) // NAMES_AT_A_TIME)
    cut = F.pmod(F.xxhash64("key"), F.lit(rounds)).alias("round")
    sizes = counted[1].groupBy(cut).agg(F.sum("names").alias("names")).collect() if rounds else []
    titles, names = titles.drop("shape"), names.drop("shape")
    tasks = 4 * _parts(ours, 0, pairs_per_task)

    def pairs(r: int, part: int, parts: int) -> DataFrame:
        near = _compared(ours.repartition(tasks, "id"), _part(theirs, "name", r, rounds), "block", percent)
        near = near.where(_distance(percent) >= 0).select(F.col("id").alias("key"), F.col("name").alias("near"))
        met = lookup_join(titles, stored(near, "shape-pairs"), "key", "inner", ["id"], broadcast_bytes=broadcast_bytes)
        met = met.drop("key").withColumnRenamed("near", "key")
        here = _part(_part(names, "key", r, rounds), "name", part, parts)  # several parts: one shape has that many names
        return _compared(met, here, "key", percent).select(*_PAIR, *more)

    parts = {row["round"]: -(-row["names"] // (2 * NAMES_AT_A_TIME)) for row in sizes}
    return [partial(pairs, r, p, n) for r, n in sorted(parts.items()) for p in range(n)]


def _index_rows(texts: DataFrame, percent: int, far: bool) -> int:
    """Rows that the texts have in an index: they follow from the length of a text alone."""
    none = F.lit(0).cast("long")
    lengths = texts.groupBy("n").agg(F.count(F.lit(1)).alias("c1"))
    one = lengths.select(F.col("n").alias("id"), F.lit("").alias("block"), F.expr("repeat('x', int(n))").alias("t"), "n", "c1", none.alias("c2"), none.alias("c3"))
    return _signatures(one, percent, "title", "name", far).agg(F.ifnull(F.sum("c1"), none)).first()[0]


def _by_pieces(
    titles: DataFrame,
    names: DataFrame,
    more: Sequence[str],
    percent: int,
    pairs_per_task: int,
    broadcast_bytes: int,
    pairs_per_text: int,
) -> list[Round] | None:
    """Pairs that share a piece of text at a compatible place, by an index (None: comparing every pair costs less).

    The index holds numbers, places and counts of characters, no texts. Pairs that an entry
    brings together are made distinct and only then meet their texts. A round has the
    entries of some keys, so that what is on disk at a time does not follow the texts.
    """
    sizes = [
        df.groupBy("block").agg(F.count(F.lit(1)).alias(c), F.max("n").alias(f"n_{c}")) for df, c in ((titles, "a"), (names, "b"))
    ]
    load = (F.col("a") * F.col("b")).alias("load")
    total_pairs, longest = sizes[0].join(sizes[1], "block").agg(
        F.ifnull(F.sum(load), F.lit(0)), F.ifnull(F.max(F.greatest("n_a", "n_b")), F.lit(0))
    ).first()
    far = longest > PLACED_UP_TO
    if pairs_per_text and (100 - percent) * SHORTEST_PIECE > 100:
        return None
    rows = _index_rows(titles.select("n").unionAll(names.select("n")), percent, far)
    rounds = max(1, -(-rows // ROWS_AT_A_TIME))
    if pairs_per_text and total_pairs <= rows * PAIRS_PER_ROW * (1 + rounds / 10):  # each round makes all rows, which is a tenth of their cost
        return None

    def index(texts: DataFrame, longer: str, shorter: str, r: int) -> DataFrame:
        rows = _signatures(texts.select("id", "block", "t", "n", *_COUNTS), percent, longer, shorter, far)
        return rows.where(F.pmod("key", F.lit(rounds)) == r) if rounds > 1 else rows

    def pairs(r: int) -> DataFrame:
        ours = index(names.withColumnRenamed("name", "id"), "name", "title", r)
        ours = ours.withColumnsRenamed({c: f"name_{c}" for c in [*_KEEP[1:], "p", "i", "role"]} | {"id": "name"})
        allowed = _allowed(percent)
        # the longer text knows which piece it is; equal lengths meet as a longer title only
        title_longer = F.col("role") == "title"
        in_role = F.when(title_longer, F.col("n") >= F.col("name_n")).otherwise(F.col("n") < F.col("name_n"))
        piece = F.when(title_longer, F.col("i")).otherwise(F.col("name_i"))
        moved = F.col("p") - F.col("name_p")
        behind = F.col("n") - F.col("name_n") - moved
        near = _gram_join(index(titles, "title", "name", r), ours, total_pairs, pairs_per_task).where(
            (F.col("role") == F.col("name_role"))
            & in_role
            & (F.abs(F.col("n") - F.col("name_n")) <= allowed)
            & (F.abs(moved) <= piece)
            & (F.abs(behind) <= allowed - piece)
            & (_surplus("c", "name_c") <= allowed)
            & (_surplus("name_c", "c") <= allowed)
        )
        met = near.select("id", "name").distinct()
        met = lookup_join(met, _theirs(names.drop("c", *_COUNTS)), "name", "inner", ["id"], broadcast_bytes=broadcast_bytes)
        met = lookup_join(met, titles.drop("c", *_COUNTS), "id", "inner", ["name"], broadcast_bytes=broadcast_bytes)
        lost = (_lost_pairs("g", "name_g") <= 2 * allowed) & (_lost_pairs("name_g", "g") <= 2 * allowed)
        return met.where(lost).select(*_PAIR, *more)

    return [partial(pairs, r) for r in range(rounds)]


def _near(
    titles: DataFrame, names: DataFrame, percent: int, pairs_per_task: int, broadcast_bytes: int, pairs_per_text: int
) -> list[Round]:
    """Pairs of marked texts whose distance has to be taken, in rounds that are to be run one by one.

    A block is compared whole where that is cheaper than an index of its texts; larger
    blocks go by shapes. Where most texts have a shape of their own, they go by pieces if
    those are long enough to bring few texts together, else they are compared whole as well.
    """
    more = ["sku"]
    a = titles.groupBy("block").agg(F.count(F.lit(1)).cast("double").alias("a"))
    b = names.groupBy("block").agg(F.count(F.lit(1)).cast("double").alias("b"))
    whole = F.expr(f"a * b <= {pairs_per_text} * (a + b)").alias("whole")
    blocks = stored(a.join(b, "block").select("block", F.expr("a * b").alias("load"), whole), "blocks")
    kinds = {r["whole"] for r in blocks.select("whole").distinct().collect()}

    def small(titles: DataFrame, names: DataFrame, blocks: DataFrame) -> DataFrame:
        return _whole_blocks(titles, names, blocks, percent, pairs_per_task).select(*_PAIR, *more)

    if kinds <= {True}:
        return [partial(small, titles, names, blocks)]
    rounds = []
    if True in kinds:
        few, many = blocks.where("whole"), blocks.where("NOT whole").select("block")
        some = [lookup_join(df, few.select("block"), "block", "inner", [i], broadcast_bytes=broadcast_bytes)
                for df, i in ((titles, "id"), (names, "name"))]
        rounds.append(partial(small, *some, few))
        titles = _dealt(lookup_join(titles, many, "block", "inner", ["id"], broadcast_bytes=broadcast_bytes), "titles")
        names = stored(lookup_join(names, many, "block", "inner", ["name"], broadcast_bytes=broadcast_bytes), "names")
    far = _by_shapes(titles, names, more, percent, pairs_per_task, broadcast_bytes)
    if far is None:
        far = _by_pieces(titles, names, more, percent, pairs_per_task, broadcast_bytes, pairs_per_text)
    return rounds + (_by_names(titles, names, more, percent) if far is None else far)


def _dealt(titles: DataFrame, name: str) -> DataFrame:
    """A stored table whose files keep all cores busy: rounds read it as it lies."""
    return stored(titles.repartition(2 * titles.sparkSession.sparkContext.defaultParallelism, "id"), name)


def _both_marked(titles: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Titles and names, both with numbers and masks."""
    number = F.monotonically_increasing_id()
    return _marked(titles, "id", number, "titles"), _marked(names, "name", number, "names", "sku")


def candidates(
    titles: DataFrame,
    names: DataFrame,
    percent: int = FUZZY_PERCENT,
    pairs_per_task: int = PAIRS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
    pairs_per_text: int = PAIRS_PER_TEXT,
) -> DataFrame:
    """Pairs of a title and a name whose distance has to be taken: block, t, n, name_t, name_n, sku, each pair once.

    Titles that equal a name are left out. Pairs of neighbouring characters are compared before the distance.
    """
    titles = titles.join(names.select("block", "t"), ["block", "t"], "left_anti")
    rounds = _near(*_both_marked(titles, names), percent, pairs_per_task, broadcast_bytes, pairs_per_text)
    near = [pairs().select("block", "t", "n", "name_t", "name_n", "sku") for pairs in rounds]
    return near[0] if len(near) == 1 else reduce(DataFrame.unionAll, near).dropDuplicates(["block", "t", "name_t"])


def best_titles(
    titles: DataFrame,
    names: DataFrame,
    percent: int = FUZZY_PERCENT,
    pairs_per_task: int = PAIRS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
    pairs_per_text: int = PAIRS_PER_TEXT,
) -> DataFrame:
    """Best catalogue name for each distinct title of a block.

    In: ``titles(block, t)`` and ``names(block, t, sku)``, each distinct and
    non-empty, both stored tables. Out: ``(block, t, sku, edits, longest)``.

    Similarity is ``100 * (1 - levenshtein / longer length)``. It counts a
    substitution as one edit, where an insert-delete ratio would count two. The
    boundary is tested in whole numbers: ``100 * edits <= (100 - percent) *
    longest``. Of equally good names the smallest SKU wins.

    Equal texts are settled by an equi-join. Where blocks are large, titles are
    first compared at half the difference allowed: one that has a name there has
    its best name there, and only the others are compared at the full difference.

    Small blocks are compared whole, larger ones by the shapes of their texts, by
    pieces, or whole by so many names at a time, in rounds that leave nothing but
    the best names on disk. By pieces: cut the longer text into one piece more than the k edits allowed, and at least one piece survives unchanged in the other text. Of
    those that survive, one piece ``i`` has at most ``i`` edits before it and at
    most ``k - i`` behind it (walking over the pieces, edits so far minus pieces
    so far starts at 0, ends below ``edits - k``, and falls by one only at an
    intact piece), which bounds how far it has moved. Joining pieces with
    substrings at those places therefore finds every pair that can pass, while
    titles of one block that share nothing never meet. Pairs whose characters, or
    pairs of neighbouring characters, alone need too many edits are dropped before
    the distance (in bit masks; nothing that can pass is lost). Each pair left is compared once; the
    best one is kept by an aggregate that combines map-side.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be in 1..100, not {percent}")
    known = titles.join(names.withColumn("equal", F.lit(True)), ["block", "t"], "left")
    if percent < 100:
        known = stored(known, "known")
    equal = known.where("equal").select(
        "block", "t", "sku", F.lit(0).alias("edits"), F.char_length("t").cast("long").alias("longest")
    )
    if percent == 100:
        return equal
    ours, theirs = _both_marked(known.where("equal IS NULL"), names)
    sizes = [df.groupBy("block").agg(F.count(F.lit(1)).cast("double").alias(c)) for df, c in ((ours, "a"), (theirs, "b"))]
    pairs, widest = sizes[0].join(sizes[1], "block").agg(F.sum(F.expr("a * b")), F.max(F.expr("a * b / (a + b)"))).first()
    few, spark = pairs is None or widest <= pairs_per_text, titles.sparkSession
    best = equal
    for step in [percent] if few else sorted({(100 + percent) // 2, percent}, reverse=True):
        with scratch_tables(spark):
            rounds = []
            for pairs in _near(ours, theirs, step, pairs_per_task, broadcast_bytes, pairs_per_text):
                with scratch_tables(spark):
                    rounds.append(kept(_closest(pairs(), step), "close"))
            if not rounds:
                continue
            first = F.min("best").alias("best")
            close = rounds[0] if len(rounds) == 1 else reduce(DataFrame.unionAll, rounds).groupBy("id", "block", "t").agg(first)
            close = kept(close.select("id", "block", "t", "best.sku", "best.edits", "best.longest"), "close")
        if step != percent:
            ours = _dealt(lookup_join(ours, close.select("id"), "id", "left_anti", ["id"], broadcast_bytes=broadcast_bytes), "titles")
        best = best.unionByName(close.drop("id"))
    return best


def _closest(pairs: DataFrame, percent: int) -> DataFrame:
    """The best name of each title among these pairs."""
    close = pairs.withColumns({"edits": _distance(percent), "longest": F.greatest("n", "name_n")}).where("edits >= 0")
    first = F.min(F.struct((F.col("edits") / F.col("longest")).alias("share"), "sku", "edits", "longest")).alias("best")
    return close.groupBy("id", "block", "t").agg(first)


def fuzzy_candidates(
    catalogue: DataFrame,
    listings: DataFrame,
    block: str,
    title: str = "seller_product_name",
    name: str = "product_name",
    catalogue_block: str | None = None,
    percent: int = FUZZY_PERCENT,
    pairs_per_task: int = PAIRS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Best SKU per distinct (block, normalised title), as a stored table.

    Copies collapse before anything is compared: the work grows with distinct
    titles and names, not with listings.
    """
    names = (
        catalogue.select(
            F.col(catalogue_block or block).alias("block"), sorted_words(F.col(name)).alias("t"), "sku"
        )
        .where("t != '' AND block IS NOT NULL")
        .groupBy("block", "t")
        .agg(F.min("sku").alias("sku"))
    )
    titles = (
        listings.select(F.col(block).alias("block"), sorted_words(F.col(title)).alias("t"))
        .where("t != '' AND block IS NOT NULL")
        .distinct()
    )
    with scratch_tables(catalogue.sparkSession):
        best = best_titles(stored(titles, "titles"), stored(names, "names"), percent, pairs_per_task, broadcast_bytes)
        return kept(best, "best")


def fuzzy_match(
    catalogue: DataFrame,
    listings: DataFrame,
    block: str,
    title: str = "seller_product_name",
    name: str = "product_name",
    catalogue_block: str | None = None,
    percent: int = FUZZY_PERCENT,
    how: str = "inner",
    pairs_per_task: int = PAIRS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Listings with the SKU of the most similar catalogue name in their block.

    Adds ``sku`` and ``match_confidence`` (similarity / 100, at most 0.99);
    ``how='left'`` keeps listings without a match, with NULLs in both.
    """
    best = fuzzy_candidates(
        catalogue, listings, block, title, name, catalogue_block, percent, pairs_per_task, broadcast_bytes
    )
    return attach_best(listings, best, block, title, how, broadcast_bytes)


def fuzzy_confidence() -> Column:
    """Share of the longer text that stays, below 1.0: certainty is for exact SKUs."""
    return F.least((F.col("longest") - F.col("edits")) / F.col("longest"), F.lit(FUZZY_MOST))


def attach_best(
    listings: DataFrame,
    best: DataFrame,
    block: str,
    title: str = "seller_product_name",
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fuzzy_candidates`` back to the listings they stand for."""
    scored = best.select(
        F.col("block").alias(block),
        F.col("t").alias("__t"),
        "sku",
        fuzzy_confidence().alias("match_confidence"),
    )
    keyed = listings.withColumn("__t", sorted_words(F.col(title)))
    return lookup_join(
        keyed, scored, [block, "__t"], how, ["listing_id"], broadcast_bytes=broadcast_bytes
    ).drop("__t")
