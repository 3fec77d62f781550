import os
import random

import pytest
from pyspark.sql import functions as F

from assayline.operators import matching
from assayline.operators.quality import add_anomaly_columns
from assayline.plans.product_master import (
    all_match_rows,
    flag_matches,
    one_per_product,
    product_master,
    product_match_pairs,
    rows_flagged_with,
    sku_coverage,
)
from assayline.registry import QUALITY_COLUMNS
from assayline.sources.literals import literal_table
from assayline.sources.scratch import scratch_dir


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(titles, names, percent):
    best = {}
    for block, t in titles:
        found = []
        for other, n, sku in names:
            m = max(len(t), len(n))
            d = levenshtein(t, n)
            if block == other and 100 * (m - d) >= percent * m:
                found.append((d / m, sku, d, m))
        if found:
            _, sku, d, m = min(found)
            best[block, t] = (sku, d, m)
    return best


def random_texts(count, seed):
    """Texts that are often a few edits apart, lengths 1 to about 30."""
    rng = random.Random(seed)
    seeds = ["".join(rng.choices("abcde ", k=rng.randint(1, 28))).strip() or "a" for _ in range(25)]
    out = set()
    while len(out) < count:
        text = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 1 + len(text) // 3)):
            where = rng.randrange(len(text) + 1)
            kind = rng.random()
            if kind < 0.4 and text:
                text[min(where, len(text) - 1)] = rng.choice("abcdeé")
            elif kind < 0.7:
                text.insert(where, rng.choice("abcde"))
            elif text:
                del text[min(where, len(text) - 1)]
        if text:
            out.add("".join(text))
    return sorted(out)


@pytest.mark.parametrize("percent", [50, 70, 85, 100])
def test_best_titles_equals_brute_force(spark, percent):
    titles = [(i % 3, t) for i, t in enumerate(random_texts(120, 1))]
    names = [(i % 3, t, f"SKU-{i}") for i, t in enumerate(random_texts(120, 2))]
    a = literal_table(spark, titles, "block int, t string")
    b = literal_table(spark, names, "block int, t string, sku string")
    want = brute_force(titles, names, percent)
    assert want
    for pairs_per_task in (10**9, 3) if percent == 70 else (10**9,):  # one cell per gram; a grid
        got = matching.best_titles(a, b, percent, pairs_per_task).collect()
        assert {(r.block, r.t): (r.sku, r.edits, r.longest) for r in got} == want
        assert len(got) == len(want)


def test_long_texts(spark):
    rng = random.Random(3)

    def vary(text, edits):
        out = list(text)
        for _ in range(edits):
            out[rng.randrange(len(out))] = rng.choice("abcdef")
        return "".join(out)

    seeds = ["".join(rng.choices("abcdefgh", k=k)) for k in (90, 99, 100, 101, 130, 260)]
    names = [(1, s, f"S{i}") for i, s in enumerate(seeds)]
    titles = {(1, vary(s, e) + s[:x]) for s in seeds for e, x in ((3, 0), (20, 5), (60, 0), (10, 30))}
    a = literal_table(spark, sorted(titles), "block int, t string")
    b = literal_table(spark, names, "block int, t string, sku string")
    got = {(r.block, r.t): (r.sku, r.edits, r.longest) for r in matching.best_titles(a, b, 70).collect()}
    want = brute_force(titles, names, 70)
    assert got == want and len(want) > 12


def test_long_random_texts(spark):
    """Lengths around the border of placed pieces, edits of all kinds, at several thresholds."""
    rng = random.Random(9)

    def edited(text, edits):
        out = list(text)
        for _ in range(edits):
            at = rng.randrange(len(out))
            out[at : at + 1] = rng.choice([[], [rng.choice("abcé")], [out[at], rng.choice("abc")]])
        return "".join(out) or "a"

    seeds = ["".join(rng.choices("abcd ", k=k)).strip() + "x" for k in range(70, 170, 4)]
    names = sorted({(1, s, f"S{i}") for i, s in enumerate(seeds)})
    titles = sorted({(1, edited(s, rng.choice([1, len(s) // 6, len(s) // 4, len(s) // 3]))) for s in seeds for _ in range(3)})
    a = literal_table(spark, titles, "block int, t string")
    b = literal_table(spark, names, "block int, t string, sku string")
    for percent in (60, 75, 90):
        got = {(r.block, r.t): (r.sku, r.edits, r.longest) for r in matching.best_titles(a, b, percent).collect()}
        assert got == brute_force(titles, names, percent) and got


def test_masks_lose_nothing(spark):
    """The surplus of characters and the lost pairs of neighbours never exceed what the distance allows."""
    texts = random_texts(60, 5) + ["é🙂" * 9, "a" * 200, "ab" * 70, "b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    one = df.select("t", matching._count_masks("t").alias("c"), matching._pair_masks("t").alias("g")).select("t", "c.*", "g.*")
    other = one.toDF(*[f"name_{c}" for c in one.columns])
    both = one.crossJoin(other).select(
        "t", "name_t", matching._surplus("c", "name_c").alias("s"), matching._lost_pairs("g", "name_g").alias("l")
    )
    for r in both.collect():
        edits = levenshtein(r.t, r.name_t)
        assert r.s <= edits and r.l <= 2 * edits


def test_each_pair_is_compared_once(spark):
    a = literal_table(spark, [(1, f"blue round lamp {i:03d}") for i in range(40)], "block int, t string")
    b = literal_table(spark, [(1, f"blue round lamp x{i:02d}", f"S{i}") for i in range(40)], "block int, t string, sku string")
    pairs = matching.candidates(a, b, 70)
    assert pairs.count() == pairs.select("t", "name_t").distinct().count() == 1600


def test_hot_grams_are_laid_out_on_a_grid(spark):
    a = literal_table(
        spark, [(1, f"common {i:03d}") for i in range(60)], "block int, t string"
    )
    b = literal_table(
        spark,
        [(1, f"common x{i:02d}", f"S{i}") for i in range(60)],
        "block int, t string, sku string",
    )
    sized = [
        df.select(F.monotonically_increasing_id().alias("id"), "block", "t", F.char_length("t").cast("long").alias("n"),
                  matching._count_masks("t").alias("c")).select("*", "c.*")
        for df in (a, b)
    ]
    left = matching._signatures(sized[0], 70, "title", "name")
    right = matching._signatures(sized[1], 70, "name", "title")
    sizes = matching._grid_sizes(left, right, ["key"], 100)
    assert sizes is not None and max(r.side for r in sizes.collect()) == 6  # ceil(sqrt(3600 / 100))
    rows_a = [(1, f"common {i:03d}") for i in range(60)]
    rows_b = [(1, f"common x{i:02d}", f"S{i}") for i in range(60)]
    got = matching.best_titles(a, b, 70, 100).collect()
    assert {(r.block, r.t): (r.sku, r.edits, r.longest) for r in got} == brute_force(rows_a, rows_b, 70)


def model_titles(count, seed):
    """Few words and model numbers: many texts of one shape, some a few edits from a name, some of no name."""
    rng = random.Random(seed)
    words = ["blue ring", "blue rod", "old anvil", "hot plate"]
    names = sorted({f"{rng.choice(words)} m{rng.randrange(100, 1000)}x{rng.randrange(10, 100)}" for _ in range(count)})
    titles = set()
    for n in names:
        kind, at = rng.randrange(5), rng.randrange(len(n))
        titles.add([n[:at] + n[at + 1 :], n + " new", n[3:], n[::-1], n[:-3] + "777"][kind].strip())
    return sorted(titles), names


@pytest.mark.parametrize(
    "way, percent",
    [("whole", 70), ("shapes", 70), ("shapes", 90), ("few names a title", 70), ("pieces", 60), ("mixed blocks", 70)],
)
def test_every_way_finds_the_same(spark, monkeypatch, way, percent):
    titles, names = model_titles(60, 4)
    titles = [(1, t) for t in titles] + ([(2, t) for t in titles[:9]] if way == "mixed blocks" else [])
    names = [(i, n, f"S{k}") for i in {b for b, _ in titles} for k, n in enumerate(names[: 99 if i == 1 else 7])]
    monkeypatch.setattr(matching, "TEXTS_PER_SHAPE", 10**9 if way == "pieces" else 1)
    per_text = {"whole": 10**6, "shapes": 20, "few names a title": 1, "pieces": 0, "mixed blocks": 5}[way]
    a = literal_table(spark, titles, "block int, t string")
    b = literal_table(spark, names, "block int, t string, sku string")
    want = brute_force(titles, names, percent)
    got = matching.best_titles(a, b, percent, 100, 1 << 26 if way == "whole" else 0, per_text).collect()
    assert {(r.block, r.t): (r.sku, r.edits, r.longest) for r in got} == want
    assert len(got) == len(want) > 10
    pairs = matching.candidates(a, b, percent, 100, pairs_per_text=per_text)
    assert pairs.count() == pairs.select("block", "t", "name_t").distinct().count()


def test_pieces_of_short_and_long_texts(spark):
    """The index alone, which blocks as small as these do not need: one cell a key, a grid, texts beyond placed pieces."""
    rng = random.Random(5)
    texts = random_texts(120, 1)
    short = [texts[::2], texts[1::2]]
    seeds = ["".join(rng.choices("abcd ", k=k)).strip() + "x" for k in range(70, 170, 8)]
    long = [sorted({s[: len(s) // 2] + rng.choice("abé") + s[len(s) // 2 + cut :] for s in seeds for cut in (1, 9, 30)}), sorted(seeds)]
    for (titles, names), pairs_per_task in ((short, 10**9), (short, 3), (long, 10**9)):
        titles, names = [(1, t) for t in titles], [(1, n, f"S{i}") for i, n in enumerate(names)]
        a = literal_table(spark, titles, "block int, t string")
        b = literal_table(spark, names, "block int, t string, sku string")
        got = matching.best_titles(a, b, 70, pairs_per_task, pairs_per_text=0).collect()
        assert {(r.block, r.t): (r.sku, r.edits, r.longest) for r in got} == brute_force(titles, names, 70)
        assert len(got) > 10


def test_model_numbers_make_no_index(spark, monkeypatch):
    """What is written for titles with model numbers stays near their own count, however many pairs they have."""
    titles, names = model_titles(400, 6)
    written, stored = [], matching.stored

    def counted(df, name):
        out = stored(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(matching, "stored", counted)
    a = literal_table(spark, [(1, t) for t in titles], "block int, t string")
    b = literal_table(spark, [(1, n, n) for n in names], "block int, t string, sku string")
    assert matching.best_titles(a, b, 70, 1000).count() > 200
    assert sum(written) < 10 * (len(titles) + len(names))


def test_titles_near_many_names_make_no_index(spark, monkeypatch):
    """Nor is one made where the shapes leave a title many names: those are compared so many at a time."""
    titles, names = model_titles(400, 6)
    written = []
    for write in ("stored", "kept"):

        def counted(df, name, write=getattr(matching, write, matching.stored)):
            out = write(df, name)
            written.append(out.count())
            return out

        monkeypatch.setattr(matching, write, counted, raising=False)
    monkeypatch.setattr(matching, "NAMES_AT_A_TIME", 200, raising=False)
    titles, names = [(1, t) for t in titles], [(1, n, n) for n in names]
    a = literal_table(spark, titles, "block int, t string")
    b = literal_table(spark, names, "block int, t string, sku string")
    got = matching.best_titles(a, b, 70, 1000, pairs_per_text=20).collect()
    assert {(r.block, r.t): (r.sku, r.edits, r.longest) for r in got} == brute_force(titles, names, 70)
    assert sum(written) < 15 * (len(titles) + len(names))


@pytest.mark.parametrize("way, percent", [("shapes", 70), ("names", 70), ("pieces", 88)])
def test_rounds_find_the_same(spark, monkeypatch, way, percent):
    titles, names = model_titles(40, 4)
    titles, names = [(1, t) for t in titles], [(1, n, f"S{i}") for i, n in enumerate(names)]
    monkeypatch.setattr(matching, "TEXTS_PER_SHAPE", 1 if way == "shapes" else 10**9)
    monkeypatch.setattr(matching, "NAMES_AT_A_TIME", 6 if way == "shapes" else 15)
    monkeypatch.setattr(matching, "ROWS_AT_A_TIME", 500)
    monkeypatch.setattr(matching, "PAIRS_PER_ROW", 0.01 if way == "pieces" else 10**9)
    a = literal_table(spark, titles, "block int, t string")
    b = literal_table(spark, names, "block int, t string, sku string")
    rounds = []
    near = matching._near
    monkeypatch.setattr(matching, "_near", lambda *args: rounds.append(near(*args)) or rounds[-1])
    got = matching.best_titles(a, b, percent, pairs_per_text=5).collect()
    assert {(r.block, r.t): (r.sku, r.edits, r.longest) for r in got} == brute_force(titles, names, percent)
    assert max(len(r) for r in rounds) > 1 and len(got) > 5


def test_only_the_best_names_stay_on_disk(shop, spark):
    catalogue, listings = shop
    folder = scratch_dir(spark)
    before = set(os.listdir(folder))
    best = matching.fuzzy_candidates(catalogue, listings, "category_id")
    assert best.count() > 0
    (left,) = set(os.listdir(folder)) - before
    assert left.startswith("best-")


def test_percent_bounds(spark):
    a = literal_table(spark, [(1, "x")], "block int, t string")
    b = literal_table(spark, [(1, "x", "s")], "block int, t string, sku string")
    for percent in (0, 101):
        with pytest.raises(ValueError):
            matching.best_titles(a, b, percent)


CATALOGUE = "sku string, product_name string, brand_key string, category_key string, " \
    "condition_code_key string, standard_cost double, rrp double, category_id string"
LISTING = "listing_id bigint, seller_id bigint, seller_sku_ref string, seller_product_name string, " \
    "asking_price double, category_id string"


@pytest.fixture(scope="module")
def shop(spark):
    catalogue = [
        ("S1", "Blue Phone", "b1", "c1", None, 5.0, 10.0, "P"),
        ("S2", "Red Lamp - large", "b2", "c2", "n", 6.0, 12.0, "L"),
        ("S3", None, "b3", "c3", "n", None, None, "L"),
        ("S4", "Green Desk", "b4", "c4", "n", 7.0, 14.0, "D"),
    ]
    listings = [
        (10, 1, "S1", "blue phone", 9.0, "P"),
        (11, 1, "S1", "phone case", 3.0, "P"),
        (12, 2, "S1", "wholly other", 3.0, "P"),
        (13, 2, "S2", None, 3.0, "L"),
        (14, 3, "S3", "anything", 3.0, "L"),
        (15, 3, None, "large red lamp", 8.0, "L"),
        (16, 3, "X9", "phones blue", 8.0, "P"),
        (17, 3, "X9", "zzzzzz", 8.0, "P"),
        (18, 3, "X9", "green desk", 8.0, "P"),  # right title, wrong category
        (19, 3, None, None, 8.0, "P"),
        (20, 3, None, "--", 8.0, None),
    ]
    return (
        literal_table(spark, catalogue, CATALOGUE),
        literal_table(spark, listings, LISTING),
    )


def by_listing(df, *cols):
    return {r.match_source_listing_id: tuple(r[c] for c in cols) for r in df.collect()}


def test_pairs_and_flags(shop):
    catalogue, listings = shop
    pairs = product_match_pairs(catalogue, listings)
    assert pairs.count() == 11 and len(pairs.columns) == 17
    exact = matching.exact_sku_pairs(catalogue, listings)
    unknown = matching.unknown_skus(catalogue, listings)
    assert exact.unionByName(unknown).exceptAll(pairs.drop(*QUALITY_COLUMNS)).count() == 0
    flags = by_listing(flag_matches(pairs), "anomaly_reason_code", "product_name")
    assert flags[10] == (None, "Blue Phone")  # the catalogue's name wins
    assert flags[11] == (None, "Blue Phone")  # half of the words
    assert flags[12][0] == flags[13][0] == flags[14][0] == "SKU_PRODUCT_MISMATCH"
    assert flags[14][1] is None  # even a missing catalogue name
    assert {flags[i][0] for i in range(15, 21)} == {"SKU_NOT_IN_CATALOGUE"}
    alike = by_listing(flag_matches(pairs, similarity_below=50), "anomaly_reason_code")
    assert alike[12] == ("SKU_PRODUCT_MISMATCH",) and alike[10] == (None,)
    assert rows_flagged_with(flag_matches(pairs)).count() == 3
    covered = sku_coverage(pairs, catalogue).first()
    assert tuple(covered) == (3, 4, False)


def test_left_variant_keeps_unlisted_catalogue_rows(shop):
    catalogue, listings = shop
    left = matching.exact_sku_pairs(catalogue, listings, how="left")
    extra = left.where("match_source_listing_id IS NULL").collect()
    assert [(r.sku, r.match_confidence, r.match_pass) for r in extra] == [("S4", 0.0, None)]
    with pytest.raises(ValueError):
        matching.exact_sku_pairs(catalogue, listings, how="outer")


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_master_has_one_row_per_product(shop, broadcast_bytes):
    catalogue, listings = shop
    rows = all_match_rows(catalogue, listings, "category_id", broadcast_bytes=broadcast_bytes)
    assert rows.count() == 11
    found = by_listing(rows, "match_pass", "sku")
    assert found[15] == ("FUZZY", "S2") and found[16] == ("FUZZY", "S1")
    assert found[17][0] == found[18][0] == found[19][0] == found[20][0] == "SKU_NOT_IN_CATALOGUE"
    master = product_master(catalogue, listings, "category_id", broadcast_bytes=broadcast_bytes)
    out = {r.sku: r for r in master.collect()}
    assert len(out) == master.count() == 5 and set(out) == {"S1", "S2", "S3", "X9", None}
    s1 = out["S1"]
    assert s1.match_source_listing_id == 10 and s1.match_confidence == 1.0
    assert s1.anomaly_reason_code == "PRODUCT_FUZZY_MATCH,SKU_PRODUCT_MISMATCH"
    assert (s1.anomaly_flag, s1.data_quality_status, s1.metric_certainty_level) == (
        True, "FLAGGED_ANOMALY", "UNRELIABLE",
    )
    assert out[None].match_source_listing_id == 19  # missing SKUs share one key
    assert out["X9"].list_price == 8.0 and out["X9"].brand_key is None
    assert master.columns == product_match_pairs(catalogue, listings).columns


def test_master_of_clean_rows_is_clean(shop):
    catalogue, listings = shop
    clean = flag_matches(product_match_pairs(catalogue, listings.where("listing_id = 10")))
    (row,) = one_per_product(clean).collect()
    assert (row.anomaly_flag, row.anomaly_reason_code, row.data_quality_status) == (False, None, "CLEAN")


def test_fuzzy_match_left_keeps_all_listings(shop):
    catalogue, listings = shop
    out = matching.fuzzy_match(
        catalogue, listings, "category_id", percent=85, how="left", broadcast_bytes=0
    )
    assert out.count() == listings.count()
    # "blue phones" is one edit in eleven from "blue phone"
    assert {r.listing_id for r in out.collect() if r.sku} == {10, 15, 16}


def test_quality_defaults_do_not_touch_match_rows(shop):
    catalogue, listings = shop
    rows = matching.match_rows(catalogue, listings)
    assert add_anomaly_columns(rows).columns[-4:] == list(QUALITY_COLUMNS)


def test_exact_pairs_come_before_fuzzy_ones(shop):
    """A key with an exact pair is never labelled fuzzy; fuzzy rows are never certain."""
    catalogue, listings = shop
    rows = all_match_rows(catalogue, listings, "category_id")
    fuzzy = rows.where("match_pass = 'FUZZY'")
    assert fuzzy.where("match_confidence < 0.7 OR match_confidence > 0.99").count() == 0
    exact = rows.where("match_pass = 'EXACT_SKU'").select("canonical_product_key").distinct()
    one = one_per_product(flag_matches(add_anomaly_columns(rows)))
    assert one.where("match_pass = 'FUZZY'").join(exact, "canonical_product_key").count() == 0
    covered = sku_coverage(rows, catalogue).first().matched_skus
    assert covered == rows.where("match_pass = 'EXACT_SKU'").select("sku").distinct().count()
