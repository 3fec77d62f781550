"""N-gram Jaccard join: exact links between shingle sets, by prefix lists and set-relation skipping.

Steps, each over all documents:

1. Equal sets become one class; its smallest document stands for it.
2. Document frequencies of all shingles are counted. A shingle of one set cannot be
   shared, so a set with more than a fifth of such shingles has no partner and goes.
3. The remaining sets are ordered rarest shingle first; two linked sets share one of
   their first fifth. Each such shingle ties its sets to the smallest of them, which
   gives families that no link leaves.
4. Within a family the sets are joined by inverted lists with the two skipping rules
   of set relations (``link_sets``).

No pairs of a family are written out: a task returns a spanning forest of its links.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.blocks import LOWER, SPACED, free_name, map_arrow, mix, shares, stored, windows_of, words_of
from assayline.llm.chunks import Chunk, Question, answers_of, ask, bucket_count, pack_chunks, read_chunk, refused, starts_of
from assayline.llm.components import components

#: Words of a shingle. Two sets link when 5 * shared >= 4 * union.
SHINGLE = 5
#: Shingles of the sets that one task joins (8 bytes each); larger families are dealt in blocks.
TASK_TOKENS = 250_000
#: Rounds in which a large family's sets are compared with one of them before its blocks are.
PIVOT_ROUNDS = 3


def least_shared(a: int, b: int | None = None) -> int:
    """Shingles that sets of these sizes share at least if they link (one size: with any partner)."""
    return -(-4 * a // 5) if b is None else -(-4 * (a + b) // 9)


@dataclass
class Sets:
    """Distinct shingle hashes of documents, sorted within each; n+1 offsets."""

    hash: np.ndarray
    doc: np.ndarray
    offsets: np.ndarray

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit digests of each set."""
        sizes = np.diff(self.offsets).astype(np.uint64)
        out = []
        for salt in (0x51, 0xA7):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.hash + np.uint64(salt << 40)))))
            out.append(mix(total[self.offsets[1:]] - total[self.offsets[:-1]] + sizes))
        return out[0], out[1]


def sets_of(chunk: Chunk, n: int = SHINGLE) -> Sets:
    """Distinct n-word shingles of each document; a shorter one is one shingle, one without words has none."""
    words = words_of(LOWER[chunk.data], chunk.offsets, SPACED)
    at, hashes = windows_of(words, n)
    docs, all_hashes = [words.doc[at]], [hashes]
    counts = np.diff(words.first)
    for short in range(1, n):
        if (counts == short).any():
            at, hashes = windows_of(words, short)
            whole = counts[words.doc[at]] == short
            docs.append(words.doc[at][whole])
            all_hashes.append(mix(hashes[whole] + np.uint64(short)))
    doc, h = np.concatenate(docs), np.concatenate(all_hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = starts_of(doc, h)
    doc, h = doc[first], h[first]
    return Sets(h, doc, np.searchsorted(doc, np.arange(len(counts) + 1), "left"))


class Questions:
    """What chunks ask about their sets."""

    def __init__(self, bits: int):
        self.mask = np.uint64(((1 << bits) - 1) << (64 - bits))

    # 1: the smallest document of each set
    @staticmethod
    def sets(chunk: Chunk, _=None) -> dict[str, np.ndarray]:
        return Questions._sets(chunk, sets_of(chunk))[0]

    @staticmethod
    def _sets(chunk: Chunk, sets: Sets):
        key, check = sets.digests()
        full = np.flatnonzero(np.diff(sets.offsets) > 0)
        ids = chunk.doc_ids()
        order = full[np.lexsort((full, ids[full], check[full], key[full]))]
        first = starts_of(key[order], check[order])
        at = order[first]
        return {"key": key[at], "check": check[at], "id": ids[at]}, at

    @staticmethod
    def smallest(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
        """1 for the entry that stands for its set (ties: the first chunk)."""
        order = np.lexsort((source, columns["id"], columns["check"], columns["key"]))
        first = starts_of(columns["key"][order], columns["check"][order])
        out = np.zeros(len(order), np.uint8)
        out[order[first]] = 1
        return out

    # 2: document frequencies
    def frequencies(self, chunk: Chunk, answers: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return self._frequencies(chunk, sets_of(chunk), answers)[0]

    def _frequencies(self, chunk: Chunk, sets: Sets, answers):
        """Columns; the chosen shingles in their order; the place of each in the columns."""
        _, at = self._sets(chunk, sets)
        chosen = np.zeros(len(chunk.ids), bool)
        chosen[at[answers["class"] == 1]] = True
        rows = np.flatnonzero(chosen[sets.doc])
        key = sets.hash[rows] & self.mask
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        first = starts_of(key)
        sizes = np.diff(np.append(first, len(rows)))
        columns = {"key": key[first], "n": np.minimum(sizes, 255).astype(np.uint8)}
        return columns, rows, np.repeat(np.arange(len(first)), sizes)

    @staticmethod
    def added(columns: dict[str, np.ndarray], first: np.ndarray) -> dict[str, np.ndarray]:
        """Frequencies of keys that several senders have, 255 for more."""
        return {"n": np.minimum(np.add.reduceat(columns["n"].astype(np.int64), first), 255).astype(np.uint8)}

    @staticmethod
    def counted(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
        """Document frequency, 255 for more."""
        order = np.argsort(columns["key"], kind="stable")
        first = starts_of(columns["key"][order])
        total = np.add.reduceat(columns["n"][order].astype(np.int64), first)
        out = np.zeros(len(order), np.uint8)
        out[order] = np.repeat(np.minimum(total, 255), np.diff(np.append(first, len(order))))
        return out


def _pack(arrays: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.astype("<u8").tobytes() for a in arrays))


def _tokens(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u8")


def prefix_length(n: int, alone: int) -> int:
    """How many of a set's shared shingles, rarest first, one partner at least has as well; ``alone`` are in no other."""
    return n - least_shared(n) + 1 - alone


#: Sets that may have a partner: as chunks, so that they can ask again.
PARTNERS = "chunk string, ids array<long>, sizes array<long>, data binary"


def _chunk_rows(questions: Questions, batch: pa.RecordBatch, i: int):
    """Of one chunk: (doc_id, n, set digest or None) of each document, and the sets that may have a partner."""
    chunk, answers = read_chunk(batch, i), answers_of(batch, i)
    sets = sets_of(chunk)
    n = np.diff(sets.offsets)
    one, two = sets.digests()
    rows = [
        {"doc_id": d, "n_shingles": k, "digest": (int(a) << 64 | int(b)).to_bytes(16, "big") if k else None}
        for d, k, a, b in zip(chunk.ids, n.tolist(), one.tolist(), two.tolist())
    ]
    _, chosen, place = questions._frequencies(chunk, sets, answers)
    count = np.zeros(len(sets.hash), np.int64)
    count[chosen] = answers["df"][place]
    shared = np.bincount(sets.doc[count > 1], minlength=len(n))
    keep = np.flatnonzero((n > 0) & (shared >= -(-4 * n // 5)))
    out = []
    for d in keep.tolist():
        lo, hi = int(sets.offsets[d]), int(sets.offsets[d + 1])
        tokens, df = sets.hash[lo:hi], count[lo:hi]
        tokens, df = tokens[df > 1], df[df > 1]
        out.append((chunk.ids[d], hi - lo, tokens[np.lexsort((tokens, df))]))
    return rows, out


@dataclass
class Partners:
    ids: list
    n: np.ndarray
    tokens: list[np.ndarray]

    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """First shingles of all sets, and the set of each."""
        parts = [t[: prefix_length(n, n - len(t))] for n, t in zip(self.n.tolist(), self.tokens)]
        doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), doc


def _read_partners(batch: pa.RecordBatch, i: int) -> Partners:
    ids = batch.column("ids")[i].as_py()
    sizes = np.array(batch.column("sizes")[i].as_py(), np.int64).reshape(-1, 2)
    tokens = _tokens(batch.column("data")[i].as_py())
    return Partners(ids, sizes[:, 0], np.split(tokens, np.cumsum(sizes[:, 1])[:-1]) if len(ids) else [])


def _first_shingles(partners: Partners, _=None) -> dict[str, np.ndarray]:
    return _ask_prefixes(partners)[0]


def _ask_prefixes(partners: Partners):
    key, doc = partners.prefixes()
    ids = np.array([np.iinfo(np.int64).max if i is None else i for i in partners.ids], np.int64)
    ids = ids[doc] if len(doc) else np.zeros(0, np.int64)
    order = np.lexsort((ids, key))
    first = starts_of(key[order])
    place = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    return {"key": key[order][first], "id": ids[order][first]}, doc[order], place


def _smallest_id(columns: dict[str, np.ndarray], source: np.ndarray) -> np.ndarray:
    order = np.lexsort((columns["id"], columns["key"]))
    first = starts_of(columns["key"][order])
    out = np.zeros(len(order), np.int64)
    out[order] = np.repeat(columns["id"][order][first], np.diff(np.append(first, len(order))))
    return out


class _Forest:
    def __init__(self, labels: list):
        first: dict = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Shared values of two sorted arrays."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def open_entries(places: dict[int, list[tuple[int, int]]], a: int, smallest: int, left: int):
    """(size, set) of entries that a set of ``a`` shingles, ``left`` of them from the probing place on, may link to."""
    least = least_shared(a, smallest)
    if left < least:
        return
    for j, block in places.items():
        # what both have from their places on; larger sets need more
        most = min(j, left)
        if most < least:
            continue
        for size, y in block[bisect_left(block, (smallest,)) :]:
            if least_shared(a, size) > most:
                break
            yield size, y


def link_sets(n: list[int], tokens: list[np.ndarray], labels: list) -> list[int]:
    """Root of each set after joining all linked ones (sets with equal labels are joined already).

    Sets come by size; a set probes the lists of its first shingles. A list is kept in
    blocks, one for each component at the time of entry and place in the set, ordered by size:

    * index skipping: the blocks of the set's own component are passed over whole, as is
      a block whose place (or the probing place) leaves too few shingles to share; in
      the others so are the entries that are too small, and those too large for the place;
    * answer skipping: an entry that was joined to a highly similar set (its base) keeps
      its differences from it. Once the overlap with the base is known, the entry's
      overlap is bounded by it, and if need be made from it by the differences alone.
    """
    forest = _Forest(labels)
    ordered = [np.sort(t) for t in tokens]
    base: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}  # set -> (base, own more, base's more)
    lists: dict[int, dict[int, dict[int, list[tuple[int, int]]]]] = {}
    for x in sorted(range(len(n)), key=lambda i: (n[i], i)):
        a, mine = n[x], ordered[x]
        alone = a - len(mine)
        known: dict[int, int] = {}
        checked: set[int] = set()
        smallest = least_shared(a)
        prefix = tokens[x][: prefix_length(a, alone)].tolist()
        for i, token in enumerate(prefix):
            for root, places in lists.get(token, {}).items():
                if forest.root(root) == forest.root(x):
                    continue
                for size, y in open_entries(places, a, smallest, a - alone - i):
                    need = least_shared(a, size)
                    if y in checked:
                        continue
                    checked.add(y)
                    from_base = base.get(y)
                    if from_base and from_base[0] in known:
                        b, more, less = from_base
                        if known[b] + len(more) < need:
                            continue
                        shared = known[b] + _overlap(more, mine) - _overlap(less, mine)
                    else:
                        shared = _overlap(mine, ordered[y])
                    known[y] = shared
                    if shared < need:
                        continue
                    if x not in base:
                        other = ordered[y]
                        base[x] = (y, np.setdiff1d(mine, other, True), np.setdiff1d(other, mine, True))
                    ra, rb = forest.root(x), forest.root(y)
                    forest.up[max(ra, rb)] = min(ra, rb)
                    break
        root = forest.root(x)
        for i, token in enumerate(prefix):
            # what the set has from this place on
            lists.setdefault(token, {}).setdefault(root, {}).setdefault(len(mine) - i, []).append((a, x))
    return [forest.root(i) for i in range(len(n))]


LINK = "a long, b long"
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _join_task(table: pa.Table) -> pa.Table:
    """All families of a task, one after another; links as (set, root)."""
    family = table.column("family").to_numpy()
    order = np.lexsort((table.column("doc_id").to_numpy(), family))
    table, family = table.take(pa.array(order)), family[order]
    ids, n = table.column("doc_id").to_pylist(), table.column("n").to_pylist()
    label, data = table.column("label").to_pylist(), table.column("tokens")
    links = []
    bounds = [*starts_of(family).tolist(), len(family)]
    for lo, hi in zip(bounds, bounds[1:]):
        tokens = [_tokens(data[i].as_py()) for i in range(lo, hi)]
        roots = link_sets(n[lo:hi], tokens, label[lo:hi])
        links += [(ids[lo + i], ids[lo + r]) for i, r in enumerate(roots) if i != r]
    return pa.table([[a for a, _ in links], [b for _, b in links]], schema=_LINK)


def _pivot_links(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Links of members with their family's pivot (family, pivot, pivot_n, pivot_tokens)."""
    size = pivots.agg(F.sum(F.length("pivot_tokens"))).first()[0] or 0
    # one set a large family; broadcast only if they are small together
    pivots = F.broadcast(pivots) if size < 64 << 20 else pivots

    def run(batches):
        for batch in batches:
            links, seen = [], {}
            for i in range(batch.num_rows):
                pivot = batch.column("pivot")[i].as_py()
                if pivot not in seen:
                    seen = {pivot: np.sort(_tokens(batch.column("pivot_tokens")[i].as_py()))}
                doc, n = batch.column("doc_id")[i].as_py(), batch.column("n")[i].as_py()
                need = least_shared(n, batch.column("pivot_n")[i].as_py())
                if doc != pivot and _overlap(np.sort(_tokens(batch.column("tokens")[i].as_py())), seen[pivot]) >= need:
                    links.append((doc, pivot))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"]
            )

    return map_arrow(members.join(pivots, "family"), run, LINK)


def _labelled(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """``members`` with the component by the links found so far."""
    if links is None:
        return members.withColumn("label", F.col("doc_id"))
    found = components(links, "a", "b")
    joined = members.join(found, members["doc_id"] == found["node"], "left")
    return joined.select(*members.columns, F.coalesce("component", "doc_id").alias("label"))


def _family_links(members: DataFrame, task_tokens: int) -> DataFrame:
    """Links within families (family, doc_id, n, size, tokens)."""
    sizes = members.groupBy("family").agg(F.sum("size").alias("total"), F.count("*").alias("docs"))
    sizes = stored(sizes, "families")
    large = sizes.where(F.col("total") > task_tokens).select("family")
    links = None
    if large.head(1):
        big = stored(members.join(large, "family", "left_semi"), "large")
        labelled = _labelled(big, None)
        for _ in range(PIVOT_ROUNDS):
            # of each family that is not one component yet: the smallest set outside the component of most
            per = labelled.groupBy("family", "label").agg(F.count("*").alias("k"), F.min("doc_id").alias("least"))
            split = per.groupBy("family").agg(F.count("*").alias("parts"), F.max(F.struct("k", F.negative("label"))).alias("top"))
            split = split.where("parts > 1")
            if links is None:
                pick = per.groupBy("family").agg(F.min("least").alias("pivot"))
            else:
                pick = (
                    per.join(split, "family").where(F.col("label") != F.negative("top.col2"))
                    .groupBy("family").agg(F.min("least").alias("pivot"))
                )
            chosen = big.join(pick.select(F.col("pivot").alias("doc_id")), "doc_id", "left_semi").select(
                "family", F.col("doc_id").alias("pivot"), F.col("n").alias("pivot_n"), F.col("tokens").alias("pivot_tokens")
            )
            chosen = stored(chosen, "pivots")
            if not chosen.head(1):
                break
            found = _pivot_links(big, chosen)
            links = stored(found if links is None else links.unionByName(found), "links")
            labelled = _labelled(big, links)
        members = members.join(large, "family", "left_anti").withColumn("label", F.col("doc_id")).unionByName(
            labelled.select(*members.columns, "label")
        )
    else:
        members = members.withColumn("label", F.col("doc_id"))
    # small families share tasks; a large one that is in several components is joined block by block
    tasks = shares(members, 8, 64)
    parts = members.groupBy("family").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("family")
    plan = sizes.join(parts, "family").select(
        "family", F.greatest(F.lit(1), F.ceil(2 * F.col("total") / task_tokens)).cast("int").alias("blocks")
    )
    plan = plan.withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    joined = members.join(plan, "family")
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))
    )
    dealt = joined.withColumn("block", block).withColumn("pair", F.explode(pairs))
    own = F.struct(F.col("family").alias("f"), F.col("pair.i").alias("i"), F.col("pair.j").alias("j"))
    shared = F.struct(F.pmod(F.xxhash64("family"), F.lit(tasks)).alias("f"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    dealt = dealt.withColumn("task", F.when(F.col("blocks") > 1, own).otherwise(shared))
    found = dealt.select("task", "family", "doc_id", "n", "label", "tokens").groupBy("task").applyInArrow(_join_task, LINK)
    return found if links is None else found.unionByName(links)


def _told_apart(docs: DataFrame, id_col: str) -> bool:
    """Whether every row has an id of its own."""
    ids = docs.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return not ids.where("id IS NULL OR n > 1").head(1)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written once, with a number of its own for every row, and the number's column."""
    name = free_name(docs, "row")
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def join_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_tokens: int = TASK_TOKENS
) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id.

    Documents link when 5 * shared >= 4 * union of their distinct shingles (A-Z in lower
    case, words end at ASCII white space). component_id is the smallest doc_id reachable
    by links, itself included. NULL, empty and blank texts have no shingles and are
    their own component; rows with equal sets are linked. Every row is a document, also
    where ids are NULL or repeated: such rows are linked by their texts only, and a
    component without any id has a NULL one.
    """
    if _told_apart(docs, id_col):
        return _joined(docs, id_col, text_col, task_tokens)
    rows, number = _numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    found = _joined(rows, number, "text", task_tokens).withColumnsRenamed({"doc_id": number, "component_id": "component"})
    met = stored(found.join(rows.select(number, "doc_id"), number), "numbered")
    least = met.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return met.join(least, "component").select("doc_id", "n_shingles", "component_id")


def _joined(docs: DataFrame, id_col: str, text_col: str, task_tokens: int) -> DataFrame:
    """``join_documents`` where every row has an id of its own."""
    buckets = bucket_count(docs)
    questions = Questions(min(64, (shares(docs, 1, 1) << 22).bit_length() + 10))
    chunks = pack_chunks(docs, id_col, text_col)
    smallest = Question(Questions.smallest, ("key", "check"), ("id",), others=refused)
    chunks = ask(chunks, "class", Questions.sets, smallest, buckets)
    chunks = ask(chunks, "df", questions.frequencies, Question(Questions.counted, total=Questions.added), buckets)

    def describe(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, sets = _chunk_rows(questions, batch, i)
                k = len(rows)
                ids, sizes = [s[0] for s in sets], [x for s in sets for x in (s[1], len(s[2]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["doc_id"] for r in rows] + [None], pa.int64()),
                        pa.array([r["n_shingles"] for r in rows] + [None], pa.int64()),
                        pa.array([r["digest"] for r in rows] + [None], pa.binary()),
                        pa.array([None] * k + [batch.column("chunk")[i].as_py()], pa.string()),
                        pa.array([None] * k + [ids], pa.list_(pa.int64())),
                        pa.array([None] * k + [sizes], pa.list_(pa.int64())),
                        pa.array([None] * k + [_pack([s[2] for s in sets])], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "chunk", "ids", "sizes", "data"],
                )

    described = stored(map_arrow(chunks, describe, "doc_id long, n_shingles long, digest binary, " + PARTNERS), "sets")
    rows = described.where("chunk IS NULL").select("doc_id", "n_shingles", "digest")
    partners = described.where("chunk IS NOT NULL AND size(ids) > 0").select("chunk", "ids", "sizes", "data")
    asked = ask(partners, "least", _first_shingles, Question(_smallest_id, rank=("id",)), buckets, _read_partners)

    def ties(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                sets = _read_partners(batch, i)
                _, doc, place = _ask_prefixes(sets)
                least = answers_of(batch, i)["least"][place]
                ids = np.array([np.iinfo(np.int64).max if d is None else d for d in sets.ids], np.int64)[doc]
                pairs = np.unique(np.stack([ids, least], 1)[ids != least], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    families = stored(components(map_arrow(asked, ties, LINK), "a", "b"), "tied")

    def sets_by_row(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                sets = _read_partners(batch, i)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([np.iinfo(np.int64).max if d is None else d for d in sets.ids], pa.int64()),
                        pa.array(sets.n, pa.int64()),
                        pa.array([len(t) for t in sets.tokens], pa.int64()),
                        pa.array([_pack([t]) for t in sets.tokens], pa.binary()),
                    ],
                    names=["node", "n", "size", "tokens"],
                )

    singles = map_arrow(partners, sets_by_row, "node long, n long, size long, tokens binary")
    members = singles.join(families, "node").select(
        F.col("component").alias("family"), F.col("node").alias("doc_id"), "n", "size", "tokens"
    )
    links = _family_links(stored(members, "members"), task_tokens)
    linked = components(links, "a", "b")
    # from the documents that stand for their sets to all rows
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"))
    classes = classes.join(linked, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    out = rows.join(classes, "digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, same columns.

    The row of the smallest id stays, rows without an id come last; of rows with one id
    the one of the first text. Rows without shingles all stay, as do rows of one id whose
    texts are not linked.
    """
    if _told_apart(docs, id_col):
        found = _joined(docs, id_col, text_col, TASK_TOKENS)
        first = found.where("doc_id = component_id").select(F.col("doc_id").alias(id_col))
        return docs.join(first, id_col, "left_semi").select(*docs.columns)
    rows, number = _numbered(docs)
    found = _joined(rows.select(number, text_col), number, text_col, TASK_TOKENS)
    groups = found.select(F.col("doc_id").alias(number), F.col("component_id").alias("__component"))
    met = rows.select(number, F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(groups, number)
    order = F.struct(F.col("__id").isNull(), "__id", "__text", number)
    first = met.groupBy("__component").agg(F.min(order)[number].alias(number))
    return rows.join(first.select(number), number, "left_semi").select(*docs.columns)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return join_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op1_ngram_join": op1_ngram_join}
ORACLES: dict[str, str] = {}
