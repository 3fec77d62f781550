"""Quality rules: statistics of each text, fixed base rules, and an isolation forest over the statistics.

The forest is grown on a bounded sample of labelled rows (``MAX_LABELLED``), its
rejection threshold is calibrated on the same labels, and the small model
(``TREES`` trees over ``SAMPLE`` rows) is broadcast. Statistics and verdicts are
computed for every whole text where it lies: no shuffle of the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayline.llm.blocks import SPACED, byte_rows, free_name, map_arrow, mix, slices, windows_of, words_of

#: Labelled rows that the forest and its threshold are fitted on at most (those with the smallest hash of the id).
MAX_LABELLED = 20_000
#: Trees, and rows drawn for each of them.
TREES, SAMPLE = 100, 256
#: Share of the labelled good rows that the calibrated threshold may reject at most.
GOOD_LOSS = 0.001
#: Base rules.
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in "!?.,;:"]] = True

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbols", "upper", "bangs", "dup_lines", "repeats", "same_next"]


def _per_doc(offsets: np.ndarray, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: is an equal (doc, hash) earlier; is one anywhere else."""
    key = mix(hashes + mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    earlier = np.zeros(len(key), bool)
    earlier[order] = same
    both = same.copy()
    both[:-1] |= same[1:]
    twice = np.zeros(len(key), bool)
    twice[order] = both
    return earlier, twice


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts of ``STATS`` and the matrix of ``FEATURES`` for each text; NULL counts as empty."""
    data, offsets = byte_rows(column)
    n = len(offsets) - 1
    words = words_of(data, offsets, SPACED)
    n_words = np.diff(words.first)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    per_word = points[words.end] - points[words.start]
    word_chars = np.bincount(words.doc, per_word, n).astype(np.int64) if len(words.doc) else np.zeros(n, np.int64)
    # lines: runs between \n and document ends, kept if a word starts in them
    is_line = np.ones(256, bool)
    is_line[0x0A] = False
    lines = words_of(data, offsets, is_line)
    with_word = np.searchsorted(words.start, lines.end, "left") > np.searchsorted(words.start, lines.start, "left")
    line_doc, line_hash = lines.doc[with_word], lines.hash[with_word]
    dup = _seen_before(line_doc, line_hash)[0]
    n_dup = np.bincount(line_doc[dup], minlength=n)
    at, hashes = windows_of(words, REPEAT_WINDOW)
    twice = _seen_before(words.doc[at], hashes)[1]
    cover = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    n_repeat = np.bincount(words.doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    n_symbols = _per_doc(offsets, SYMBOLS[data])
    stats = dict(zip(STATS, (n_words, word_chars, n_symbols, n_dup, n_repeat)))

    same_next = np.zeros(len(words.doc), bool)
    if len(words.doc):
        same_next[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    n_lines = np.maximum(1, np.bincount(line_doc, minlength=n))
    letters = np.maximum(1, word_chars)
    counted = np.maximum(1, n_words)
    features = np.stack(
        [
            n_symbols / counted,
            _per_doc(offsets, UPPER[data]) / letters,
            _per_doc(offsets, data == ord("!")) / counted,
            n_dup / n_lines,
            n_repeat / counted,
            np.bincount(words.doc[same_next], minlength=n) / counted,
        ],
        axis=1,
    )
    return stats, features


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    n = stats["n_words"]
    return (n < LEAST_WORDS) | (100 * stats["n_repeat_words"] > REPEAT_PERCENT * n)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def good_units(good: np.ndarray) -> np.ndarray:
    """Per feature: what all but a thousandth of the good rows stay below, and a little."""
    return np.quantile(good, 0.999, axis=0) + 0.02 if len(good) else np.ones(len(FEATURES))


def in_units(rows: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Features in whole units, at most 20: the ordinary scatter of good text is 0."""
    return np.minimum(np.floor(rows / unit), 20.0)


@dataclass
class IsolationForest:
    """Random trees as flat arrays: split feature (-1: leaf), split value, children, leaf depth."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    roots: np.ndarray
    norm: float
    unit: np.ndarray
    threshold: float = float("inf")

    @classmethod
    def grow(
        cls, rows: np.ndarray, unit: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7
    ) -> IsolationForest:
        rng = np.random.default_rng(seed)
        rows = in_units(rows, unit)
        size = min(sample, len(rows))
        most = int(np.ceil(np.log2(max(2, size))))
        nodes: list[list[float]] = []

        def build(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, -1, -1, 0.0])
            spread = part.max(0) - part.min(0) if len(part) else np.zeros(rows.shape[1])
            usable = np.flatnonzero(spread > 0)
            if depth >= most or len(part) <= 1 or not len(usable):
                nodes[at][4] = depth + float(_mean_path(len(part)))
                return at
            f = int(rng.choice(usable))
            v = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            below = part[:, f] < v
            nodes[at][:2] = [f, v]
            nodes[at][2] = build(part[below], depth + 1)
            nodes[at][3] = build(part[~below], depth + 1)
            return at

        roots = [build(rows[rng.choice(len(rows), size, replace=False)], 0) for _ in range(trees if size else 0)]
        table = np.array(nodes, float).reshape(-1, 5)
        ints = table[:, [0, 2, 3]].astype(np.int64)
        return cls(
            ints[:, 0], table[:, 1], ints[:, 1], ints[:, 2], table[:, 4], np.array(roots, np.int64),
            float(_mean_path(size)) or 1.0, unit,
        )

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for rows that few splits isolate."""
        rows = in_units(rows, self.unit)
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots.tolist():
            node = np.full(len(rows), root)
            while True:
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                low = rows[every, np.maximum(f, 0)] < self.value[node]
                node = np.where(inner, np.where(low, self.left[node], self.right[node]), node)
            total += self.depth[node]
        if not len(self.roots):
            return np.zeros(len(rows))
        return 2.0 ** -(total / len(self.roots) / self.norm)

    def calibrate(self, rows: np.ndarray, good: np.ndarray, loss: float = GOOD_LOSS) -> None:
        """The lowest threshold that rejects at most ``loss`` of the good rows, midway to the next score."""
        if not good.any():
            return
        scores = self.score(rows)
        kept = np.sort(scores[good])
        limit = kept[max(0, int(np.ceil(len(kept) * (1 - loss))) - 1)]
        above = scores[scores > limit]
        self.threshold = float((limit + above.min()) / 2) if len(above) else float("inf")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> IsolationForest:
    """Grow and calibrate on at most ``max_labelled`` labelled documents that pass the base rules.

    ``labels`` has doc_id and quality (1 good, 0 bad; the lower of repeated rows
    counts). Good rows set the unit of each statistic and the threshold; trees are
    grown on all of them. Without good rows nothing is rejected.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    n = chosen.count()
    # a bounded table: at most max_labelled short rows
    hint = F.broadcast(chosen) if n <= MAX_LABELLED else chosen
    texts = docs.select("doc_id", "text").join(hint, "doc_id")

    def measure(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                stats, features = statistics(part.column("text"))
                ok = np.flatnonzero(~base_failed(stats))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(features[ok]), pa.list_(pa.float64())), part.column("quality").take(pa.array(ok))],
                    names=["features", "quality"],
                )

    rows = map_arrow(texts, measure, "features array<double>, quality int").toPandas()
    # the order of arrival must not change the model
    table = np.array(sorted((*f, q) for f, q in zip(rows["features"], rows["quality"])), float)
    table = table.reshape(-1, len(FEATURES) + 1)
    features, good = table[:, :-1], table[:, -1] == 1
    forest = IsolationForest.grow(features, good_units(features[good]))
    forest.calibrate(features, good)
    return forest


def judge(docs: DataFrame, forest: IsolationForest, text_col: str = "text", out_col: str = "rules") -> DataFrame:
    """``docs`` with a column ``out_col``: the statistics, base_failed, score and kept.

    NULL and empty texts have no words and fail the base rules; repeated rows get
    the same verdict; an own column of that name is replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(forest)
    names = [c for c in docs.columns if c != out_col]
    kind = ",".join(f"{s}:long" for s in STATS) + ",base_failed:boolean,score:double,kept:boolean"
    schema = StructType([docs.schema[c] for c in names] + StructType.fromDDL(f"`{out_col}` struct<{kind}>").fields)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                stats, features = statistics(part.column(text_col))
                failed = base_failed(stats)
                score = model.value.score(features)
                columns = [pa.array(stats[s], pa.int64()) for s in STATS]
                columns += [pa.array(failed), pa.array(score), pa.array(~failed & (score < model.value.threshold))]
                rules = pa.StructArray.from_arrays(columns, [*STATS, "base_failed", "score", "kept"])
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [rules], names=[*names, out_col])

    return map_arrow(docs, run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, same columns."""
    rules = free_name(docs, "rules")
    return judge(docs, fit(docs, labels), out_col=rules).where(f"{rules}.kept").select(*docs.columns)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = judge(docs, fit(docs, labels))
    return judged.select("doc_id", *[f"rules.{s}" for s in STATS], "rules.base_failed", "rules.kept")


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES: dict[str, str] = {}
