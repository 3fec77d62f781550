"""Byte-level BPE: a minimal acyclic transducer of frequent words, exact merges for the rest.

Frequent words of the corpus are compiled with their token ids into a minimal
acyclic automaton: states with equal right languages are shared, the ids sit on
the arcs as one number per word (the sum of the outputs along its path, which
points into a table of id sequences). The automaton is a set of flat arrays that
every worker memory-maps from one file. Words it does not hold are merged by the
vocabulary's ranks. Both ways give the same ids; the lexicon only saves time.
"""

from __future__ import annotations

import json
import mmap
import os
import re
import tempfile
import uuid
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayline.llm.blocks import map_arrow, slices, stored

#: Fixed: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed: letters and digits of later Unicode versions, which are neither in the encodings to be matched.
LATE = """
    0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
    10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
    16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
    1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
    1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_LATE = "".join("-".join(chr(int(end, 16)) for end in r.split("-")) for r in LATE.split())
#: The same pattern without them, for the few texts that have any.
LATE_PATTERN = "(?V1)" + PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]{_LATE}]").replace(
    r" ?\p{L}", rf" ?[\p{{L}}--[{_LATE}]]"
).replace(r" ?\p{N}", rf" ?[\p{{N}}--[{_LATE}]]")
#: Words compiled into the lexicon at most: the most frequent of all documents.
LEXICON_WORDS = 150_000
#: Distinct pieces between spaces that a task counts before it passes the counts on.
COUNT_PIECES = 150_000
#: Ids of pieces, and of merged words, that a worker keeps for later batches at most.
KEEP_PIECES = 200_000
#: Up to this many bytes a word's merges are found by scanning, beyond by a heap.
LONG_WORD = 64


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.special = special
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.ids = {as_bytes(t): i for t, i in vocab.items() if t not in special}
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in special.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(self.ids[as_bytes(a)], self.ids[as_bytes(b)]): r for r, (a, b) in enumerate(pairs)}
        self.joined = {p: self.ids[self.bytes_of[p[0]] + self.bytes_of[p[1]]] for p in self.ranks}
        self.single = [self.ids[bytes([b])] for b in range(256)]

    def merge(self, word: bytes) -> list[int]:
        """Apply the lowest-ranked merge, leftmost first, until none applies."""
        return self._merge_long(word) if len(word) > LONG_WORD else self._merge_short(word)

    def _merge_short(self, word: bytes) -> list[int]:
        parts = [self.single[b] for b in word]
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [self.joined[parts[i], parts[i + 1]]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
        return parts

    def pair_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted pairs (first id * 2**32 + second id), the rank of each, the joined id by rank, and the rank by two bytes."""
        if not hasattr(self, "_table"):
            key = np.array([a << 32 | b for a, b in self.ranks], np.int64)
            rank = np.array(list(self.ranks.values()), np.int32)
            joined = np.zeros(len(rank), np.int32)
            joined[rank] = [self.joined[p] for p in self.ranks]
            order = np.argsort(key)
            of_bytes = [[self.ranks.get((a, b), len(rank)) for b in self.single] for a in self.single]
            self._table = key[order], rank[order], joined, np.array(of_bytes, np.int32)
        return self._table

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words as little-endian unsigned 32-bit integers; the short ones are merged side by side.

        A round joins, in every word, the leftmost pair of the lowest rank; words
        without a pair that joins are done.
        """
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[i] = np.array(self._merge_long(word), "<u4").tobytes()
            else:
                by_length.setdefault((len(word) + 3) // 4, []).append(i)
        keys, ranks, joined, of_bytes = self.pair_table()
        none = len(ranks)
        single = np.array(self.single, np.int32)

        def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            pair = left.astype(np.int64) << 32 | right
            at = np.minimum(np.searchsorted(keys, pair), none - 1)
            return np.where(keys[at] == pair, ranks[at], none)

        def close(table: np.ndarray, gap: np.ndarray) -> np.ndarray:
            """A table without one place of each row."""
            kept = np.ones(table.shape, bool)
            kept[np.arange(len(gap)), gap] = False
            return table[kept].reshape(len(gap), -1) if len(gap) else table[:, 1:]

        for group in by_length.values():
            sizes = np.array([len(words[i]) for i in group])
            width = int(sizes.max())
            raw = np.zeros((len(group), width), np.uint8)
            inside = np.arange(width) < sizes[:, None]
            raw[inside] = np.frombuffer(b"".join([words[i] for i in group]), np.uint8)
            # all rows lose one part a round; -1 fills the ends
            places, parts = np.array(group), np.where(inside, single[raw], -1)
            order = np.where(inside[:, 1:], of_bytes[raw[:, :-1], raw[:, 1:]], none)
            while len(places):
                if order.shape[1]:
                    best = order.argmin(1)
                    rank = order[np.arange(len(best)), best]
                    joins = rank < none
                else:
                    joins = np.zeros(len(places), bool)
                if not joins.all():
                    ready = parts[~joins]
                    inside = ready >= 0
                    flat = ready[inside].astype("<u4").tobytes()
                    ends = (4 * np.cumsum(inside.sum(1))).tolist()
                    for i, a, b in zip(places[~joins].tolist(), [0, *ends], ends):
                        out[i] = flat[a:b]
                    places, parts, order = places[joins], parts[joins], order[joins]
                    if not len(places):
                        break
                    best, rank = best[joins], rank[joins]
                row = np.arange(len(places))
                parts[row, best] = joined[rank]
                parts, order = close(parts, best + 1), close(order, best)
                for side in (best, best - 1):
                    there = (side >= 0) & (side < order.shape[1])
                    rows, at = row[there], side[there]
                    order[rows, at] = rank_of(parts[rows, at], parts[rows, at + 1])
        return out

    def _merge_long(self, word: bytes) -> list[int]:
        """The same over a linked list and a heap: n log n for runs without a break."""
        import heapq

        parts: list[int] = [self.single[b] for b in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [
            (r, i, parts[i], parts[i + 1])
            for i in range(n - 1)
            if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i] = self.joined[a, b]
            alive[j], after[i] = False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    rank = self.ranks.get((parts[left], parts[right]))
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, parts[left], parts[right]))
        return [p for p, here in zip(parts, alive) if here]


def compile_lexicon(entries: dict[bytes, bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic transducer of words with their ids (as ``Codec.encode`` gives them), as flat arrays.

    Built from the right: states are merged when they have equal finality and arcs
    (label, target, number of words below). A word's place in the sorted list is
    the sum of the words skipped on its path, so the outputs never block sharing.
    """
    words = sorted(entries)
    registry: dict[tuple, int] = {}
    states: list[tuple[bool, tuple, int]] = []  # final, arcs (label, target), words below

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in registry:
            registry[key] = len(states)
            states.append((final, key[1], final + sum(states[t][2] for _, t in arcs)))
        return registry[key]

    path: list[tuple[list, bool]] = [([], False)]  # open states along the last word
    last = b""
    for word in words:
        common = len(os.path.commonprefix((last, word)))
        while len(path) - 1 > common:
            arcs, final = path.pop()
            path[-1][0].append((last[len(path) - 1], freeze(final, arcs)))
        for _ in word[common:]:
            path.append(([], False))
        path[-1] = (path[-1][0], True)
        last = word
    while len(path) > 1:
        arcs, final = path.pop()
        path[-1][0].append((last[len(path) - 1], freeze(final, arcs)))
    root = freeze(path[0][1], path[0][0])

    first, labels, targets, skipped = [0], [], [], []
    for final, arcs, _ in states:
        count = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skipped.append(count)
            count += states[target][2]
        first.append(len(labels))
    ids = [entries[w] for w in words]
    return {
        "first": np.array(first, np.int32),
        "key": np.array([s for s in range(len(states)) for _ in range(first[s + 1] - first[s])], np.int64) * 256
        + np.array(labels, np.int64),
        "target": np.array(targets, np.int32),
        "skipped": np.array(skipped, np.int32),
        "final": np.array([s[0] for s in states], np.uint8),
        "root": np.array([root], np.int32),
        "id_first": np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids]))).astype(np.int64),
        "ids": np.frombuffer(b"".join(ids), "<u4"),
    }


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    head = json.dumps({k: [str(a.dtype), len(a)] for k, a in arrays.items()}).encode()
    body = b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays.values())
    return len(head).to_bytes(8, "little") + head + bytes(-len(head) % 8) + body


class Lexicon:
    """A packed transducer, memory-mapped; finds many words at once."""

    def __init__(self, buffer):
        size = int.from_bytes(buffer[:8], "little")
        at = 8 + size + (-size % 8)
        self.arrays: dict[str, np.ndarray] = {}
        for name, (kind, n) in json.loads(bytes(buffer[8 : 8 + size])).items():
            array = np.frombuffer(buffer, np.dtype(kind), n, at)
            self.arrays[name] = array
            at += array.nbytes + (-array.nbytes % 8)

    @classmethod
    def mapped(cls, packed: bytes) -> Lexicon:
        """Through a file that has no name any more once it is mapped: nothing stays when the worker ends."""
        with tempfile.TemporaryFile() as file:
            file.write(packed)
            file.flush()
            return cls(memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the id table, -1 for words not held."""
        a = self.arrays
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(a["key"]):
            return out
        lengths = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        state = np.full(n, int(a["root"][0]), np.int64)
        place = np.zeros(n, np.int64)
        active = np.arange(n)
        step = 0
        while len(active):
            done = lengths[active] == step
            ends = active[done]
            hit = ends[a["final"][state[ends]] == 1]
            out[hit] = place[hit]
            active = active[~done]
            key = state[active] * 256 + data[begin[active] + step]
            arc = np.minimum(np.searchsorted(a["key"], key), len(a["key"]) - 1)
            found = a["key"][arc] == key
            active, arc = active[found], arc[found]
            place[active] += a["skipped"][arc]
            state[active] = a["target"][arc]
            step += 1
        return out

    def ids_of(self, places: np.ndarray) -> list[bytes | None]:
        """Ids at many places, None for words not held."""
        first, data = self.arrays["id_first"], memoryview(self.arrays["ids"]).cast("B")
        at = np.maximum(places, 0)
        if not len(first) - 1:
            return [None] * len(places)
        spans = zip(places.tolist(), (4 * first[at]).tolist(), (4 * first[at + 1]).tolist())
        return [bytes(data[a:b]) if p >= 0 else None for p, a, b in spans]

    def ids(self, place: int) -> bytes:
        first = self.arrays["id_first"]
        return self.arrays["ids"][first[place] : first[place + 1]].tobytes()


class Splitter:
    """Cuts texts, and pieces of them, into words of the pattern."""

    def __init__(self):
        self.split_early, self.split_late = regex.compile(PATTERN).findall, regex.compile(LATE_PATTERN).findall
        self.late = re.compile(f"[{_LATE}]").search

    def split(self, string: str) -> list[str]:
        """Words of the pattern."""
        late = not string.isascii() and self.late(string)
        return self.split_late(string) if late else self.split_early(string)

    def cut(self, pieces: list[str]) -> list[list[str]]:
        """Words of the pattern of each piece; a piece is a space and characters without one.

        A space before a character begins a new word, so pieces are cut together and told apart by it.
        """
        joined = "".join(pieces)
        if not joined.isascii() and self.late(joined):
            return [self.split(p) for p in pieces]
        rows: list[list[str]] = []
        if all([p[1:2].strip() for p in pieces]):
            for word in self.split_early(joined):
                if word[0] == " ":
                    rows.append([word])
                else:
                    rows[-1].append(word)
            return rows
        # white space after the space
        odd = {p: self.split_early(p) for p in pieces if not p[1:2].strip()}
        rest = iter(self.cut([p for p in pieces if p not in odd]))
        return [odd[p] if p in odd else next(rest) for p in pieces]


class Codec(Splitter):
    """Encodes and decodes texts with a vocabulary and a lexicon of frequent words.

    A single space before a character always begins a new word of the pattern, so a
    text without double spaces is cut at its spaces first and the ids of each piece
    (with its space) are kept; other texts are cut by the pattern as a whole.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        super().__init__()
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.pieces: dict[str, bytes] = {}
        self.merged: dict[bytes, bytes] = {}
        table = vocabulary.bytes_of
        self.table = [table.get(i, b"") for i in range(max(table) + 1)]

    def forget(self) -> None:
        self.pieces.clear()
        self.merged.clear()

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words of the pattern: from the lexicon, else merged."""
        raw = list(map(str.encode, words))
        ids = self.lexicon.ids_of(self.lexicon.find(raw))
        rare = [i for i, known in enumerate(ids) if known is None]
        if len(self.merged) > KEEP_PIECES:
            self.merged.clear()
        merged = self.merged
        new = [raw[i] for i in rare if raw[i] not in merged]
        merged.update(zip(new, self.vocabulary.merge_many(new)))
        for i in rare:
            ids[i] = merged[raw[i]]
        return ids

    def _ids(self, strings: list[str]) -> list[bytes]:
        """Ids of whole strings."""
        rows = [self.split(s) for s in strings]
        words = list({w for row in rows for w in row})
        known = dict(zip(words, self._word_ids(words)))
        return [b"".join([known[w] for w in row]) for row in rows]

    def _learn(self, new: set[str]) -> None:
        """Keep the ids of pieces, given without their space."""
        # letters after a space are one word of the pattern
        plain = [w for w in new if w.isalpha()]
        mixed = list(new.difference(plain))
        spaced = [f" {w}" for w in plain]
        rows = self.cut([f" {w}" for w in mixed])
        words = spaced + list({w for row in rows for w in row}.difference(spaced))
        ids = self._word_ids(words)
        self.pieces.update(zip(plain, ids))
        known = dict(zip(words, ids))
        self.pieces.update(zip(mixed, [b"".join([known[w] for w in row]) for row in rows]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; special tokens' strings become their ids."""
        special = self.vocabulary.special
        plan: list[list[tuple[str, list[str]] | bytes]] = []
        whole: list[str] = []
        for text in texts:
            parts = [text]
            if special and any(s in text for s in special):
                parts = self.vocabulary.split_special.split(text)
            steps: list[tuple[str, list[str]] | bytes] = []
            for part in parts:
                if part in special:
                    steps.append(special[part].to_bytes(4, "little"))
                elif part:
                    head, *rest = [part] if "  " in part else part.split(" ")
                    steps.append((head, rest))
                    whole.append(head)
            plan.append(steps)
        if len(self.pieces) > KEEP_PIECES:
            self.pieces.clear()
        known = self.pieces
        self._learn(set().union(*[step[1] for steps in plan for step in steps if type(step) is tuple]).difference(known))
        heads, ids_of = dict(zip(whole, self._ids(whole))), known.__getitem__
        return [
            b"".join([step if type(step) is bytes else heads[step[0]] + b"".join(map(ids_of, step[1])) for step in steps])
            for steps in plan
        ]

    def decode(self, ids: bytes) -> str:
        table = self.table
        return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def train_lexicon(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", most: int = LEXICON_WORDS) -> bytes:
    """Count the words of all documents (those between single spaces) and compile the most frequent ones.

    At most ``most``: all words of a count are taken or none. Counts are combined in
    the tasks, then by word; only the chosen words reach the driver.
    """

    def count(batches):
        splitter = Splitter()
        pieces: Counter = Counter()

        def flush():
            # letters are one word of the pattern
            totals = Counter({f" {piece}": n for piece, n in pieces.items() if piece.isalpha()})
            mixed = {f" {piece}": n for piece, n in pieces.items() if not piece.isalpha()}
            for row, n in zip(splitter.cut(list(mixed)), mixed.values()):
                for word in row:
                    totals[word] += n
            pieces.clear()
            words, counts = zip(*totals.items()) if totals else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column(text_col):
                if text.is_valid:
                    pieces.update(text.as_py().split(" "))
                if len(pieces) > COUNT_PIECES:
                    yield flush()
        yield flush()

    counts = map_arrow(docs.select(text_col), count, "word string, n long")
    counts = stored(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # the least count of which at most ``most`` words have as many, from a few hundred steps of a thirty-second
    step = F.floor(F.log2("n") * 32).cast("int")
    held, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            break
        least = row["step"]
    if least is None:
        return pack(compile_lexicon({}))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def merge(batches):
        for batch in batches:
            ids = shared.value.merge_many([w.encode() for w in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["word", "ids"])

    top = map_arrow(counts.where(step >= least).select("word"), merge, "word string, ids binary").toArrow()
    words = top.column("word").cast(pa.binary())
    return pack(compile_lexicon({w.as_py(): i.as_py() for w, i in zip(words, top.column("ids"))}))


_CODECS: dict[str, Codec] = {}


def _codec(key: str, vocabulary, lexicon) -> Codec:
    """One codec for each worker process and call of ``encode``, told by its ``key``."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary.value, Lexicon.mapped(lexicon.value))
    return _CODECS[key]


def encode(
    docs: DataFrame, path: str, text_col: str = "text", lexicon: bytes | None = None, decoded: str | None = None
) -> DataFrame:
    """``docs`` with ``token_ids``: the ids of the whole text, little-endian unsigned 32-bit integers.

    With ``decoded`` the ids are also decoded again, into a column of that name.

    ``path`` is a byte-level BPE file in the tokenizers library's format. NULL and
    empty texts have no ids; strings of special tokens in a text become their ids;
    repeated rows are encoded alike; an own column named ``token_ids`` is replaced.
    """
    context = docs.sparkSession.sparkContext
    vocabulary = Vocabulary(path)
    packed = train_lexicon(docs, vocabulary, text_col) if lexicon is None else lexicon
    shared, mapped, key = context.broadcast(vocabulary), context.broadcast(packed), uuid.uuid4().hex
    names = [c for c in docs.columns if c not in ("token_ids", decoded)]
    made = "token_ids binary" + (f", {decoded} string" if decoded else "")
    schema = StructType([docs.schema[c] for c in names] + StructType.fromDDL(made).fields)

    def run(batches):
        codec = _codec(key, shared, mapped)
        for batch in batches:
            for part in slices(batch, text_col):
                ids = codec.encode([t or "" for t in part.column(text_col).to_pylist()])
                columns = [part.column(c) for c in names] + [pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array(map(codec.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        # workers live on for tasks of other kinds
        codec.forget()

    return map_arrow(docs, run, schema)


def decode(docs: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of their ids; NULL ids give an empty text, bytes that are no UTF-8 U+FFFD."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    names = [c for c in docs.columns if c != out_col]
    schema = StructType([docs.schema[c] for c in names] + StructType.fromDDL(f"{out_col} string").fields)

    def run(batches):
        decoder = Codec(shared.value, None)
        for batch in batches:
            for part in slices(batch, ids_col, limit=4 << 20):
                texts = [decoder.decode(i or b"") for i in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(texts, pa.string())], names=[*names, out_col]
                )

    return map_arrow(docs, run, schema)


def digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of every document, and the ids if asked."""
    coded = encode(docs.select("doc_id", "text"), path, decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *(["token_ids"] if with_ids else []),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the public byte-level vocabulary."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op10_bpe": op10_bpe}
ORACLES: dict[str, str] = {}
