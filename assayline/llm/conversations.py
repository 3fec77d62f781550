"""Repair of the structure of conversations: the cheapest edits, found by a dynamic program with persistent audits.

A repaired conversation is empty, or an optional system message and then pairs of user
and assistant messages. Each row is kept, given another role or deleted; empty messages
may be inserted anywhere. The program walks the rows once and holds, for each of four
states (nothing yet, after system, after user, after assistant), the cheapest cost and
its audit: the letters of all edits so far, as a linked node that shares its beginning
with the others. Nodes know their ancestors at powers of two and a rolling hash, so two
audits of equal cost are compared by a search for their longest common prefix; equal
hashes are verified on the letters.

Inserts belong to the edit of the row behind them. So two audits of one row hold equally
many letters other than I and end with one: none is a proper prefix of another, and what
is smaller now stays smaller whatever follows.

That makes the program a product of small matrices: a piece of a conversation is told
by, for each state before it, the cheapest audit to each state behind it. Rows are
range-partitioned by conversation and turn, so a conversation may hold any share of them:
a partition cuts it in pieces of bounded size, the pieces' matrices (not their texts) are
multiplied in order in one pass, and each piece then applies its part of the audit where
its texts are. Only the digest of the repaired text, which is defined over the whole of
it, streams through one task, in order and without holding it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from assayline.llm.blocks import map_arrow, shares, stored

RE_ROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Bounds of a piece; one longer text is a piece of its own.
PIECE_ROWS = 4_096
PIECE_BYTES = 1 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a message of the role that may follow, for each initial that may be kept.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: State after the one role that may be inserted or given.
NEXT = (USER, USER, ASSISTANT, USER)
#: Inserts worth making in front of an edit: more would come back to a state.
INSERTS = (2, 2, 1, 1)
#: Inserts that end a conversation.
TAIL = ("", "II", "I", "")
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = frozenset(["su", "ua", "au"])
SPACE = " \t\n\x0b\x0c\r"

TOTALS = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"
MESSAGES = "array<struct<role:string,text:string>>"
WAYS = "array<struct<before:int,after:int,cost:long,audit:string>>"
FACTS = (
    "struct<blank:long,duplicate:long,truncated:long,illegal:long,first:string,last:string,"
    "low:long,high:long,turns:long>"
)


class Audits:
    """Sequences of letters (or of whole texts) as linked nodes; node 0 is the empty one."""

    def __init__(self, modulus: int = (1 << 61) - 1):
        self.modulus = modulus
        self.letter: list[str] = [""]
        self.depth = [0]
        self.hash = [0]
        self.up: list[list[int]] = [[]]

    def add(self, node: int, letter: str) -> int:
        """A new node behind ``node``."""
        new = len(self.letter)
        value = ord(letter) if len(letter) == 1 else int.from_bytes(hashlib.blake2b(letter.encode(), digest_size=7).digest(), "big")
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * 1_000_003 + value + 1) % self.modulus)
        ups, k = [node], 0
        while len(self.up[ups[k]]) > k:
            ups.append(self.up[ups[k]][k])
            k += 1
        self.up.append(ups)
        return new

    def extend(self, node: int, letters: str) -> int:
        for letter in letters:
            node = self.add(node, letter)
        return node

    def ancestor(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def parts(self, node: int) -> list[str]:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return out[::-1]

    def text(self, node: int) -> str:
        return "".join(self.parts(node))

    def _same(self, a: int, b: int) -> bool:
        """Letter by letter, up to a node that both share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the sequence of ``a`` comes before that of ``b``."""
        if a == b:
            return False
        shorter = self.depth[a] < self.depth[b]
        x = self.ancestor(a, max(0, self.depth[a] - self.depth[b]))
        y = self.ancestor(b, max(0, self.depth[b] - self.depth[a]))
        if self.hash[x] == self.hash[y]:
            return shorter if self._same(x, y) else self.parts(a) < self.parts(b)
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        # the first difference, if the equal hashes in front of it are no collision
        if not self._same(self.up[x][0], self.up[y][0]):
            return self.parts(a) < self.parts(b)
        return self.letter[x] < self.letter[y]


Best = dict[int, tuple[int, int]]  # state -> cost, node


def _offer(best: Best, audits: Audits, state: int, cost: int, node: int, letters: str) -> None:
    have = best.get(state)
    if have is not None and have[0] < cost:
        return
    new = audits.extend(node, letters)
    if have is None or cost < have[0] or audits.less(new, have[1]):
        best[state] = (cost, new)


def step(best: Best, audits: Audits, initial: str, forced: bool, truncated: bool) -> Best:
    """The states after one more row; ``forced`` rows can only be deleted."""
    out: Best = {}
    for state, (cost, node) in best.items():
        # an insert in front of a deletion is never best: behind it, it costs the same and reads smaller
        _offer(out, audits, state, cost + DELETE, node, "D")
        if forced:
            continue
        stays = cost + (TRUNCATED if truncated else 0)
        at = state
        for n in range(INSERTS[state] + 1):
            if n:
                at = NEXT[at]
            if initial in KEPT[at]:
                _offer(out, audits, KEPT[at][initial], stays + n * INSERT, node, "I" * n + "K")
            _offer(out, audits, NEXT[at], stays + n * INSERT + RE_ROLE, node, "I" * n + "R")
    return out


def finish(best: Best, audits: Audits) -> tuple[int, int]:
    """Cost and node of the cheapest whole audit, inserts at the end included."""
    done: Best = {}
    for state, (cost, node) in best.items():
        tail = TAIL[state]
        # the tail is one last part, so that all ends are of one depth
        _offer_part(done, audits, cost + INSERT * len(tail), node, tail)
    return done[START]


def _offer_part(best: Best, audits: Audits, cost: int, node: int, part: str, state: int = START) -> None:
    have = best.get(state)
    if have is not None and have[0] < cost:
        return
    new = audits.add(node, part)
    if have is None or cost < have[0] or audits.less(new, have[1]):
        best[state] = (cost, new)


def apply_audit(audit: str, rows: list[tuple], state: int) -> tuple[list[dict], int]:
    """The messages that an audit leaves of (role, text) rows, and the state behind them."""
    out, at = [], iter(rows)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            out.append({"role": ROLES[state], "text": ""})
            continue
        role, text = next(at)
        if letter == "D":
            continue
        if letter == "R":
            state = NEXT[state]
            role = ROLES[state]
        else:
            state = KEPT[state][role[:1]]
        out.append({"role": role, "text": text})
    return out, state


class Piece:
    """Consecutive rows of one conversation."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.marks: list[tuple] = []
        self.bytes = 0
        self.facts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.facts |= dict.fromkeys(("first", "last", "low", "high"))

    def add(self, turn, role: str, text: str, first: bool) -> None:
        """The next row; ``first``: its role and text were not seen before."""
        facts = self.facts
        words = text.strip(SPACE)
        blank, repeated = not words, bool(words) and not first
        cut = bool(words) and words[-1] not in ".!?"
        facts["blank"] += blank
        facts["duplicate"] += repeated
        facts["truncated"] += cut and not repeated
        initial = role[:1]
        if self.rows:
            facts["illegal"] += facts["last"] + initial not in LEGAL
        else:
            facts["first"] = initial
        facts["last"] = initial
        if turn is not None and turn != facts["high"]:
            facts["turns"] += 1
            facts["low"] = turn if facts["low"] is None else facts["low"]
            facts["high"] = turn
        self.rows.append((role, text))
        self.marks.append((initial, blank or repeated, cut))
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.rows) >= PIECE_ROWS or self.bytes >= PIECE_BYTES

    def walk(self, audits: Audits, state: int) -> Best:
        best: Best = {state: (0, 0)}
        for initial, forced, cut in self.marks:
            best = step(best, audits, initial, forced, cut)
        return best


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _whole(conv, place: int, piece: Piece) -> dict:
    """A conversation that lies in one piece."""
    audits = Audits()
    cost, node = finish(piece.walk(audits, START), audits)
    audit, facts = audits.text(node), piece.facts
    totals = {k: facts[k] for k in ("blank", "duplicate", "truncated", "illegal")}
    totals |= {"gaps": _gaps(facts["low"], facts["high"], facts["turns"]), "cost": cost, "audit": audit}
    messages, _ = apply_audit(audit, piece.rows, START)
    return {"conv": conv, "place": place, "messages": messages, "totals": totals, "facts": None, "ways": None}


def _part(conv, place: int, piece: Piece) -> dict:
    """A piece of a conversation that may go on elsewhere: its matrix and its rows as they are."""
    ways = []
    for before in range(4):
        audits = Audits()
        for after, (cost, node) in sorted(piece.walk(audits, before).items()):
            ways.append({"before": before, "after": after, "cost": cost, "audit": audits.text(node)})
    messages = [{"role": r, "text": t} for r, t in piece.rows]
    return {"conv": conv, "place": place, "messages": messages, "totals": None, "facts": piece.facts, "ways": ways}


def _cut(part: int, rows: Iterator[tuple]) -> Iterator[dict]:
    """Pieces of one sorted partition: rows of (conv, turn, role, text, kind), a mark (kind 0) before each first row.

    Only conversations that begin and end within the partition, in one piece, are
    whole; its first and its last one may go on in the neighbours.
    """
    place = part << 32
    conv, piece, outside, marked, any_row = None, Piece(), True, False, False
    for own, turn, role, text, kind in rows:
        if any_row and own != conv:
            yield (_part if outside else _whole)(conv, place, piece)
            place += 1
            piece, outside = Piece(), False
        elif piece.full():
            # the conversation goes on, so none of its pieces is whole
            outside = True
            yield _part(conv, place, piece)
            place += 1
            piece = Piece()
        conv, any_row = own, True
        if kind == 0:
            marked = True
        elif kind == 1:
            piece.add(turn, role, text, marked)
            marked = False
    if any_row:
        yield _part(conv, place, piece)


def _chosen(conv, pieces: list[dict]) -> Iterator[dict]:
    """Each piece's part of the cheapest audit of a conversation, and its totals on the last piece."""
    audits = Audits()
    best: Best = {START: (0, 0)}
    before: list[dict[int, int]] = []  # for each piece: node -> state in front of it
    totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    last = low = high = None
    turns = 0
    for p in pieces:
        out: Best = {}
        came: dict[int, int] = {}
        for way in p["ways"]:
            if way["before"] in best:
                cost, node = best[way["before"]]
                _offer_part(out, audits, cost + way["cost"], node, way["audit"], way["after"])
                came.setdefault(out[way["after"]][1], way["before"])
        best = out
        before.append(came)
        facts = p["facts"]
        for k in totals:
            totals[k] += facts[k]
        if facts["first"] is not None:
            totals["illegal"] += last is not None and last + facts["first"] not in LEGAL
            last = facts["last"]
        if facts["low"] is not None:
            turns += facts["turns"] - (high == facts["low"])
            low = facts["low"] if low is None else low
            high = facts["high"]
    cost, node = finish(best, audits)
    parts, states = [], []
    tail, node = audits.letter[node], audits.up[node][0]
    for came in reversed(before):
        parts.append(audits.letter[node])
        states.append(came[node])
        node = audits.up[node][0]
    parts, states = parts[::-1], states[::-1]
    parts[-1] += tail
    totals |= {"gaps": _gaps(low, high, turns), "cost": cost, "audit": "".join(parts)}
    for i, p in enumerate(pieces):
        end = i == len(pieces) - 1
        yield {"place": p["place"], "state": states[i], "audit": parts[i], "totals": totals if end else None}


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int, weight) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += weight(row)
        if size >= most:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, size = [], 0
    yield pa.RecordBatch.from_pylist(out, schema)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _text_size(row: dict) -> int:
    return 100 + sum(len(m["text"]) + 20 for m in row["messages"])


def repaired(rows: DataFrame, gone_col: str | None = None) -> DataFrame:
    """Pieces of repaired conversations: conv_id, place, messages (role, text), totals.

    ``rows`` has conv_id, turn (long), role and text; rows with a true ``gone_col``
    only say that their conversation exists. Rows are taken by turn, NULL first, then
    by role and text; a NULL role or text counts as one space, a NULL conv_id is a
    conversation of its own. ``totals`` (gaps, blank, duplicate, truncated, illegal,
    cost, audit) stands on a conversation's last piece only; pieces are in order of
    ``place``, and most conversations are one. Other columns are ignored; an empty
    table gives no rows.
    """
    gone = F.col(gone_col) if gone_col else F.lit(False)
    space = F.lit(" ")
    lines = rows.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.ifnull("role", space).alias("role"),
        F.ifnull("text", space).alias("text"),
        gone.alias("gone"),
    )
    # a number of its own tells equal rows apart, so that any number of them can be spread
    lines = lines.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("copy", F.monotonically_increasing_id())
    lines = stored(lines, "turns")
    order = ["conv", "turn", "role", "digest", "copy"]
    # the first row of each role and text, found map-side first, is marked by a row in front of it
    firsts = lines.where("NOT gone").groupBy("conv", "role", "digest").agg(F.min(F.struct("turn", "copy")).alias("at"))
    marks = firsts.select("conv", "at.turn", "role", "digest", "at.copy", F.lit("").alias("text"), F.lit(0).alias("kind"))
    kind = F.when(F.col("gone"), 2).otherwise(1)
    both = lines.select("conv", "turn", "role", "digest", "copy", "text", kind.alias("kind")).unionByName(marks)
    ordered = both.repartitionByRange(shares(lines), *order).sortWithinPartitions(*order, "kind")
    ordered = ordered.select("conv", "turn", "role", "text", "kind")

    schema = StructType(
        [ordered.schema["conv"], *StructType.fromDDL(f"place long, messages {MESSAGES}, totals {TOTALS}, facts {FACTS}, ways {WAYS}").fields]
    )
    made = to_arrow_schema(schema)

    def cut(batches):
        from pyspark import TaskContext

        yield from _batches(_cut(TaskContext.get().partitionId(), _rows(batches)), made, 4 << 20, _text_size)

    pieces = stored(map_arrow(ordered, cut, schema), "pieces")

    # conversations of several pieces: matrices meet in order, texts stay
    parts = pieces.where("totals IS NULL")
    choice = StructType.fromDDL(f"place long, state int, audit string, totals {TOTALS}")
    chosen_schema = to_arrow_schema(choice)

    def choose(batches):
        yield from _batches(_groups(_rows(batches), _chosen_rows), chosen_schema, 4 << 20, lambda r: 200 + len(r["audit"]))

    matrices = parts.select("conv", "place", "facts", "ways").repartition("conv")
    choices = map_arrow(matrices.sortWithinPartitions("conv", "place"), choose, choice)

    done = StructType([schema["conv"], *StructType.fromDDL(f"place long, messages {MESSAGES}, totals {TOTALS}").fields])
    done_schema = to_arrow_schema(done)

    def apply(batches):
        def each():
            for conv, place, messages, state, audit, totals in _rows(batches):
                left, _ = apply_audit(audit, [(m["role"], m["text"]) for m in messages], state)
                yield {"conv": conv, "place": place, "messages": left, "totals": totals}

        yield from _batches(each(), done_schema, 4 << 20, _text_size)

    joined = parts.select("conv", "place", "messages").join(choices, "place")
    joined = joined.select("conv", "place", "messages", "state", "audit", "totals")
    whole = pieces.where("totals IS NOT NULL").select("conv", "place", "messages", "totals")
    several = map_arrow(joined, apply, done)
    return (
        whole.withColumn("whole", F.lit(True))
        .unionByName(several.withColumn("whole", F.lit(False)))
        .withColumnRenamed("conv", "conv_id")
    )


def _groups(rows: Iterator[tuple], each) -> Iterator[dict]:
    """Runs of rows with one first column, one run in memory at a time."""
    held: list[tuple] = []
    for row in rows:
        if held and held[0][0] != row[0]:
            yield from each(held)
            held = []
        held.append(row)
    if held:
        yield from each(held)


def _chosen_rows(held: list[tuple]) -> Iterator[dict]:
    return _chosen(held[0][0], [{"place": place, "facts": facts, "ways": ways} for _, place, facts, ways in held])


def _lines(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["text"]))


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired``: conv_id, totals, sha256 of its ``role:text`` lines.

    A conversation in several pieces streams through one task in order, one piece in
    memory at a time: the digest is defined over the whole text.
    """
    whole = pieces.where("whole").select("conv_id", "totals", F.sha2(F.array_join(_lines(F.col("messages")), "\n"), 256).alias("sha256"))
    parts = pieces.where("NOT whole").select("conv_id", "place", _lines(F.col("messages")).alias("lines"), "totals")
    schema = StructType([parts.schema["conv_id"], *StructType.fromDDL(f"totals {TOTALS}, sha256 string").fields])
    made = to_arrow_schema(schema)

    def hashed(batches):
        def each():
            state, empty = hashlib.sha256(), True
            for conv, _, lines, totals in _rows(batches):
                for line in lines:
                    state.update((line if empty else "\n" + line).encode())
                    empty = False
                if totals is not None:
                    yield {"conv_id": conv, "totals": totals, "sha256": state.hexdigest()}
                    state, empty = hashlib.sha256(), True

        yield from _batches(each(), made, 4 << 20, lambda r: 200 + len(r["totals"]["audit"]))

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return whole.unionByName(map_arrow(ordered, hashed, schema))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone: rows broken on purpose, by a checksum of conversation and turn.

    Of twenty rows one goes (it stays as a ``gone`` row without text), one loses its
    text, one its full stops, one is there twice, one is given to the user. NULLs
    count as one space.
    """
    space = F.lit(" ")
    key = F.concat(F.ifnull(F.col("conv_id").cast("string"), space), F.lit(":"), F.ifnull(F.col("turn").cast("string"), space))
    fate = F.crc32(key.cast("binary")) % 20
    text = F.ifnull("text", space)
    text = F.when(fate <= 1, F.lit("")).when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(F.ifnull("role", space)).alias("role"),
        text.alias("text"),
        (fate == 0).alias("gone"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired, one row each."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    done = digests(repaired(damaged(rows), "gone"))
    return done.select(
        "conv_id",
        *[f"totals.{c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")],
        F.col("sha256").alias("repaired_sha256"),
    )


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES: dict[str, str] = {}
