"""Conversation repair: the program against plain searches, pieces against whole conversations, the query, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from assayline.llm import conversations as c

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_faults(rows):
    """(forced, truncated) of each (role, text) row, and the three counts."""
    seen, marks, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        marks.append((fault in (0, 1), fault == 2))
        seen.add((role, text))
    return marks, counts


def plain_repair(rows):
    """Cheapest cost, least audit and its messages: a search from the end over whole strings."""
    marks, _ = plain_faults(rows)
    best = {}

    def rest(i, state, inserted):
        if (i, state, inserted) in best:
            return best[i, state, inserted]
        out = []
        if i == len(rows) and state in ("", "a"):
            out.append((0, "", ()))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        roles = {"u": "user", "a": "assistant"}
        if inserted < 3:
            for r in follow.replace("s", ""):
                cost, audit, kept = rest(i, r, inserted + 1)
                out.append((cost + 5, "I" + audit, ((roles[r], ""), *kept)))
        if i < len(rows):
            forced, cut = marks[i]
            cost, audit, kept = rest(i + 1, state, 0)
            out.append((cost + 2, "D" + audit, kept))
            if not forced:
                role, text = rows[i]
                for r in follow:
                    if role[:1] == r:
                        cost, audit, kept = rest(i + 1, r, 0)
                        out.append((cost + 5 * cut, "K" + audit, ((role, text), *kept)))
                    if r != "s":
                        cost, audit, kept = rest(i + 1, r, 0)
                        out.append((cost + 1 + 5 * cut, "R" + audit, ((roles[r], text), *kept)))
        best[i, state, inserted] = min(out, default=(10**9, "~", ()))
        return best[i, state, inserted]

    for i in range(len(rows), 0, -1):  # from the end, so that nothing recurses far
        for state, inserted in itertools.product(("", "s", "u", "a"), range(4)):
            rest(i, state, inserted)
    return rest(0, "", 0)


def plain_row(conv, rows):
    """The contract's row of one conversation from its damaged rows (turn, role, text) in order."""
    lines = [(r, t) for _, r, t in rows]
    turns = {t for t, _, _ in rows if t is not None}
    _, counts = plain_faults(lines)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(lines))
    cost, audit, kept = plain_repair(lines)
    text = "\n".join(f"{r}:{t}" for r, t in kept)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        own.extend([(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {k: sorted(v, key=order) for k, v in out.items()}


def random_rows(rng, n):
    texts = ["Yes.", "No", "", " \t", "What?", "Go on!", "end.  ", "x"]
    roles = ["user", "assistant", "system", "tool", " ", "", "u", "agent"]
    weights = [8, 8, 2, 1, 1, 1, 1, 1]
    return [
        (rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.randrange(99)}" + rng.choice(".!? "))
        for _ in range(n)
    ]


def repaired_here(rows):
    """One conversation in one piece, without Spark."""
    piece, seen = c.Piece(), set()
    for turn, (role, text) in enumerate(rows):
        piece.add(turn, role, text, (role, text) not in seen)
        seen.add((role, text))
    return c._whole(1, 0, piece)


def test_program():
    rng = random.Random(1)
    for _ in range(1500):
        rows = random_rows(rng, rng.randrange(9))
        cost, audit, kept = plain_repair(rows)
        got = repaired_here(rows)
        assert (got["totals"]["cost"], got["totals"]["audit"]) == (cost, audit)
        assert tuple((m["role"], m["text"]) for m in got["messages"]) == kept
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in kept))


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3, 1])
def test_audits_compare(modulus):
    """Also where hashes collide all the time."""
    rng = random.Random(2)
    audits = c.Audits(modulus)
    nodes = [0]
    for _ in range(600):
        nodes.append(audits.extend(rng.choice(nodes[-40:]), "".join(rng.choices("DIKR", [9, 1, 1, 1], k=rng.randrange(1, 5)))))
    for _ in range(4000):
        a, b = rng.choices(nodes, k=2)
        assert audits.less(a, b) == (audits.text(a) < audits.text(b))


def test_audits_share():
    """A long conversation makes a few nodes a row, not a copy of its audit."""
    audits = c.Audits()
    best = {c.START: (0, 0)}
    for i in range(3000):
        best = c.step(best, audits, "ua"[i % 3 == 0], i % 7 == 0, i % 5 == 0)
    assert len(audits.letter) < 40 * 3000
    a, b = (node for _, node in list(best.values())[:2])
    assert audits.less(a, b) == (audits.text(a) < audits.text(b))


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def odd_rows():
    rng = random.Random(4)
    rows = []
    for conv in range(40):
        rows += [(conv, t, r, x) for t, (r, x) in enumerate(random_rows(rng, rng.randrange(1, 12)))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"Line {t}.") for t in range(700)]  # a third of all rows
    rows += [(101, 5, "user", "Same.")] * 300  # equal rows
    rows += [(102, None, "user", None), (102, None, None, "a."), (102, 3, "assistant", "b" * 200_000 + ".")]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (None, 2**40, None, None)]
    rows += [(103, t, "user", None) for t in range(3)]
    rng.shuffle(rows)
    return rows


def test_query_rows(spark, tmp_path):
    rows = odd_rows()
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    want = sorted((plain_row(k, v) for k, v in plain_damage(rows).items()), key=repr)
    got = sorted(map(tuple, c.op12_conversation_repair(spark, str(tmp_path)).collect()), key=repr)
    assert got == want


def test_pieces(monkeypatch):
    """Conversations cut in pieces of three rows give what whole ones give."""
    rng = random.Random(6)
    convs = {k: random_rows(rng, rng.randrange(30)) for k in range(60)}
    for conv, rows in convs.items():
        monkeypatch.setattr(c, "PIECE_ROWS", 3)
        seen, pieces, piece = set(), [], c.Piece()
        for turn, (role, text) in enumerate(rows):
            if piece.full():
                pieces.append(piece)
                piece = c.Piece()
            piece.add(turn // 2, role, text, (role, text) not in seen)
            seen.add((role, text))
        pieces.append(piece)
        parts = [c._part(conv, i, p) for i, p in enumerate(pieces)]
        chosen = list(c._chosen(conv, parts))
        messages = [
            m for p, x in zip(pieces, chosen) for m in c.apply_audit(x["audit"], p.rows, x["state"])[0]
        ]
        lines = [(turn // 2, r, t) for turn, (r, t) in enumerate(rows)]
        want = plain_row(conv, lines)
        totals = chosen[-1]["totals"]
        digest = hashlib.sha256("\n".join(f"{m['role']}:{m['text']}" for m in messages).encode()).hexdigest()
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
        assert (conv, *[totals[n] for n in names], digest) == want


def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    want = sorted(plain_row(k, v) for k, v in plain_damage(rows).items())
    assert sorted(map(tuple, c.op12_conversation_repair(spark, SF).collect())) == want


def test_messages_and_other_columns(spark):
    """The operator gives the repaired messages; columns of clashing names are ignored."""
    rows = spark.sql(
        "SELECT 'x' AS conv_id, CAST(t AS LONG) AS turn, r AS role, m AS text, 1 AS totals, 2 AS place, 3 AS copy, 4 AS conv, 5 AS gone "
        "FROM VALUES (1, 'user', 'Hi.'), (2, 'user', 'Ho.'), (3, 'assistant', '') AS v(t, r, m)"
    )
    out = c.repaired(rows).orderBy("place").collect()
    assert [(m.role, m.text) for r in out for m in r.messages] == [("user", "Hi."), ("assistant", "Ho.")]
    assert [(r.totals.audit, r.totals.cost) for r in out if r.totals] == [("KRD", 3)]


def test_empty(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert c.op12_conversation_repair(spark, str(tmp_path)).collect() == []
