"""Rows that every operator must bear, and plain versions of shared steps."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ba", "do", "ri", "me", "tu", "xo", "né"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(n=60, seed=1):
    """Texts with copies, near copies, shared passages, hits of every kind, and odd rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    texts = []
    for i in range(n):
        lines = [sentence(rng, rng.randint(3, 30)).capitalize() + "." for _ in range(rng.randint(1, 8))]
        kind = i % 10
        if kind == 1 and texts:
            lines = [rng.choice(texts)]
        elif kind == 2 and texts:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = "changed"
            lines = [" ".join(words)]
        elif kind == 3:
            lines.insert(rng.randint(0, len(lines)), passage)
        elif kind == 4:
            lines.append("Write to jo.doe@mail.example.org or call +1 (826) 555-4081 from 190.137.2.77 with 4111 1111 1111 1111.")
        elif kind == 5:
            lines[0] = " | ".join(lines[0].split(" "))
        elif kind == 6:
            lines = ["spam eggs " * 40]
        texts.append("\n".join(lines))
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def odd_rows():
    """NULLs in any column, empty, blank and very long texts, repeated rows, ids without order."""
    rng = random.Random(5)
    long_text = sentence(rng, 60_000)
    return [
        (1000, None, None, None, None),
        (1001, "", "en", "a", 0),
        (1002, " \n\t ", "en", "a", 4),
        (1003, "one two", "en", None, 7),
        (1003, "one two", "en", None, 7),
        (1004, "ONE two", None, "a", 7),
        (None, "a text without an id that is long enough to be compared with others around it", "en", "a", 70),
        (None, "a text without an id that is long enough to be compared with others around it", "en", "a", 70),
        (1005, long_text, "en", "a", len(long_text)),
        (1006, long_text + " end", "en", "a", len(long_text) + 4),
        (-7, "x" * 300_000, "en", "a", 300_000),
        (2**62, "日本語の文 🙂 né\x00\x1f|<|endoftext|>  two  spaces \r\n", "ja", "b", 40),
    ]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def words(text, pattern=r"[^\x20\x09-\x0D]+", lower=True):
    return re.findall(pattern, (text or "").translate(LOWER) if lower else text or "")
