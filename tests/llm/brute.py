"""Plain-Python versions of the operators, and rows that are awkward in every way."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, ids string, score double, digest string"
PASSAGE = "".join(f"passage word {i} goes on; " for i in range(14))
WORDS = [f"word{i}" for i in range(400)]


def awkward() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, copies, near copies, shared passages, repeated rows."""
    base = WORDS[:120]
    near = base[:50] + ["changed"] + base[51:]
    texts = [
        None, "", " \t\n", "one", "Two words", "Two words", "éàü ß 漢字 😀 don't  12345   x", "A" * 5_000, "tab\tline\r\n\x0b\x0c end",
        " ".join(base), " ".join(near), " ".join(near).upper(), " ".join(base), " ".join(reversed(base)),
        "first " + PASSAGE + "first end", "second " + PASSAGE + "and more", PASSAGE * 2, "of of of of " * 60,
        " ".join(WORDS[(i * 7919) % 400] for i in range(30_000)),
    ]
    rows = [
        (i, text, ["en", "fr", None][i % 3], ["a", "b", None, "ü"][i % 4], None if i % 5 == 0 else len(text or ""), "x", "y", 0.5, "z")
        for i, text in enumerate(texts)
    ]
    return [*rows, rows[9], rows[9], (None, "null id " + PASSAGE, "en", "a", 3, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def empty(spark):
    return frame(spark).limit(0)


def shingles(text: str | None, words: int) -> frozenset:
    parts = (text or "").encode().lower().split()
    return frozenset(b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))) if parts else frozenset()


def components(texts: list[str | None], ids: list, words: int) -> list:
    """The least id of each text's group; the text's own id if it has no words."""
    sets = [shingles(t, words) for t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, own in enumerate(ids):
        least[find(i)].append(own)
    pick = lambda group: min((x for x in group if x is not None), default=None)
    return [pick(least[find(i)]) if sets[i] else ids[i] for i in range(len(sets))]


def kept_bytes(texts: list[str | None], length: int = 200) -> list[tuple[bytes, int, int]]:
    """What is left of each text, bytes gone and runs gone."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((bytes(b for b, g in zip(d, gone, strict=False) if not g), int(gone.sum()), runs))
    return out


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
