"""Plain restatements that the operators are held against, and the rows they run on."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import regex

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, row string, node string, "
          "component string, score string, g string, stats string, words string, key string")


def edge_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and very long texts, exact and near copies, shared
    passages, ties and repeated rows."""
    rng = np.random.default_rng(3)
    syllables = ["th", "er", "on", "an", "ré", "in", "ti", "es", "ou", "är"]

    def text(n):
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))

    base = text(120)
    near = base.split(" ")
    near[60] = "changed"
    passage = text(40)
    long = text(30_000)
    rows = [
        (None, base), (None, "nothing has this id"), (1, None), (2, ""), (3, " \n\t \x0b "), (4, "one"), (5, "one"),
        (6, "two words"), (7, base), (8, " ".join(near)), (9, base), (9, base), (10, text(80) + "\n" + passage),
        (11, passage + " " + text(70)), (12, long), (13, long[:150_000]), (14, "a" * 400), (15, "a" * 120 + "b" * 60),
        (16, base.upper() + " "), (17, "ééé " * 60), (18, "x" + "ééé " * 60), (19, "\0\0" + "\0" * 80), (20, "\0" * 60),
        (21, "### *** | pipes | of | words | " * 20), (22, "line one is here\n" * 30), (23, "12345 67890 !!"),
        (2**61, text(60)), (-4, text(60)), (24, text(90)), (25, "И привет 漢字"),
    ]
    return [(i, t, None if k % 5 == 0 else ["en", "fr"][k % 2], f"s{k % 3}", None, *["clash"] * 9)
            for k, (i, t) in enumerate(rows)]


def documents(spark, rows):
    return spark.createDataFrame([(*r, *(None,) * (5 - len(r)), *("clash",) * min(9, 14 - len(r))) for r in rows],
                                 SCHEMA)


def edges(spark):
    return documents(spark, edge_rows())


def words(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, k):
    w = words(text, lower=True)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_components(rows, k, percent):
    """(set size, component index -> members) by comparing every two rows."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    return [len(s) for s in sets], [top(i) for i in range(len(rows))]


def cut_repeats(rows, length):
    """(n_bytes, n_removed, n_spans, kept) by the definition: null ids come last."""
    ids = [2**63 if i is None else i for i, _ in rows]
    raw = [(t or "").encode() for _, t in rows]
    first = {}
    for i, b in zip(ids, raw):
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in zip(ids, raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = True
        starts = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest()))
    return out


def rule_statistics(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(zip(w, w[1:], w[2:]))
    inside = {j for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside))


def _plain_words(text):
    return [x for x in regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).split(" ") if x]


def leaks(rows, items, k=5, percent=80):
    """{(doc_id, item_id): best similarity} over all item-sized windows that share a shingle."""
    grams = lambda w: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    weight = lambda s: sum(sum(map(len, g)) for g in s)
    out = {}
    split = {item: _plain_words(text) for item, text in items}
    for doc, text in rows:
        w = _plain_words(text)
        held = grams(w)
        for item, t in split.items():
            b = set(grams(t))
            last = max(0, len(w) - len(t))
            starts = {s for place, g in enumerate(held) if g in b
                      for s in range(max(0, place - len(t) + k), min(place, last) + 1)}
            for s in starts:
                a = set(held[s:s + max(0, len(t) - k + 1)])
                x, u = weight(a & b), weight(a | b)
                if 100 * x >= percent * u:
                    out[doc, item] = max(out.get((doc, item), 0), x / u)
    return out
