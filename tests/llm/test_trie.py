import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import trie
from riskloom.llm.trie import conversation_trie, decompose, member_digests
from tests.conftest import SF01

SCHEMA = "conv_id long, turn long, role string, text string, c string, d string, o string, part string"


def _tie(turn, role, text):
    key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
    return (turn is not None, turn or 0, key)


def _expected(rows, every=100, heads=6):
    own = {}
    for c, *turn in rows:
        if c is not None:
            own.setdefault(c, []).append(turn)
    own = {c: [(r or "", t or "") for _, r, t in sorted(x, key=lambda y: _tie(*y))] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = tuple(own.get(c - int(math.fmod(c, every)), [])[:h] + turns[h:])
    members, kids = {}, {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    leaves, saved, out = {}, {}, {}
    for s in sorted(members, key=len, reverse=True):
        below = kids.get(s, [])
        leaves[s] = sum(leaves[x] for x in below) or 1
        saved[s] = sum(saved[x] for x in below) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[s] if len(built[c]) == len(s)))
        out[min(members[s]), len(s)] = (min(members[s[:-1]]) if s else None, len(members[s]), len(below), leaves[s], saved[s],
                                        hashlib.sha256(ends.encode()).hexdigest())
    return out


def _found(df):
    got = df.collect()
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                                        r["ends_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def _odd_rows():
    rng = random.Random(2)
    rows = [(None, 0, "user", "no conversation"), (5, None, None, None), (5, None, "user", "b"), (5, 0, "user", "b"), (5, 0, "user", "b"),
            (5, 0, "a", "é"), (-7, 1, "user", "minus"), (-107, 1, "user", "minus"), (2**61, 3, "user", "x" * 50_000), (105, 0, "user", "lone")]
    for c in [0, 100, 200, -100, *rng.sample(range(300), 90)]:
        for t in range(rng.randint(1, 8)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "", None, "ß" * 9])))
    rows += [(400 + i, t, "user", f"same {t}") for i in range(60) for t in range(6)]
    rows += [(700, t, "user", f"deep {t % 3}") for t in range(300)]
    return rows


@pytest.mark.parametrize("group_nodes", [50_000, 40, 3])
def test_trie_equals_the_definition(spark, group_nodes, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    rows = _odd_rows()
    assert _found(conversation_trie(_frame(spark, rows), group_nodes=group_nodes)) == _expected(rows)


def test_whole_table_equals_the_definition(spark):
    convs = spark.read.parquet(f"{SF01}/conversations.parquet")
    rows = [tuple(r) for r in convs.select("conv_id", "turn", "role", "text").collect()]
    assert _found(conversation_trie(convs)) == _expected(rows)


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "hello") for c in range(1, 40)]  # no base: turns up to h go
    got = _found(conversation_trie(_frame(spark, rows)))
    assert got == _expected(rows) and got[1, 0][5] != hashlib.sha256(b"").hexdigest()
    assert conversation_trie(_frame(spark, [])).count() == 0
    assert conversation_trie(_frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_long_member_lists_are_hashed_in_order(spark, monkeypatch):
    n = 30_000
    ends = spark.range(n).select(F.lit(1).cast("long").alias("o"), F.lit(2).cast("long").alias("d"), (F.col("id") * 7 - 999).alias("c"))
    got = member_digests(ends.union(spark.sql("SELECT 3L, 2L, -5L"))).collect()
    want = hashlib.sha256(",".join(str(i * 7 - 999) for i in range(n)).encode()).hexdigest()
    assert {(r["o"], r["d"]): r["ends"] for r in got} == {(1, 2): want, (3, 2): hashlib.sha256(b"-5").hexdigest()}


def test_centroids_sum_any_forest():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n = int(rng.integers(1, 70))
        reach = int(rng.integers(1, 20))
        up = np.array([i if i == 0 or rng.random() < 0.1 else rng.integers(max(0, i - reach), i) for i in range(n)])
        deep = np.zeros(n, int)
        for i in range(n):
            deep[i] = 0 if up[i] == i else deep[up[i]] + 1
        shuffle = rng.permutation(n)
        parent, depth = np.empty(n, int), np.empty(n, int)
        parent[shuffle], depth[shuffle] = shuffle[up], deep
        values = rng.integers(0, 9, (n, 2))
        want = values.copy()
        for i in sorted(range(n), key=lambda i: -depth[i]):
            if parent[i] != i:
                want[parent[i]] += want[i]
        assert (decompose(parent, depth, values) == want).all()
