import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from riskloom.llm import minhash
from riskloom.llm import parts as dealing
from riskloom.llm.common import table
from riskloom.llm.components import components
from riskloom.llm.minhash import drop_near_duplicates, near_duplicates, superminhash
from riskloom.llm.suffix import anchors, deep_shallow, remove_repeats
from tests.conftest import SF
from tests.llm.brute import cut_repeats, documents, edge_rows, edges, near_components


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, k):
    rows = sorted({(r[0], r[1]) for r in edge_rows()}, key=str)
    rows += [(r["doc_id"] + 1000, r["text"]) for r in table(spark, SF, "documents").collect()]
    sizes, top = near_components(rows, k, 80)
    least = {}
    for (i, _), t in zip(rows, top):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    want = sorted((str(i), n, least.get(t), least.get(t) is None or least[t] == i)
                  for (i, _), n, t in zip(rows, sizes, top))
    got = near_duplicates(documents(spark, rows), words=k, similarity=80).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want


def test_near_duplicates_of_edited_copies(spark):
    """A group whose members differ so much that only some of them link."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        w = list(base)
        for at in rng.choice(80, rng.integers(0, 14), replace=False):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    sizes, top = near_components(rows, 2, 80)
    least = {}
    for (i, _), t in zip(rows, top):
        least[t] = min(least.get(t, i), i)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(spark, rows), words=2).collect()}
    assert got == {i: least[t] for (i, _), t in zip(rows, top)}
    assert 1 < len(set(got.values())) < 90


def test_hot_buckets_and_pivots_are_dealt_without_losing_pairs(spark, monkeypatch):
    """Parts never hold more than their share, and all settings find the same links."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(x if rng.random() > 0.03 else f"x{i}_{j}" for j, x in enumerate(base))) for i in range(120)]
    rows += [(200 + i, " ".join(f"v{i}_{j}" for j in range(40)) + (" end" if i % 2 else "")) for i in range(30)]
    rows += [(300 + i, t + " more") for i, (_, t) in enumerate(rows[-30:])]
    docs = documents(spark, rows)
    found = {}
    for parts in (1, 7, 4096):
        monkeypatch.setattr(dealing, "PARTS", parts)
        monkeypatch.setattr(minhash, "CELL", 9 if parts == 7 else 1024)
        found[parts] = sorted((r["doc_id"], r["component_id"]) for r in near_duplicates(docs, words=2).collect())
        entries = minhash.signatures(docs, 2).select(
            F.explode("keys").alias("key"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"))
        members = minhash._bucket_members(entries).cache()
        total, buckets = members.count(), members.select("key").distinct().count()
        assert members.select("key", "salts").distinct().groupBy().sum("salts").first()[0] <= buckets + parts
        assert members.where("s < 0 or s >= salts").count() == 0
        assert members.groupBy("key").count().count() == buckets and total == entries.join(
            entries.groupBy("key").count().where("count > 1"), "key").count()
        members.unpersist()
    assert found[1] == found[7] == found[4096]
    sizes, top = near_components(rows, 2, 80)
    assert [c for _, c in found[1]] == [min(i for (i, _), t in zip(rows, top) if t == u) for u in top]


@pytest.mark.parametrize("cell", [4, 1024])
def test_last_round_meets_all_that_can_link(spark, monkeypatch, cell):
    """Every pair of a bucket that the bound lets through meets, in whatever level or part."""
    monkeypatch.setattr(minhash, "CELL", cell)
    rng = np.random.default_rng(3)
    members = [(int(k), int(r), int(n), int(rng.integers(0, n // 3 + 1)), int(r), int(salts), int(r) % int(salts))
               for r, (k, n, salts) in enumerate(zip(np.repeat([1, 2], 60), rng.integers(1, 40, 120), np.repeat([50, 1], 60)))]
    frame = spark.createDataFrame(members, "key long, rep long, n long, p long, c long, salts int, s int")
    got = {(r["a"], r["b"]) for r in minhash._last_meetings(frame, 80).collect()}
    want = set()
    for x in members:
        for y in members:
            rest = min(x[2] - x[3], y[2] - y[3])
            if x[0] == y[0] and x[1] < y[1] and 100 * rest >= 80 * (x[2] + y[2] - rest):
                want.add((x[1], y[1]))
    assert got == want and len(want) > 50


def test_near_duplicates_keep_one_row_and_all_columns(spark):
    docs = edges(spark)
    kept = drop_near_duplicates(docs, words=2)
    assert kept.schema == docs.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert 9 not in ids and 5 not in ids and 7 in ids and 4 in ids and ids.count(12) == 1
    assert drop_near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, [])).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**54 - 1), min_size=1, max_size=60, unique=True))
def test_superminhash_by_ranks_equals_element_by_element(elements):
    """Every rank of every element offered to its register, without early stopping."""
    from riskloom.llm.common import mix64
    m = 8
    got = superminhash(np.array(elements, np.uint64), np.array([len(elements)]), m)[0]
    want = np.full(m, 2**64 - 1, np.uint64)
    for e in elements:
        perm = list(range(m))
        for j in range(m):
            x = mix64(np.array([(e + ((j + 1) * 0xD1B54A32D192ED03) % 2**64) % 2**64], np.uint64))
            pick = j + int((int(mix64(x ^ np.uint64(0x2545F4914F6CDD1D))[0]) >> 32) * (m - j) >> 32)
            perm[j], perm[pick] = perm[pick], perm[j]
            want[perm[j]] = min(want[perm[j]], np.uint64((j << 56) | (int(x[0]) >> 8)))
    assert got.tolist() == want.tolist()


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**54, 300).astype(np.uint64)
    b = np.concatenate([a[:200], rng.integers(0, 2**54, 100).astype(np.uint64)])
    sig = superminhash(np.concatenate([a, b]), np.array([300, 300]), 1024)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.06


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [
        (200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 1 for i in range(1, 40))
    assert all(got[i] == 200 for i in range(200, 209)) and 300 not in got


def test_repeats_equal_the_definition(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = remove_repeats(edges(spark), length=50, carry=["doc_id", "text"], chunk_bytes=20_000, bucket_bytes=30_000)
    have = sorted((str(r["row"]["doc_id"]), r["n_bytes"], sum(s["length"] for s in r["spans"]), len(r["spans"]),
                   hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got.collect())
    assert have == sorted((str(i), *x) for (i, _), x in zip(rows, cut_repeats(rows, 50)))


def test_repeats_as_text_drop_split_characters(spark):
    rows = [(1, "é" * 40 + "tail of the first"), (2, "xx" + "é" * 40 + "other end"), (3, "©" * 25 + "z")]
    got = {r["row"]["doc_id"]: r["kept"] for r in remove_repeats(
        documents(spark, rows), length=51, as_text=True).collect()}
    want = {i: n for (i, _), n in zip(rows, cut_repeats(rows, 51))}
    assert got[1] == rows[0][1] and got[2].startswith("xx") and got[2].endswith("other end")
    assert want[2][1] > 0 and "�" not in got[2]
    assert remove_repeats(documents(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=25),
       st.integers(1, 3))
def test_deep_shallow_sorts(strings, groups):
    m = np.zeros((len(strings), 60), np.uint8)
    for i, s in enumerate(strings):
        m[i, :len(s)] = np.frombuffer(s, np.uint8)
    m[:, :30] = 7  # a long common prefix, so that blind tries have work
    group = np.arange(len(strings)) % groups
    order = deep_shallow(m, group)
    keys = [(int(group[i]), m[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(strings)))


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=50, max_size=200).map(lambda b: bytes(x % 4 for x in b)), st.integers(0, 30))
def test_equal_windows_have_equal_anchors(body, shift):
    data = np.frombuffer(bytes(shift) + b"\x09" + body, np.uint8)
    other = np.frombuffer(body, np.uint8)
    a, _ = anchors(data, np.array([0, len(data)]), 50)
    b, _ = anchors(other, np.array([0, len(other)]), 50)
    a = {int(x) - shift - 1 for x in a}
    for start in range(len(body) - 49):
        inside = {x for x in b.tolist() if start <= x <= start + 26}
        assert inside and inside & a, (start, inside)
