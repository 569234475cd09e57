"""What link contraction and near-duplicate search leave on disk, and the tasks they take."""

import os
import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from riskloom.llm.common import scratch_path, stored
from riskloom.llm.components import components
from riskloom.llm.minhash import drop_near_duplicates, near_duplicates
from riskloom.session import checkpoint_dir, discard, mounted


def _tables(spark) -> set[str]:
    return set(os.listdir(mounted(checkpoint_dir(spark))))


def _labels(names) -> Counter:
    return Counter(re.sub(r"-[0-9a-f]{32}$", "", n) for n in names)


@pytest.fixture
def wide_shuffles(spark):
    """Each shuffle has 16 tasks, as none is small enough to be left out or joined up."""
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield 16
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tasks(spark, name: str, call) -> int:
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        call()
        ids = {s for j in sc.statusTracker().getJobIdsForGroup(name) for s in sc.statusTracker().getJobInfo(j).stageIds}
        infos = [sc.statusTracker().getStageInfo(s) for s in ids]
        return sum(i.numCompletedTasks for i in infos if i)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_rounds_of_components(spark, wide_shuffles):
    """A path contracts in a few rounds; each takes few shuffles and its table goes."""
    n = 200
    links = stored(spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), "path")
    before, out = _tables(spark), []
    tasks = _tasks(spark, "rounds", lambda: out.append(components(links)))
    rounds = 9  # of this path, the one that changes nothing included
    assert tasks < 7 * rounds * wide_shuffles
    assert _labels(_tables(spark) - before) == {"links": 1}
    assert {(r["node"], r["component"]) for r in out[0].collect()} == {(i, 0) for i in range(n)}
    assert out[0].count() == n


def _documents(spark):
    """Exact copies, a chain of edited copies and texts that stand alone."""
    rows = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(120)]
        for v in range(8):
            edited = words[:]
            edited[v * 13] = f"v{v}"
            rows.append((100 * g + v, " ".join(edited)))
            rows.append((100 * g + v + 50, " ".join(edited)))
    rows += [(1000 + i, " ".join(f"s{i}x{j}" for j in range(40))) for i in range(10)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates_leave_what_their_rows_are_read_from(spark):
    docs = _documents(spark)
    before = _tables(spark)
    rows = near_duplicates(docs, words=2, similarity=80)
    left = _labels(n for n in _tables(spark) - before if "riskloom" not in n)
    assert set(left) == {"signatures", "links"}
    got = {r["doc_id"]: r["component_id"] for r in rows.collect()}
    assert all(got[i] == (i - i % 100 if i < 1000 else i) for i in got) and len(got) == 106
    assert {r["doc_id"] for r in drop_near_duplicates(docs, words=2, similarity=80).collect()} == {
        *range(0, 600, 100), *range(1000, 1010)}


def test_discard_spares_what_was_not_stored(spark):
    path = scratch_path(spark, "given")
    spark.range(3).write.parquet(path)
    given = spark.read.parquet(path)
    kept, gone = stored(given, "kept"), stored(given, "gone")
    discard(given, kept.where("id > 0"), gone)
    assert given.count() == kept.count() == 3
    left = _labels(_tables(spark))
    assert left["kept"] == 1 and left["gone"] == 0
