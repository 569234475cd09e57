"""Passages that very many documents share do not gather at one task."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import suffix
from riskloom.llm.suffix import remove_repeats
from tests.llm import brute
from tests.llm.brute import documents, edge_rows


def _boilerplate(n):
    """Each document has its own words on both sides of one line, of 60 bytes or longer."""
    rng = np.random.default_rng(8)
    own = lambda: "".join(rng.choice(list("abcdefghij klmnop"), 90))
    line = "All rights reserved; do not copy without leave of the owners."
    return [(i, own() + line[: 61 - i % 9] + own()) for i in range(n)]


@pytest.mark.parametrize("crowd", [0, 3, 40])
def test_crowded_anchors_give_the_same_cuts(spark, crowd):
    rows = [(r[0], r[1]) for r in edge_rows() if len(r[1] or "") < 20_000] + [(500 + i, t) for i, t in _boilerplate(60)]
    out = remove_repeats(documents(spark, rows), length=50, chunk_bytes=4000, bucket_bytes=8000, crowd=crowd).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"]).alias("n_removed"),
        F.size("spans").alias("n_spans"), "kept").collect()
    have = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"],
                   hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out)
    want = sorted((str(i), *w) for (i, _), w in zip(rows, brute.cut_repeats(rows, 50)))
    assert have == want


def test_no_task_receives_all_occurrences(spark, monkeypatch):
    rows = _boilerplate(400)
    seen = spark.sparkContext.accumulator(0)
    real = suffix.smaller_windows

    def counted(group, *rest):
        seen.add(int(np.bincount(group).max() >= 300))
        return real(group, *rest)

    monkeypatch.setattr(suffix, "smaller_windows", counted)
    for crowd, gathered in ((100, False), (10**6, True)):
        got = remove_repeats(documents(spark, rows), length=50, chunk_bytes=8000, crowd=crowd)
        assert got.where(F.size("spans") > 0).count() == 399 and (seen.value > 0) == gathered
