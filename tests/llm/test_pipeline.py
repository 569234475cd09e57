import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF01
from tests.llm import brute


def test_pipeline_equals_stages_one_by_one(spark):
    """run() against plain restatements of the stages after the rules, on whole tables."""
    docs = pd.read_parquet(f"{SF01}/documents.parquet")
    first = corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{SF01}/documents.parquet"), SF01)
    assert first.columns == list(docs.columns)
    kept = {r["doc_id"] for r in first.select("doc_id").collect()}
    passes = {i for i, t in zip(docs.doc_id, docs.text)
              for s in [brute.rule_statistics(t)] if s[0] >= 50 and 100 * s[4] <= 50 * s[0]}
    good = set(pd.read_parquet(f"{SF01}/labels.parquet").query("quality == 1").doc_id)
    assert kept <= passes and len(passes & good - kept) <= 0.05 * len(good)

    rows = sorted((i, t) for i, t in zip(docs.doc_id, docs.text) if i in kept)
    _, top = brute.near_components(rows, 5, 80)
    seen, unique = set(), []
    for row, t in zip(rows, top):
        if t not in seen:
            unique.append(row)
        seen.add(t)
    ids = {i for i, _ in unique}

    first_at, cut = {}, []
    for i, t in unique:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        strings = [raw[k:k + 50] for k in range(len(raw) - 49)]
        for k, s in enumerate(strings):
            if s in first_at:
                gone[k:k + 50] = True
        for s in strings:
            first_at.setdefault(s, i)
        out, at = [], 0
        for c in t:
            n = len(c.encode())
            if not gone[at:at + n].any():
                out.append(c)
            at += n
        cut.append((i, "".join(out)))
    bench = pd.read_parquet(f"{SF01}/benchmark.parquet")
    leaky = {d for d, _ in brute.leaks(cut, list(zip(bench.item_id, bench.text)))}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in cut:
        if i in leaky:
            continue
        x = lib.encode(t, add_special_tokens=False).ids + [0]
        want += [(i, p // 2048, p, len(x[p:p + 2048]), zlib.crc32(np.array(x[p:p + 2048], "<u4").tobytes()))
                 for p in range(0, len(x), 2048)]
    got = corpus_pipeline.run(spark, SF01).toPandas()
    have = sorted(zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32))
    assert have == sorted(want) and ids >= set(got.doc_id) and len(leaky) > 0
    ends = got.sort_values(["sequence_id", "offset"])
    follows = ends.groupby("sequence_id").length.cumsum() - ends.length
    assert (follows == ends.offset).all() and (ends.offset + ends.length <= 2048).all()


def test_stages_are_the_ten_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "suffix_dedup", "decontaminate", "pack"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_rows(spark):
    docs = brute.edges(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF01)
        assert out.columns == docs.columns, name
        out.count()
        assert stage(spark, docs.limit(0), SF01).count() == 0, name
    assert corpus_pipeline.pack(spark, docs, SF01).count() >= len(brute.edge_rows())
