import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import table
from riskloom.llm.encode import Encoder, encoder
from riskloom.llm.packing import best_fit_decreasing, lower_bound, pack_documents
from riskloom.llm.tokens import read_token_files, write_token_files
from tests.conftest import SF
from tests.llm.brute import documents, edge_rows, edges

ODD = ["", " ", "\n", "a\n\nb  c\td", " lead", "trail ", "x <|endoftext|> y", "a\x1cb c", "é́ ố a", "İ ΑΣ Σ",
       "a \n b", "\x00 a\x00", "don't 's  're x　y", "\nfoo bar", "foo\n", "\0", "x... y.$# Ab,\nz.",
       "a\x85b c\x0bd", "<|startoftext|>x y", "漢字 かな 한글", "a 12.5% b", "x \0a \0 b", "\0x y\0 z", "a\xa0b c", "a \n\nb", " \n", "x\n"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("block", [1 << 20, 9])
def test_units_give_the_librarys_ids(name, block):
    path = public_tokenizers.path(name)
    ours, lib = Encoder(path, block_chars=block), Tokenizer.from_file(path)
    texts = ODD + [t or "" for _, t, *_ in edge_rows() if len(t or "") < 3000]
    for text, ids in zip(texts, ours.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t.,#'<| ́A1"), max_size=40))
def test_units_give_the_librarys_ids_of_any_text(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        ids = np.frombuffer(encoder(path).encode([text])[0], "<u4").tolist()
        assert ids == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_small_memo_forgets_and_learns_again():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"word{i} again{i % 7} word{i}." for i in range(200)]
    assert Encoder(path, memo_units=20).encode(texts) == Encoder(path).encode(texts)


def test_token_files_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = read_token_files(write_token_files(edges(spark), path, end_id=2), block_ids=500).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (2**63 - 1 if r[0] is None else r[0], r[1] or ""))
    at = 0
    for row, (i, text) in zip(sorted(got, key=lambda r: r["start"]), order):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (i, at, len(ids))
        assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == ids
        at += len(ids)


def test_token_files_of_an_empty_table(spark):
    files = write_token_files(documents(spark, []), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    assert read_token_files(files).count() == 0


def test_packing_covers_every_document_without_gaps(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    docs = edges(spark).unionByName(table(spark, SF, "documents").select("doc_id", "text"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = pack_documents(docs, path, capacity=256, group_pieces=60, keep_ids=True).collect()
    want = defaultdict(int)
    total = 0
    for i, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for p in range(0, len(ids), 256):
            part = np.array(ids[p:p + 256], "<u4").tobytes()
            want[i, p // 256, p, len(part) // 4, zlib.crc32(part)] += 1
    for r in got:
        want[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] -= 1
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
    assert not any(want.values())
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    histogram = np.bincount([r["length"] for r in got], minlength=257)
    assert len(bins) <= 1.01 * lower_bound(histogram, 256) + 1


def test_packing_an_empty_table(spark):
    assert pack_documents(documents(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_bound_is_below_and_best_fit_above_the_optimum(lengths):
    def fewest(rest, rooms):
        if not rest:
            return len(rooms)
        best = len(rest) + len(rooms)
        for i, room in enumerate(rooms):
            if room >= rest[0] and room not in rooms[:i]:
                best = min(best, fewest(rest[1:], rooms[:i] + [room - rest[0]] + rooms[i + 1:]))
        return min(best, fewest(rest[1:], rooms + [12 - rest[0]]))

    best = fewest(sorted(lengths, reverse=True), [])
    x = np.array(lengths, np.int64)
    bin_of, offset, fill = best_fit_decreasing(x, 12)
    assert lower_bound(np.bincount(x, minlength=13), 12) <= best <= len(fill)
    assert (fill <= 12).all() and np.bincount(bin_of, weights=x, minlength=len(fill)).tolist() == fill.tolist()


def test_query_equals_spark_crc(spark):
    from riskloom.llm.queries import op2_token_files
    got = op2_token_files(spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    assert got.agg(F.min("start")).first()[0] == 0
