import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm.spelling import _one_inserted, _one_replaced, _walk, grow_tree, near_words, spelling_variants, word_counts
from tests.llm.brute import documents, edge_rows

UPPER = {c: c + 32 for c in range(65, 91)}


def _words(rows, least=7, drop=31):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % drop == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            if len(low) >= least:
                out[low] += 1
    return {w: n for w, n in out.items() if n >= 2}


def _near(words):
    near = defaultdict(set)
    gaps = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            gaps[i, cut].add(w)
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for same in gaps.values():
        for w in same:
            near[w] |= same - {w}
    return near


def _expected(words, ratio=10):
    near, form = _near(words), {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x)) if near[w] else None
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words.get(form[w]), root)
    return out


def _found(df):
    got = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got}
    assert len(out) == len(got)
    return out


def _variants(seed):
    """Texts of few letters, so that many words are near, with chains of ever rarer variants."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 10))) for _ in range(60)]
    rows, n = [], 200
    for stem in stems:
        word = stem
        for k in (200, 20, 2):
            rows.append((len(rows), " ".join([word.capitalize()] * k)))
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice(["", "x", word[at] + "y"]) + word[at + 1:]
    return rows + [(None, " ".join(stems)), (None, " ".join(stems)), (n, "abcdefg " * 5), (n, "abcdefg " * 5)]


@pytest.mark.parametrize("cell_words", [1 << 15, 8])
def test_variants_equal_the_definition(spark, cell_words):
    rows = _variants(3) + [(r[0], r[1]) for r in edge_rows()]
    want = _expected(_words(rows))
    got = _found(spelling_variants(documents(spark, rows), cell_words=cell_words))
    assert got == want
    assert any(v[4] != k and v[4] != v[2] for k, v in got.items()) and any(v[1] > 1 for v in got.values())


def test_hashed_letters_are_dropped(spark):
    rows = [(i, "somewhat longer wordings " * 2) for i in range(200)]
    got = {r["word"]: r["n"] for r in word_counts(documents(spark, rows)).collect()}
    assert got == _words(rows) and len(got) > 3


def test_words_of_equal_letters_split_by_their_beginnings(spark):
    rng = random.Random(5)
    words = {}
    while len(words) < 120:  # one letter count for all, many a swap or a move apart
        w = list("aaaabbbbcccc")
        rng.shuffle(w)
        words["".join(w)] = rng.randint(2, 9)
        words["".join(w) + "a"] = 2
        words["b" + "".join(w)[1:]] = 3
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    tree = grow_tree(df, 8)
    assert any(split[0] for split in tree.values())
    codes = np.array([[ord(c) for c in w] for w in words if len(w) == 12], np.uint32)
    cells = list(_walk(tree, 12, codes, 0, 0))
    assert sum(len(rows) for _, rows in cells) == len(codes) and max(len(rows) for _, rows in cells) <= 8
    got = {r["word"]: (r["n_near"], r["form"], r["form_n"]) for r in near_words(df, 8).collect()}
    near = _near(words)
    want = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            want[w] = (len(near[w]), best, words[best])
    assert got == want


def test_odd_tables(spark):
    assert spelling_variants(documents(spark, [])).count() == 0
    assert spelling_variants(documents(spark, [(1, None), (2, ""), (3, "short words only")])).count() == 0
    long = "ab" * 20_000
    rows = [(1, f"{long} {long}c {long}"), (2, f"{long}c x{long[1:]} x{long[1:]}")]
    assert _found(spelling_variants(documents(spark, rows))) == _expected(_words(rows))


def test_letters_in_order_decide():
    code = lambda ws: np.array([[ord(c) for c in w] for w in ws])
    a = code(["abcd", "abcd", "abcd", "aaaa", "abab"])
    assert _one_replaced(a, code(["abcx", "abcd", "abdc", "aaba", "baba"])).tolist() == [True, False, False, True, False]
    assert _one_inserted(a, code(["xabcd", "abcdx", "abxdc", "aaaaa", "babab"])).tolist() == [True, True, False, True, True]
