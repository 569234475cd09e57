"""Operator 12: spelling variants by k-d trees over letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by one step up, one
step down, or one of each, and so it changes the counts within any fixed number of leading
letters by at most one step up and one down. Words of one length make one k-d tree whose
splits ask "more than t times letter x (among the first h letters)". Its leaves are the cells
that tasks search: a word goes to every cell whose box lies within its steps, once for the
words of its own length and once for those one letter longer. Inside a cell a finer tree over
the same counts, kept as unary bits, leaves few candidates; their letters in order decide.
Each task returns sums per word, so pairs are never written.

The top tree grows by one Spark aggregate of letter counts a level until no cell holds more
than ``cell_words`` words or ``CELL_CHARS`` characters; words that agree in all letter counts
are split by the counts of their first h letters. It has at most a few times ``MAX_CELLS``
nodes, since beyond that many full cells the cells grow instead.

Null and empty texts have no words; a null ``doc_id`` is the empty string in what is hashed;
repeated rows count each time; other columns do not matter; an empty table gives no words.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ship, stored

LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CELL_CHARS = 1 << 20
MAX_CELLS = 1 << 16
LEAF = 48
BITS = 256
_BLOCK = 1 << 21
_HELD = 1 << 17


# ------------------------------------------------------------------ words and counts
def word_counts(docs: DataFrame, min_letters: int = 7, min_count: int = 2, drop_every: int = 31) -> DataFrame:
    """``(word, n)``: maximal letter runs with A-Z lower-cased, of which those whose hash with
    their document's id ``drop_every`` divides lose the letter that the hash points at."""
    low = F.translate("run", _UPPER, _LOWER)
    size = F.length("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(
        F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(f"([{LETTERS}]{{{min_letters},}})"), 1)).alias("run"))
    hashed = runs.select(low.alias("run"), F.crc32(F.concat("doc", F.lit(":"), low)).alias("h"))
    at = (F.col("h") % size).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    words = hashed.select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _by_length(words: pa.Array):
    """(length, row numbers, codes) of each length in a batch."""
    texts = words.to_pylist()
    rows = defaultdict(list)
    for i, w in enumerate(texts):
        rows[len(w)].append(i)
    for length, at in rows.items():
        yield length, np.array(at), _codes([texts[i] for i in at], length)


def _count(codes: np.ndarray, rows: np.ndarray, h: int, letter: int) -> np.ndarray:
    part = codes[rows] if not h else codes[rows, :h]
    return (part == letter).sum(axis=1)


# ------------------------------------------------------------------ the top tree
def _walk(tree: dict, length: int, codes: np.ndarray, up: int, down: int):
    """Cells of words of ``length`` that ``codes`` can reach with so many letters gained and
    lost: (cell, row numbers). No steps at all: the words' own cells. Leading letters may
    change by one step each way where any letter changes."""
    slack = 1 if up or down else 0
    todo = [(1, np.arange(len(codes)), {})]
    while todo:
        node, rows, needs = todo.pop()
        split = tree.get((length, node))
        if split is None:
            yield node, rows
            continue
        h, letter, t, lo, hi = split
        c = _count(codes, rows, h, letter)
        for child in (0, 1):
            # steps into [lo, t] or [t + 1, hi] beyond those the parent's box already asks
            more_up = np.maximum((t + 1 if child else lo) - c, 0) - np.maximum(lo - c, 0)
            more_down = np.maximum(c - (hi if child else t), 0) - np.maximum(c - hi, 0)
            ups, downs = needs.get(h, (0, 0))
            ups, downs = ups + more_up, downs + more_down
            fits = (ups <= (slack if h else up)) & (downs <= (slack if h else down))
            if fits.any():
                kept = {k: (a[fits], b[fits]) for k, (a, b) in needs.items() if k != h}
                todo.append((2 * node + child, rows[fits], kept | {h: (ups[fits], downs[fits])}))


_HIST = "length int, node long, h int, letter int, c int, n long"


def _histograms(tree, open_cells: set, stuck: set):
    """Per open cell and letter, how many words have it c times; letter -1 counts the words.
    Stuck cells are told apart by their leading letters."""
    def run(batches):
        counts = defaultdict(int)
        for batch in batches:
            for length, _, codes in _by_length(batch.column(0)):
                for node, rows in _walk(tree.value, length, codes, 0, 0):
                    if (length, node) not in open_cells:
                        continue
                    counts[length, node, 0, -1, 0] += len(rows)
                    for h in range(1, length) if (length, node) in stuck else (0,):
                        part = codes[rows, :h] if h else codes[rows]
                        for letter in np.unique(part):
                            c = np.bincount((part == letter).sum(axis=1))
                            for k in np.flatnonzero(c[1:]) + 1:
                                counts[length, node, h, int(letter), int(k)] += int(c[k])
                if len(counts) > _HELD:
                    yield _histogram_rows(counts)
                    counts.clear()
        if counts:
            yield _histogram_rows(counts)
    return run


def _histogram_rows(counts: dict) -> pa.RecordBatch:
    columns = zip(*((*k, n) for k, n in counts.items()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _HIST_TYPES)], names=_HIST_NAMES)


_HIST_NAMES = [c.split()[0] for c in _HIST.split(", ")]
_HIST_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]


def _splits(hist: DataFrame) -> DataFrame:
    """Per cell its words and the most even split: more than t times ``letter``."""
    keys = ["length", "node"]
    total = hist.where("letter = -1").groupBy(*keys).agg(F.sum("n").alias("total"))
    counts = hist.where("letter >= 0").groupBy(*keys, "h", "letter", "c").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "h", "letter").orderBy(F.col("c").desc())
    cuts = counts.select(*keys, "h", "letter", (F.col("c") - 1).alias("t"), F.sum("n").over(w).alias("over"))
    able = cuts.join(total, keys).where("over < total")
    best = able.groupBy(*keys).agg(F.min(F.struct(F.abs(2 * F.col("over") - F.col("total")).alias("off"),
                                                  "h", "letter", "t", "over")).alias("b"))
    return total.join(best, keys, "left").select(*keys, "total", "b.h", "b.letter", "b.t", "b.over")


def grow_tree(words: DataFrame, cell_words: int) -> dict:
    """Inner nodes ``(length, node) -> (h, letter, t, lo, hi)`` of the trees of all lengths;
    node 1 is the root, 2n and 2n + 1 are the children; lo and hi bound the count before."""
    spark = ship(words.sparkSession)
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))

    def limit(length: int) -> int:
        return max(2, min(cell_words, CELL_CHARS // length))

    fits = F.greatest(F.lit(2), F.least(F.lit(cell_words), F.floor(F.lit(CELL_CHARS) / F.col("length"))))
    open_cells = {(r["length"], 1) for r in sizes.where(F.col("n") > fits).collect()}
    stuck: set = set()
    tree: dict = {}
    while open_cells:
        shared = spark.sparkContext.broadcast(tree)
        lengths = sorted({length for length, _ in open_cells})
        hist = words.where(F.length("word").isin(lengths)).select("word").mapInArrow(
            _histograms(shared, open_cells, stuck), _HIST)
        found = _splits(hist).collect()
        shared.unpersist()
        left, waiting = set(), set()
        for r in found:
            at = (r["length"], r["node"])
            if r["h"] is None:  # no letter count tells these words apart
                if at not in stuck:
                    waiting.add(at)
                continue
            tree[at] = (r["h"], r["letter"], r["t"], *_bounds(tree, at, r["h"], r["letter"]))
            for child, n in ((0, r["total"] - r["over"]), (1, r["over"])):
                if n > limit(r["length"]):
                    left.add((r["length"], 2 * r["node"] + child))
        open_cells, stuck = left | waiting, waiting
    return tree


def _bounds(tree: dict, at: tuple, h: int, letter: int) -> tuple[int, int]:
    """Least and largest count of the letter in a cell, from the splits above it."""
    length, node = at
    lo, hi = 0, h or length
    while node > 1:
        above = tree[length, node >> 1]
        if above[:2] == (h, letter):
            lo, hi = (max(lo, above[2] + 1), hi) if node & 1 else (lo, min(hi, above[2]))
        node >>= 1
    return lo, hi


_ROUTED = "length int, node long, role int, word string, n long"


def _route(tree):
    """Each word into its own cell (role 0: searched there, against larger words too), into
    the cells after its own that hold words it can become by one replacement (role 1), and
    into those of words one letter longer (role 2)."""
    def run(batches):
        for batch in batches:
            words, counts = batch.column(0), batch.column(1)
            parts = []
            for length, at, codes in _by_length(words):
                own = np.zeros(len(at), np.int64)
                for node, rows in _walk(tree.value, length, codes, 0, 0):
                    own[rows] = node
                    parts.append((length, node, 0, at[rows]))
                for node, rows in _walk(tree.value, length, codes, 1, 1):
                    rows = rows[own[rows] < node]
                    parts.append((length, node, 1, at[rows]))
                for node, rows in _walk(tree.value, length + 1, codes, 1, 0):
                    parts.append((length + 1, node, 2, at[rows]))
            parts = [p for p in parts if len(p[3])]
            if not parts:
                continue
            size = [len(p[3]) for p in parts]
            rows = pa.array(np.concatenate([p[3] for p in parts]))
            fixed = [pa.array(np.repeat([p[i] for p in parts], size), t) for i, t in
                     enumerate((pa.int32(), pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*fixed, words.take(rows), counts.take(rows)],
                                             names=["length", "node", "role", "word", "n"])
    return run


# ------------------------------------------------------------------ search inside a cell
def _unary(codes: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
    """One bit per (letter, t): whether a word has the letter more than t times."""
    out = np.empty((len(codes), len(pairs)), bool)
    letter, c = None, None
    for j, (x, t) in enumerate(pairs):
        if x != letter:
            letter, c = x, (codes == x).sum(axis=1)
        out[:, j] = c > t
    return out


def _pairs(codes: np.ndarray) -> list[tuple[int, int]]:
    """(letter, t) that tell words of the cell apart, the most even ones where there are many."""
    found = []
    for x in np.unique(codes):
        over = len(codes) - np.cumsum(np.bincount((codes == x).sum(axis=1)))
        found += [(abs(2 * int(n) - len(codes)), int(x), t) for t, n in enumerate(over) if 0 < n < len(codes)]
    return sorted((x, t) for _, x, t in sorted(found)[:BITS])


def _packed(bits: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(bits), -(-max(bits.shape[1], 1) // 64) * 64), bool)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


def _leaves(t_bits: np.ndarray, q_bits: np.ndarray, up: int, down: int):
    """Pairs of a leaf's targets and the queries that can reach its box."""
    todo = [(np.arange(len(t_bits)), np.arange(len(q_bits)), np.zeros(len(q_bits), np.int8), np.zeros(len(q_bits), np.int8))]
    while todo:
        t, q, ups, downs = todo.pop()
        if not len(q):
            continue
        if len(t) > LEAF:
            ones = t_bits[t].sum(axis=0)
            j = int(np.abs(2 * ones - len(t)).argmin()) if len(ones) else 0
            if len(ones) and 0 < ones[j] < len(t):
                side, has = t_bits[t, j], q_bits[q, j]
                low, high = downs + has, ups + ~has
                a, b = low <= down, high <= up
                todo.append((t[~side], q[a], ups[a], low[a]))
                todo.append((t[side], q[b], high[b], downs[b]))
                continue
        yield t, q


def _candidates(t_bits, q_bits, up, down):
    """(query, target) whose unary counts lie within the steps."""
    tp, qp = _packed(t_bits), _packed(q_bits)
    for t, q in _leaves(t_bits, q_bits, up, down):
        step = max(1, _BLOCK // len(t))
        for a in range(0, len(q), step):
            block = q[a:a + step]
            ups = np.zeros((len(block), len(t)), np.uint8)
            downs = np.zeros_like(ups)
            for k in range(tp.shape[1]):
                x, y = tp[t, k], qp[block, k][:, None]
                ups += np.bitwise_count(x & ~y)
                downs += np.bitwise_count(y & ~x)
            i, j = np.nonzero((ups <= up) & (downs <= down))
            if len(i):
                yield block[i], t[j]


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one letter put in: what agrees from the front and, one place on,
    from the back covers a."""
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= a.shape[1]


def _search(group: pa.Table) -> pa.Table:
    """Near words of one cell: per word how many, and the one of largest n."""
    names = group.column("word").to_pylist()
    n = group.column("n").to_numpy()
    role = group.column("role").to_numpy()
    length = group.column("length")[0].as_py()
    # rank by n, then by code points: the least rank among near words is the word's form
    order = sorted(range(len(names)), key=lambda i: (-n[i], names[i]))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    near = np.zeros(len(names), np.int64)
    best = np.full(len(names), len(names), np.int64)
    target = np.flatnonzero(role == 0)
    if len(target):
        t_codes = _codes([names[i] for i in target], length)
        pairs = _pairs(t_codes)
        t_bits = _unary(t_codes, pairs)
        chars = max(1, _BLOCK // length)
        for kind, up, down in ((0, 1, 1), (1, 1, 1), (2, 1, 0)):
            query = target if kind == 0 else np.flatnonzero(role == kind)
            if kind == 0:
                query = query[group.column("asks").to_numpy()[query]]
            if not len(query):
                continue
            q_codes = _codes([names[i] for i in query], length - (kind == 2))
            for q, t in _candidates(t_bits, _unary(q_codes, pairs), up, down):
                for a in range(0, len(q), chars):
                    x, y = q[a:a + chars], t[a:a + chars]
                    if kind == 0:  # each pair of the cell's own words once
                        once = rank[query[x]] < rank[target[y]]
                        x, y = x[once], y[once]
                    hit = (_one_inserted if kind == 2 else _one_replaced)(q_codes[x], t_codes[y])
                    x, y = query[x[hit]], target[y[hit]]
                    np.add.at(near, x, 1)
                    np.add.at(near, y, 1)
                    np.minimum.at(best, x, rank[y])
                    np.minimum.at(best, y, rank[x])
    some = np.flatnonzero(near)
    first = np.array(order, np.int64)[best[some]] if len(some) else some
    return pa.table([pa.array([names[i] for i in some], pa.string()), pa.array(near[some]), pa.array(n[first], pa.int64()),
                     pa.array([names[i] for i in first], pa.string())], names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, cell_words: int = 1 << 15) -> DataFrame:
    """``(word, n_near, form_n, form)`` for words with at least one near word: how many words
    differ by one letter, and the one of largest n (ties: first in code-point order)."""
    spark = ship(words.sparkSession)
    total = words.count()
    cell_words = max(cell_words, -(-total // MAX_CELLS))
    tree = spark.sparkContext.broadcast(grow_tree(words, cell_words))
    routed = stored(words.select("word", "n").mapInArrow(_route(tree), _ROUTED), "spelling-cells")
    # a cell with many visitors is searched by several tasks, each with all of its words
    visits = routed.groupBy("length", "node").agg(F.sum((F.col("role") > 0).cast("long")).alias("v"), F.sum(
        (F.col("role") == 0).cast("long")).alias("own"))
    tasks = visits.where("own > 0").select("length", "node", F.greatest(F.lit(1), F.ceil(
        F.col("v") / F.lit(2 * cell_words))).cast("int").alias("tasks"))
    dealt = routed.join(tasks, ["length", "node"])
    own = F.pmod(F.xxhash64("word"), F.col("tasks")).cast("int")
    dealt = dealt.withColumn("task", F.explode(F.when(F.col("role") == 0, F.sequence(F.lit(0), F.col("tasks") - 1))
                                               .otherwise(F.array(own))))
    dealt = dealt.select("length", "node", "task", "role", (F.col("task") == own).alias("asks"), "word", "n")
    part = dealt.groupBy("length", "node", "task").applyInArrow(_search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("b")
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.m")).alias("form_n"), "b.form")


# ------------------------------------------------------------------ forms and roots
def spelling_variants(docs: DataFrame, min_letters: int = 7, min_count: int = 2, ratio: int = 10, drop_every: int = 31,
                      cell_words: int = 1 << 15) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` per word: its near words, the form it is a
    variant of (its near word of largest n where that is ``ratio`` times its own, else null)
    and the root that forms lead to."""
    words = stored(word_counts(docs, min_letters, min_count, drop_every), "spelling-words")
    near = near_words(words, cell_words)
    far = F.col("form_n") >= ratio * F.col("n")
    table = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(far, F.col("form")).alias("form"), F.when(far, F.col("form_n")).alias("form_n")), "spelling-forms")
    # a form has ratio times the occurrences, so chains are short; each step doubles what is followed
    top = table.agg(F.max("n")).first()[0] or 1
    chain = max(1, int(math.log(top) / math.log(max(2, ratio))) + 1)
    follow = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(chain)))):
        onward = follow.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        follow = stored(follow.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root")), "spelling-roots")
    return table.join(follow, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
