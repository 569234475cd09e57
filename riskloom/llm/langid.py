"""Operator 6: languages of spans by script, character n-grams and Viterbi.

Words are runs of letters. The script of a word's first letter leaves only the languages
that use this script in the training texts; hashed character bigrams and trigrams with
word edges give a log probability per word and language; Viterbi with a penalty for each
switch labels the words, and runs of one label are the spans. A document's language is
the one with the most letters.

Null texts and texts without a letter have no spans, language ``und`` and score 0; so has
every text if there is nothing to learn from. Training rows need text and language; equal
scores go to the alphabetically first language. Output follows the input row by row.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix64, run_index, ship

GRAMS = 1 << 15
BLOCK = 1 << 10
#: fixed values: first code points of script ranges; "-" ranges belong to no script
SCRIPTS = [
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "-"),
    (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Canadian"),
    (0x1680, "-"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "-"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "-"), (0x2C60, "Latin"), (0x2C80, "-"), (0x2DE0, "Cyrillic"), (0x2E00, "-"), (0x3040, "Kana"),
    (0x3100, "-"), (0x3130, "Hangul"), (0x3190, "-"), (0x31F0, "Kana"), (0x3200, "-"), (0x3400, "Han"),
    (0x4DC0, "-"), (0x4E00, "Han"), (0xA000, "-"), (0xA640, "Cyrillic"), (0xA6A0, "-"), (0xA720, "Latin"),
    (0xA800, "-"), (0xAC00, "Hangul"), (0xD7B0, "-"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "-"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "-"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0xFFE0, "-"), (0x20000, "Han"), (0x32000, "-"),
]
_NAMES = sorted({s for _, s in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS])
_SCRIPT_OF = np.array([_NAMES.index(s) for _, s in SCRIPTS] + [_NAMES.index("-")])
_U = np.uint64


@functools.lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower case."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            letter[c] = True
            low = s.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return letter, lower


def split_words(texts: list[str]):
    """Words of a list of texts: first and end character (in their text), words per text,
    script of each word, its n-gram buckets (two per letter) and letters per word."""
    letter, lower = _letters()
    sizes = np.array([len(t) for t in texts], np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flag = letter[code]
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    edge = starts[1:-1]
    edge = edge[(edge > 0) & (edge < len(code))]
    first[edge] |= flag[edge]
    last[edge - 1] |= flag[edge - 1]
    at = np.flatnonzero(flag)
    c = lower[code[at]].astype(np.uint64)
    head, tail = first[at], last[at]
    before, after = np.empty_like(c), np.empty_like(c)
    before[1:], after[:-1] = c[:-1], c[1:]
    before[head], after[tail] = 1, 2
    two = before * _U(0x9E3779B97F4A7C15) + c * _U(0xC2B2AE3D27D4EB4F)
    grams = np.empty((len(c), 2), np.int32)
    grams[:, 0] = mix64(two) & _U(GRAMS - 1)
    grams[:, 1] = mix64(two + after * _U(0x165667B19E3779F9) + _U(3)) & _U(GRAMS - 1)
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(begin, starts))
    owner = run_index(counts)
    script = _SCRIPT_OF[np.searchsorted(_STARTS, code[begin], side="right") - 1]
    return begin - starts[owner], end - starts[owner], counts, script, grams, end - begin


def _text_blocks(column, chars: int = 1 << 19):
    """Consecutive texts of a column with about ``chars`` characters at a time."""
    block, size = [], 0
    for text in column.to_pylist():
        block.append(text)
        size += len(text)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


class Model:
    """Log probabilities of n-gram buckets and the languages each script can be."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, least_share: float):
        self.langs = langs
        smooth = counts + 0.5
        self.table = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        possible = (share >= least_share).T
        self.excluded = np.where(possible | ~possible.any(axis=1, keepdims=True), 0, -1e6).astype(np.float32)
        self.known = possible.any(axis=1)

    def word_scores(self, script, grams, letters) -> np.ndarray:
        if not len(letters):
            return np.zeros((0, len(self.langs)), np.float32)
        per_letter = self.table[grams[:, 0]] + self.table[grams[:, 1]]
        begin = np.concatenate([[0], np.cumsum(letters)[:-1]])
        scores = np.add.reduceat(per_letter, begin, axis=0)
        return np.where(self.known[script][:, None], scores + self.excluded[script], 0)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word when every change of label within a text costs ``penalty``.
    All texts take a step together; shorter ones drop out."""
    order = np.argsort(-counts, kind="stable")
    first = (np.concatenate([[0], np.cumsum(counts)[:-1]]))[order]
    alive = len(counts) - np.searchsorted(np.sort(counts), np.arange(counts.max(initial=0)), side="right")
    labels = np.zeros(len(scores), np.int8 if scores.shape[1] < 128 else np.int32)
    came = np.zeros(scores.shape, labels.dtype)
    own = np.arange(scores.shape[1], dtype=labels.dtype)
    best = np.zeros((len(counts), scores.shape[1]), np.float64)
    for t, n in enumerate(alive.tolist()):
        rows = first[:n] + t
        b = best[:n]
        if t:
            top = b.argmax(axis=1)
            change = b[np.arange(n), top] - penalty
            switch = change[:, None] > b
            came[rows] = np.where(switch, top[:, None], own)
            b = np.where(switch, change[:, None], b)
        best[:n] = b + scores[rows]
    state = best.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        rows = first[:n] + t
        labels[rows] = state[:n]
        state[:n] = came[rows, state[:n]] if t else state[:n]
    return labels


def learn(rows: DataFrame, least_share: float = 0.001) -> Model | None:
    """Count n-grams and scripts by language over ``rows(text, lang)``."""
    ship(rows.sparkSession)

    def count(batches):
        grams_of: dict[str, np.ndarray] = {}
        scripts_of: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            at = 0
            for block in _text_blocks(batch.column("text")):
                _, _, counts, script, grams, letters = split_words(block)
                of = np.array(langs[at:at + len(block)])
                at += len(block)
                word_lang = np.repeat(of, counts)
                gram_lang = np.repeat(word_lang, letters)
                for lang in set(of.tolist()):
                    g = np.bincount(grams[gram_lang == lang].reshape(-1), minlength=GRAMS)
                    s = np.bincount(script[word_lang == lang], minlength=len(_NAMES))
                    grams_of[lang] = grams_of.get(lang, 0) + g
                    scripts_of[lang] = scripts_of.get(lang, 0) + s
        for lang, g in grams_of.items():
            parts = [*g.reshape(-1, BLOCK), scripts_of[lang]]
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * len(parts), "part": pa.array(range(len(parts)), pa.int32()),
                "counts": pa.array(parts, pa.list_(pa.int64()))})

    def add(rows: pa.Table) -> pa.Table:
        v = rows.column("counts").combine_chunks()
        total = v.flatten().to_numpy().reshape(len(v), -1).sum(axis=0)
        return pa.table({"lang": rows.column("lang").slice(0, 1), "part": rows.column("part").slice(0, 1),
                         "counts": pa.array([total])})

    schema = "lang string, part int, counts array<long>"
    sums = rows.select("text", "lang").mapInArrow(count, schema).groupBy("lang", "part").applyInArrow(
        add, schema).collect()
    langs = sorted({r["lang"] for r in sums})
    if not langs:
        return None
    counts = np.zeros((len(langs), GRAMS))
    scripts = np.zeros((len(langs), len(_NAMES)))
    for r in sums:
        i = langs.index(r["lang"])
        if r["part"] * BLOCK < GRAMS:
            counts[i, r["part"] * BLOCK:(r["part"] + 1) * BLOCK] = r["counts"]
        else:
            scripts[i] = r["counts"]
    return Model(langs, counts, scripts, least_share)


def label_spans(docs: DataFrame, model: Model | None, penalty: float = 12.0) -> DataFrame:
    """doc_id, lang_pred, score (share of letters in that language) and the spans
    (start and end character, lang) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.array().cast("array<struct<start:bigint,end:bigint,lang:string>>").alias("spans"))
    names = np.array(model.langs)

    def run(batches):
        for batch in batches:
            parts = []
            for block in _text_blocks(batch.column("text")):
                begin, end, counts, script, grams, letters = split_words(block)
                parts.append((begin, end, counts, letters, model.word_scores(script, grams, letters)))
            if not parts:
                continue
            begin, end, counts, letters, scores = (np.concatenate(x) for x in zip(*parts))
            label = viterbi(scores, counts, penalty)
            owner = run_index(counts)
            n = len(counts)
            weight = np.bincount(owner * len(names) + label, weights=letters,
                                 minlength=n * len(names)).reshape(n, len(names))
            total = weight.sum(axis=1)
            best = weight.argmax(axis=1)
            fresh = np.ones(len(label), bool)
            fresh[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
            head = np.flatnonzero(fresh)
            tail = np.append(head[1:], len(label)) - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(begin[head]), pa.array(end[tail] if len(head) else end[:0]), pa.array(names[label[head]])],
                ["start", "end", "lang"])
            per = np.bincount(owner[head], minlength=n)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.where(total > 0, names[best], "und")),
                pa.array(weight[np.arange(n), best] / np.maximum(total, 1)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), spans)],
                ["doc_id", "lang_pred", "score", "spans"])

    return rows.mapInArrow(run, out)


def languages(docs: DataFrame, held_out: Column, penalty: float = 12.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans; learns from the rows not held out."""
    held = F.coalesce(held_out, F.lit(False))
    train = docs.where(~held & F.col("text").isNotNull() & F.col("lang").isNotNull())
    return label_spans(docs, learn(train), penalty).withColumn("held_out", held)
