"""Operator 1: quality scores from a Gaussian kernel over document statistics.

Random Fourier features approximate the kernel: z(x) = sqrt(2 / D) cos(W x + b). Each
partition of the labelled rows sums its part of the normal equations, the sums are added
per matrix row, and the driver solves one (D + 1)-square ridge system. Labelled rows that
the ridge fit has not seen then calibrate its output by isotonic regression over a fixed
number of bins.

Null or empty texts have all statistics 0 and a score like any other. A document with
several labels counts once, with the highest; null labels are skipped. Without usable
labels every score is 0.5. Rows without doc_id are scored and not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WordHasher, run_index, ship, slices, stored, text_bytes

FEATURES = ["log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "exclaim", "stops",
            "other_punctuation", "beyond_ascii", "newlines", "distinct_words", "repeated_neighbours",
            "repeated_second_neighbours", "symbol_words"]
BINS = 512
LOW, HIGH = -0.5, 1.5


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[65:91] = 1
    kind[48:58] = 2
    for chars, k in ((b"#*$%&|<>", 3), (b"!", 4), (b".,;:?", 5), (b"\"'()[]{}/\\-_+=~^`@", 6), (b"\n", 8)):
        kind[list(chars)] = k
    kind[128:] = 7
    return kind


_KIND = _classes()


def document_statistics(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> np.ndarray:
    """One row of FEATURES for each text of a block."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    kind = _KIND[data]
    owner = run_index(size)
    counts = np.bincount(owner * 9 + kind, minlength=9 * n).reshape(n, 9)[:, :9]
    h, begin, end, words = hasher(data, offsets, lower=False)
    word_owner = run_index(words)
    many, bytes_ = np.maximum(words, 1), np.maximum(size, 1)

    def share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(word_owner, weights=flag, minlength=n) / many

    def same_as(step: int) -> np.ndarray:
        flag = np.zeros(len(h))
        if len(h) > step:
            flag[step:] = (h[step:] == h[:-step]) & (word_owner[step:] == word_owner[:-step])
        return flag

    distinct = np.zeros(n)
    if len(h):
        order = np.lexsort((h, word_owner))
        new = np.ones(len(h))
        new[1:] = (h[order][1:] != h[order][:-1]) | (word_owner[order][1:] != word_owner[order][:-1])
        distinct = np.bincount(word_owner[order], weights=new, minlength=n)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(words)
    out[:, 2] = (size - counts[:, 8]) / many
    for j, k in enumerate((1, 2, 3, 4, 5, 6, 7, 8)):
        out[:, 3 + j] = counts[:, k] / bytes_
    out[:, 11] = distinct / many
    out[:, 12], out[:, 13] = share(same_as(1)), share(same_as(2))
    if len(h):
        out[:, 14] = share(((kind[begin] == 3) | (kind[end - 1] == 3)).astype(float))
    out[:, 2] = np.log1p(out[:, 2])
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics vector ``x`` of every row."""
    ship(docs.sparkSession)

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets, 1 << 20):
                x = document_statistics(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], hasher)
                ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1)))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
                       ).mapInArrow(run, "doc_id long, x array<double>")


class KernelRidge:
    """Standardisation, random features, ridge weights and the calibration curve."""

    def __init__(self, mean, scale, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.standard_normal((len(mean), features)) / (width * np.sqrt(len(mean)))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)
        self.curve = (np.array([LOW, HIGH]), np.array([0.5, 0.5]))

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(z), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated; a millionth of the raw score keeps the order inside flat steps."""
        raw = np.clip(self.raw(x), LOW, HIGH)
        return (1 - 1e-6) * np.interp(raw, *self.curve) + 1e-6 * (raw - LOW) / (HIGH - LOW)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("x")
    return col.flatten().to_numpy().reshape(len(col), -1)


def isotonic(total: np.ndarray, ones: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins with ``total`` rows, ``ones`` of them positive, at
    mean raw score ``at``; the blocks' means and rates."""
    blocks: list[list[float]] = []
    for n, y, x in zip(total.tolist(), ones.tolist(), at.tolist()):
        blocks.append([n, y, n * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


def normal_equations(train: DataFrame, model: KernelRidge) -> np.ndarray:
    """Sums of z z' with the target as last column, added up over the partitions."""
    d = len(model.beta)

    def run(batches):
        total = np.zeros((d, d + 1))
        for batch in batches:
            z = model.lift(_matrix(batch))
            y = batch.column("y").to_numpy()
            total[:, :d] += z.T @ z
            total[:, d] += z.T @ y
        if total.any():
            ends = np.arange(0, total.size + 1, d + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d, dtype=np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(total.reshape(-1)))], ["i", "v"])

    def add(rows: pa.Table) -> pa.Table:
        v = rows.column("v").combine_chunks()
        total = v.flatten().to_numpy().reshape(len(v), -1).sum(axis=0)
        return pa.table({"i": rows.column("i").slice(0, 1), "v": pa.array([total])})

    rows = train.select("x", "y").mapInArrow(run, "i int, v array<double>").groupBy("i").applyInArrow(
        add, "i int, v array<double>").collect()
    out = np.zeros((d, d + 1))
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def fit(labelled: DataFrame, calibrate: Column, features: int = 256, width: float = 0.7, ridge: float = 1e-3,
        seed: int = 7) -> KernelRidge:
    """Fit on ``labelled(x, y)``: rows where ``calibrate`` holds go to the isotonic step,
    all others to the ridge system. Only sums leave the executors."""
    ship(labelled.sparkSession)
    flagged = stored(labelled.withColumn("calibrate", calibrate), "quality-training")
    train, held = flagged.where("not calibrate"), flagged.where("calibrate")
    moments = train.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    mean, scale = np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    for r in moments:
        mean[r["j"]], scale[r["j"]] = r["m"], r["s"] if r["s"] and r["s"] > 1e-9 else 1.0
    model = KernelRidge(mean, scale, features, width, seed)
    sums = normal_equations(train, model)
    n = sums[-1, -2]
    if not n:
        return model
    penalty = ridge * n * np.eye(features + 1) / features
    penalty[-1, -1] = 0
    model.beta = np.linalg.solve(sums[:, :-1] + penalty + 1e-9 * np.eye(features + 1), sums[:, -1])

    def bins(batches):
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch)), LOW, HIGH)
            yield pa.RecordBatch.from_pydict({
                "bin": pa.array(np.minimum((raw - LOW) / (HIGH - LOW) * BINS, BINS - 1).astype(np.int32)),
                "raw": pa.array(raw), "y": batch.column("y")})

    table = held.select("x", "y").mapInArrow(bins, "bin int, raw double, y double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"), F.avg("raw").alias("at")).orderBy("bin").collect()
    if table:
        model.curve = isotonic(np.array([r["n"] for r in table], float), np.array([r["ones"] for r in table]),
                               np.array([r["at"] for r in table]))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, calibrate: Column,
                   threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row. ``held_out`` and ``calibrate``
    are conditions on doc_id; held-out labels are never read."""
    stats = stored(statistics(docs), "document-statistics")
    target = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    held = F.coalesce(held_out, F.lit(False))
    model = fit(stats.where(~held).join(target, "doc_id").select("doc_id", "x", "y"), calibrate, **options)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(_matrix(batch)) if batch.num_rows else np.zeros(0))],
                ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
