"""Operator 8: best-fit packing of token sequences with certified bin counts.

Documents become pieces of at most ``capacity`` ids. Pieces shorter than a bin are dealt
to groups of a fixed expected size; each group is packed by best-fit decreasing, and
dual-feasible functions bound from below how many bins its lengths need. Bins that are
not full, from groups above their bound and the last bin of every other group, give
their pieces to the next round, where fewer groups mix them anew. Rounds end when the
pieces still open are packed in as many bins as their own bound allows, or no longer
shrink.

An empty table gives an empty table; a null or empty text is one piece with the end id.
Repeated rows are packed as often as they occur. Null doc_ids stay null.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship, stored
from riskloom.llm.encode import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def lower_bound(histogram: np.ndarray, capacity: int, splits: int = 24) -> int:
    """Least number of bins for ``histogram[length]`` pieces of each length, by the best of
    two families of dual-feasible functions: one drops pieces below a cut and counts those
    above its complement as whole bins; the other rounds multiples of capacity / (k + 1)."""
    size = np.flatnonzero(histogram)
    if not len(size):
        return 0
    many = histogram[size].astype(np.int64)
    best = -(-int((size * many).sum()) // capacity)
    for cut in np.unique(np.concatenate([size[size <= capacity // 2], [0]])):
        value = np.where(size > capacity - cut, capacity, np.where(size < cut, 0, size))
        best = max(best, -(-int((value * many).sum()) // capacity))
    for k in range(1, splits + 1):
        whole = (size * (k + 1)) % capacity == 0
        value = np.where(whole, size * k, (size * (k + 1) // capacity) * capacity)
        best = max(best, -(-int((value * many).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and each bin's fill. A bit set of the free space of
    open bins finds the tightest bin that still fits."""
    order = np.argsort(-length, kind="stable")
    bin_of = np.empty(len(length), np.int64)
    offset = np.empty(len(length), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i, n in zip(order.tolist(), length[order].tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += n
        room -= n
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bin_of, offset, np.array(fill, np.int64)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int,
                 keep_ids: bool = False) -> DataFrame:
    """The pieces of each document: whole, or cut every ``capacity`` ids if longer."""
    def cut(batches):
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys = part.column("doc_id").to_pylist()
                rows = [(k, p // step, p // 4, ids[p:p + step])
                        for k, ids in zip(keys, encoder(tokenizer_path).encode(part.column("text").to_pylist()))
                        for ids in [ids + end] for p in range(0, len(ids), step)]
                doc, piece, start, raw = zip(*rows) if rows else ((), (), (), ())
                out = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array([len(x) // 4 for x in raw], pa.int64()),
                       pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    out.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    ship(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return src.mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))


def _repack(round_no: int, capacity: int):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        length = rows["length"].to_numpy()
        bin_of, offset, fill = best_fit_decreasing(length, capacity)
        bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        loose = fill < capacity
        if len(fill) == bound:  # certified: only what the last bin leaves free can still be won
            loose &= fill == fill.min()
        base = (round_no << 56) | (int(key[0]) << 28)
        return rows.drop(columns="g").assign(sequence_id=base + bin_of, offset=offset, open=loose[bin_of])
    return pack


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048,
                   keep_ids: bool = False, group_pieces: int = 40_000, rounds: int = 5) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``. ``group_pieces`` is the expected
    number of pieces one task packs at a time, so its memory does not grow with the table."""
    pieces = stored(token_pieces(docs, tokenizer_path, end_id, capacity, keep_ids), "pieces")
    full = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62)), "offset": F.lit(0).cast("long")})
    done = [full]
    left = pieces.where(F.col("length") < capacity)
    schema = (PIECES + (", ids binary" if keep_ids else "")
              + ", sequence_id long, offset long, open boolean")
    fewest = None
    for r in range(rounds):
        n, bins, bound = _standing(left, capacity, r)
        if r and (bins == bound or (fewest is not None and bins >= fewest)):
            break
        fewest = bins if r else None
        groups = max(1, -(-n // group_pieces))
        dealt = left.drop("sequence_id", "offset", "open").withColumn(
            "g", F.pmod(F.xxhash64(F.lit(r), "doc_id", "piece", "ids_crc32", "length"), F.lit(groups)))
        packed = stored(dealt.groupBy("g").applyInPandas(_repack(r, capacity), schema), f"packed-{r}")
        done.append(packed.where(~F.col("open")).drop("open"))
        left = packed.where("open")
    done.append(left.drop("open"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _standing(left: DataFrame, capacity: int, r: int) -> tuple[int, int, int]:
    """Pieces that are open, the bins they take, and the bound for all of them together.
    The histogram has at most ``capacity`` rows."""
    rows = left.groupBy("length").count().collect()
    histogram = np.zeros(capacity + 1, np.int64)
    for x in rows:
        histogram[x["length"]] = x["count"]
    bins = left.where("offset = 0").count() if r else 0
    return int(histogram.sum()), bins, lower_bound(histogram, capacity)
