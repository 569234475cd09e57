"""Approximate k-nearest-neighbour join (F7) over p-stable hash buckets.

A hash function projects a row on a Gaussian direction and cuts the line into cells of equal
width. Each table has its own list of functions, from wide cells to narrow ones; a bucket is a
list of cells of the table's first functions, as many as it takes to hold at most
``bucket_rows`` targets: crowded buckets go on to the next function, so dense regions get long
keys, sparse ones short keys, and the number of rows met by a query does not grow with the
table. A query also visits, per table, the buckets across the ``probes`` cell borders it lies
nearest to. Distances are exact; only which targets are met is up to the hashes.

Cells are computed where they are needed and never stored. The targets of each table are
written once, ordered by bucket, to files on the shared storage; a task has neighbouring
queries and reads the buckets that its slice visits, so nothing is copied per (query, bucket)
and a query leaves its task with its k best only. The driver and the tasks hold the keys of
crowded buckets, at most one for ``bucket_rows`` targets of a table and function.

Rows with equal vectors are searched once, and of equal targets only the ``k`` (+ 1) smallest
IDs can be answers, so copies neither crowd a bucket nor repeat work. What all functions fail
to split is cut by hash into parts that each visitor meets one by one. A query that met fewer
than ``k`` targets is handed to the exact join. The cell widths come from at most
``fit_rows`` targets (drawn by the hash of their ID); every target is indexed.

Null or empty inputs give no rows; ties go to the smaller target ID.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.knn import PARTIAL, PROPOSED, _matrix, _squared, knn
from riskloom.session import cut_lineage, open_output, open_shared, scratch_path, ship

SLICE = 1024
QUERIES = 4096
FILE_ROWS = 1 << 16
FILES = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _widths(sample: np.ndarray, k: int, functions: int) -> np.ndarray:
    """Cell widths of a table's functions, falling from four times the distance that nearly all
    sampled rows have to their k-th neighbour in the sample to four times that of the densest:
    a bucket that stays crowded meets cells of its own scale."""
    some = sample[:512]
    near = np.sort(_squared(some, sample), axis=1)
    away = np.sqrt(near[:, min(k, near.shape[1] - 1)])
    away = away[away > 0]
    if not len(away):
        return np.ones(functions)
    low, high = np.quantile(away, [0.02, 0.98])
    return 4 * np.geomspace(high, low, functions)


class _Cells:
    """Cells of all functions of all tables: ``floor(x . direction + shift)`` in cell widths."""

    def __init__(self, dims: int, widths: np.ndarray, tables: int, seed: int):
        functions = len(widths)
        draw = np.random.default_rng(seed)
        self.tables, self.functions = tables, functions
        self.directions = draw.standard_normal((dims, tables * functions)) / np.tile(widths, tables)
        self.shifts = draw.random(tables * functions)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.directions + self.shifts).reshape(len(x), self.tables, self.functions)


class _Places(NamedTuple):
    """Rows and how their cells are found: for each table their own ones, then those with one
    of the ``probes`` nearest borders among the first ``span`` functions crossed."""
    rows: DataFrame
    cells: _Cells
    probes: int = 0
    span: int = 0


def _target_cells(rows: DataFrame, cells: _Cells) -> _Places:
    return _Places(rows, cells)


def _query_cells(rows: DataFrame, cells: _Cells, probes: int, span: int) -> _Places:
    return _Places(rows, cells, probes, span)


def _cells_at(x: np.ndarray, cells: _Cells, probes: int = 0, span: int = 0) -> np.ndarray:
    """(rows, tables, 1 + probes, functions) cells."""
    at = cells(x)
    low = np.floor(at)
    part = (at - low)[:, :, :span]
    order = np.argsort(np.minimum(part, 1 - part), axis=2)[:, :, :probes]
    out = np.repeat(low.astype(np.int64)[:, :, None, :], 1 + order.shape[2], axis=2)
    if order.shape[2]:
        step = np.where(np.take_along_axis(part, order, 2) < 0.5, -1, 1)
        row, table, probe = np.indices(order.shape)
        out[row, table, probe + 1, order] += step
    return out


def _mix(key: np.ndarray, value) -> np.ndarray:
    """Hash of a key that goes on with ``value``, equal in every task."""
    z = key + np.asarray(value).astype(np.uint64) * _ODD
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _walk(at: np.ndarray, split: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Depth by depth the places (numbers into the flattened cells) that are not settled yet,
    their keys and parts: 0 for a bucket that goes on, -1 for one that is not crowded."""
    flat = at.reshape(-1, at.shape[-1])
    table = np.broadcast_to(np.arange(at.shape[1])[:, None], at.shape[:3]).reshape(-1)
    place = np.arange(len(flat))
    key = _mix(np.ones(len(flat), np.uint64), table)
    for depth in range(flat.shape[1]):
        key = _mix(key, flat[place, depth])
        parts = np.full(len(key), -1)
        if depth < len(split) and len(split[depth][0]):
            keys, many = split[depth]
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            parts = np.where(keys[spot] == key, many[spot], -1)
        yield place, key, parts
        place, key = place[parts == 0], key[parts == 0]
        if not len(place):
            return


def _counts(places: _Places, split: list, depths: range) -> DataFrame:
    """(depth, key, n): targets of the buckets at ``depths`` below crowded ones, of a batch."""
    rows, cells = places.rows, places.cells
    ahead = split + [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * (depths.start - len(split))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found: dict = {d: [] for d in depths}
            for s in range(0, len(f), SLICE):
                at = _cells_at(_matrix(f["features"].iloc[s:s + SLICE]), cells)
                for depth, (place, key, _) in enumerate(_walk(at, ahead)):
                    if depth < depths.start:
                        continue
                    flat = at.reshape(-1, at.shape[-1])
                    found[depth].append(key)
                    for d in depths[1:]:
                        key = _mix(key, flat[place, d])
                        found[d].append(key)
            for d in depths:
                key, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found[d]]), return_counts=True)
                yield pd.DataFrame({"depth": np.full(len(key), d, np.int32), "key": key.view(np.int64), "n": n})
    return rows.select("features").mapInPandas(run, "depth int, key long, n long")


def _buckets(places: _Places, functions: int, bucket_rows: int):
    """(ID, unit, features) of every target and table, and by depth the keys that are no unit
    of their own with their parts: 0 for a bucket that goes on, else its number of parts."""
    split: list = []
    while len(split) < functions and (not split or len(split[-1][0])):
        depths = range(len(split), min(len(split) + 3, functions))
        crowded = _counts(places, split, depths).groupBy("depth", "key").agg(F.sum("n").alias("n")).where(
            F.col("n") > bucket_rows).toArrow()
        depth, key, n = (crowded.column(c).to_numpy() for c in ("depth", "key", "n"))
        for d in depths:
            here = key[depth == d].view(np.uint64)
            order = np.argsort(here)
            parts = -(-n[depth == d] // bucket_rows) if d == functions - 1 else np.zeros(len(here), np.int64)
            split.append((here[order], parts[order]))
    shared, cells = places.rows.sparkSession.sparkContext.broadcast(split), places.cells

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in range(0, len(f), SLICE):
                g = f.iloc[s:s + SLICE]
                at = _cells_at(_matrix(g["features"]), cells)
                unit, row = np.zeros(len(g) * cells.tables, np.uint64), np.repeat(np.arange(len(g)), cells.tables)
                ids = g["ID"].to_numpy("int64")
                for place, key, parts in _walk(at, shared.value):
                    dealt = _mix(np.full(len(key), 3, np.uint64), ids[row[place]]) % np.maximum(parts, 1).astype(np.uint64)
                    unit[place] = np.where(parts > 0, _mix(key, dealt), key)
                yield pd.DataFrame({"ID": ids[row], "unit": unit.view(np.int64), "features": g["features"].iloc[row].to_numpy()})
    return places.rows.select("ID", "features").mapInPandas(run, "ID long, unit long, features array<double>"), split


def _visited(at: np.ndarray, split: list) -> tuple[np.ndarray, np.ndarray]:
    """(row, unit): the units that queries with these cells visit, each once."""
    each = at.shape[1] * at.shape[2]
    rows, units = [], []
    for place, key, parts in _walk(at, split):
        whole = parts < 0
        rows.append(place[whole] // each)
        units.append(key[whole])
        for i in np.flatnonzero(parts > 0):
            rows.append(np.full(parts[i], place[i] // each))
            units.append(_mix(np.full(parts[i], key[i]), np.arange(parts[i])))
    row, unit = np.concatenate(rows), np.concatenate(units).view(np.int64)
    order = np.lexsort((row, unit))
    row, unit = row[order], unit[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (np.diff(row) != 0) | (unit[1:] != unit[:-1])
    return row[fresh], unit[fresh]


def _visits(places: _Places, split: list) -> DataFrame:
    """(ID, unit): the units that queries visit."""
    rows, cells, probes, span = places

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in range(0, len(f), SLICE):
                g = f.iloc[s:s + SLICE]
                row, unit = _visited(_cells_at(_matrix(g["features"]), cells, probes, span), split)
                yield pd.DataFrame({"ID": g["ID"].to_numpy("int64")[row], "unit": unit})
    return rows.select("ID", "features").mapInPandas(run, "ID long, unit long")


def _write_file(folder: str):
    """Units side by side in one file (per row its ID and vector), their first rows in another."""
    def close(file, out, path, units, n):
        out.close()
        unit, first = np.unique(np.concatenate(units), return_index=True)
        with open_output(path + ".units") as index:
            index.write(np.concatenate([unit, first, [n]]).astype(np.int64).tobytes())
        return pd.DataFrame({"file": [file], "path": [path], "n": [len(unit)]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file = out = path = None
        units, n = [], 0
        for f in frames:
            number = f["file"].to_numpy()
            for a, b in _runs(number):
                if number[a] != file:
                    if out is not None:
                        yield close(file, out, path, units, n)
                    file, units, n = int(number[a]), [], 0
                    path = f"{folder}/{file}-{TaskContext.get().taskAttemptId()}"
                    out = open_output(path)
                x = _matrix(f["features"].iloc[a:b])
                out.write(np.column_stack([f["ID"].iloc[a:b].to_numpy("int64").view(np.float64), x]).tobytes())
                units.append(f["unit"].iloc[a:b].to_numpy("int64"))
                n += b - a
        if out is not None:
            yield close(file, out, path, units, n)
    return run


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return ((a, b) for a, b in zip(edges, edges[1:]) if a < b)


class _Units:
    """Reads units from their files, each opened when first needed."""

    def __init__(self, files: dict, many: int, dims: int):
        self.files, self.many, self.dims, self.open = files, many, dims, {}

    def __call__(self, unit: int):
        number = int(unit % self.many)
        if number not in self.files:
            return None
        if number not in self.open:
            path, n = self.files[number]
            with open_shared(path + ".units") as f:
                index = np.frombuffer(f.read_buffer(), np.int64).copy()
            self.open[number] = index[:n], index[n:], open_shared(path)
        units, first, source = self.open[number]
        at = int(np.searchsorted(units, unit))
        if at == len(units) or units[at] != unit:
            return None
        row = 8 * (self.dims + 1)
        source.seek(int(first[at]) * row)
        m = np.frombuffer(source.read_buffer(int(first[at + 1] - first[at]) * row), np.float64).reshape(-1, self.dims + 1)
        return m[:, 0].copy().view(np.int64), m[:, 1:]


def _exact(tx: np.ndarray, j: np.ndarray, x: np.ndarray, i: np.ndarray) -> np.ndarray:
    diff = tx[j] - x[i]
    return np.einsum("jk,jk->j", diff, diff)


def _best(x: np.ndarray, row: np.ndarray, unit: np.ndarray, units, k: int):
    """(row, nid, dist2): the k best targets in the units that each row of ``x`` visits. A
    matrix product proposes, exact distances decide."""
    norm, bound = (x * x).sum(1), np.full(len(x), np.inf)
    rows, nids, dists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for a, b in _runs(unit):
        got = units(unit[a])
        if got is None:
            continue
        tid, tx = got
        r = row[a:b]
        near = _squared(x[r], tx)
        # what rounding can move a proposed distance by, both of a pair
        slack = 1e-14 * (8 + x.shape[1]) * (norm[r] + (tx * tx).sum(1).max())
        # each of the n rows of a repeated ID takes n places of the unit's list
        repeats = (np.diff(tid) == 0).any()
        limit = bound[r]
        if len(tid) >= k:
            limit = np.minimum(limit, np.partition(near, k - 1, axis=1)[:, k - 1] + slack)
            if not repeats:
                bound[r] = limit
        i, j = np.nonzero(near <= (limit + slack)[:, None])
        d = np.concatenate([np.zeros(0), *(_exact(tx, j[s:s + PROPOSED], x, r[i[s:s + PROPOSED]]) for s in range(0, len(i), PROPOSED))])
        if repeats:
            times = (np.searchsorted(tid, tid, "right") - np.searchsorted(tid, tid))[j]
            i, j, d = (np.repeat(v, times) for v in (i, j, d))
            order = np.lexsort((tid[j], d, i))
            order = order[np.arange(len(i)) - np.searchsorted(i[order], i[order]) < k]
            i, j, d = i[order], j[order], d[order]
        rows.append(r[i])
        nids.append(tid[j])
        dists.append(d)
    row, nid, dist = (np.concatenate(v) for v in (rows, nids, dists))
    order = np.lexsort((nid, dist, row))
    row, nid, dist = row[order], nid[order], dist[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (np.diff(row) != 0) | (np.diff(nid) != 0) | (dist[1:] != dist[:-1])
    row, nid, dist = row[fresh], nid[fresh], dist[fresh]
    few = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[few], nid[few], dist[few]


def _met(queries: _Places, units: DataFrame, split: list, k: int, n_queries: int, n_units: int) -> DataFrame:
    """The k best targets in the units that each query visits."""
    rows, cells, probes, span = queries
    spark = ship(rows.sparkSession)
    many = max(1, min(FILES, -(-n_units // FILE_ROWS)))
    folder = scratch_path(spark, "lsh-units")
    written = units.withColumn("file", F.pmod("unit", F.lit(many)).cast("int")).repartition(many, "file").sortWithinPartitions(
        "file", "unit", "ID").select("file", "unit", "ID", "features").mapInPandas(
        _write_file(folder), "file int, path string, n int").collect()
    shared = spark.sparkContext.broadcast((split, {r["file"]: (r["path"], r["n"]) for r in written}))
    dims = len(cells.directions)

    def home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(home=list(_cells_at(_matrix(f["features"]), cells)[:, 0, 0, :span]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, files = shared.value
        read = _Units(files, many, dims)
        for f in frames:
            for s in range(0, len(f), SLICE):
                x, ids = _matrix(f["features"].iloc[s:s + SLICE]), f["ID"].iloc[s:s + SLICE].to_numpy("int64")
                row, nid, dist = _best(x, *_visited(_cells_at(x, cells, probes, span), split), read, k)
                yield pd.DataFrame({"qid": ids[row], "nid": nid, "dist2": dist})
    # neighbouring queries lie side by side, so that the slices of a task share units
    dealt = rows.select("ID", "features").mapInPandas(home, "ID long, features array<double>, home array<long>")
    return dealt.repartitionByRange(max(1, -(-n_queries // QUERIES)), "home", "ID").sortWithinPartitions("home", "ID").select(
        "ID", "features").mapInPandas(run, PARTIAL)


def knn_lsh(queries: DataFrame, targets: DataFrame, k: int, exclude_self: bool = True, tables: int = 8,
            functions: int = 32, probes: int = 4, bucket_rows: int = 512, fit_rows: int = 4096,
            seed: int = 0) -> DataFrame:
    """(qid, nid, dist2, rank), as ``knn`` but with the neighbours that the buckets meet.

    More ``tables``, ``probes`` or ``bucket_rows`` raise recall and cost.
    """
    both = [df.select(F.col("ID").cast("long").alias("ID"), F.col("features").cast("array<double>").alias("features"))
            .where("ID is not null and features is not null") for df in (queries, targets)]
    wanted = k + exclude_self
    copies = Window.partitionBy("features").orderBy("ID")
    t = cut_lineage(both[1].withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= wanted).drop("copy"))
    q = cut_lineage(both[0].select("features").distinct().select(
        F.monotonically_increasing_id().alias("ID"), "features"))
    sample = t.orderBy(F.xxhash64("ID", F.lit(7)), "ID").limit(fit_rows).select("features").collect()
    if not sample:
        return knn(queries, targets, k, exclude_self)
    rows = np.array([r["features"] for r in sample], "float64")
    cells = _Cells(rows.shape[1], _widths(rows, k, functions), tables, seed)

    units, split = _buckets(_target_cells(t, cells), functions, bucket_rows)
    found = cut_lineage(_met(_query_cells(q, cells, probes, span=12), units, split, wanted, q.count(), t.count() * tables))
    few = cut_lineage(q.join(found.groupBy(F.col("qid").alias("ID")).agg(F.count(F.lit(1)).alias("n")), "ID", "left").where(
        F.coalesce("n", F.lit(0)) < wanted).drop("n"))
    if not few.isEmpty():
        rest = knn(few, t, wanted, exclude_self=False).drop("rank")
        found = found.join(few.select(F.col("ID").alias("qid")), "qid", "left_anti").unionByName(rest)

    same = both[0].join(q.select(F.col("ID").alias("same"), "features"), "features").select("ID", "same")
    out = same.join(found, F.col("same") == F.col("qid")).select(F.col("ID").alias("qid"), "nid", "dist2")
    if exclude_self:
        out = out.where("qid <> nid")
    best = Window.partitionBy("qid").orderBy("dist2", "nid")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
