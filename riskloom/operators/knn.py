"""Exact k-nearest-neighbour join (F7) that skips blocks by distance bounds.

Targets are dealt to blocks by their nearest pivot (target rows drawn by hash, one for every
``rows_per_block`` targets, at most ``pivots``, which bounds what the driver and each task
hold); a block with more rows is split into units by hash, so a unit has a bounded size
whatever the data looks like. Each unit is one file on the shared storage, so nothing is
copied per query: what is stored follows the rows, not the pairs. A task has queries of
neighbouring blocks. A query first meets its own block, which bounds the distance of its
k-th neighbour; by the triangle inequality a block whose pivot is farther than that bound plus
the block's radius holds no neighbour, and the bound tightens with every unit met. Ties go to
the smaller target ID.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import cut_lineage, open_output, read_shared, scratch_path, ship

PARTIAL = "qid long, nid long, dist2 double"
SLICE = 512
PROPOSED = 1 << 17
TILE = 1 << 18


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype("float64")


def _squared(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.maximum((q * q).sum(1)[:, None] + (t * t).sum(1)[None, :] - 2 * q @ t.T, 0)


def _nearest(k: int, exclude_self: bool, slice_rows: int = 256):
    """The k best targets of each query of a group. A matrix product proposes, exact
    distances decide; a query whose proposals are too close to call gets all of them."""
    spare = 8

    def ranked(qx: np.ndarray, tx: np.ndarray, near: np.ndarray, pick: np.ndarray):
        """Places and exact distances of the best among ``pick`` (ascending in each row)."""
        diff = tx[pick] - qx[:, None, :]
        exact = np.einsum("ijk,ijk->ij", diff, diff)
        exact[np.isinf(np.take_along_axis(near, pick, 1))] = np.inf
        best = np.argsort(exact, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(pick, best, 1), np.take_along_axis(exact, best, 1)

    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        qids, nids, dists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(q) and len(t):
            t = t.sort_values("ID", kind="stable")
            tx, tid = _matrix(t["features"]), t["ID"].to_numpy("int64")
            qx_all, qid_all = _matrix(q["features"]), q["ID"].to_numpy("int64")
            scale = 1e-9 * (1 + (tx * tx).sum(1).max())
            want = min(k + spare, len(tid))
            everything = np.arange(len(tid))
            for s in range(0, len(qid_all), slice_rows):
                qx, qid = qx_all[s:s + slice_rows], qid_all[s:s + slice_rows]
                near = _squared(qx, tx)
                if exclude_self:
                    near[qid[:, None] == tid[None, :]] = np.inf
                pick = np.sort(np.argpartition(near, want - 1, axis=1)[:, :want], axis=1)
                place, exact = ranked(qx, tx, near, pick)
                if want < len(tid):
                    proposed = np.sort(np.take_along_axis(near, pick, 1), axis=1)
                    slack = scale + 1e-9 * (qx * qx).sum(1)
                    for i in np.flatnonzero(proposed[:, -1] <= proposed[:, min(k, want) - 1] + slack):
                        place[i], exact[i] = (x[0] for x in ranked(qx[i:i + 1], tx, near[i:i + 1], everything[None, :]))
                there = np.isfinite(exact)
                qids.append(np.repeat(qid, there.sum(1)))
                nids.append(tid[place[there]])
                dists.append(exact[there])
        return pd.DataFrame({"qid": np.concatenate(qids), "nid": np.concatenate(nids), "dist2": np.concatenate(dists)})
    return run


def _meet(queries: DataFrame, targets: DataFrame, k: int, exclude_self: bool, rows_per_block: int) -> DataFrame:
    """Partial lists of (unit, ID, features) queries against the targets of their unit."""
    share = queries.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("parts"))
    q = queries.join(share, "unit").withColumn("part", F.pmod(F.xxhash64("ID", F.lit(1)), F.col("parts")).cast("int"))
    t = targets.join(share, "unit").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return q.select("unit", "part", "ID", "features").groupBy("unit", "part").cogroup(
        t.select("unit", "part", "ID", "features").groupBy("unit", "part")).applyInPandas(_nearest(k, exclude_self), PARTIAL)


def _placed(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """ID, features, block (nearest pivot) and the distance to that pivot."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = _matrix(f["features"])
                block = np.concatenate([_squared(x[s:s + 1024], pivots).argmin(1) for s in range(0, len(x), 1024)])
                yield f.assign(block=block, near=np.sqrt(((x - pivots[block]) ** 2).sum(1)))
    return rows.select(F.col("ID").cast("long").alias("ID"), F.col("features").cast("array<double>").alias("features")
                       ).mapInPandas(run, "ID long, features array<double>, block int, near double")


def _write_unit(folder: str, keep: int):
    """A file of one unit: IDs ascending, then vectors. Of equal vectors the rows of the
    ``keep`` smallest IDs suffice, as ties go to the smaller one."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ID", kind="stable")
        x, ids = np.ascontiguousarray(_matrix(rows["features"])), rows["ID"].to_numpy("int64")
        same = pd.Series(np.unique(x.view(f"V{8 * x.shape[1]}").ravel(), return_inverse=True)[1]) if x.shape[1] else pd.Series(np.zeros(len(x), int))
        first = ~pd.DataFrame({"same": same, "ID": ids}).duplicated().to_numpy()
        rank = pd.Series(first.astype(int)).groupby(same).cumsum().to_numpy()
        x, ids = x[rank <= keep], ids[rank <= keep]
        path = f"{folder}/{rows['unit'].iloc[0]}-{TaskContext.get().taskAttemptId()}"
        with open_output(path) as out:
            out.write(ids.tobytes())
            out.write(x.tobytes())
        return pd.DataFrame({"block": rows["block"].iloc[:1], "path": [path], "n": [len(ids)]})
    return run


def _read_unit(path: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    data = read_shared(path)
    return np.frombuffer(data, np.int64, n), np.frombuffer(data, np.float64, offset=8 * n).reshape(n, -1)


def _rough(q: np.ndarray, t: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Squared distances of a few queries at a time, each with what may be added to a bound so
    that nothing within it is missed. One product of single-precision rows gives a tile that stays
    in a core's cache; rows are taken from the targets' mean, as the error follows their norms. What does not
    fit single precision is measured in double."""
    with np.errstate(over="ignore", invalid="ignore"):
        mean = t.mean(0)
        a, b = q - mean, t - mean
        na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        most = max(na.max(initial=0), nb.max(initial=0))
        far = (np.sqrt(mean @ mean) + np.sqrt(most)) ** 2
    n, f = t.shape
    size = max(1, TILE // max(n, 1))
    runs = [slice(s, min(s + size, len(q))) for s in range(0, len(q), size)]
    if not (1e-12 < most and far < 1e30):
        norm, top = (q * q).sum(1), (t * t).sum(1).max()
        for run in runs:
            yield run, _squared(q[run], t), 4e-9 * (1 + top + norm[run])
        return
    # every term of a product has the error of about (columns + 8) roundings of 2^-24, before and after
    slack = (4 * (f + 8) * 2.0 ** -24) * (na + nb.max()) + 1e-9 * far
    left, right = np.empty((len(q), f + 2), np.float32), np.empty((f + 2, n), np.float32)
    left[:, :f], left[:, f], left[:, f + 1] = -2 * a, 1, na
    right[:f], right[f], right[f + 1] = b.T, nb, 1
    room = np.empty((min(size, len(q)), len(t)), np.float32)
    for run in runs:
        yield run, np.matmul(left[run], right, out=room[:run.stop - run.start]), slack[run]


class _Best:
    """The k nearest targets met so far by each query of a slice; ``bound``: the k-th distance."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, k: int, exclude_self: bool):
        self.q, self.ids, self.k, self.exclude_self = q, ids, k, exclude_self
        self.row, self.nid, self.dist = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.bound = np.full(len(q), np.inf)
        self.norm = (q * q).sum(1)

    def meet(self, rows: np.ndarray, tid: np.ndarray, tx: np.ndarray) -> None:
        """A matrix product proposes targets for ``rows``, exact distances decide."""
        bound = self.bound[rows]
        own = np.searchsorted(tid, self.ids[rows]) if self.exclude_self else None
        i, j = [], []
        for run, near, slack in _rough(self.q[rows], tx):
            if self.exclude_self:
                at = own[run]
                for r in np.flatnonzero((at < len(tid)) & (tid[np.minimum(at, len(tid) - 1)] == self.ids[rows[run]])):
                    near[r, tid == self.ids[rows[run.start + r]]] = np.inf
            limit = bound[run]
            fresh = np.flatnonzero(np.isinf(limit))
            if len(fresh) and len(tid) > self.k:
                limit[fresh] = np.partition(near[fresh], self.k - 1, axis=1)[:, self.k - 1]
            with np.errstate(over="ignore"):
                limit = (limit + slack).astype(near.dtype)
            at = np.flatnonzero(near <= limit[:, None])
            at = at[np.isfinite(near.ravel()[at])]
            r, c = np.divmod(at, len(tid))
            i.append(r + run.start)
            j.append(c)
        i, j = np.concatenate(i), np.concatenate(j)
        for s in range(0, len(i), PROPOSED):
            r, c = rows[i[s:s + PROPOSED]], j[s:s + PROPOSED]
            diff = tx[c] - self.q[r]
            self._merge(r, tid[c], np.einsum("jk,jk->j", diff, diff))

    def _merge(self, row, nid, dist) -> None:
        better = dist <= self.bound[row]
        row, nid, dist = (np.concatenate(x) for x in ((self.row, row[better]), (self.nid, nid[better]), (self.dist, dist[better])))
        order = np.lexsort((nid, dist, row))
        row, nid, dist = row[order], nid[order], dist[order]
        start = np.searchsorted(row, np.arange(len(self.q)))
        place = np.arange(len(row)) - start[row]
        self.row, self.nid, self.dist = (x[place < self.k] for x in (row, nid, dist))
        last = place == self.k - 1
        self.bound[row[last]] = dist[last]


def _reachable(queries: DataFrame, centres: np.ndarray, radius: np.ndarray, units: list, k: int, exclude_self: bool) -> DataFrame:
    """The k nearest of every query, one slice of queries of a block at a time: blocks come by
    distance, those beyond a query's bound are skipped, and one unit is held at a time."""
    shared = queries.sparkSession.sparkContext.broadcast((centres, radius, units))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, radius, units = shared.value
        for f in frames:
            block = f["block"].to_numpy()
            for s in _slices(block, SLICE):
                x, ids = _matrix(f["features"].iloc[s]), f["ID"].iloc[s].to_numpy("int64")
                away = np.sqrt(((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)) if len(centres) * x.size < 1e7 \
                    else np.sqrt(_squared(x, centres))
                slack = 1e-6 * (1 + np.abs(x).max(initial=0))
                best = _Best(x, ids, k, exclude_self)
                least = away - radius - slack
                own = block[s.start]
                for b in [own, *(c for c in np.argsort(away.min(axis=0), kind="stable") if c != own)]:
                    for path, n in units[b]:
                        rows = np.flatnonzero(least[:, b] <= np.sqrt(best.bound))
                        if not len(rows):
                            break
                        best.meet(rows, *_read_unit(path, n))
                yield pd.DataFrame({"qid": ids[best.row], "nid": best.nid, "dist2": best.dist})
    return queries.select("ID", "features", "block").mapInPandas(run, PARTIAL)


def _slices(block: np.ndarray, rows: int) -> Iterator[slice]:
    """Runs of equal blocks, at most ``rows`` long."""
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    for a, b in zip(edges, edges[1:]):
        for s in range(a, b, rows):
            yield slice(s, min(b, s + rows))


def knn(queries: DataFrame, targets: DataFrame, k: int, exclude_self: bool = True,
        rows_per_block: int = 4000, pivots: int = 4096) -> DataFrame:
    """(qid, nid, dist2, rank) — the k nearest targets of every query row.

    Both inputs have ``ID`` and ``features`` (array<double>). ``exclude_self`` drops
    the pair with equal IDs (neighbours of a row within its own set). ``rows_per_block``
    bounds the targets that a task holds at a time. What is stored follows rows; the work,
    where bounds rule out little, follows queries x targets: see ``lsh.knn_lsh``.
    """
    spark = ship(targets.sparkSession)
    one = queries is targets
    targets = cut_lineage(targets.select("ID", "features"))
    n = targets.count()
    if not n:
        return spark.createDataFrame([], PARTIAL + ", rank int")
    queries = targets if one else cut_lineage(queries.select("ID", "features"))
    blocks = max(1, min(pivots, -(-n // rows_per_block)))
    drawn = targets.orderBy(F.xxhash64("ID", F.lit(7)), "ID").limit(blocks).select("features").collect()
    centres = np.array([r["features"] for r in drawn], "float64").reshape(len(drawn), -1)
    placed = _placed(targets, centres)
    stats = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("near").alias("radius")).collect()
    radius, many = np.zeros(len(centres)), np.ones(len(centres), np.int64)
    for r in stats:
        radius[r["block"]], many[r["block"]] = r["radius"], -(-r["n"] // rows_per_block)
    first = np.concatenate([[0], np.cumsum(many)])

    # a crowded block is split by hash, so a unit has a bounded size whatever the data looks like
    number = F.array(*[F.lit(int(x)) for x in first])
    unit = F.element_at(number, F.col("block") + 1) + F.pmod(
        F.xxhash64("ID"), F.element_at(number, F.col("block") + 2) - F.element_at(number, F.col("block") + 1))
    folder = scratch_path(spark, "knn-units")
    written = placed.withColumn("unit", unit).groupBy("unit").applyInPandas(
        _write_unit(folder, k + bool(exclude_self)), "block int, path string, n long").collect()
    units: list = [[] for _ in centres]
    for r in sorted(written, key=lambda r: r["path"]):
        units[r["block"]].append((r["path"], r["n"]))

    # queries of a block lie side by side; a task has about as many as a unit has targets
    count = n if one else queries.count()
    dealt = _placed(queries, centres).withColumn("h", F.xxhash64("ID")).repartitionByRange(
        max(1, -(-count // rows_per_block)), "block", "h").sortWithinPartitions("block", "h")
    partial = cut_lineage(_reachable(dealt, centres, radius, units, k, exclude_self))
    w = Window.partitionBy("qid").orderBy("dist2", "nid")
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
