"""Operator 5: remove repeated passages by sorted suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with
a smaller doc_id. The suffixes that are sorted start at anchors: the ``GRAM``-byte strings
whose hash is the least of some window of ``length`` bytes. Every window holds an anchor,
and equal windows hold equal anchors, so each repeat shows up at its anchors.

1. Documents are stored in chunk files on the shared storage (the attempt of a task is part
   of a file's name, and only files of finished tasks are listed). Each chunk sends the fingerprints of its anchors to
   buckets by hash range; a bucket answers which anchors occur in two documents, and which are crowded.
2. A chunk sends the bytes around such anchors to the anchor's bucket. Equal surroundings
   in one chunk travel once, with their smallest doc_id. Near a passage's edges the bytes
   around an anchor differ from document to document, so anchors that occur more than
   ``crowd`` times do not gather at one bucket: each window that holds one goes, as a 128-bit
   hash, to a bucket of its own hash. Equal windows of a chunk travel once.
3. The bucket sorts the suffixes at its anchors (and the reversed prefixes) by
   deep-shallow sorting: multikey quicksort on eight-byte symbols to a shallow depth, then
   a blind trie for each group that still shares its prefix. Common prefix lengths of
   neighbours give, for every window around an anchor, the entries that hold it, hence
   its smallest doc_id. Hashed windows are grouped by their hash.
4. The chunks mark the windows that occur in a smaller doc_id and cut their bytes.

Texts shorter than ``length`` lose nothing. Rows with the same doc_id do not remove each
other's text; null doc_ids come after all others. Every input row gives one output row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from riskloom.llm.common import (NO_ID, mix64, open_output, read_shared, scratch_path, ship, slices, stored,
                                 text_bytes)

GRAM = 24
SHALLOW = 32  # bytes that multikey quicksort looks at before blind tries take over
OFTEN = 8  # occurrences of an anchor in a chunk that the chunk reports
_U = np.uint64


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` elements."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a run of texts."""
    places, hashes = [], []
    for a, b in slices(offsets, 1 << 19):
        lo, hi = int(offsets[a]), int(offsets[b])
        n = hi - lo
        if n < length:
            continue
        padded = np.zeros(n + 8, np.uint8)
        padded[:n] = data[lo:hi]
        word = np.ndarray((n,), "<u8", padded.data, strides=(1,)).astype(np.uint64)
        m = n - GRAM + 1
        h = word[:m] * _U(0x9E3779B97F4A7C15)
        h += word[8:8 + m] * _U(0xC2B2AE3D27D4EB4F)
        h += word[16:16 + m] * _U(0x165667B19E3779F9)
        h = mix64(h) | _U(1)
        width = length - GRAM + 1
        least = _slide(h, width, np.minimum)  # one per window start 0 .. n - length
        ends = offsets[a + 1:b + 1] - lo
        for e in ends[:-1]:  # windows that cross into the next text
            least[max(0, e - length + 1):e] = 0
        reach = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        reach[width - 1:width - 1 + len(least)] = least
        chosen = np.flatnonzero(_slide(reach, width, np.maximum) == h)
        places.append(chosen + lo)
        hashes.append(mix64(h[chosen] ^ _U(0x632BE59BD9B4E019)))  # minima are small; spread them evenly
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


# ------------------------------------------------------------------ deep-shallow sorting


class _BlindTrie:
    """Orders distinct equal-length byte strings. A node is [depth, leaf, children]; a
    descent looks only at the byte of each node's depth, then one comparison with the
    leaf it reaches shows where the new string branches off."""

    def __init__(self, first: bytes, value: int):
        self.root = [len(first), (first, value), None]

    def insert(self, key: bytes, value: int) -> None:
        node = self.root
        while node[2] is not None:
            node = node[2].get(key[node[0]]) or next(iter(node[2].values()))
        other = node[1][0]
        depth = 0
        for x, y in zip(key, other):
            if x != y:
                break
            depth += 1
        node, parent = self.root, None
        while node[2] is not None and node[0] < depth:
            parent, node = node, node[2][key[node[0]]]
        leaf = [len(key), (key, value), None]
        if node[2] is not None and node[0] == depth:
            node[2][key[depth]] = leaf
            return
        branch = [depth, None, {other[depth]: node, key[depth]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[2][key[parent[0]]] = branch

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node[2] is None:
                out.append(node[1][1])
            else:
                stack.extend(node[2][c] for c in sorted(node[2], reverse=True))
        return out


def deep_shallow(strings: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix by (group, bytes).

    Shallow: each pass sorts every range that is still tied by its next eight bytes.
    Deep: equal rows of a tied range are taken together and a blind trie orders the rest.
    """
    n, width = strings.shape
    symbols = -(-width // 8)
    padded = np.zeros((n, symbols * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    tied = _ranges(group[order])
    for d in range(min(SHALLOW // 8, symbols)):
        live = np.flatnonzero(tied >= 0)
        if not len(live):
            return order
        rows = order[live]
        sub = np.lexsort((words[rows, d], tied[live]))
        order[live] = rows[sub]
        key, rng = words[order[live], d], tied[live]  # ranges keep their places
        tied[live] = _ranges(rng, key)
    live = np.flatnonzero(tied >= 0)
    if not len(live) or symbols * 8 <= SHALLOW:
        return order
    # equal rows side by side, so that a trie holds each string once
    rows, rng = order[live], tied[live]
    mixed = mix64(words[rows, SHALLOW // 8:] ^ _U(0x632BE59BD9B4E019)
                  * np.arange(1, symbols - SHALLOW // 8 + 1, dtype=np.uint64))
    sub = np.lexsort((mixed.sum(axis=1, dtype=np.uint64), rng))
    rows = rows[sub]
    deep = words[rows, SHALLOW // 8:]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rng[1:] != rng[:-1]) | (deep[1:] != deep[:-1]).any(axis=1)
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(rows)))
    rng_of = rng[heads]
    bounds = np.flatnonzero(np.concatenate([[True], rng_of[1:] != rng_of[:-1], [True]]))
    rank = np.zeros(len(heads), np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            keys = padded[rows[heads[a:b]], SHALLOW:]
            trie = _BlindTrie(keys[0].tobytes(), 0)
            for i in range(1, b - a):
                key = keys[i].tobytes()
                trie.insert(key, i)
            rank[a + np.array(trie.ordered())] = np.arange(b - a)
    final = np.lexsort((np.repeat(rank, sizes), rng))
    order[live] = rows[final]
    return order


def _ranges(*keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys an element is in; -1 where the run has one."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    change = np.ones(n + 1, bool)
    change[1:n] = False
    for k in keys:
        change[1:n] |= k[1:] != k[:-1]
    number = np.cumsum(change[:n]) - 1
    return np.where(change[:n] & change[1:], -1, number)


def _common(strings: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Length of the prefix that each sorted row shares with the one before it."""
    out = np.zeros(len(strings), np.int64)
    differ = np.ones((max(len(strings) - 1, 0), strings.shape[1] + 1), bool)
    differ[:, :-1] = strings[1:] != strings[:-1]
    out[1:] = np.where(group[1:] == group[:-1], differ.argmax(axis=1), 0)
    out[1:][group[1:] != group[:-1]] = -1
    return out


def smaller_windows(group, doc, before, around, n_before, n_after, length: int) -> np.ndarray:
    """Bit i of an entry: its window that starts i bytes before the anchor also occurs at
    an entry of the same anchor with a smaller doc. ``before`` are the reversed bytes in
    front of the anchor, ``around`` those from it on."""
    n = len(group)
    mask = np.zeros(n, np.uint64)
    right = deep_shallow(around, group)
    left = deep_shallow(before, group)
    lcp_r, lcp_l = _common(around[right], group[right]), _common(before[left], group[left])
    pos_r, pos_l = np.empty(n, np.int64), np.empty(n, np.int64)
    pos_r[right], pos_l[left] = np.arange(n), np.arange(n)
    for i in range(length - GRAM + 1):
        fits = (n_before >= i) & (n_after >= length - i)
        if not fits.any():
            continue
        class_r = np.cumsum(lcp_r < length - i)[pos_r]
        class_l = np.cumsum(lcp_l < i)[pos_l] if i else np.zeros(n, np.int64)
        rows = np.flatnonzero(fits)
        key = class_r[rows].astype(np.uint64) * _U(n + 1) + class_l[rows].astype(np.uint64)
        by = np.argsort(key, kind="stable")
        key = key[by]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.minimum.reduceat(doc[rows[by]], start)
        size = np.diff(np.append(start, len(by)))
        hit = rows[by][np.repeat(least, size) < doc[rows[by]]]
        mask[hit] |= _U(1) << _U(i)
    return mask


# ------------------------------------------------------------------ chunks and buckets


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed Arrow stream; a matrix becomes fixed-size binary."""
    cols = []
    for x in arrays.values():
        if x.ndim == 2:
            cols.append(pa.Array.from_buffers(pa.binary(x.shape[1]), len(x), [
                None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]))
        else:
            cols.append(pa.array(x))
    batches = [pa.RecordBatch.from_arrays([c], [k]) for k, c in zip(arrays, cols)]
    return b"".join(len(s).to_bytes(8, "little") + s for s in map(_stream, batches))


def _stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    while at < len(raw):
        n = int.from_bytes(raw[at:at + 8], "little")
        batch = pa.ipc.open_stream(pa.py_buffer(raw)[at + 8:at + 8 + n]).read_next_batch()
        col = batch.column(0)
        if pa.types.is_fixed_size_binary(col.type):
            width = col.type.byte_width
            out[batch.schema.names[0]] = np.frombuffer(col.buffers()[1], np.uint8)[:len(col) * width].reshape(-1, width)
        else:
            out[batch.schema.names[0]] = col.to_numpy(zero_copy_only=False)
        at += 8 + n
    return out


def _chunks(docs: DataFrame, carry: list[str], chunk_bytes: int) -> DataFrame:
    """Files of about ``chunk_bytes`` of text, each a compressed Arrow stream of doc_id, text
    and the carried columns; one row per file: its number, path and bytes of text."""
    folder = scratch_path(docs.sparkSession, "text-chunks")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))

    def pack(batches):
        ctx = TaskContext.get()
        base, number = ctx.partitionId() << 32, 0
        held, size = [], 0

        def emit():
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            path = f"{folder}/{base + number}-{ctx.taskAttemptId()}.arrow"
            with open_output(path) as f:
                f.write(_stream(batch))
            return pa.RecordBatch.from_pydict({"chunk": [base + number], "n_bytes": [size], "path": [path]})

        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets, chunk_bytes):
                held.append(batch.slice(a, b - a))
                size += int(offsets[b] - offsets[a])
                if size >= chunk_bytes // 2 or sum(x.num_rows for x in held) >= 1 << 16:
                    yield emit()
                    held, size, number = [], 0, number + 1
        if held and sum(x.num_rows for x in held):
            yield emit()

    return rows.mapInArrow(pack, "chunk long, n_bytes long, path string")


def _opened(path: str):
    batch = pa.ipc.open_stream(read_shared(path)).read_next_batch()
    data, offsets = text_bytes(batch.column("text"))
    return batch, batch.column("doc_id").to_numpy(), data, offsets


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Hash ranges, so that sorted hashes have sorted buckets."""
    return ((hashes >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _doc_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, side="right") - 1


def _fingerprints(chunks: DataFrame, length: int, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for number, path in zip(batch.column("chunk").to_pylist(), batch.column("path").to_pylist()):
                _, ids, data, offsets = _opened(path)
                places, hashes = anchors(data, offsets, length)
                doc = ids[_doc_of(places, offsets)]
                order = np.argsort(hashes, kind="stable")
                h, d = hashes[order], doc[order]
                start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else order
                several = np.minimum.reduceat(d, start) < np.maximum.reduceat(d, start) if len(h) else order > 0
                count = np.diff(np.append(start, len(h)))
                h = h[start]
                cut = np.searchsorted(_bucket(h, buckets), np.arange(buckets + 1))
                rows = [(b, number, np.uint32(h[x:y] & _U(0xFFFFFFFF)).tobytes()
                         + (h[x:y] >> _U(32)).astype(np.uint16).tobytes() + np.packbits(several[x:y]).tobytes(),
                         int(y - x), _often(count[x:y])) for b, (x, y) in enumerate(zip(cut[:-1], cut[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()))],
                    ["bucket", "chunk", "prints", "n", "often"])
    return chunks.mapInArrow(run, "bucket int, chunk long, prints binary, n long, often binary")


def _often(count: np.ndarray) -> bytes:
    """Index and number of the fingerprints that a chunk holds OFTEN times or more."""
    at = np.flatnonzero(count >= OFTEN)
    return np.stack([at, count[at]], axis=1).astype(np.uint32).tobytes()


def _answers(crowd: int):
    return lambda rows: _shared(rows, crowd)


def _shared(rows: pa.Table, crowd: int) -> pa.Table:
    """For each chunk's sorted fingerprints in this bucket: which occur in two documents,
    and which more than ``crowd`` times (up to OFTEN - 1 in a chunk count as one)."""
    counts = rows.column("n").to_numpy()
    keys, several = [], []
    for raw, n in zip(rows.column("prints"), counts.tolist()):
        raw = raw.as_buffer()
        low = np.frombuffer(raw, np.uint32, n)
        high = np.frombuffer(raw, np.uint8)[4 * n:6 * n].copy().view(np.uint16)
        keys.append(high.astype(np.uint64) << _U(32) | low)
        several.append(np.unpackbits(np.frombuffer(raw, np.uint8)[6 * n:], count=n).astype(bool))
    key, flag = np.concatenate(keys), np.concatenate(several)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    flag[order[1:][same]] = True
    flag[order[:-1][same]] = True
    ends = np.cumsum(counts)
    times = np.ones(len(key), np.int64)
    for raw, end, n in zip(rows.column("often"), ends, counts):
        at = np.frombuffer(raw.as_buffer(), np.uint32).reshape(-1, 2).astype(np.int64)
        times[end - n + at[:, 0]] = at[:, 1]
    hot = np.zeros(len(key), bool)
    if len(key):
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        hot[order] = np.repeat(np.add.reduceat(times[order], start) > crowd, np.diff(np.append(start, len(key))))
    return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "n": rows.column("n"),
                     "flags": pa.array([np.packbits(flag[e - n:e]).tobytes() for e, n in zip(ends, counts)],
                                       pa.binary()),
                     "hot": pa.array([np.packbits(hot[e - n:e]).tobytes() if hot[e - n:e].any() else None
                                      for e, n in zip(ends, counts)], pa.binary())})


def _hashed_windows(places, data, offsets, ids, length: int, buckets: int):
    """(bucket, packed windows) of the windows that hold one of the anchors at ``places``:
    hash, smallest doc of this chunk, and where the windows start."""
    row = _doc_of(places, offsets)
    starts = places[:, None] - np.arange(length - GRAM + 1)
    inside = (starts >= offsets[row][:, None]) & (starts + length <= offsets[row + 1][:, None])
    starts = np.unique(starts[inside])
    width = -(-length // 8)
    salt = _U(0xE220A8397B1DCDAF) * np.arange(1, 2 * width + 1, dtype=np.uint64)
    one, two = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), 1 << 14):
        s = slice(a, a + (1 << 14))
        words = np.zeros((len(starts[s]), width * 8), np.uint8)
        words[:, :length] = data[starts[s, None] + np.arange(length)]
        words = words.view(np.uint64)
        one[s] = mix64(mix64(words ^ salt[:width]).sum(axis=1, dtype=np.uint64))
        two[s] = mix64(mix64(words ^ salt[width:]).sum(axis=1, dtype=np.uint64))
    doc = ids[_doc_of(starts, offsets)]
    order = np.lexsort((doc, two, one))
    head = np.ones(len(order), bool)
    head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    entry = np.cumsum(head) - 1
    first = order[head]
    later = doc[order] > doc[first][entry]
    cut = np.searchsorted(_bucket(one[first], buckets), np.arange(buckets + 1))
    cut_all = np.searchsorted(entry, cut)
    for b in np.flatnonzero(np.diff(cut)).tolist():
        f, s = first[cut[b]:cut[b + 1]], slice(cut_all[b], cut_all[b + 1])
        yield b, _pack(one=one[f], two=two[f], doc=doc[f], place=starts[order[s]].astype(np.uint32),
                       entry=(entry[s] - cut[b]).astype(np.uint32), later=later[s].astype(np.uint8))


def _surroundings(length: int, buckets: int):
    reach = length - GRAM
    spread = np.arange(-reach, length)

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int64()),
                             "entries": pa.array([], pa.binary()), "hashed": pa.array([], pa.bool_())})
        _, ids, data, offsets = _opened(texts.column("path")[0].as_py())
        places, hashes = anchors(data, offsets, length)
        distinct, inverse = np.unique(hashes, return_inverse=True)
        answers = answers.sort_by("bucket")
        flags = [np.unpackbits(np.frombuffer(f.as_buffer(), np.uint8), count=n).astype(bool)
                 for f, n in zip(answers.column("flags"), answers.column("n").to_pylist())]
        flag = np.concatenate(flags) if flags else np.zeros(0, bool)
        crowds = [np.unpackbits(np.frombuffer(f.as_buffer(), np.uint8), count=n).astype(bool) if f.is_valid
                  else np.zeros(n, bool) for f, n in zip(answers.column("hot"), answers.column("n").to_pylist())]
        crowded = np.concatenate(crowds) if crowds else np.zeros(0, bool)
        hot = np.flatnonzero((flag & crowded)[inverse]) if len(distinct) else np.zeros(0, np.int64)
        out = []
        if len(hot):
            out += [(b, key[0].as_py(), packed, True) for b, packed in _hashed_windows(
                places[hot], data, offsets, ids, length, buckets)]
        keep = np.flatnonzero((flag & ~crowded)[inverse]) if len(distinct) else np.zeros(0, np.int64)
        places, hashes = places[keep], hashes[keep]
        row = _doc_of(places, offsets)
        begin, end, doc = offsets[row], offsets[row + 1], ids[row]
        around = np.zeros((len(places), len(spread)), np.uint8)
        for a in range(0, len(places), 1 << 14):
            s = slice(a, a + (1 << 14))
            at = places[s, None] + spread
            inside = (at >= begin[s, None]) & (at < end[s, None])
            around[s] = np.where(inside, data[np.where(inside, at, 0)], 0)
        n_before = np.minimum(places - begin, reach).astype(np.uint8)
        n_after = np.minimum(end - places, length).astype(np.uint8)
        # equal surroundings become one entry with their smallest doc
        words = np.zeros((len(places), -(-(len(spread) + 2) // 8) * 8), np.uint8)
        words[:, :len(spread)] = around
        words[:, len(spread)], words[:, len(spread) + 1] = n_before, n_after
        words = words.view(np.uint64)
        salt = _U(0xE220A8397B1DCDAF) * np.arange(1, words.shape[1] + 1, dtype=np.uint64)
        mixed = mix64(words ^ salt).sum(axis=1, dtype=np.uint64)
        order = np.lexsort((doc, mixed, hashes))
        w = words[order]
        head = np.ones(len(order), bool)
        head[1:] = (w[1:] != w[:-1]).any(axis=1)
        entry = np.cumsum(head) - 1
        first = order[head]
        least = doc[first]
        later = doc[order] > least[entry] if len(order) else head
        bucket = _bucket(hashes[first], buckets)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        cut_all = np.searchsorted(entry, cut)
        for b in np.flatnonzero(np.diff(cut)).tolist():
            f = first[cut[b]:cut[b + 1]]
            s = slice(cut_all[b], cut_all[b + 1])
            out.append((b, key[0].as_py(), _pack(
                anchor=hashes[f], doc=doc[f], n_before=n_before[f], n_after=n_after[f], bytes=around[f],
                place=places[order[s]].astype(np.uint32), entry=(entry[s] - cut[b]).astype(np.uint32),
                later=later[s].astype(np.uint8)), False))
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table({"bucket": pa.array(cols[0], pa.int32()), "chunk": pa.array(cols[1], pa.int64()),
                         "entries": pa.array(cols[2], pa.binary()), "hashed": pa.array(cols[3], pa.bool_())})
    return run


def _judge_hashed(rows: pa.Table) -> pa.Table:
    parts = [_unpack(x.as_buffer().to_pybytes()) for x in rows.column("entries")]
    one, two, doc = (np.concatenate([p[k] for p in parts]) for k in ("one", "two", "doc"))
    order = np.lexsort((two, one))
    head = np.ones(len(order), bool)
    head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    start = np.flatnonzero(head)
    smaller = np.empty(len(order), bool)
    least = np.minimum.reduceat(doc[order], start)
    smaller[order] = np.repeat(least, np.diff(np.append(start, len(order)))) < doc[order]
    out, at = [], 0
    for p in parts:
        hit = p["later"].astype(bool) | smaller[p["entry"].astype(np.int64) + at]
        at += len(p["doc"])
        out.append(_pack(place=p["place"][hit], windows=np.ones(int(hit.sum()), np.uint64)))
    return pa.table({"chunk": rows.column("chunk"), "hits": pa.array(out, pa.binary())})


def _judge(length: int):
    reach = length - GRAM
    whole = np.arange(reach + 1)

    def run(rows: pa.Table) -> pa.Table:
        hashed = rows.filter(rows.column("hashed"))
        rows = rows.filter(pc.invert(rows.column("hashed")))
        return pa.concat_tables([f(x) for f, x in ((whole_anchors, rows), (_judge_hashed, hashed)) if x.num_rows])

    def whole_anchors(rows: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_buffer().to_pybytes()) for x in rows.column("entries")]
        col = {k: np.concatenate([p[k] for p in parts]) for k in ("anchor", "doc", "n_before", "n_after", "bytes")}
        _, group = np.unique(col["anchor"], return_inverse=True)
        mask = smaller_windows(group, col["doc"], np.ascontiguousarray(col["bytes"][:, :reach][:, ::-1]),
                               np.ascontiguousarray(col["bytes"][:, reach:]), col["n_before"].astype(np.int64),
                               col["n_after"].astype(np.int64), length)
        fits = (whole <= col["n_before"][:, None].astype(np.int64)) \
            & (length - whole <= col["n_after"][:, None].astype(np.int64))
        every = (fits.astype(np.uint64) << whole.astype(np.uint64)).sum(axis=1, dtype=np.uint64)
        out, at = [], 0
        for p in parts:
            e = p["entry"].astype(np.int64) + at
            at += len(p["anchor"])
            m = np.where(p["later"].astype(bool), every[e], mask[e])
            hit = m > 0
            out.append(_pack(place=p["place"][hit], windows=m[hit].astype(np.uint64)))
        return pa.table({"chunk": rows.column("chunk"), "hits": pa.array(out, pa.binary())})
    return run


def _whole_characters(gone: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``gone``, with every UTF-8 character that lost a byte gone as a whole."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if len(lead) == len(data):
        return gone
    lost = np.logical_or.reduceat(gone, lead)
    return np.repeat(lost, np.diff(np.append(lead, len(data))))


def _cut(length: int, schema: pa.Schema, as_text: bool):
    def run(key: tuple, texts: pa.Table, hits: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()
        batch, _, data, offsets = _opened(texts.column("path")[0].as_py())
        step = np.zeros(len(data) + 1, np.int32)
        for raw in hits.column("hits"):
            found = _unpack(raw.as_buffer().to_pybytes())
            place, windows = found["place"].astype(np.int64), found["windows"]
            for i in range(length - GRAM + 1):
                s = place[(windows >> _U(i)) & _U(1) > 0] - i
                np.add.at(step, s, 1)
                np.add.at(step, s + length, -1)
        gone = np.cumsum(step[:-1]) > 0
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # a run that touches a text's end goes on in the next text only as a run of its own
        inner = offsets[1:-1]
        split = inner[(inner > 0) & (inner < len(data))]
        split = np.unique(split[gone[split] & gone[split - 1]])
        begin, end = np.sort(np.append(begin, split)), np.sort(np.append(end, split))
        owner = _doc_of(begin, offsets)
        n = batch.num_rows
        per = np.bincount(owner, minlength=n)
        left = ~(_whole_characters(gone, data) if as_text and len(data) else gone)
        kept = data[left]
        ends = np.concatenate([[0], np.cumsum(left)])[offsets]
        spans = pa.StructArray.from_arrays([pa.array(begin - offsets[owner]), pa.array(end - begin)],
                                           ["start", "length"])
        heads = pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32))
        return pa.Table.from_arrays([
            batch.column("row"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(heads, spans),
            pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                         pa.py_buffer(kept.tobytes())]).cast(
                pa.string() if as_text else pa.binary())],
            schema=schema)
    return run


def remove_repeats(docs: DataFrame, length: int = 50, carry: list[str] | None = None,
                   as_text: bool = False, chunk_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20,
                   crowd: int = 1 << 13) -> DataFrame:
    """``row`` (the carried columns), ``n_bytes``, ``spans`` (start and length of the runs
    removed, in bytes) and ``kept`` (the bytes that remain) of every row of ``docs``. With
    ``as_text``, ``kept`` is a string without the characters that lost a byte.

    ``chunk_bytes`` and ``bucket_bytes`` set how much text a task holds at a time; raise
    both on very large tables, where each chunk talks to each bucket.
    """
    ship(docs.sparkSession)
    carry = ["doc_id"] if carry is None else carry
    chunks = stored(_chunks(docs, carry, chunk_bytes), "text-chunks")
    n_chunks, total = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    # the rows that name chunks are tiny, so the number of tasks is set by chunks, not bytes
    tasks = max(1, -(-n_chunks // 4))

    def by_chunk(rows: DataFrame):
        return rows.repartition(tasks, "chunk").groupBy("chunk")

    names = chunks.select("chunk", "path")
    shared = (_fingerprints(names.repartition(tasks, "chunk"), length, buckets).groupBy("bucket")
              .applyInArrow(_answers(crowd), "chunk long, bucket int, n long, flags binary, hot binary"))
    entries = by_chunk(names).cogroup(by_chunk(shared)).applyInArrow(
        _surroundings(length, buckets), "bucket int, chunk long, entries binary, hashed boolean")
    hits = stored(entries.groupBy("bucket").applyInArrow(_judge(length), "chunk long, hits binary"), "repeat-hits")
    row_type = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")).schema
    extra = StructType.fromDDL("n_bytes long, spans array<struct<start:long,length:long>>, kept "
                               + ("string" if as_text else "binary"))
    out = StructType(row_type.fields + extra.fields)
    return by_chunk(names).cogroup(by_chunk(hits)).applyInArrow(_cut(length, to_arrow_schema(out), as_text), out)
