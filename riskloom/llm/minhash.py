"""Operator 9: near-duplicate documents by SuperMinHash, banding and verified links.

1. Each text becomes its set of distinct word shingles (64-bit word hashes; a shingle
   keeps 54 bits). Texts with the same set form a class at once.
2. SuperMinHash: element e takes the ranks 0, 1, ... of its own random permutation one
   after the other; rank j offers j + uniform to register p_j(e). A text stops after rank
   j once all registers hold less than j + 1, because no later rank can lower them. All
   texts of a block take rank j together, which gives the same minima.
3. Bands of registers are bucketed. A bucket links no pairs by itself: its members are
   compared with a few pivots, then members of different components with each other, and
   every link is confirmed on the full sets. Exact bounds from set sizes and rare shingles
   spare comparisons that cannot confirm. Hot buckets and pivots are dealt over many
   tasks (``parts.py``).
4. Links are contracted to components; the smallest doc_id of a component stays.

With 42 bands of 6 registers a pair at similarity 0.8 is missed with probability 3e-6.
Texts without words have the empty set and link with nothing; texts with fewer words
than a shingle are one shingle. A row without doc_id is named by its text (above 2**62,
so after every real id) and leaves without one. Rows that share a doc_id are one node;
the smallest of their texts stands for it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import parts
from riskloom.llm.common import WordHasher, discard, mix64, run_index, ship, slices, stored, text_bytes
from riskloom.llm.components import components

BANDS, ROWS = 42, 6
#: members of a bucket and size that meet in one cell of the last round
CELL = 1024
_U = np.uint64
_ID_BITS = 10  # texts of a block; the other 54 bits hold the shingle


_UNNAMED = 1 << 62


def _node():
    """doc_id, or for a row without one a name made of its text."""
    return F.coalesce(F.col("doc_id").cast("long"),
                      F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(_UNNAMED)) + _UNNAMED)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(_node().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shingle_sets(data, offsets, words: int, hasher: WordHasher):
    """Sorted distinct shingles of up to 2**10 texts, and how many each text has."""
    h, _, _, counts = hasher(data, offsets)
    owner = run_index(counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = len(h)
    acc = h.copy()
    for t in range(1, words):
        acc[:n - t] = mix64(acc[:n - t] * _U(0x9E3779B97F4A7C15) + h[t:]) if n > t else acc[:n - t]
    left = first[owner + 1] - np.arange(n) if n else np.zeros(0, np.int64)
    keep = left >= words
    parts, owners = [acc[keep]], [owner[keep]]
    for size in range(1, words):
        row = np.flatnonzero(counts == size)
        if len(row):
            x = h[first[row]]
            for t in range(1, size):
                x = mix64(x * _U(0x9E3779B97F4A7C15) + h[first[row] + t])
            parts.append(mix64(x + _U(size)))
            owners.append(row)
    key = (np.concatenate(parts) >> _U(_ID_BITS)) | (np.concatenate(owners).astype(_U) << _U(64 - _ID_BITS))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    owner = (key >> _U(64 - _ID_BITS)).astype(np.int64)
    return key & _U((1 << (64 - _ID_BITS)) - 1), np.bincount(owner, minlength=len(offsets) - 1)


def superminhash(elements: np.ndarray, sizes: np.ndarray, registers: int) -> np.ndarray:
    """Signatures of texts whose distinct elements follow each other: uint64
    ``rank << 56 | uniform``, all ones where a text has no element."""
    none = _U(2**64 - 1)
    sig = np.full((len(sizes), registers), none)
    flat = sig.reshape(-1)
    owner = run_index(sizes)
    e, perm = elements, None
    for j in range(registers):
        if not len(e):
            break
        x = mix64(e + _U(((j + 1) * 0xD1B54A32D192ED03) % 2**64))
        pick = j + ((mix64(x ^ _U(0x2545F4914F6CDD1D)) >> _U(32)) * _U(registers - j) >> _U(32)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            row = np.arange(len(e))
            slot = perm[row, pick].astype(np.int64)
            perm[row, pick] = perm[:, j]
        np.minimum.at(flat, owner * registers + slot, (_U(j) << _U(56)) | (x >> _U(8)))
        active = (sig == none).any(axis=1)[owner]
        if perm is None:
            e, owner, pick = e[active], owner[active], pick[active]
            perm = np.tile(np.arange(registers, dtype=np.uint16), (len(e), 1))
            perm[np.arange(len(e)), pick] = 0
        elif not active.all():
            e, owner, perm = e[active], owner[active], perm[active]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.tile(np.arange(bands, dtype=_U), (len(sig), 1))
    for r in range(rows):
        key = mix64(key * _U(0x9E3779B97F4A7C15) + sig[:, r:bands * rows:rows])
    return key.view(np.int64)


def _blocks(batches, size: int = 1 << 19):
    """Record batches as (rows, bytes, offsets) blocks of at most 2**10 texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << _ID_BITS):
            part = batch.slice(at, 1 << _ID_BITS)
            data, offsets = text_bytes(part.column("text"))
            for a, b in slices(offsets, size):
                yield part.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit sum over the set (set_a, set_b) and the band keys."""
    ship(docs.sparkSession)

    def run(batches):
        hasher = WordHasher()
        for part, data, offsets in _blocks(batches):
            e, sizes = shingle_sets(data, offsets, words, hasher)
            keys = band_keys(superminhash(e, sizes, bands * rows), bands, rows)
            first = np.concatenate([[0], np.cumsum(sizes)])
            sums = []
            for salt in (0x632BE59BD9B4E019, 0xE220A8397B1DCDAF):
                total = np.concatenate([[_U(0)], np.cumsum(mix64(e ^ _U(salt)))])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)),
                                          pa.array(keys.reshape(-1)))],
                ["doc_id", "n_shingles", "set_a", "set_b", "keys"])

    return _named(docs).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        hasher = WordHasher()
        for part, data, offsets in _blocks(batches):
            e, sizes = shingle_sets(data, offsets, words, hasher)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(e.view(np.int64)))],
                ["doc_id", "shingles"])
    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def _with_sets(pairs: DataFrame, sets: DataFrame, end: str, other: str, total: int) -> DataFrame:
    """``pairs`` with the set of one end; the pairs of a hot end are dealt by the other."""
    hot = F.broadcast(pairs.groupBy(end).agg(F.count(F.lit(1)).alias("m")).select(
        end, parts.salts(F.col("m"), total).alias("hot")).where("hot > 1"))
    dealt = pairs.join(hot, end, "left").withColumn("s", parts.part_of(other, F.coalesce("hot", F.lit(1)))).drop("hot")
    held = sets.select(F.col("doc_id").alias(end), F.col("shingles").alias(f"s{end}")).join(hot, end, "left").withColumn(
        "salts", F.coalesce("hot", F.lit(1))).drop("hot")
    return dealt.join(parts.each_part(held).drop("salts"), [end, "s"]).drop("s")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= similarity * union."""
    total = pairs.count()
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    full = _with_sets(_with_sets(pairs, sets, "a", "b", total), sets, "b", "a", total)
    return full.where(100 * both >= similarity * either).select("a", "b")


def _clustered(members: DataFrame) -> DataFrame:
    """Members with ``g``, the cluster of all members that buckets connect: only members of
    one cluster ever meet."""
    least = members.groupBy("key").agg(F.min("rep").alias("least"), F.max("salts").alias("salts"))
    ties = members.drop("salts").join(parts.each_part(least), ["key", "s"]).select(
        F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    return members.join(components(ties), F.col("rep") == F.col("node"), "left").withColumn(
        "g", F.coalesce("component", "rep")).drop("node", "component")


def _rare_shingles(members: DataFrame, sets: DataFrame, most: int) -> DataFrame:
    """(g, e, rep): the shingles of open members that at most ``most`` of their cluster have."""
    reps = members.select(F.col("rep").alias("doc_id"), "g").distinct()
    postings = sets.join(reps, "doc_id").select("g", F.explode("shingles").alias("e"), F.col("doc_id").alias("rep"))
    rare = postings.groupBy("g", "e").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") <= most)
    return stored(postings.join(rare, ["g", "e"]).select("g", "e", "rep", "k"), "rare-shingles")


def _sharing_rare(members: DataFrame, rare: DataFrame, similarity: int) -> DataFrame:
    """Pairs of open members that share rare shingles and can link. A rare shingle meets a
    bounded number of members, so there are at most so many rows per shingle of a set."""
    reps = members.select("rep", "n", "p", "c").distinct()
    rows = rare.where("k > 1").join(reps, "rep")
    x = rows.select("g", "e", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("p").alias("px"), F.col("c").alias("cx"))
    y = rows.select("g", "e", F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("p").alias("py"), F.col("c").alias("cy"))
    met = x.join(y, (x["g"] == y["g"]) & (x["e"] == y["e"]) & (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy"))).groupBy(
        F.col("x").alias("a"), F.col("y").alias("b"), "nx", "ny", "px", "py").agg(F.count(F.lit(1)).alias("o"))
    return met.where(_feasible(similarity, F.col("o"))).select("a", "b")


def _feasible(similarity: int, rare=None):
    """Whether two sets can reach the similarity if they share ``rare`` of their rare
    shingles (``px`` and ``py`` of them): the rest of the smaller bounds the rest."""
    shared = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    shared = shared if rare is None else shared + rare
    return 100 * shared >= similarity * (F.col("nx") + F.col("ny") - shared)


def _side(rows: DataFrame, name: str, on: list[str]) -> DataFrame:
    return rows.select(*on, F.col("rep").alias(name), *[F.col(c).alias(c + name) for c in ("n", "p", "c")])


def _meetings(rows: DataFrame, pivots: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs (a < b) of a bucket's members and its pivots, in different components,
    that can link without sharing a rare shingle."""
    on = ["key", "s"]
    met = _side(rows, "x", on).join(_side(parts.each_part(pivots), "y", on), on)
    return met.where((F.col("cx") != F.col("cy")) & _feasible(similarity)).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _last_meetings(rows: DataFrame, similarity: int) -> DataFrame:
    """As ``_meetings``, of all members of a bucket with each other.

    ``_feasible`` can only hold if each set's rest is at least the similarity of the set,
    and the larger set at most 1 / similarity times the smaller. So members with too many
    rare shingles stay away, and members meet those of their own and the next level of size.
    More than ``CELL`` members of a level are dealt to a row of a square (as the smaller
    set) and to a column (as the larger); each two meet in one cell, with about ``CELL``
    members on either side.
    """
    step = math.log(100 / similarity) + 1e-6
    able = rows.where(100 * (F.col("n") - F.col("p")) >= similarity * F.col("n")).withColumn(
        "level", F.floor(F.log(F.col("n").cast("double")) / step))
    seeking = able.withColumn("level", F.explode(F.array(F.col("level"), F.col("level") + 1)))
    crowds = parts.each_part(seeking.groupBy("key", "level").agg(
        F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("side"), F.max("salts").alias("salts"))).drop("salts")

    def placed(members: DataFrame, name: str, own: str, all_of: str) -> DataFrame:
        at = members.join(crowds, ["key", "level", "s"]).withColumn(own, parts.part_of("rep", F.col("side")))
        return _side(at.withColumn(all_of, F.explode(F.sequence(F.lit(0), F.col("side") - 1))), name, on)

    on = ["key", "level", "across", "down"]
    met = placed(seeking, "x", "across", "down").join(placed(able, "y", "down", "across"), on)
    return met.where((F.struct("nx", "x") < F.struct("ny", "y")) & (F.col("cx") != F.col("cy"))
                     & _feasible(similarity)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _pivots(rows: DataFrame, order: list) -> DataFrame:
    """The first members of each bucket in each of the given orders (no list of members is
    gathered: every order is one minimum)."""
    member = F.struct("rep", "n", "p", "c", "salts")
    least = rows.groupBy("key").agg(*[F.min(F.struct(o.alias("o"), member.alias("m"))).alias(f"m{i}")
                                      for i, o in enumerate(order)])
    return least.select("key", F.explode(F.array_distinct(F.array(*[
        F.col(f"m{i}.m") for i in range(len(order))]))).alias("m")).select("key", "m.*")


def _stars(labels: DataFrame) -> DataFrame:
    """Links that connect what ``labels`` name as one component."""
    return labels.select(F.col("component").alias("a"), F.col("node").alias("b")).where("a <> b")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components, with their component."""
    labelled = members.join(labels, F.col("rep") == F.col("node"), "left").withColumn(
        "c", F.coalesce("component", "rep")).drop("node", "component")
    spread = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                         F.max("salts").alias("salts")).where("lo <> hi")
    return stored(labelled.join(parts.each_part(spread).select("key", "s"), ["key", "s"]), "open-members")


def _bucket_members(entries: DataFrame) -> DataFrame:
    """The entries of buckets with two members or more, stored and dealt in parts: part ``s``
    of the bucket's ``salts``; ``p``, rare shingles, is not known yet."""
    shared = stored(entries.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"),
                                               F.count(F.lit(1)).alias("m")).where("lo <> hi").select("key", "m"), "buckets")
    total = shared.agg(F.sum("m")).first()[0] or 0
    dealt = parts.joined(entries, shared.select("key", parts.salts(F.col("m"), total).alias("salts")), "key", "rep")
    members = stored(dealt.withColumn("p", F.lit(0).cast("long")), "bucket-members")
    discard(shared)
    return members


def linked(docs: DataFrame, words: int = 5, similarity: int = 80, bands: int = BANDS,
           rows: int = ROWS, pivots: int = 4, rare_in: int = 64) -> DataFrame:
    """doc_id (or a text's stand-in for it), n_shingles and component of every row.

    ``similarity`` is in percent. Bucket members meet in three rounds: with one member drawn
    by hash; then, where a bucket still holds several components, with its
    ``pivots`` members that have the smallest share of rare shingles (in a group of edited
    copies those closest to the original); at last all that are still in different
    components and can link: two sets share at most the smaller rest of each besides rare
    shingles (those of at most ``rare_in`` members of a cluster), and who shares rare ones is found
    by joining on them.
    """
    sigs = stored(signatures(docs, words, bands, rows), "signatures")
    classes = (sigs.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
               .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")))
    entries = classes.select(F.explode("keys").alias("key"), "rep", F.col("n_shingles").alias("n"))
    members = _bucket_members(entries)
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = _named(docs).join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    sets = stored(_sets(texts, words), "shingle-sets")

    alone = members.withColumn("c", F.col("rep"))
    pairs = stored(_meetings(alone, _pivots(alone, [F.xxhash64("rep")]), similarity), "pairs")
    found = stored(_confirmed(pairs, sets, similarity), "links")
    labels = components(found)

    used = [members, sets, pairs, found]
    members = _unsettled(members, labels)
    used.append(members)
    if not members.isEmpty():
        members = stored(_clustered(members), "clustered")
        used.append(members)
        rare = _rare_shingles(members, sets, rare_in)
        held = rare.groupBy("rep").agg(F.count(F.lit(1)).alias("p"))
        members = stored(members.drop("p").join(held, "rep", "left").withColumn(
            "p", F.coalesce("p", F.lit(0).cast("long"))), "open-members")
        used += [rare, members]
        share = F.floor(F.col("p") * 1_000_000 / F.col("n"))
        central = [F.struct(F.floor(share / 10 ** i), F.xxhash64(F.lit(i), "rep")) for i in range(pivots)]
        for r in range(2):
            if r == 0:
                meet = _meetings(members, _pivots(members, central), similarity)
            else:
                meet = _last_meetings(members, similarity).union(_sharing_rare(members, rare, similarity)).distinct()
            more = stored(meet.join(pairs, ["a", "b"], "left_anti"), "pairs")
            pairs = pairs.unionByName(more)
            found = stored(_confirmed(more, sets, similarity), "links")
            labels = components(_stars(labels).unionByName(found))
            used += [more, found]
            if r == 0:
                members = _unsettled(members.drop("c"), labels)
                used.append(members)
    discard(*used)
    by_class = classes.select("set_a", "set_b", F.col("n_shingles").alias("n"), "rep").join(
        labels, F.col("rep") == F.col("node"), "left").select(
        "set_a", "set_b", "n", F.coalesce("component", "rep").alias("component"))
    rows_out = sigs.select("doc_id", "n_shingles", "set_a", "set_b").join(
        by_class.withColumnRenamed("n", "n_shingles"), ["set_a", "set_b", "n_shingles"], "left")
    return rows_out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    def real(name: str):
        return F.when(F.col(name) < _UNNAMED, F.col(name))
    return linked(docs, **options).select(
        real("doc_id").alias("doc_id"), "n_shingles", real("component").alias("component_id"),
        (F.col("doc_id") == F.col("component")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each component: its smallest doc_id, and any one of the rows
    that share that doc_id and text. Of different texts under one doc_id, the one with the
    least hash is known by the doc_id, the others by a name made of both, which comes after
    every real id."""
    body = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    least = docs.where("doc_id is not null").select(F.col("doc_id").alias("shared_id"), body.alias("body")).groupBy(
        "shared_id").agg(F.min("body").alias("least"), F.max("body").alias("most")).where("least <> most")
    named = docs.select(_node().alias("node"), body.alias("body"), F.coalesce("text", F.lit("")).alias("text"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    other = F.pmod(F.xxhash64("node", "body"), F.lit(_UNNAMED)) + _UNNAMED
    named = named.join(least.drop("most"), F.col("node") == F.col("shared_id").cast("long"), "left").withColumn(
        "node", F.when(F.col("body") != F.col("least"), other).otherwise(F.col("node")))
    rows = named.select(F.col("node").alias("doc_id"), "text")
    first = linked(rows, **options).where("doc_id = component").select(F.col("doc_id").alias("node")).distinct()
    return named.join(first, "node", "left_semi").dropDuplicates(["node"]).select("row.*")
