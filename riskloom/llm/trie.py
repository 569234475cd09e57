"""Operator 13: the prefix trie of conversations, rolled up by centroid decomposition.

A turn becomes a 128-bit hash of its role and text as soon as it is read; texts travel no
further. A prefix is the exclusive or of the hashes of (place, turn), so prefixes of one long
conversation come from blocks of it in parallel. A node is named by its smallest member
conversation and its depth, which makes a node's parent a lookup in that conversation's steps.

The rollup adds each node's values to all nodes above it. While a component of the
parent-edge forest is large, its centroid is the deepest node under which more than half of
its steps lie; one join with the steps tells who is below it, the totals of that part are
added along the steps from the centroid to the component's top, and the children of the
centroid and what is left above become components of at most half the steps. Components of
at most ``group_nodes`` nodes are decomposed the same way within tasks, many at once.

Conversations are ordered by turn, nulls first, turns that tie by their hash. Null roles and
texts count as empty; repeated rows are turns of their own. Rows without ``conv_id`` belong
to no conversation and make no node. ``c % 100`` keeps the sign of c, as in SQL. Other
columns do not matter; an empty table has no conversations and so no nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ship, stored

BLOCK = 4096
_END_CHARS = 1 << 16


# ------------------------------------------------------------------ turns and steps
def _turns(convs: DataFrame) -> DataFrame:
    """``(c, k, size, digest, n)``: every turn with its place from 1, its code points, its hash
    and the turns of its conversation. Ranges of (conversation, turn) are numbered apart and
    joined by their counts, so a hot conversation is spread over tasks."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = convs.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"), F.length(text).cast("long").alias("size"),
        digest.alias("digest"))
    order = ["c", "turn", "digest"]
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "c", "size", "digest", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    runs = ranged.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    w = Window.partitionBy("c")
    runs = runs.select("c", "part", "first", F.sum("m").over(w).alias("n"),
                       (F.sum("m").over(w.orderBy("part")) - F.col("m")).alias("before"))
    return ranged.join(runs, ["c", "part"]).select(
        "c", (F.col("at") - F.col("first") + F.col("before") + 1).alias("k"), "size", "digest", "n")


def rebuilt_turns(convs: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """``(c, d, size, digest, length)`` of conversations that each begin with the first
    h = crc32(c) mod ``heads`` turns of conversation c - c mod ``every`` in place of their own,
    and the ``(c, length)`` of all of them."""
    turns = stored(_turns(convs), "conversation-turns")
    h = F.crc32(F.col("c").cast("string")) % heads
    base = F.col("c") - F.col("c") % every
    sizes = turns.where("k = 1").select("c", "n")
    have = sizes.where(F.col("c") % every == 0).select(F.col("c").alias("b"), F.least(F.lit(heads - 1), "n").alias("nb"))
    plan = sizes.withColumns({"b": base, "h": h}).join(have, "b", "left").select(
        "c", "b", "h", F.least("h", F.coalesce("nb", F.lit(0))).alias("lead"), "n")
    plan = plan.withColumn("length", F.col("lead") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    plan = stored(plan, "conversation-plan")
    own = turns.where(F.col("k") > h).join(plan.select("c", "h", "lead", "length"), "c").select(
        "c", (F.col("k") - F.col("h") + F.col("lead")).alias("d"), "size", "digest", "length")
    lead = turns.where((F.col("k") < heads) & (F.col("c") % every == 0)).select(
        F.col("c").alias("b"), F.col("k").alias("d"), "size", "digest")
    led = plan.join(lead, "b").where(F.col("d") <= F.col("lead")).select("c", "d", "size", "digest", "length")
    return own.unionByName(led), plan.select("c", "length")


def _prefixes(steps: DataFrame) -> DataFrame:
    """Adds the prefix hash up to each step (x1, x2)."""
    halves = {"x1": F.xxhash64("d", "digest"), "x2": F.xxhash64(F.lit("second"), "digest", "d")}
    rows = steps.withColumns(halves | {"block": F.floor((F.col("d") - 1) / BLOCK)})
    w = Window.partitionBy("c", "block")
    inside = [F.bit_xor(x).over(w.orderBy("d")).alias(x) for x in halves]
    sums = rows.groupBy("c", "block").agg(*[F.bit_xor(x).alias(x) for x in halves])
    v = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("c", "block", *[F.coalesce(F.bit_xor(x).over(v), F.lit(0)).alias(f"{x}_before") for x in halves])
    return rows.select("c", "block", "d", "size", "length", *inside).join(before, ["c", "block"]).select(
        "c", "d", "size", "length", *[F.col(x).bitwiseXOR(F.col(f"{x}_before")).alias(x) for x in halves])


# ------------------------------------------------------------------ member lists
def _joined(batches):
    """Ascending (o, d, c) rows to runs of one node's decimal ids, comma-joined; a run ends
    with its node or when it is long."""
    key, ids, chars, done = None, [], 0, []

    def full():
        return pa.RecordBatch.from_pydict(dict(zip(_RUNS.names, zip(*done))), schema=_RUNS)

    for batch in batches:
        for o, d, c in zip(*(x.to_pylist() for x in batch.columns)):
            if ids and ((o, d) != key or chars > _END_CHARS):
                done.append((*key, ids[0], ",".join(map(str, ids))))
                ids, chars = [], 0
                if len(done) >= 256:
                    yield full()
                    done = []
            key = (o, d)
            ids.append(c)
            chars += len(str(c)) + 1
    if ids:
        done.append((*key, ids[0], ",".join(map(str, ids))))
    if done:
        yield full()


_RUNS = pa.schema([("o", pa.int64()), ("d", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def _digests(batches):
    """Runs in order to one SHA-256 per node, whatever its length."""
    key, sha, out = None, None, []

    def full():
        o, d, text = zip(*out)
        return pa.RecordBatch.from_pydict({"o": pa.array(o, pa.int64()), "d": pa.array(d, pa.int64()), "ends": list(text)})

    for batch in batches:
        for o, d, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
            if (o, d) != key:
                if sha is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (o, d), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
            if len(out) >= 10_000:
                yield full()
                out = []
    if sha is not None:
        out.append((*key, sha.hexdigest()))
        yield full()


def member_digests(ends: DataFrame) -> DataFrame:
    """``(o, d, ends)``: SHA-256 of the ascending ids ``c`` of each node ``(o, d)``. Ranges of
    (node, id) are joined to strings in parallel; a node's strings are hashed in order."""
    order = ["o", "d", "c"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _joined, "o long, d long, first long, ids string")
    return runs.repartition("o", "d").sortWithinPartitions("o", "d", "first").mapInArrow(
        _digests, "o long, d long, ends string")


# ------------------------------------------------------------------ centroid decomposition
def _preorder(parent: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each node in a walk of the forest from its tops, and the place after its
    last descendant. ``order`` lists parents before children; tops are their own parents."""
    size = [1] * len(parent)
    up = parent.tolist()
    for v in reversed(order.tolist()):
        if up[v] != v:
            size[up[v]] += size[v]
    begin = [0] * len(parent)
    free = list(begin)  # next place for a child
    at = 0
    for v in order.tolist():
        if up[v] == v:
            begin[v] = at
            at += size[v]
        else:
            begin[v] = free[up[v]]
            free[up[v]] += size[v]
        free[v] = begin[v] + 1
    begin = np.array(begin)
    return begin, begin + np.array(size)


def decompose(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each node's subtree in a forest (tops are their own parents), by
    centroid decomposition of all its trees at once.

    Nodes are laid out in walk order, so "below the centroid" is a range. Each round finds the
    deepest node of every component with more than half of its nodes below or at it, adds the
    totals of that part to the nodes between the centroid and the component's top, and splits.
    """
    order = np.argsort(depth, kind="stable")
    begin, end = _preorder(parent, order)
    walk = np.argsort(begin)
    place = begin  # node -> place
    up, low, last = place[parent[walk]], depth[walk], end[walk]
    own = values[walk].astype(np.int64)
    total = own.copy()
    n = len(walk)
    size = last - np.arange(n)
    live = np.arange(n)
    comp = np.maximum.accumulate(np.where(up == live, live, 0))
    while len(live):
        # live nodes by component and walk order; a component's top comes first
        live = live[np.lexsort((live, comp[live]))]
        c = comp[live]
        head = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        which = np.cumsum(np.r_[False, c[1:] != c[:-1]])
        heavy = np.where(2 * size[live] > size[live[head]][which], low[live], -1)
        deepest = np.maximum.reduceat(heavy, head)
        g = live[np.flatnonzero(heavy == deepest[which])]  # one a component: heavy nodes form a chain
        mine = g[which]
        below = (live >= mine) & (live < last[mine])
        part = np.add.reduceat(np.where(below[:, None], own[live], 0), head, axis=0)
        path = (live < mine) & (last[live] > mine)
        total[live[path]] += part[which[path]]
        total[g] += part - own[g]
        size[live[path]] -= size[g][which[path]]
        # below the centroid each child starts a component: the child at or before a node
        under = below & (live != mine)
        first = under & (up[live] == mine)
        child = np.searchsorted(which[first] * n + live[first], which[under] * n + live[under], "right") - 1
        comp[live[under]] = live[first][child]
        live = live[live != mine]
    out = np.empty_like(total)
    out[walk] = total
    return out


_SUMS = "o long, d long, n_leaves long, saved long"


def _decompose_group(group: pa.Table) -> pa.Table:
    """Sums within the components of one bucket."""
    o, d, po, to, td = (group.column(x).to_numpy() for x in ("o", "d", "po", "to", "td"))
    place = {k: i for i, k in enumerate(zip(o.tolist(), d.tolist()))}
    top = (o == to) & (d == td)
    parent = np.array([i if t else place[p, k - 1] for i, (t, p, k) in
                       enumerate(zip(top.tolist(), po.tolist(), d.tolist()))], np.int64)
    values = np.stack([group.column("leaf").to_numpy(), group.column("saved").to_numpy()], axis=1)
    sums = decompose(parent, d, values)
    return pa.table([o, d, sums[:, 0], sums[:, 1]], names=["o", "d", "n_leaves", "saved"])


def rollup(nodes: DataFrame, steps: DataFrame, group_nodes: int = 50_000) -> DataFrame:
    """``(o, d, n_leaves, saved)``: sums of ``leaf`` and ``saved`` over each node's subtree.

    ``nodes``: (o, d, po, steps_below, leaf, saved) with the parent's name (po, d - 1), null at
    tops, and the steps at or below the node. ``steps``: (c, d, o, po) of every conversation.
    """
    root = nodes.where("d = 0").select("o").first()
    live = stored(nodes.withColumns({"to": F.lit(root and root["o"]).cast("long"), "td": F.lit(0).cast("long")}), "trie-live")
    key = ["to", "td"]
    small, adds = [], []
    while True:
        sizes = live.groupBy(*key).agg(F.count("*").alias("m"), F.max("steps_below").alias("weight"))
        large = stored(sizes.where(F.col("m") > group_nodes).select(*key, "weight"), "trie-large")
        if large.isEmpty():
            small.append(live)
            break
        small.append(live.join(large.select(*key), key, "left_anti"))
        live = live.join(large, key)
        g = live.where(2 * F.col("steps_below") > F.col("weight")).groupBy(*key).agg(
            F.max(F.struct("d", "o", "steps_below")).alias("g"))
        g = stored(g.select(*key, F.col("g.o").alias("go"), F.col("g.d").alias("gd"), F.col("g.steps_below").alias("gs")),
                   "trie-centroids")
        live = live.drop("weight").join(g.drop("gs"), key)
        # the step after the centroid's depth, in the conversation that names the node
        after = steps.select(F.col("c").alias("o"), (F.col("d") - 1).alias("gd"), F.col("o").alias("co"), F.col("po").alias("cp"))
        at = F.col("d") - F.col("gd")
        own = live.where(at <= 0).withColumns({"co": F.lit(None).cast("long"),
                                               "below": (at == 0) & (F.col("o") == F.col("go"))})
        deep = live.where(at > 0).join(after, ["o", "gd"]).withColumn("below", F.col("cp") == F.col("go")).drop("cp")
        live = stored(own.unionByName(deep), "trie-split")
        part = live.where("below").groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved"))
        part = stored(g.join(part, key), "trie-parts")
        path = stored(part.join(steps.select(F.col("c").alias("go"), "d", "o"), "go").where(
            (F.col("d") >= F.col("td")) & (F.col("d") < F.col("gd"))).select("o", "d", "n_leaves", "saved", "gs"), "trie-path")
        adds.append(path.select("o", "d", "n_leaves", "saved"))
        adds.append(part.select(F.col("go").alias("o"), F.col("gd").alias("d"), "n_leaves", "saved"))
        under = F.col("below") & F.col("co").isNotNull()
        live = live.where(~F.col("below") | F.col("co").isNotNull()).join(path.select("o", "d", "gs"), ["o", "d"], "left").select(
            "o", "d", "po", (F.col("steps_below") - F.coalesce("gs", F.lit(0))).alias("steps_below"), "leaf", "saved",
            F.when(under, F.col("co")).otherwise(F.col("to")).alias("to"),
            F.when(under, F.col("gd") + 1).otherwise(F.col("td")).alias("td"))
        live = stored(live, "trie-live")
    rest = small[0]
    for x in small[1:]:
        rest = rest.unionByName(x.select(*rest.columns))
    buckets = max(1, -(-nodes.count() // group_nodes))
    dealt = rest.select("o", "d", "po", *key, "leaf", "saved", F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("bucket"))
    sums = dealt.groupBy("bucket").applyInArrow(_decompose_group, _SUMS)
    for x in adds:
        sums = sums.unionByName(x)
    return sums.groupBy("o", "d").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


# ------------------------------------------------------------------ the trie
def conversation_trie(convs: DataFrame, every: int = 100, heads: int = 6, group_nodes: int = 50_000) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree, and
    ``ends_sha256`` of the members that end there."""
    ship(convs.sparkSession)
    turns, lengths = rebuilt_turns(convs, every, heads)
    hashed = stored(_prefixes(turns), "trie-prefixes")
    node = ["d", "x1", "x2"]
    below = F.sum(F.col("length") - F.col("d") + 1)
    named = hashed.groupBy(*node).agg(F.min("c").alias("o"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
                                      below.alias("steps_below"))
    named = stored(named, "trie-names")
    first = lengths.agg(F.min("c").alias("o"), F.count("*").alias("n_convs"),
                        F.sum(F.col("length") + 1).alias("steps_below")).where("n_convs > 0")
    root = first.first()
    root_id = F.lit(None if root is None else root["o"]).cast("long")
    own = hashed.select("c", *node).join(named.select(*node, "o"), node).select("c", "d", "o")
    own = stored(own, "trie-own")
    above = own.select("c", (F.col("d") + 1).alias("d"), F.col("o").alias("po"))
    deeper = own.where("d > 1").join(above, ["c", "d"]).select("c", "d", "o", "po")
    tops = own.where("d = 1").select("c", "d", "o", root_id.alias("po"))
    base = lengths.select("c", F.lit(0).cast("long").alias("d"), root_id.alias("o"), F.lit(None).cast("long").alias("po"))
    steps = stored(deeper.unionByName(tops).unionByName(base), "trie-steps")
    parents = steps.where("c = o AND d > 0").select("o", "d", "po")
    nodes = named.join(parents, ["o", "d"]).select("o", "d", "po", "n_convs", "size", "steps_below").unionByName(
        first.select("o", F.lit(0).cast("long").alias("d"), F.lit(None).cast("long").alias("po"), "n_convs",
                     F.lit(0).cast("long").alias("size"), "steps_below"))
    children = nodes.where("d > 0").groupBy(F.col("po").alias("o"), (F.col("d") - 1).alias("d")).agg(
        F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, ["o", "d"], "left").select(
        "o", "d", "po", "n_convs", "steps_below", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved")),
        "trie-nodes")
    sums = rollup(nodes.select("o", "d", "po", "steps_below", "leaf", "saved"), steps, group_nodes)
    ends = steps.join(lengths.select("c", F.col("length").alias("d")), ["c", "d"]).select("o", "d", "c")
    out = nodes.drop("leaf", "saved").join(sums, ["o", "d"]).join(member_digests(ends), ["o", "d"], "left")
    return out.select(F.col("o").alias("conv_id"), F.col("d").alias("depth"), F.col("po").alias("parent_conv_id"), "n_convs",
                      "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), _or_empty("ends").alias("ends_sha256"))


def _or_empty(ends: str) -> Column:
    return F.coalesce(F.col(ends), F.lit(hashlib.sha256(b"").hexdigest()))
