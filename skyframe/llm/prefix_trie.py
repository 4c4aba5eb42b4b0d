"""Conversation prefix trie, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. Its key is a pair of 64-bit
words: the exclusive or of the hashes of (place, turn) over its turns, so a
prefix's key is a running aggregate and a conversation of any length is cut
into blocks whose carries are combined.

Subtree sums follow the parent edges by centroid decomposition. In every
component the deepest node that holds half of it or more is its centroid;
what lies below the centroid in the component is summed, added to the
centroid and to the nodes on the path up to the component's top, and taken
off their sizes; the children's subtrees and the rest become components of
their own. A component at least halves, so the rounds grow with the
logarithm of the tree, however deep a chain or wide a fan is. Components
larger than a bound are split by joins: the turn after the centroid in the
conversation that names a node tells whether, and through which child, it
lies below, and that of the centroid lists its path. Smaller components are
packed into shards and split further inside one Arrow function each, with
the same steps on arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.plans.ordered import with_rank
from skyframe.session import written

#: Turns of one conversation that one window task orders.
BLOCK = 4096
#: Centroids of one round that are broadcast; more are joined.
FEW = 100_000
#: Bytes of conversation ids in one packed row.
CHUNK = 1 << 20


def shared_turns(conv: Column, most: int) -> Column:
    """Turns taken from the donor: a hash of the id, below ``most``."""
    return (F.crc32(conv.cast("string").cast("binary")) % most).cast("int")


def rebuilt_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", family: int = 20, most: int = 4) -> DataFrame:
    """(c, depth, total, a, b, words): the turns of the rebuilt conversations, from depth 1, and a row of depth 0 each.

    Conversation c takes its first h turns from conversation c - c % family
    and goes on with its own turns after its first h; ``total`` counts its
    turns, ``a`` and ``b`` hash the role and text. A donor gives fewer than
    ``most`` turns to fewer than 2 * ``family`` conversations.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.substring(text, 1, 32).alias("head"), F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
    ranked = with_rank(written(turns, "turns"), ["turn"], group=["c"], tie=["role", "head", "a", "b"], rank_col="pos",
                       size_col="len")
    ranked = written(ranked.select("c", "pos", "len", "a", "b", "words"), "ranked-turns")

    lent = ranked.filter((F.col("pos") < most) & (F.col("c") % family == 0)).select(
        F.col("c").alias("donor"), "pos", "len", "a", "b", "words")
    own = F.greatest(F.col("len") - F.col("h"), F.lit(0))
    taken = F.least(F.col("h"), F.coalesce(F.col("has"), F.lit(0))).cast("int")
    convs = ranked.filter("pos = 1").select("c", "len", shared_turns(F.col("c"), most).alias("h"),
                                            (F.col("c") - F.col("c") % family).alias("donor"))
    convs = convs.join(lent.filter("pos = 1").select("donor", F.col("len").alias("has")), "donor", "left").select(
        "c", "donor", "h", taken.alias("k"), (taken + own).cast("long").alias("total"))
    convs = written(convs, "rebuilt")

    first = convs.join(lent.drop("len"), "donor").filter("pos <= k").select(
        "c", F.col("pos").cast("long").alias("depth"), "total", "a", "b", "words")
    rest = ranked.filter(F.col("pos") > shared_turns(F.col("c"), most)).join(convs, "c").select(
        "c", (F.col("pos") - F.col("h") + F.col("k")).cast("long").alias("depth"), "total", "a", "b", "words")
    tops = convs.select("c", F.lit(0).cast("long").alias("depth"), "total", F.lit(0).cast("long").alias("a"),
                        F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("words"))
    return first.unionByName(rest).unionByName(tops)


def prefixes(turns: DataFrame) -> DataFrame:
    """(c, depth, total, words, h1, h2, p1, p2): each turn's node and its parent, as keys."""
    def word(name, top):
        return F.when(F.col("depth") > 0, F.xxhash64("depth", name, F.lit(top))).otherwise(F.lit(0).cast("long"))

    x = written(turns.select("c", "depth", "total", "words", word("a", 1).alias("x"), word("b", 2).alias("y"),
                             F.expr(f"depth div {BLOCK}").alias("block")), "hashed-turns")
    so_far = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = x.select("*", F.bit_xor("x").over(so_far).alias("h1"), F.bit_xor("y").over(so_far).alias("h2"))
    out = run.filter("block = 0")
    if not x.filter("block > 0").isEmpty():
        carry = _carries(x.groupBy("c", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")))
        out = out.unionByName(run.filter("block > 0").join(carry, ["c", "block"]).select(
            *[c for c in run.columns if c not in ("h1", "h2")], F.col("h1").bitwiseXOR(F.col("cx")).alias("h1"),
            F.col("h2").bitwiseXOR(F.col("cy")).alias("h2")))
    return out.select("c", "depth", "total", "words", "h1", "h2", F.col("h1").bitwiseXOR(F.col("x")).alias("p1"),
                      F.col("h2").bitwiseXOR(F.col("y")).alias("p2"))


def _carries(per: DataFrame) -> DataFrame:
    """(c, block, cx, cy): what the blocks before a block of a conversation add up to, over blocks of blocks."""
    none = F.lit(0).cast("long")
    per = written(per.withColumn("far", F.expr(f"block div {BLOCK}")), "blocks")
    far = per.groupBy("c", "far").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    over = Window.partitionBy("c").orderBy("far").rowsBetween(Window.unboundedPreceding, -1)
    far = far.select("c", "far", *[F.coalesce(F.bit_xor(n).over(over), none).alias("f" + n) for n in "xy"])
    near = Window.partitionBy("c", "far").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = per.select("c", "far", "block", *[F.coalesce(F.bit_xor(n).over(near), none).alias("n" + n) for n in "xy"])
    return here.join(far, ["c", "far"]).select(
        "c", "block", *[F.col("n" + n).bitwiseXOR(F.col("f" + n)).alias("c" + n) for n in "xy"])


def _sizes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(h1, h2, size): nodes below and at each node. A conversation names a run of nodes at the end of its path."""
    named = nodes.groupBy(F.col("conv").alias("c")).agg(F.count(F.lit(1)).alias("m"))
    below = F.least(F.col("m"), F.col("total") - F.col("depth") + 1)
    return rows.join(named, "c").groupBy("h1", "h2").agg(F.sum(below).alias("size"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= FEW else df


def split_round(big: DataFrame, rows: DataFrame, bound: int) -> tuple[DataFrame, DataFrame] | None:
    """One round over components larger than ``bound``: (the nodes in their new components, sums to add to nodes)."""
    centers = big.filter("2 * size >= s").groupBy("t1", "t2").agg(F.max_by(
        F.struct(F.col("h1").alias("x1"), F.col("h2").alias("x2"), F.col("conv").alias("xc"), F.col("depth").alias("xd"),
                 F.col("size").alias("xs"), F.col("top").alias("xt")), "depth").alias("x")).select("t1", "t2", "x.*")
    centers = written(centers, "centroids")
    n = centers.count()
    if n == 0:
        return None
    u = big.join(_small(centers, n), ["t1", "t2"])
    # the turn after the centroid in the path of a deeper node: its parent is the centroid, or the node lies elsewhere
    after = rows.select(F.col("c").alias("conv"), (F.col("depth") - 1).alias("xd"), F.col("p1").alias("q1"),
                        F.col("p2").alias("q2"), F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    deeper = u.filter("depth > xd").join(after, ["conv", "xd"])
    others = u.filter("depth <= xd").select("*", *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2", "k1", "k2")])
    under = F.coalesce((F.col("q1") == F.col("x1")) & (F.col("q2") == F.col("x2")), F.lit(False))
    at = (F.col("h1") == F.col("x1")) & (F.col("h2") == F.col("x2"))
    placed = written(deeper.unionByName(others).withColumns({"under": under, "at": at}), "placed")

    sums = placed.filter("under or at").groupBy("t1", "t2").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    sums = centers.join(sums, ["t1", "t2"])
    path = rows.join(_small(sums, n), (F.col("c") == F.col("xc")) & (F.col("depth") <= F.col("xd"))
                     & (F.col("depth") >= F.col("xt")))
    path = written(path.select("h1", "h2", rows["depth"], "leaf", "saved", "xs"), "paths")

    tops = written(placed.filter("under and h1 = k1 and h2 = k2").filter(F.col("size") > bound).select(
        "k1", "k2", F.col("size").alias("ks")), "tops")
    keep = ["h1", "h2", "p1", "p2", "conv", "depth", "size", "leaf", "saved"]
    below = placed.filter("under").join(_small(tops, tops.count()), ["k1", "k2"], "left").select(
        *keep, F.col("k1").alias("t1"), F.col("k2").alias("t2"), (F.col("xd") + 1).alias("top"),
        F.coalesce("ks", F.lit(0)).alias("s"))
    off = path.select("h1", "h2", F.col("xs").alias("off"))
    above = placed.filter("not under and not at").join(off, ["h1", "h2"], "left").select(
        *[(F.col("size") - F.coalesce("off", F.lit(0))).alias("size") if c == "size" else F.col(c) for c in keep],
        "t1", "t2", "top", (F.col("s") - F.col("xs")).alias("s"))
    return written(below.unionByName(above), "components"), path.select("h1", "h2", "leaf", "saved")


def centroid_sums(parent: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Subtree sums of ``weights`` over a forest in preorder (``parent`` -1 at tops), by centroid decomposition."""
    n = len(parent)
    end, size, sums = np.arange(n) + size, size.copy(), np.zeros_like(weights)
    comp = np.where(parent < 0, np.arange(n), 0)
    comp = np.maximum.accumulate(comp)
    alive, center, total = np.ones(n, bool), np.zeros(n, np.int64), np.zeros_like(weights)
    while alive.any():
        at = np.flatnonzero(alive)
        own = comp[at]
        half = 2 * size[at] >= size[own]
        center[own[half]] = at[half]  # nodes with half of a component form a path: the last one in preorder stays
        x = center[own]
        low = (at >= x) & (at < end[x])
        total[own] = 0
        np.add.at(total, own[low], weights[at[low]])
        cur, top = at[at == x], own[at == x]
        add, less = total[top], size[cur]
        while len(cur):
            sums[cur] += add
            size[cur] -= less
            on = cur != top
            cur, top, add, less = parent[cur[on]], top[on], add[on], less[on]
        below = low & (at != x)
        seq, mid, old = at[below], x[below], own[below]
        order = np.argsort(old, kind="stable")
        seq, mid = seq[order], mid[order]
        child = np.where(parent[seq] == mid, np.arange(len(seq)), 0)
        comp[seq] = seq[np.maximum.accumulate(child)] if len(seq) else seq
        alive[at[at == x]] = False
    return sums


def preorder(parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of every node in preorder, subtree size) of a forest."""
    n = len(parent)
    order = np.argsort(depth, kind="stable")
    cut = np.flatnonzero(np.diff(depth[order], prepend=-1, append=-1))
    levels = [order[a:b] for a, b in zip(cut[:-1], cut[1:])]
    size = np.ones(n, np.int64)
    for level in reversed(levels):
        inner = level[parent[level] >= 0]
        np.add.at(size, parent[inner], size[inner])
    place, tops = np.zeros(n, np.int64), np.flatnonzero(parent < 0)
    place[tops] = np.cumsum(size[tops]) - size[tops]
    for level in levels:
        level = level[parent[level] >= 0]
        level = level[np.argsort(parent[level], kind="stable")]
        up, run = parent[level], np.cumsum(size[level]) - size[level]
        head = np.flatnonzero(np.diff(up, prepend=-1)) if len(up) else up
        run = run - np.repeat(run[head], np.diff(np.append(head, len(up)))) if len(up) else run
        place[level] = place[up] + 1 + run
    return place, size


def _roll_shards(nodes: DataFrame, shards: int) -> DataFrame:
    """(h1, h2, leaf, saved) of whole components: every shard rolls up its own."""
    def roll(table: pa.Table) -> pa.Table:
        col = {c: np.asarray(table.column(c)) for c in ("h1", "h2", "p1", "p2", "t1", "t2", "depth", "leaf", "saved")}
        n = table.num_rows
        number = dict(zip(zip(col["h1"].tolist(), col["h2"].tolist()), range(n)))
        top = (col["h1"] == col["t1"]) & (col["h2"] == col["t2"])
        parent = np.fromiter((-1 if t else number[p] for t, p in zip(
            top.tolist(), zip(col["p1"].tolist(), col["p2"].tolist()))), np.int64, n)
        place, size = preorder(parent, col["depth"])
        back = np.argsort(place)
        moved = np.where(parent[back] < 0, -1, place[parent[back]])
        sums = centroid_sums(moved, size[back], np.stack([col["leaf"][back], col["saved"][back]], 1))
        return pa.table([pa.array(col["h1"][back]), pa.array(col["h2"][back]), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
                        names=["h1", "h2", "leaf", "saved"])

    shard = F.pmod(F.xxhash64("t1", "t2"), F.lit(shards)).cast("int").alias("shard")
    rows = nodes.select("h1", "h2", "p1", "p2", "t1", "t2", "depth", "leaf", "saved", shard)
    return rows.groupBy("shard").applyInArrow(roll, "h1 long, h2 long, leaf long, saved long")


def roll_up(rows: DataFrame, nodes: DataFrame, bound: int = 4096) -> DataFrame:
    """(h1, h2, leaf, saved): the sums of both columns over the subtree of every node."""
    n = nodes.count()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    zero = F.lit(0).cast("long")
    state = nodes.select("h1", "h2", "p1", "p2", "conv", "depth", "leaf", "saved", zero.alias("t1"), zero.alias("t2"),
                         zero.alias("top"), F.lit(n).cast("long").alias("s"))
    small, added = [], []
    if n > bound:
        state = written(state.join(_sizes(rows, nodes), ["h1", "h2"]), "sizes")
        while (step := split_round(state.filter(F.col("s") > bound), rows, bound)) is not None:
            small.append(state.filter(F.col("s") <= bound))
            state = step[0]
            added.append(step[1])
    small.append(state.filter(F.col("s") <= bound))
    small = reduce(DataFrame.unionByName, [s.drop("size") for s in small])
    every = reduce(DataFrame.unionByName, added, _roll_shards(small, max(parts, -(-n // (4 * bound)))))
    return every.groupBy("h1", "h2").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))


def _end_digests(rows: DataFrame) -> DataFrame:
    """(h1, h2, digest) of the ascending ids that end at a node.

    Range tasks join the ids of a node to long strings first, so that a node
    at which very many conversations end is read as few rows where its
    digest, which must go through them in order, is taken.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, length, out = None, [], 0, []

        def flush():
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["h1", "h2", "first", "ids"])

        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("h1", "h2", "c"))):
                if (a, b) != key or length > CHUNK:
                    flush()
                    key, ids, length = (a, b), [], 0
                ids.append(c)
                length += 12
            if out:
                yield batch_of(out)
                out = []
        flush()
        if out:
            yield batch_of(out)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.string()))], names=["h1", "h2", "digest"])

        for batch in batches:
            for a, b, ids in zip(*(batch.column(x).to_pylist() for x in ("h1", "h2", "ids"))):
                if (a, b) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield batch_of(out)
                out = []
        if key is not None:
            yield batch_of([(*key, state.hexdigest())])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = rows.filter("depth = total").select("h1", "h2", "c")
    packed = ends.repartitionByRange(parts, "h1", "h2", "c").sortWithinPartitions("h1", "h2", "c").mapInArrow(
        pack, "h1 long, h2 long, first long, ids string")
    return packed.repartition(parts, "h1", "h2").sortWithinPartitions("h1", "h2", "first").mapInArrow(
        digest, "h1 long, h2 long, digest string")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", family: int = 20, most: int = 4, bound: int = 4096) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Nodes are the distinct sequences of first turns of the rebuilt
    conversations (``rebuilt_turns``), the empty one included; conv_id is the
    smallest conversation that starts with it, and (conv_id, depth) names it.
    n_leaves and saved_tokens ((n_convs - 1) times the words of the last
    turn) are sums over the subtree; ends_sha256 hashes the ids of the
    conversations that end there. ``bound`` is the size of the components
    that one task splits.

    Turns are ordered by ``turn_col``, null first, then by role, the first 32
    characters of the text and a hash; repeated rows are turns of their own.
    A null role or text is empty. Rows without a conversation id take no
    part. An empty table has no nodes. Other columns are neither read nor
    kept.
    """
    rows = written(prefixes(rebuilt_turns(conversations, conv_col, turn_col, role_col, text_col, family, most)), "paths")
    found = written(rows.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv"), F.min("depth").alias("depth"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("words").alias("words")), "found")
    kids = found.filter("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = written(found.join(kids, ["h1", "h2"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
        "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words")}), "nodes")
    sums = roll_up(rows, nodes, bound).withColumnsRenamed({"leaf": "n_leaves", "saved": "saved_tokens"})
    whole = nodes.join(sums, ["h1", "h2"]).join(_end_digests(rows), ["h1", "h2"], "left")

    # the root is the parent of very many nodes: its name is one number
    root = nodes.filter("depth = 0").select("conv").first()
    up = whole.filter("depth <= 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(root[0] if root else None).cast("long")))
    names = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    return up.unionByName(whole.filter("depth > 1").join(names, ["p1", "p2"]), allowMissingColumns=True).select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
