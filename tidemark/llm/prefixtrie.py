"""Conversation prefix trie by double arrays.

Conversations are rebuilt (see ``rebuilt``); every distinct prefix of their
(role, text) turns is a node.  Turns travel as 16-byte digests, texts never; a
node is known by the exclusive-or of 128-bit hashes of (turn, depth).

Equal conversations are one path with a weight.  A *heavy* node has more than
``limit`` path rows below it; the highest nodes that aren't heavy are the prefix
shards.  Each task packs some shards into a double array over dense turn ids,
walks it for its nodes and adds up their subtrees.  What a shard sends up to its
heavy parent is one row; these rows are merged globally, and the paths to the
heavy nodes go through the same step again, until only the root is left: usually
two rounds, more only for heavy paths longer than ``limit`` turns.  So neither a
frequent first turn, nor copies, nor a very long conversation meets in one task.
A list of members of one node is hashed in order, from chunks, in one task: that
is the nature of its hash.

Edge cases: a null conversation id takes no part; null turns come first, rows of
equal turn are ordered by the digest of the row (MD5 of length of role, colon,
role and text); null role or text counts as empty; repeated rows are turns like
others; an empty table has no root and gives no rows.  Columns other than the
four are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored
from .doublearray import DoubleArray
from .structure import crc32_sql

FAMILY, MOST_SHARED = 100, 6
BLOCK = 1024
CHUNK_IDS = 50_000
NONE = -1 << 63


def _ranked(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank from 1, turn_id, size) of every row in its conversation's
    order: numbered in range partitions, then moved by the partitions before."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("turn_id"), F.length(text).cast("long").alias("size"))
    order = ["conv_id", "turn", "turn_id"]
    dealt = rows.where("conv_id is not null").repartitionByRange(*order).sortWithinPartitions(*order)
    seq = stored(dealt.select("conv_id", "turn_id", "size", F.monotonically_increasing_id().alias("pos")).withColumn("seg", F.shiftright("pos", 33)), "trie-rows")
    inside = seq.withColumn("rank", F.row_number().over(Window.partitionBy("conv_id", "seg").orderBy("pos")).cast("long"))
    before = Window.partitionBy("_c").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range partition
    offset = (seq.groupBy(F.col("conv_id").alias("_c"), F.col("seg").alias("_s")).agg(F.count("*").alias("_n"))
              .select("_c", "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return inside.join(offset, (F.col("conv_id") == F.col("_c")) & (F.col("seg") == F.col("_s"))).select(
        "conv_id", (F.col("rank") + F.col("_off")).alias("rank"), "turn_id", "size")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, turn_id, size), (conv_id, length)): each conversation c
    as the first crc32(c) % 6 turns of conversation c - c % 100, then its own
    turns after as many."""
    rows = stored(_ranked(conversations), "trie-ranked")
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = counts.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h"),
                          (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
    lead = counts.select(F.col("conv_id").alias("_f"), F.col("n").alias("_fn"))
    convs = stored(convs.join(lead, F.col("family") == F.col("_f"), "left").select("conv_id", "n", "h", "family", F.least("h", F.coalesce("_fn", F.lit(0))).alias("shared")), "trie-convs")
    who = convs.select(F.col("conv_id").alias("_c"), "h", "shared")
    own = rows.join(who, F.col("conv_id") == F.col("_c")).where("rank > h").select("conv_id", (F.col("shared") + F.col("rank") - F.col("h")).alias("depth"), "turn_id", "size")
    first = rows.where((F.col("rank") < MOST_SHARED) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("_f"), "rank", "turn_id", "size")
    taken = convs.join(first, F.col("family") == F.col("_f")).where("rank <= shared").select("conv_id", F.col("rank").alias("depth"), "turn_id", "size")
    return own.unionByName(taken), convs.select("conv_id", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def prefixed(turns: DataFrame) -> DataFrame:
    """Turns with the node (a, b) they lead to and the node (pa, pb) before:
    exclusive-ors of hashes, run within blocks of a conversation and offset by
    the blocks before."""
    x = turns.select("*", F.xxhash64("depth", "turn_id").alias("_a"), F.xxhash64("turn_id", "depth", F.lit("b")).alias("_b"),
                     F.floor(F.col("depth") / BLOCK).alias("_block"))
    run = Window.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_c").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    offset = (x.groupBy(F.col("conv_id").alias("_c"), F.col("_block").alias("_k")).agg(F.bit_xor("_a").alias("_a0"), F.bit_xor("_b").alias("_b0"))
              .select("_c", "_k", F.coalesce(F.bit_xor("_a0").over(before), F.lit(0)).alias("_a0"), F.coalesce(F.bit_xor("_b0").over(before), F.lit(0)).alias("_b0")))
    x = x.select("*", F.bit_xor("_a").over(run).alias("_ra"), F.bit_xor("_b").over(run).alias("_rb"))
    x = x.join(offset, (F.col("conv_id") == F.col("_c")) & (F.col("_block") == F.col("_k")))
    a, b = F.col("_ra").bitwiseXOR(F.col("_a0")), F.col("_rb").bitwiseXOR(F.col("_b0"))
    return x.select("conv_id", "depth", "turn_id", "size", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("_a")).alias("pa"), b.bitwiseXOR(F.col("_b")).alias("pb"))


def _member_hashes(ends: DataFrame) -> DataFrame:
    """(ends, sha): for each node where conversations end, its least such
    conversation and the hash of their ids in order."""
    def chunks(batches):
        now, ids = None, []

        def done():
            return pa.record_batch([pa.array([now[0]]), pa.array([now[1]]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names=["a", "b", "lo", "ids"])

        for batch in batches:
            a, b, c = (batch.column(n).to_numpy() for n in ("a", "b", "conv_id"))
            cut = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else []
            for lo, hi in zip(cut, np.append(cut[1:], len(a))):
                key = int(a[lo]), int(b[lo])
                if ids and (key != now or len(ids) >= CHUNK_IDS):
                    yield done()
                    ids = []
                now = key
                ids += c[lo:hi].tolist()
        if ids:
            yield done()

    def hashes(batches):
        now, least, sha, rows = None, None, None, []
        for batch in batches:
            for a, b, lo, ids in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "lo", "ids"))):
                if (a, b) != now:
                    if now is not None:
                        rows.append((least, sha.hexdigest()))
                    now, least, sha = (a, b), lo, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if rows:
                yield pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["ends", "sha"])
                rows = []
        if now is not None:
            yield pa.record_batch([pa.array([least]), pa.array([sha.hexdigest()])], names=["ends", "sha"])

    order = ["a", "b", "conv_id"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return (dealt.mapInArrow(chunks, "a long, b long, lo long, ids string").repartition("a", "b").sortWithinPartitions("a", "b", "lo")
            .mapInArrow(hashes, "ends long, sha string"))


_NODE = ("conv_id long, depth long, a long, b long, pa long, pb long, parent long, n long, kids long, leaves long, saved long, ends long, heavy boolean")


def _nodes(rows: dict) -> pa.RecordBatch:
    """The nodes of some shards, whose rows are sorted by (ca, cb, path, depth)."""
    new_path = np.append(True, (rows["path"][1:] != rows["path"][:-1]) | (rows["ca"][1:] != rows["ca"][:-1]) | (rows["cb"][1:] != rows["cb"][:-1]))
    offs = np.append(np.flatnonzero(new_path), len(new_path))
    shard = np.cumsum(np.append(True, (rows["ca"][1:] != rows["ca"][:-1]) | (rows["cb"][1:] != rows["cb"][:-1]))) - 1
    # dense ids in order of first use, so that siblings lie close together; the root's children are the shards
    hi, lo = rows["turn"][:, 0], rows["turn"][:, 1]
    by = np.lexsort((lo, hi))
    _, use, dense = np.unique(np.cumsum(np.append(True, (hi[by][1:] != hi[by][:-1]) | (lo[by][1:] != lo[by][:-1])))[np.argsort(by)], return_index=True, return_inverse=True)
    rank = np.empty(len(use), np.int64)
    rank[np.argsort(use)] = np.arange(len(use))
    label = rank[dense]
    top = offs[:-1]
    label[top] = shard[top]
    trie = DoubleArray(label, offs)
    slot, last = trie.slot, offs[1:] - 1
    parent = trie.check
    n, kids, leaves, saved = (np.zeros(trie.size, np.int64) for _ in range(4))
    least, ends = np.full(trie.size, np.iinfo(np.int64).max), np.full(trie.size, NONE)
    end_at = slot[last]
    for total, name in ((n, "n"), (kids, "kids"), (leaves, "leaves"), (saved, "saved")):
        np.add.at(total, end_at, rows[name][last])
    np.minimum.at(least, end_at, rows["path"][last])
    np.maximum.at(ends, end_at, rows["ends"][last])
    heavy = kids > 0
    # a row of each node, and the nodes by depth
    node, row = np.unique(slot, return_index=True)
    depth = np.zeros(trie.size, np.int64)
    depth[node] = rows["depth"][row]
    size = np.zeros(trie.size, np.int64)
    size[node] = rows["size"][row]
    root = parent[node] == 0
    level = node[np.argsort(-depth[node], kind="stable")]
    cut = np.append(np.flatnonzero(np.append(True, depth[level][1:] != depth[level][:-1])), len(level))
    for f, t in zip(cut[:-1], cut[1:]):
        v = level[f:t]
        leaves[v] += kids[v] == 0
        saved[v] += (n[v] - 1) * size[v]
        u = parent[v]
        np.add.at(n, u, n[v]), np.add.at(kids, u, 1), np.add.at(leaves, u, leaves[v]), np.add.at(saved, u, saved[v])
        np.minimum.at(least, u, least[v])
    up = pa.array(least[parent[node]], mask=root)
    num = lambda x: pa.array(x[node])
    own = lambda name: pa.array(rows[name][row])
    return pa.record_batch([num(least), num(depth), own("a"), own("b"), own("pa"), own("pb"), up, num(n), num(kids), num(leaves), num(saved),
                            pa.array(ends[node], mask=ends[node] == NONE), pa.array(heavy[node])], names=[f.split()[0] for f in _NODE.split(", ")])


_CARRIED = ["path", "length", "n", "kids", "leaves", "saved", "ends"]
_ROW = ["ca", "cb", "path", "depth", "size", "a", "b", "pa", "pb", "n", "kids", "leaves", "saved", "ends", "turn_id"]


def _packed(target: int):
    """Sorted rows of shards to their nodes, about ``target`` rows at a time."""
    def read(b) -> dict:
        out = {c: b.column(c).to_numpy() for c in _ROW[:-1]}
        ids = b.column("turn_id")
        ids = ids.cast(pa.large_binary()) if not pa.types.is_large_binary(ids.type) else ids
        at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        out["turn"] = np.frombuffer(ids.buffers()[2], np.uint8)[at[0]:at[-1]].view(np.uint64).reshape(-1, 2)
        return out

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            new = read(b)
            held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in held}
            if len(held["path"]) >= target:
                same = (held["ca"] == held["ca"][-1]) & (held["cb"] == held["cb"][-1])
                done = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if done:
                    yield _nodes({c: v[:done] for c, v in held.items()})
                    held = {c: v[done:] for c, v in held.items()}
        if held is not None:
            yield _nodes(held)
    return run


def nodes(conversations: DataFrame, limit: int = 16_384) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    turns, convs = rebuilt(conversations)
    steps = stored(prefixed(turns), "trie-steps")
    tail = steps.groupBy(F.col("conv_id").alias("_c")).agg(F.max_by(F.struct("a", "b"), "depth").alias("_t"))
    ends = stored(convs.join(tail, F.col("conv_id") == F.col("_c"), "left").select(
        "conv_id", "length", F.coalesce("_t.a", F.lit(0)).alias("a"), F.coalesce("_t.b", F.lit(0)).alias("b")), "trie-ends")
    hashes = stored(_member_hashes(ends), "trie-hashes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")]
    entries = stored(ends.groupBy("length", "a", "b").agg(F.min("conv_id").alias("path"), F.count("*").alias("n"))
                     .select("length", "a", "b", "path", "n", *zero, F.col("path").alias("ends")), "trie-entries")
    parts = []
    while entries.where("length > 0").limit(1).count():
        deep = entries.where("length > 0").drop("a", "b")
        rows = stored(steps.join(deep, (F.col("conv_id") == F.col("path")) & (F.col("depth") <= F.col("length"))).drop("conv_id"), "trie-paths")
        heavy = (rows.groupBy(F.col("a").alias("_a"), F.col("b").alias("_b")).agg(F.sum(F.expr("length - depth + 1")).alias("_below"))
                 .where(F.col("_below") > limit).select("_a", "_b"))
        light = rows.join(heavy, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")
        cuts = stored(light.groupBy(F.col("path").alias("_p")).agg(F.min_by(F.struct("a", "b"), "depth").alias("_cut")), "trie-cuts")
        keyed = light.join(cuts, F.col("path") == F.col("_p")).select(F.col("_cut.a").alias("ca"), F.col("_cut.b").alias("cb"), *_ROW[2:])
        part = stored(keyed.withColumn("ends", F.coalesce("ends", F.lit(NONE))).repartition("ca", "cb").sortWithinPartitions("ca", "cb", "path", "depth")
                      .mapInArrow(_packed(4 * limit), _NODE), "trie-nodes")
        parts.append(part)
        up = part.where("parent is null").select((F.col("depth") - 1).alias("length"), F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("conv_id").alias("path"),
                                                 "n", F.lit(1).cast("long").alias("kids"), "leaves", "saved", F.lit(None).cast("long").alias("ends"))
        stay = entries.join(cuts, F.col("path") == F.col("_p"), "left_anti")  # ends at a heavy node or the root
        merged = up.unionByName(stay).groupBy("length", "a", "b").agg(
            F.min("path").alias("path"), *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")], F.max("ends").alias("ends"))
        entries, old = stored(merged, "trie-entries"), entries
        discard(rows, cuts, old)
    cols = ["conv_id", "depth", "parent_conv_id", "n", "kids", "leaves", "saved", "ends"]
    root = entries.select(F.col("path").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n", "kids",
                          F.greatest("leaves", F.lit(1)).alias("leaves"), "saved", "ends")
    out = root.select(*cols)
    if parts:
        top = root.first()["conv_id"]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        known = every.where("heavy").select((F.col("depth") + 1).alias("_d"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("conv_id").alias("_parent"))
        loose = every.where("parent is null and depth > 1").join(known, (F.col("depth") == F.col("_d")) & (F.col("pa") == F.col("_a")) & (F.col("pb") == F.col("_b")))
        out = (out.unionByName(loose.withColumn("parent_conv_id", F.col("_parent")).select(*cols))
               .unionByName(every.where("parent is not null or depth = 1").withColumn("parent_conv_id", F.coalesce("parent", F.lit(top))).select(*cols)))
    hashes = hashes.select(F.col("ends").alias("_e"), "sha")
    none = hashlib.sha256(b"").hexdigest()
    return out.join(hashes, F.col("ends") == F.col("_e"), "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(none)).alias("ends_sha256"))


def oracle_sql() -> str:
    """The same nodes in DuckDB, by prefix digests and joins to ancestors."""
    return f"""
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || t)) AS rank,
                      md5(length(r) || ':' || r || t) AS id, length(t) AS size
               FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, max(rank) AS n, {crc32_sql("conv_id::VARCHAR")} % 6 AS h, conv_id - conv_id % 100 AS family FROM turns GROUP BY conv_id),
shared AS (SELECT c.*, least(c.h, coalesce(f.n, 0)) AS taken FROM convs c LEFT JOIN convs f ON f.conv_id = c.family),
built AS (SELECT c.conv_id, t.rank AS depth, t.id, t.size FROM shared c JOIN turns t ON t.conv_id = c.family AND t.rank <= c.taken
          UNION ALL
          SELECT c.conv_id, c.taken + t.rank - c.h, t.id, t.size FROM shared c JOIN turns t ON t.conv_id = c.conv_id AND t.rank > c.h),
paths AS (SELECT conv_id, depth, size, md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM built
          UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
linked AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last FROM paths),
nodes AS (SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                 string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last) AS ends FROM linked GROUP BY node, depth),
kids AS (SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * size AS saved FROM nodes LEFT JOIN kids ON kids.parent = nodes.node),
below AS (SELECT p.node, count(*) FILTER (o.n_children = 0) AS n_leaves, sum(o.saved) AS saved_tokens
          FROM own o JOIN paths p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY p.node)
SELECT own.conv_id, own.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(own.ends, '')) AS ends_sha256
FROM own JOIN below ON below.node = own.node LEFT JOIN own up ON up.node = own.parent
"""
