"""Near duplicates by DartMinHash: weighted signatures, bands, exact check, components.

A document is the multiset of its five-word shingles (lower case, words split
at ASCII white space); the weight of a shingle is its number of occurrences
and similarity is weighted Jaccard.  Documents with a similarity of 0.8 or
more are linked; classes are the connected components.

Edge cases: null texts and texts without a word have no shingle, are never
linked and form a class of their own; a text of one to four words is one
shingle.  Rows with equal texts are one class whatever their ids; a class is
named by its smallest non-null id (null if all are null).  Input columns other
than id and text are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fingerprint, stored
from .components import components
from .textblocks import blocks, counted, mix, shingles, unit, word_hashes, word_spans

COORDS, BAND_ROWS = 128, 4


def dart_signatures(h: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int, k: int = COORDS) -> np.ndarray:
    """DartMinHash signatures, n x k, of ``n`` weighted sets given as (element
    hash, weight, row); rows without elements get zeros.

    Every element throws the same darts in every set: in each unit-wide strip
    of its weight axis the darts are a unit-rate Poisson process along the rank
    axis, drawn from the element's hash, each with a position across the strip
    and a coordinate.  A set keeps the darts that fall under its weight; for
    each coordinate the dart of least rank is the signature's entry, so two
    sets agree in a coordinate with the probability of their weighted Jaccard
    similarity.  A set of total weight w needs ranks up to about (k ln k + 2k)/w
    for a dart in every coordinate; rows left with an empty one go on at
    double the rank limit.
    """
    sig = np.zeros((n, k), np.uint64)
    strips = np.ceil(weight).astype(np.int64)
    at = np.repeat(np.arange(len(h)), strips)
    level = np.arange(len(at)) - np.repeat(np.cumsum(strips) - strips, strips)
    seed = mix(h[at] + level.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    left, owner = weight[at] - level, row[at]
    total = np.bincount(row, weight, n)
    limit = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-9)
    todo = total > 0
    while todo.any():
        keep = todo[owner]
        s, room, own = seed[keep], left[keep], owner[keep]
        rank = np.zeros(len(s))
        ranks, ids, cells = [], [], []
        m = 0
        while len(s):
            m += 1
            dart = mix(s + np.uint64(m * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log(unit(dart))
            go = rank <= limit[own]
            s, room, own, rank, dart = s[go], room[go], own[go], rank[go], dart[go]
            other = mix(dart ^ np.uint64(0x5851F42D4C957F2D))
            under = unit(mix(other)) <= room
            ranks.append(rank[under]), ids.append(dart[under])
            cells.append((own * k + (other % np.uint64(k)).astype(np.int64))[under])
        rank, dart, cell = map(np.concatenate, (ranks, ids, cells))
        best = np.full(n * k, np.inf)
        np.minimum.at(best, cell, rank)
        won = rank == best[cell]
        sig.reshape(-1)[cell[won]] = dart[won]
        todo &= np.isinf(best.reshape(n, k)).any(axis=1)
        limit[todo] *= 2
    return sig


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    b = sig.reshape(len(sig), sig.shape[1] // rows, rows)
    acc = np.zeros(b.shape[:2], np.uint64)
    for j in range(rows):
        acc = mix(acc * np.uint64(0xD1342543DE82EF95) + b[:, :, j])
    return mix(acc + np.arange(acc.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def lists(flat: np.ndarray, starts: np.ndarray, kind=pa.int64()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, kind))


def signatures(texts: DataFrame, k: int = COORDS, rows: int = BAND_ROWS) -> DataFrame:
    """(fp, n, sig, bands) of (fp, text) rows: the number of shingles, a byte of
    each coordinate, the band keys; texts without words drop out."""
    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                r, s, e = word_spans(buf, offs)
                h, row, _ = shingles(word_hashes(buf, s, e), r)
                size = np.bincount(row, minlength=hi - lo)
                h, row, c = counted(h, row)
                sig = dart_signatures(h, c.astype(float), row, hi - lo, k)
                has = np.flatnonzero(size)
                keys = band_keys(sig[has], rows).view(np.int64)
                low = (sig[has] & np.uint64(255)).astype(np.uint8).tobytes()
                yield pa.record_batch([b.column(0).slice(lo, hi - lo).take(pa.array(has)), pa.array(size[has]),
                                       pa.FixedSizeBinaryArray.from_buffers(pa.binary(k), len(has), [None, pa.py_buffer(low)]).cast(pa.binary()),
                                       lists(keys.ravel(), np.arange(len(has) + 1) * keys.shape[1])],
                                      names=["fp", "n", "sig", "bands"])

    return texts.select("fp", F.lower("text").alias("text")).mapInArrow(run, "fp binary, n long, sig binary, bands array<long>")


def _sets(text: str) -> tuple[np.ndarray, np.ndarray]:
    for _, _, buf, offs in blocks(pa.array([text], pa.string()), 1 << 62):
        r, s, e = word_spans(buf, offs)
        return counted(*shingles(word_hashes(buf, s, e), r)[:2])[::2]


def similarity(a: str, b: str) -> float:
    """Exact weighted Jaccard of the shingle multisets of two lower-case texts."""
    (h1, c1), (h2, c2) = _sets(a), _sets(b)
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    both = np.minimum(c1[i], c2[j]).sum()
    return float(both / max(c1.sum() + c2.sum() - both, 1))


def verified(pairs: DataFrame, lower: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) pairs of fingerprints whose texts, in ``lower(fp, t)``, have
    the similarity."""
    def run(batches):
        for t in batches:
            ok = [similarity(x.as_py(), y.as_py()) >= threshold for x, y in zip(t.column(2), t.column(3))]
            yield pa.record_batch([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    x = pairs.join(lower.select(F.col("fp").alias("a"), F.col("t").alias("ta")), "a")
    x = x.join(lower.select(F.col("fp").alias("b"), F.col("t").alias("tb")), "b")
    return x.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def estimates(sig: np.ndarray, size: np.ndarray, comp: np.ndarray, side: np.ndarray | None, threshold: float) -> np.ndarray:
    """m x m shares of equal coordinates; -1 for pairs of one component, of one
    ``side`` if there are two, and for sizes that rule the threshold out."""
    est = np.empty((len(sig), len(sig)), np.float32)
    for i in range(len(sig)):
        est[i] = (sig[i] == sig).mean(axis=1)
    fits = np.minimum(size, size[:, None]) >= threshold * np.maximum(size, size[:, None])
    est[~fits | (comp == comp[:, None])] = -1
    if side is not None:
        est[side == side[:, None]] = -1
    return est


def forest(est: np.ndarray, least: float) -> list:
    """Pairs (i, j) of a maximum spanning forest of the estimates from ``least`` on."""
    m = len(est)
    out = []
    near, top = np.zeros(m, np.int64), np.full(m, -2.0, np.float32)
    left = np.ones(m, bool)
    at = 0
    for _ in range(m - 1):  # Prim's algorithm on the dense block
        left[at] = False
        up = est[at] > top
        near[up], top[up] = at, est[at][up]
        at = int(np.where(left, top, -3).argmax())
        if top[at] >= least:
            out.append((int(near[at]), at))
    return out


def links(h: np.ndarray, size: np.ndarray, comp: np.ndarray, side: np.ndarray | None, threshold: float) -> list:
    """Pairs (i, j) of exactly the similarity that join all components of a
    block which any pair of its members (of its two sides, if ``side`` is given)
    joins; ``h`` holds the members' sets (``unrolled``) one after the other,
    ``size`` their lengths."""
    ids = np.unique(h, return_inverse=True)[1]
    start = np.cumsum(size) - size
    comp, mark, out = comp.copy(), np.zeros(len(ids), np.int32), []
    for i in range(len(size) - 1):
        may = (comp != comp[i]) & (np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i]))
        may[:i] = False
        if side is not None:
            may &= side != side[i]
        if may.any():
            own = ids[start[i]:start[i] + size[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[ids], start)
            mark[own] = 0
            for j in np.flatnonzero(may & (both / (size + size[i] - both) >= threshold)):
                if comp[j] != comp[i]:
                    out.append((i, int(j)))
                    comp[comp == comp[j]] = comp[i]
    return out


def by_block(batches):
    """The rows of each block, as tables, of batches sorted by their first column."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        cuts = [0, *(np.flatnonzero(np.diff(t.column(0).to_numpy())) + 1).tolist()]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield t.slice(lo, hi - lo)
        rest = t.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest


def _numbers(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """sig, n and comp (numbered) of a block's rows."""
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(t), -1)
    return sig, t.column("n").to_numpy(), np.unique(np.array(t.column("comp").to_pylist(), "S16"), return_inverse=True)[1]


def _side(t: pa.Table) -> np.ndarray | None:
    """The halves of a block of two parts; None in one of a single part."""
    half = t.column("half").to_numpy()
    return half if half.any() else None


def _pairs(found: list) -> pa.RecordBatch:
    got = list({(x, y) if x < y else (y, x) for x, y in found})
    return pa.record_batch([pa.array([x for x, _ in got], pa.binary()), pa.array([y for _, y in got], pa.binary())], names=["a", "b"])


def _forests(threshold: float, slack: float):
    """(a, b) of rows (block, fp, n, sig, comp): each block's forest."""
    def run(batches):
        found = []
        for t in by_block(batches):
            if len(t) > 1:
                fp = t.column("fp").to_pylist()
                found += [(fp[i], fp[j]) for i, j in forest(estimates(*_numbers(t), None, threshold), threshold - slack)]
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    return run


def _open_members(threshold: float, slack: float):
    """(block, half, fp, comp) of the rows (block, half, fp, n, sig, comp) that
    have a likely partner of another component in their block."""
    def run(batches):
        for t in by_block(batches):
            if len(t) > 1:
                hit = (estimates(*_numbers(t), _side(t), threshold) >= threshold - slack).any(axis=1)
                if hit.any():
                    yield from t.filter(pa.array(hit)).select(["block", "half", "fp", "comp"]).combine_chunks().to_batches()

    return run


def _exact_links(threshold: float):
    """(a, b) of rows (block, half, fp, comp, all)."""
    def run(batches):
        for t in by_block(batches):
            fp = t.column("fp").to_pylist()
            comp = np.unique(np.array(t.column("comp").to_pylist(), "S16"), return_inverse=True)[1]
            sets = [x.values.to_numpy().view(np.uint64) for x in t.column("all").combine_chunks()]
            found = links(np.concatenate(sets), np.array([len(x) for x in sets]), comp, _side(t), threshold)
            if found:
                yield _pairs([(fp[i], fp[j]) for i, j in found])

    return run


def unrolled(lower: DataFrame) -> DataFrame:
    """(fp, all) of (fp, t): the multiset of shingles of a lower-case text as a
    set, the k-th occurrence of a shingle being an element of its own."""
    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                r, s, e = word_spans(buf, offs)
                h, row, c = counted(*shingles(word_hashes(buf, s, e), r)[:2])
                h, row, k = np.repeat(h, c), np.repeat(row, c), np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                h = np.where(k > 0, mix(h + k.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), h)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), lists(h.view(np.int64), np.searchsorted(row, np.arange(hi - lo + 1)))],
                                      names=["fp", "all"])

    return lower.select("fp", "t").mapInArrow(run, "fp binary, all array<long>")


def linked(texts: DataFrame, threshold: float = 0.8, slack: float = 0.12, block_rows: int = 1024, block_shingles: int = 1 << 20) -> DataFrame:
    """(node, comp): the components of the verified links between the distinct
    texts of (fp, text) rows, for texts that have a link, without the pairs of
    all members of a band's group.

    A first pass joins what is easily joined.  A band's group is compared in
    blocks of about ``block_rows`` texts (larger groups are dealt by a hash of
    text and band), by the share of equal coordinates; a block proposes the
    pairs of a maximum spanning forest of the estimates down to ``slack`` under
    the threshold, which are verified on the texts.

    The second pass is the remainder, and exact: in each group that still holds
    several components, the members with a likely partner (an estimate down to
    ``slack`` under the threshold) in another component bring their whole sets,
    and all their pairs of different components are compared.  Large groups are
    dealt into parts, and every two parts that can hold such a pair meet in a
    task of their own.  A block gives only the links that join components, so
    it has fewer than members.
    """
    sigs = stored(signatures(texts).dropDuplicates(["fp"]), "neardup-signatures")
    each = sigs.select("fp", F.explode("bands").alias("band"))
    many = each.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    groups = each.join(many, "band")
    groups = stored(groups.join(sigs.select("fp", "n", "sig"), "fp"), "neardup-groups")
    lower = texts.join(groups.select("fp").distinct(), "fp", "left_semi").dropDuplicates(["fp"])
    lower = stored(lower.select("fp", F.lower("text").alias("t")), "neardup-texts")

    salt = F.pmod(F.xxhash64("fp", "band"), F.ceil(F.col("c") / block_rows))
    first = groups.select(F.xxhash64("band", salt).alias("block"), "band", salt.alias("salt"), "fp", "n", "sig", F.col("fp").alias("comp"))
    first = first.repartition("band", "salt").sortWithinPartitions("block", "band", "salt")
    tested = first.select("block", "fp", "n", "sig", "comp").mapInArrow(_forests(threshold, slack), "a binary, b binary").distinct()
    comp = components(stored(verified(stored(tested, "neardup-pairs"), lower, threshold), "neardup-links"))

    of = groups.join(comp, F.col("fp") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "fp")).drop("node")
    more = remainder(of, lower, threshold, slack, block_rows, block_shingles)
    for end in ("a", "b"):
        named = comp.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        more = more.join(named, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_c", end)).drop("_n", "_c")
    joined = components(stored(more, "neardup-links")).select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
    grown = comp.join(joined, F.col("comp") == F.col("_n"), "left").select("node", F.coalesce("_c", "comp").alias("comp"))
    fresh = joined.join(comp, F.col("_n") == F.col("node"), "left_anti").select(F.col("_n").alias("node"), F.col("_c").alias("comp"))
    return stored(grown.unionByName(fresh), "neardup-components")


def remainder(of: DataFrame, lower: DataFrame, threshold: float, slack: float = 0.12, block_rows: int = 1024, block_shingles: int = 1 << 20) -> DataFrame:
    """(a, b): links of texts of different components in one group, of the rows
    (band, fp, n, sig, comp) and the lower-case texts (fp, t).  Members with a
    likely partner are compared exactly, all pairs; a block gives only the links
    that join components."""
    met = _meetings(of, block_rows, block_shingles)
    met = met.repartition("block").sortWithinPartitions("block").select("block", "half", "fp", "n", "sig", "comp")
    opened = stored(met.mapInArrow(_open_members(threshold, slack), "block long, half int, fp binary, comp binary"), "neardup-open")
    sets = unrolled(lower.join(opened.select("fp").distinct(), "fp", "left_semi"))
    full = opened.join(sets, "fp").select("block", "half", "fp", "comp", "all").repartition("block").sortWithinPartitions("block")
    return stored(full.mapInArrow(_exact_links(threshold), "a binary, b binary").distinct(), "neardup-links")


def _meetings(of: DataFrame, block_rows: int, block_shingles: int) -> DataFrame:
    """(block, i, j, half, fp, n, sig, comp) of the members of groups with
    several components.  A group's largest component and its other members are
    dealt into parts of about ``block_rows`` texts and ``block_shingles``
    shingles.  Each part of the others meets itself and each other part, of
    either kind, in a block (i, j) of its own, so that any two members of
    different components meet; pairs within the largest component do not."""
    per = of.groupBy("band", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    top = (per.groupBy("band").agg(F.max(F.struct("c", "comp", "w")).alias("top"), F.sum("c").alias("c"), F.sum("w").alias("w"), F.count("*").alias("comps"))
           .where("comps > 1"))
    parts = lambda c, w: F.ceil(F.greatest(c / block_rows, w / block_shingles))
    top = top.select("band", F.col("top.comp").alias("main"), parts(F.col("c") - F.col("top.c"), F.col("w") - F.col("top.w")).alias("others"),
                     parts(F.col("top.c"), F.col("top.w")).alias("mains"))
    x, main = F.xxhash64("fp", "band"), F.col("comp") == F.col("main")
    rows = of.drop("c").join(top, "band")
    rows = rows.select("band", "fp", "n", "sig", "comp", F.when(main, F.col("others") + F.pmod(x, F.col("mains"))).otherwise(F.pmod(x, F.col("others"))).alias("x"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") + F.when(main, 0).otherwise(F.col("mains")) - 1)).alias("y"))
    i, j = F.least("x", "y"), F.greatest("x", "y")
    return rows.select(F.xxhash64("band", i, j).alias("block"), i.alias("i"), j.alias("j"), (F.col("x") > F.col("y")).cast("int").alias("half"), "fp", "n", "sig", "comp")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, class_size) for each row of ``docs``."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = base.where("text is not null").select(fingerprint(F.col("text")).alias("fp"), "text")
    comp = linked(texts, threshold)
    spaces = "^[ \\t\\n\\x0B\\f\\r]*$"
    rows = base.select("doc_id", F.when(~F.col("text").rlike(spaces), fingerprint(F.col("text"))).alias("fp"))
    named = (rows.join(comp, rows.fp == comp.node, "left")
             .select("doc_id", F.coalesce("comp", "fp").alias("comp")))
    named = stored(named)
    of = (named.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")))
    have = named.where("comp is not null").join(of, "comp").select("doc_id", "class_id", "class_size")
    return have.unionByName(named.where("comp is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (null ids
    last), of equal ids that of the smallest text fingerprint.  Rows whose text
    has no word are all kept."""
    own = fingerprint(F.col(text).cast("string"))
    base = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), own.alias("fp"))
    comp = linked(base.where("text is not null").select("fp", "text"), threshold)
    ids = base.where(F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]")).groupBy("fp", "id").agg(F.count("*").alias("n"))
    ids = stored(ids.join(comp, ids.fp == comp.node, "left").select("fp", "id", "n", F.coalesce("comp", "fp").alias("comp")))
    best = (ids.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("fp"))).alias("k"), F.sum("n").alias("rows"))
            .where("rows > 1").select("comp", F.col("k.id").alias("__keep_id"), F.col("k.fp").alias("__keep_fp")))
    # One row for each text of a class of several rows; `n` rows hold the kept id and text.
    group = (ids.join(best, "comp").groupBy(F.col("fp").alias("__fp"), "__keep_id", "__keep_fp")
             .agg(F.sum(F.when(F.col("id").eqNullSafe(F.col("__keep_id")) & (F.col("fp") == F.col("__keep_fp")), F.col("n")).otherwise(0)).alias("__n")))
    rows = docs.withColumn("__own", own).join(group, F.col("__own") == F.col("__fp"), "left")
    kept = rows.where(F.col("__n").isNull() | ((F.col("__n") > 0) & F.col(doc_id).eqNullSafe(F.col("__keep_id"))))
    single = kept.where("__n is null or __n = 1").select(*docs.columns)
    copies = kept.where("__n > 1").dropDuplicates(["__fp"]).select(*docs.columns)
    return single.unionByName(copies)
