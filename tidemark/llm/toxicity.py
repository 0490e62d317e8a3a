"""Toxicity classifier: FTRL-proximal logistic regression over hashed word
n-grams and skip-grams.

A text is the set of its words, their stems (the first four and six bytes of
longer words), pairs of neighbouring words and pairs with one or two words
between, hashed into ``DIMS`` coordinates; a coordinate counts once, so a short
insult in a very long text weighs as much as in a short one.  Each
coordinate has its own learning rate (its sum of squared gradients ``n``) and
its own weight, which is zero while its ``z`` is within the L1 penalty: the
model that is sent to the tasks is the few coordinates outside it.

Training goes through the labelled rows in ``rounds``, over their coordinates,
which are made once, where the texts lie.  In a round each of
``shards`` shards (dealt by a hash of the id, ordered by another) continues from
the common (z, n) online, row by row; afterwards each coordinate takes the mean
change of the shards that met it.  ``shards`` and ``DIMS`` bound all that the
driver sees.

Edge cases: a null or empty text has no features and gets the bias's score;
null labels and null ids are never learnt from; a document labelled twice counts
with its mean label; repeated documents are scored row by row; without labels
every score is 0.5; an empty table gives no rows.  Other columns are ignored, so
clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fold, stored
from .textblocks import ASCII_LOWER, blocks, mix, word_hashes, word_spans

# Words are runs of ASCII letters and digits and of bytes of other characters.
GAP = np.ones(256, bool)
GAP[128:] = False
for _lo, _hi in (b"09", b"AZ", b"az"):
    GAP[_lo:_hi + 1] = False

# Each kind of feature has a region of its own, so that none ever shares a
# coordinate with another kind.
WORD_BITS, BITS = 17, 15
STEMS = (4, 6)
PAIR_GAPS = (1, 2, 3)
BIAS = (1 << WORD_BITS) + (len(STEMS) + len(PAIR_GAPS)) * (1 << BITS)
DIMS = BIAS + 1


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, row) of every feature of the texts of a block, repeats included."""
    low = ASCII_LOWER[buf]
    row, s, e = word_spans(low, offs, GAP)
    h = word_hashes(low, s, e)
    region = lambda hashes, k: (hashes >> np.uint64(64 - BITS)) + np.uint64((1 << WORD_BITS) + k * (1 << BITS))
    idx, rows = [h >> np.uint64(64 - WORD_BITS)], [row]
    for k, size in enumerate(STEMS):
        long = e - s > size
        idx.append(region(word_hashes(low, s[long], s[long] + size), k))
        rows.append(row[long])
    for k, gap in enumerate(PAIR_GAPS):
        a, b = h[:-gap], h[gap:]
        same = row[:-gap] == row[gap:]
        pair = mix(a[same] * np.uint64(2 * k + 3) + mix(b[same]))
        idx.append(region(pair, len(STEMS) + k))
        rows.append(row[:-gap][same])
    return np.concatenate(idx).astype(np.int64), np.concatenate(rows)


def feature_sets(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct coordinates of each text of a block, the bias last."""
    idx, row = features(buf, offs)
    key = np.unique(row * DIMS + idx)
    cut = np.searchsorted(key, np.arange(len(offs)) * DIMS)
    for a, b in zip(cut[:-1], cut[1:]):
        yield np.append(key[a:b] % DIMS, BIAS)


def packed(u: np.ndarray) -> bytes:
    """Ascending coordinates as the bytes of their differences, the low bytes first."""
    return np.diff(u, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().cumsum(dtype=np.int64)


def _coordinates(batches):
    """(shard, draw, y, u): the packed coordinates of the rows (shard, draw, y, text)."""
    for b in batches:
        for lo, hi, buf, offs in blocks(b.column(3)):
            u = pa.array([packed(x) for x in feature_sets(buf, offs)], pa.binary())
            yield pa.record_batch([*(b.column(i).slice(lo, hi - lo) for i in range(3)), u], names=["shard", "draw", "y", "u"])


@dataclass(frozen=True)
class Rates:
    """Learning rate alpha / (beta + sqrt(n)); penalties of the weights (the
    bias has no L1)."""

    alpha: float = 5.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0

    def weights(self, z: np.ndarray, n: np.ndarray, l1) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, z: np.ndarray, n: np.ndarray, u: np.ndarray, y: float) -> None:
        """One online step with the features ``u`` and the label ``y``, in place."""
        l1 = np.full(len(u), self.l1)
        l1[-1] = 0.0
        zu, nu = z[u], n[u]
        w = self.weights(zu, nu, l1)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        more = nu + g * g
        z[u] = zu + g - (np.sqrt(more) - np.sqrt(nu)) / self.alpha * w
        n[u] = more


@dataclass(frozen=True)
class Model:
    """Coordinates with a weight other than zero, ascending, and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(DIMS)
        w[self.index] = self.weight
        return w

    def score(self, dense: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        idx, row = features(buf, offs)
        hit = dense[idx] != 0
        key = np.unique(row[hit] * DIMS + idx[hit])
        total = np.bincount(key // DIMS, dense[key % DIMS], len(offs) - 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def _round(rows: DataFrame, z: np.ndarray, n: np.ndarray, shards: int, rates: Rates) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the labelled rows from the common state."""
    state = rows.sparkSession.sparkContext.broadcast((z, n))

    def run(batches):
        z0, n0 = state.value
        shard, zs, ns = None, None, None

        def done():
            at = np.flatnonzero(ns != n0)
            return pa.record_batch([pa.array(at), pa.array(np.full(len(at), shard, np.int32)), pa.array(zs[at] - z0[at]), pa.array(ns[at] - n0[at])],
                                   names=["i", "shard", "dz", "dn"])

        for b in batches:
            for own, y, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if own != shard:
                    if shard is not None:
                        yield done()
                    shard, zs, ns = own, z0.copy(), n0.copy()
                rates.learn(zs, ns, unpacked(u.as_buffer()), y)
        if shard is not None:
            yield done()

    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "draw", "u", "y").select("shard", "y", "u")
    parts = F.sort_array(F.collect_list(F.struct("shard", "dz", "dn")))  # at most one entry of each shard
    mean = lambda c: F.aggregate(F.col("p"), F.lit(0.0), lambda a, x: a + x[c]) / F.size("p")
    got = (dealt.mapInArrow(run, "i long, shard int, dz double, dn double").groupBy("i").agg(parts.alias("p"))
           .select("i", mean("dz").alias("dz"), mean("dn").alias("dn")).toArrow())
    state.unpersist()
    i = got.column("i").to_numpy()
    z, n = z.copy(), n.copy()
    z[i] += got.column("dz").to_numpy()
    n[i] += got.column("dn").to_numpy()
    return z, n


def fit(docs: DataFrame, labels: DataFrame, learn=None, *, max_labelled: int = 50_000, shards: int = 4, rounds: int = 5,
        rates: Rates = Rates(), seed: int = 11) -> Model | None:
    """Fit on ``docs(doc_id, text)`` joined to ``labels(doc_id, label)``; ``learn``
    filters ids.  ``max_labelled`` bounds the labelled rows (a hash of the id
    picks them), whose ids are therefore broadcast.  None without rows to fit."""
    lab = labels.select(F.col("doc_id").alias("_k"), F.col("label").cast("double").alias("_y")).where("_y is not null and _k is not null")
    lab = lab.groupBy("_k").agg(F.avg("_y").alias("_y"))
    if learn is not None:
        lab = lab.where(learn(F.col("_k")))
    draw = F.abs(F.xxhash64(F.lit(seed), "_k") % (1 << 53)) / F.lit(float(1 << 53))
    count = lab.count()
    if count > max_labelled:
        lab = lab.where(draw < max_labelled / count)
    src = docs.select(F.col("doc_id").alias("_d"), F.col("text").cast("string").alias("text"))
    rows = src.join(F.broadcast(lab), F.col("_d") == F.col("_k")).select(
        F.pmod(F.xxhash64(F.lit(seed + 1), "_k"), F.lit(shards)).cast("int").alias("shard"), draw.alias("draw"), F.col("_y").alias("y"), "text")
    rows = stored(rows.mapInArrow(_coordinates, "shard int, draw double, y double, u binary"), "toxicity-rows")
    if not rows.limit(1).count():
        discard(rows)
        return None
    z, n = np.zeros(DIMS), np.zeros(DIMS)
    for _ in range(rounds):
        z, n = _round(rows, z, n, shards, rates)
    discard(rows)
    w = rates.weights(z[:BIAS], n[:BIAS], rates.l1)
    at = np.flatnonzero(w)
    return Model(at, w[at], float(rates.weights(z[BIAS:], n[BIAS:], 0.0)[0]))


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score in 0..1) of every whole text."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if model is None:
        return src.select("doc_id", F.lit(0.5).alias("score"))

    def run(batches):
        dense = model.dense()
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(model.score(dense, buf, offs))], names=["doc_id", "score"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; learns from
    ``labels(doc_id, toxic)`` except where crc32 of the id modulo 5 is 0."""
    model = fit(docs, labels.select("doc_id", F.col("toxic").alias("label")), lambda c: F.crc32(c.cast("string").cast("binary")) % 5 != 0, **options)
    return score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))
