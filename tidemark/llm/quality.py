"""Quality classifier: random Fourier features of document statistics, ridge
regression from partition-summed normal equations, isotonic calibration.

Edge cases: a null or empty text has all-zero statistics and gets a score like
any other; labels that are null are ignored, and a document labelled twice
counts with its mean label; repeated documents are scored row by row; a null
id is never learnt from; without any learnable label every score is 0.5.
Columns other than the id and the text are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, stored
from .textblocks import IS_SPACE, blocks, counted, shingles, word_hashes, word_spans

# One class per byte; shares of the classes are features.
_CLASSES = [b" ", b"\n", b"\t\r\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".", b",",
            b"!", b"?", b"|", b"*", b"#", b"$", b"%", b"&", b"'\"", b";:", b"()[]{}", b"<>", b"=+/\\", b"-_~^`@",
            bytes(range(128, 192)), bytes(range(192, 256))]
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _i
N_CLASS = len(_CLASSES) + 1
IS_NEWLINE = np.zeros(256, bool)
IS_NEWLINE[10] = True
N_STATS = N_CLASS + 17


def _statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of ``N_STATS`` numbers for each text of a block."""
    n = len(offs) - 1
    size = np.diff(offs).astype(float)
    row = np.repeat(np.arange(n), np.diff(offs))
    per = lambda r, w=None: np.bincount(r, w, n)
    shares = np.bincount(row * N_CLASS + _CLASS[buf], minlength=n * N_CLASS).reshape(n, N_CLASS) / np.maximum(size, 1)[:, None]
    same = per(row[1:][(buf[1:] == buf[:-1]) & (row[1:] == row[:-1])]) / np.maximum(size, 1)
    r, s, e = word_spans(buf, offs)
    length = (e - s).astype(float)
    words = per(r)
    w1 = np.maximum(words, 1)
    mean = per(r, length) / w1
    spread = np.sqrt(np.maximum(per(r, length ** 2) / w1 - mean ** 2, 0))
    h = word_hashes(buf, s, e)
    _, ur, uc = counted(h, r)
    top = np.zeros(n)
    np.maximum.at(top, ur, uc)
    _, sr, _ = counted(*shingles(h, r)[:2])
    lr, ls, le = word_spans(buf, offs, IS_NEWLINE)
    lines = per(lr)
    l1 = np.maximum(lines, 1)
    _, dlr, _ = counted(word_hashes(buf, ls, le), lr)
    last = _CLASS[buf[e - 1]] if len(e) else np.zeros(0, np.int64)
    first = _CLASS[buf[s]] if len(s) else np.zeros(0, np.int64)
    more = [np.log1p(size), np.log1p(words), mean, spread, per(r, length <= 3) / w1, per(r, length >= 12) / w1,
            per(ur) / w1, top / w1, per(sr) / np.maximum(words - 4, 1), np.log1p(lines), words / l1, per(dlr) / l1,
            per(r, first == 4) / w1, per(r, (last >= 8) & (last <= 15)) / w1, per(r, (last == 6) | (last == 7)) / w1,
            per(lr, le - ls < 40) / l1, same]
    return np.column_stack([shares, *more])


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats array<double>) of every whole text."""
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, hi, buf, offs in blocks(b.column(1)):
                flat = _statistics(buf, offs)
                yield pa.record_batch([ids.slice(lo, hi - lo), pa.FixedSizeListArray.from_arrays(
                    pa.array(flat.ravel()), N_STATS).cast(pa.list_(pa.float64()))], names=["doc_id", "stats"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, stats array<double>")


@dataclass
class Model:
    """Everything a score needs; its size depends on ``features`` alone."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def lift(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.weight + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.column_stack([z, np.ones(len(z))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.lift(stats) @ self.beta, self.knots, self.values)


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def isotonic(x: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending ``x`` with ``n`` cases, ``pos`` of
    them positive; half a case of each kind smooths each pool."""
    pools: list[list[float]] = []
    for xi, ni, pi in zip(x, n, pos):
        pools.append([xi, xi, ni, pi])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            b = pools.pop()
            pools[-1] = [pools[-1][0], b[1], pools[-1][2] + b[2], pools[-1][3] + b[3]]
    v = np.maximum.accumulate([(p[3] + 0.5) / (p[2] + 1) for p in pools])
    return np.array([k for p in pools for k in p[:2]]), np.repeat(v, 2)


def fit(stats: DataFrame, labels: DataFrame, learn=None, *, features: int = 384, max_labelled: int = 200_000,
        sum_partitions: int = 16, seed: int = 7, ridges: tuple = (1e-4, 1e-3, 1e-2, 1e-1), grid: float = 1e-3) -> Model | None:
    """Fit on ``labels(doc_id, label)`` joined to ``stats``; ``learn`` filters rows.

    ``max_labelled`` bounds the labelled rows (a hash of the id picks them);
    a quarter of them calibrate and choose the ridge, the rest fit.  The normal
    equations are summed in each of ``sum_partitions`` partitions, then by row
    of the matrix; the driver gets ``features``+1 rows, and calibration counts
    on a grid of scores.  None without rows to fit.
    """
    lab = labels.select(F.col("doc_id").alias("_k"), F.col("label").cast("double").alias("y")).where("y is not null and _k is not null")
    lab = lab.groupBy("_k").agg(F.avg("y").alias("y"))
    if learn is not None:
        lab = lab.where(learn(F.col("_k")))
    n = lab.count()
    draw = F.abs(F.xxhash64(F.lit(seed), "_k")) / F.lit(float(2 ** 63))
    if n > max_labelled:
        lab = lab.where(draw < max_labelled / n)
    part = (F.abs(F.xxhash64(F.lit(seed + 1), "_k")) % 4 == 0).alias("cal")
    rows = stored(stats.join(lab, stats.doc_id == lab["_k"]).select("stats", "y", part, "_k"), "quality-rows")
    one = rows.agg(*[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(N_STATS)],
                   *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATS)],
                   F.sum((~F.col("cal")).cast("int")).alias("n")).first()
    if not one["n"]:
        return None
    rng = np.random.default_rng(seed)
    sd = np.array([one[f"s{i}"] for i in range(N_STATS)])
    model = Model(np.array([one[f"m{i}"] for i in range(N_STATS)]), np.where(sd > 1e-12, sd, 1.0),
                  rng.normal(size=(N_STATS, features)) / np.sqrt(0.5 * N_STATS), rng.uniform(0, 2 * np.pi, features),
                  np.zeros(features + 1), np.zeros(1), np.zeros(1))

    def sums(batches):
        a = np.zeros((features + 1, features + 2))
        for b in batches:
            z = model.lift(_matrix(b.column(0)))
            a[:, :-1] += z.T @ z
            a[:, -1] += z.T @ b.column(1).to_numpy()
        yield pa.record_batch([pa.array(range(features + 1)), pa.array(list(a))], names=["i", "v"])

    def add(t: pa.Table) -> pa.Table:
        v = _matrix(t.column("v").combine_chunks())
        return pa.table({"i": t.column("i")[:1], "v": pa.array([v.sum(axis=0)])})

    schema = "i long, v array<double>"
    got = (rows.where("not cal").select("stats", "y", "_k").repartition(sum_partitions, "_k").select("stats", "y")
           .mapInArrow(sums, schema).groupBy("i").applyInArrow(add, schema).collect())
    m = np.zeros((features + 1, features + 2))
    for r in got:
        m[r["i"]] = r["v"]
    gram, rhs = m[:, :-1], m[:, -1]
    betas = [np.linalg.solve(gram + lam * one["n"] / features * np.eye(features + 1), rhs) for lam in ridges]

    def raw(batches):
        for b in batches:
            s = np.round(np.clip(model.lift(_matrix(b.column(0))) @ np.array(betas).T, -2, 3) / grid).astype(np.int64)
            k = len(betas)
            yield pa.record_batch([pa.array(np.tile(np.arange(k), len(s))), pa.array(s.ravel()),
                                   pa.array(np.repeat(b.column(1).to_numpy(), k))], names=["k", "s", "y"])

    counts = (rows.where("cal").select("stats", "y").mapInArrow(raw, "k long, s long, y double")
              .groupBy("k", "s").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect())
    best = None
    for k, beta in enumerate(betas):
        own = sorted((r["s"] * grid, r["n"], r["pos"]) for r in counts if r["k"] == k)
        if not own:  # nothing to calibrate on: the ridge score, clipped
            model.beta, model.knots, model.values = beta, np.array([0.0, 1.0]), np.array([0.0, 1.0])
            return model
        x, nn, pos = map(np.array, zip(*own))
        knots, values = isotonic(x, nn, pos)
        p = np.interp(x, knots, values)
        loss = -(pos * np.log(p) + (nn - pos) * np.log1p(-p)).sum()
        if best is None or loss < best:
            best, model.beta, model.knots, model.values = loss, beta, knots, values
    return model


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score in 0..1) of every row of ``stats``."""
    def run(batches):
        for b in batches:
            p = model.score(_matrix(b.column(1))) if len(b) else np.zeros(0)
            yield pa.record_batch([b.column(0), pa.array(np.clip(p, 0.0, 1.0))], names=["doc_id", "score"])

    if model is None:
        return stats.select("doc_id", F.lit(0.5).alias("score"))
    return stats.mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; learns from
    ``labels(doc_id, quality)`` except where crc32 of the id modulo 5 is 0."""
    stats = stored(statistics(docs), "quality-stats")
    model = fit(stats, labels.select("doc_id", F.col("quality").alias("label")), lambda c: F.crc32(c.cast("string").cast("binary")) % 5 != 0, **options)
    return score(stats, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of ``threshold`` or more;
    learns as ``classify`` does.  Statistics are taken twice, to fit and to
    filter, so that texts are never shuffled."""
    model = fit(stored(statistics(docs, doc_id, text), "quality-stats"), labels.select("doc_id", F.col("quality").alias("label")),
                lambda c: F.crc32(c.cast("string").cast("binary")) % 5 != 0, **options)
    if model is None:
        return docs
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            good = [model.score(_statistics(buf, offs)) >= threshold for _, _, buf, offs in blocks(b.column(at))]
            yield b.filter(pa.array(np.concatenate(good))) if good else b

    return docs.mapInArrow(run, docs.schema)
