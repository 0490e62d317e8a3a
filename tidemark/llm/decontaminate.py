"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of five-word shingles (lower case, words split at
ASCII white space).  A document is contaminated by an item if it holds at
least 0.8 of the item's distinct shingles.

Items are put in size classes (up to 8, 16, 32, ... shingles).  The smallest
items have too few shingles for signatures: each of their shingles is a key, and
every shingle of a document is looked up.  For each further class u, documents
are cut into half-overlapping windows of 2u shingles, so that a
passage of an item lies in one window and the Jaccard similarity of item and
window stays above about 0.2 however long the document is.  Items and windows
get one-permutation MinHash signatures (one hash, ``BINS`` bins); each bin is
a band of one row.  Documents that hold a small item's shingle, windows that share a bin's minimum with an item of the
class, and documents whose windows together do, are verified against the
item's shingles in the whole document.

What is broadcast is a bitmap of the items' keys, 64 bits for each up to
``MOST_BITS``.  It only spares windows that match no item; keys that pass are
joined exactly, so more items cost more rows, not wrong results.

Edge cases: null texts, and texts without a word, take no part; a text of one to
four words has one shingle, of all its words, so that such an item is found where
it is a whole text; items with equal texts and repeated ids or documents
all count; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fingerprint, free_name, stored
from .textblocks import blocks, mix, shingles, word_hashes, word_spans

BINS = 64
LEAST_CLASS = 8
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28


def size_class(n: np.ndarray) -> np.ndarray:
    """The least power of two times ``LEAST_CLASS`` that is at least ``n``."""
    return LEAST_CLASS << np.ceil(np.log2(np.maximum(n, 1) / LEAST_CLASS)).clip(0).astype(np.int64)


def full_shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the five-word shingles; a row of one to four words has one."""
    r, s, e = word_spans(buf, offs)
    h, row, _ = shingles(word_hashes(buf, s, e), r)
    return h, row


def bin_minima(h: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """n x BINS one-permutation MinHash signatures; empty bins are the largest value."""
    low = np.full(n * BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, group * BINS + (h >> np.uint64(58)).astype(np.int64), h)
    return low.reshape(n, BINS)


def keys(minima: np.ndarray, u: int) -> np.ndarray:
    """Band keys: the minima, told apart by class; the bin is in their top bits."""
    return mix(minima ^ mix(np.full(1, u, np.uint64)))


def _items(bench: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, u, n, keys, shingles) of each item."""
    kind = bench.schema[item_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                h, row = full_shingles(buf, offs)
                out = {"item_id": [], "u": [], "n": [], "keys": [], "sh": []}
                for i in range(hi - lo):
                    own = np.unique(h[row == i])
                    if len(own):
                        u = int(size_class(np.array([len(own)]))[0])
                        low = own
                        if u > LEAST_CLASS:
                            low = bin_minima(own, np.zeros(len(own), np.int64), 1)[0]
                            low = low[low != np.iinfo(np.uint64).max]
                        for k, v in zip(out, (b.column(0)[lo + i].as_py(), u, len(own), keys(low, u).view(np.int64), own.view(np.int64))):
                            out[k].append(v)
                ids = pa.array(out.pop("item_id"), b.column(0).type)
                yield pa.record_batch([ids, pa.array(out["u"], pa.int64()), pa.array(out["n"], pa.int64()),
                                       pa.array(out["keys"], pa.list_(pa.int64())), pa.array(out["sh"], pa.list_(pa.int64()))],
                                      names=["item_id", "u", "n", "keys", "sh"])

    src = bench.select(F.col(item_id).alias("item_id"), F.lower(F.col(text).cast("string")).alias("text")).where("text is not null")
    return src.mapInArrow(run, f"item_id {kind}, u long, n long, keys array<long>, sh array<long>")


def _bitmap(items: DataFrame) -> np.ndarray:
    """Bit array of the keys; positions are made distinct in Spark, so the driver
    gets words of 32 bits, no more than the bitmap has."""
    n = items.agg(F.sum(F.size("keys"))).first()[0]
    bits = min(max(LEAST_BITS, 1 << int(np.ceil(np.log2(64 * n)))), MOST_BITS)
    at = items.select(F.explode("keys").alias("k")).select(F.pmod("k", F.lit(bits)).alias("p")).distinct()
    words = at.groupBy((F.col("p") / 32).cast("int").alias("w")).agg(F.sum(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("bits"))
    got = words.toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    return out


def contaminated(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(fp, item_id, containment): fingerprints of document texts and the items
    they hold, with the share of the item's distinct shingles found."""
    items = stored(_items(bench, item_id, item_text))
    classes = sorted(r["u"] for r in items.select("u").distinct().collect())  # a few powers of two
    if not classes:
        return _none(docs, items)
    seen = docs.sparkSession.sparkContext.broadcast(_bitmap(items))

    def passing(k: np.ndarray) -> np.ndarray:
        """Which keys the bitmap lets pass."""
        p = k & np.uint64(len(seen.value) * 32 - 1)
        return (seen.value[(p >> np.uint64(5)).astype(np.int64)] >> (p & np.uint64(31)).astype(np.uint32)) & 1 == 1

    def hits(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                h, row = full_shingles(buf, offs)
                if not len(h):
                    continue
                first = np.searchsorted(row, np.arange(hi - lo))
                at = np.arange(len(h)) - first[row]
                who, what = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                if classes[0] == LEAST_CLASS:
                    k = keys(h, LEAST_CLASS)
                    hit = passing(k)
                    who.append(row[hit]), what.append(k[hit])
                for u in classes[classes[0] == LEAST_CLASS:]:
                    half = at // u
                    new = np.concatenate(([True], (row[1:] != row[:-1]) | (half[1:] != half[:-1])))
                    group = np.cumsum(new) - 1
                    own = row[new]
                    low = bin_minima(h, group, len(own))
                    two = low.copy()  # a window is a half and the next of the same text
                    joined = own[1:] == own[:-1]
                    two[:-1][joined] = np.minimum(low[:-1][joined], low[1:][joined])
                    w, c = np.nonzero(two != np.iinfo(np.uint64).max)
                    k = keys(two[w, c], u)
                    hit = passing(k)
                    pair = np.unique(np.column_stack([own[w[hit]].astype(np.uint64), k[hit]]), axis=0)
                    who.append(pair[:, 0].astype(np.int64)), what.append(pair[:, 1])
                who, what = np.concatenate(who), np.concatenate(what)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo).take(pa.array(who)), pa.array(what.view(np.int64))],
                                      names=["fp", "k"])

    texts = docs.select(fingerprint(F.col(text).cast("string")).alias("fp"), F.lower(F.col(text).cast("string")).alias("text")).where("text is not null")
    found = texts.mapInArrow(hits, "fp binary, k long").distinct()
    cand = stored(found.join(items.select("item_id", F.explode("keys").alias("k")).distinct(), "k").select("fp", "item_id").distinct())

    def shingle_rows(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                h, row = full_shingles(buf, offs)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo),
                                       pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(h.view(np.int64)))], names=["fp", "all"])

    need = cand.select("fp").distinct()
    own = texts.join(need, "fp", "left_semi").dropDuplicates(["fp"]).mapInArrow(shingle_rows, "fp binary, all array<long>")
    share = F.size(F.array_intersect("sh", "all")) / F.col("n")
    # An id on several rows: its best row counts.
    known = items.select(F.col("item_id").alias("_item"), "n", "sh")
    out = (cand.join(own, "fp").join(known, F.col("item_id").eqNullSafe(F.col("_item")))
           .select("fp", "item_id", share.alias("containment")).where(F.col("containment") >= threshold))
    return out.groupBy("fp", "item_id").agg(F.max("containment").alias("containment"))


def _none(docs: DataFrame, items: DataFrame) -> DataFrame:
    return items.select(F.lit(b"").alias("fp"), "item_id", F.lit(0.0).alias("containment")).where("false")


def report(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, containment) for each contaminated row of ``docs`` and
    each item it holds."""
    hit = stored(contaminated(docs, bench, doc_id, text, threshold=threshold))
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text).cast("string")).alias("fp"))
    return rows.join(hit, "fp").select("doc_id", "item_id", "containment")


def clean(docs: DataFrame, bench: DataFrame, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    name = free_name(docs, "_hit")
    hit = stored(contaminated(docs, bench, text=text, threshold=threshold)).select(F.col("fp").alias(name)).distinct()
    own = fingerprint(F.col(text).cast("string"))
    return docs.join(hit, own == F.col(name), "left_anti")
