"""Substring dedup: passages that repeat across documents.

Words are maximal runs of characters other than ASCII white space, compared in
lower case.  Two kinds of paragraph are banded:

* lines of at least ``min_words`` words, by MinHash signatures (16 bands of 4
  rows: a pair with a Jaccard similarity of 0.8 of five-word shingles shares a
  band with a probability above 0.999), verified by exact Jaccard;
* windows of ``span`` words that start at content-defined anchors (the least
  hash of each ``reach`` neighbouring word pairs), one band each.  Two copies of
  a passage choose the same anchors inside it, so wherever a passage of
  ``min_words`` words stands in its lines and documents, a window of it
  collides.  All windows of ``min_words`` words that hold a colliding one are
  then compared exactly, by 128-bit hashes of their words, so no common passage
  of that length is lost and no shorter one reported.

A colliding window is linked to the first of its group, never to all.  A line is
compared with the first and the last of its group; then all lines of a group
that are not yet in one component are compared with each other, in blocks, if
their signatures make 0.8 likely.  Passages that overlap
in a document are merged; the components of the links between them are the
clusters.  In each cluster the first passage (smallest id, then start) stays
and the others are to be removed.  Texts that are equal are one text in the
search; copies of a text repeat it whole.

Edge cases: null texts and texts under ``min_words`` words have no passage;
an id on several rows, and null ids, are reported row by row (null ids last);
passages that repeat only within one document are not reported; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fingerprint, stored
from .components import components
from .neardup import band_keys, dart_signatures, remainder, signatures, similarity
from .textblocks import SHINGLE_MULT, blocks, counted, mix, shingles, word_hashes, word_spans

_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
WINDOW, LINE = 0, 1
_UNITS = pa.struct([("band", pa.int64()), ("kind", pa.int32()), ("s", pa.int32()), ("n", pa.int32()), ("own", pa.int64())])
_WORD = re.compile("[^ \t\n\x0b\f\r]+")


def anchors(h: np.ndarray, row: np.ndarray, span: int, reach: int) -> np.ndarray:
    """Indices of the words at which windows start."""
    n = len(h)
    if n < max(span, reach + 1):
        return np.zeros(0, np.int64)
    pair = mix(h[:-1] * SHINGLE_MULT[0] + h[1:] * SHINGLE_MULT[1])
    least = np.lib.stride_tricks.sliding_window_view(pair, reach).argmin(axis=1)
    at = np.arange(len(least))
    inside = row[:n - reach] == row[reach:]
    a = np.unique((at + least)[inside])
    a = a[a + span <= n]
    return a[row[a] == row[a + span - 1]]


def _powers(n: int) -> list[np.ndarray]:
    """Two rows of n odd multipliers each."""
    return [np.cumprod(np.full(n, m, np.uint64)) for m in (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))]


def run_hashes(h: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """Two 64-bit hashes of the ``n`` words from each position."""
    out = []
    for m in _powers(n):
        acc = np.zeros(len(at), np.uint64)
        for j in range(n):
            acc += h[at + j] * m[j]
        out.append(mix(acc))
    return out


def units(buf: np.ndarray, offs: np.ndarray, min_words: int, span: int, reach: int) -> tuple:
    """(row, band key, kind, first word, words, own hash) of the paragraphs of a
    block, a line once for each band; then the number of words of each row."""
    n = len(offs) - 1
    r, s, e = word_spans(buf, offs)
    h = word_hashes(buf, s, e)
    words = np.bincount(r, minlength=n)
    first = np.cumsum(words) - words
    a = anchors(h, r, span, reach)
    a = a[words[r[a]] >= min_words]
    key = run_hashes(h, a, span)[0]
    out = [(r[a], key, np.full(len(a), WINDOW), a - first[r[a]], np.full(len(a), span), key)]
    lr, ls, _ = word_spans(buf, offs, _NEWLINE)
    line = np.searchsorted(ls, s, side="right") - 1
    size = np.bincount(line, minlength=len(ls)) if len(s) else np.zeros(len(ls), np.int64)
    keep = np.flatnonzero(size >= min_words)
    if len(keep):
        number = np.full(len(ls), -1)
        number[keep] = np.arange(len(keep))
        mine = number[line] >= 0
        sh, sr, _ = shingles(h[mine], number[line[mine]])
        own = np.zeros(len(keep), np.uint64)
        np.add.at(own, sr, sh)
        sh, sr, c = counted(sh, sr)
        bands = band_keys(dart_signatures(sh, c.astype(float), sr, len(keep), 64)) ^ np.uint64(0x5A5A5A5A5A5A5A5A)
        start = (np.cumsum(size) - size)[keep] - first[lr[keep]]
        b = bands.shape[1]
        out.append((np.repeat(lr[keep], b), bands.ravel(), np.full(len(keep) * b, LINE), np.repeat(start, b), np.repeat(size[keep], b), np.repeat(own, b)))
    return tuple(np.concatenate(x) for x in zip(*out)), words


def paragraphs(texts: DataFrame, min_words: int, span: int, reach: int) -> DataFrame:
    """(fp, words, units) of (fp, text) rows with ``min_words`` words at least."""
    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(1)):
                (row, band, kind, s, n, own), words = units(buf, offs, min_words, span, reach)
                o = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[o], np.arange(hi - lo + 1))
                flat = pa.StructArray.from_arrays([pa.array(band[o].view(np.int64)), pa.array(kind[o], pa.int32()), pa.array(s[o], pa.int32()),
                                                   pa.array(n[o], pa.int32()), pa.array(own[o].view(np.int64))], fields=list(_UNITS))
                out = pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(words), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)], names=["fp", "words", "units"])
                yield out.filter(pa.array(words >= min_words))

    return texts.select("fp", F.lower("text").alias("text")).mapInArrow(
        run, "fp binary, words long, units array<struct<band:long,kind:int,s:int,n:int,own:long>>")


def dense_windows(texts: DataFrame, min_words: int, span: int) -> DataFrame:
    """(u, p, h1, h2): the windows of ``min_words`` words that hold a window of
    ``span`` words at one of ``starts``, of (u, starts, text) rows."""
    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in blocks(b.column(2)):
                r, s, e = word_spans(buf, offs)
                h = word_hashes(buf, s, e)
                words = np.bincount(r, minlength=hi - lo)
                first = np.cumsum(words) - words
                starts = b.column(1).slice(lo, hi - lo)
                flat = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(hi - lo), starts.value_lengths().to_numpy(zero_copy_only=False))
                p = (flat[:, None] - np.arange(min_words - span + 1)).ravel()
                row = np.repeat(row, min_words - span + 1)
                ok = (p >= 0) & (p + min_words <= words[row])
                at = np.unique(first[row[ok]] + p[ok])
                h1, h2 = run_hashes(h, at, min_words)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo).take(pa.array(r[at])), pa.array(at - first[r[at]]),
                                       pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["u", "p", "h1", "h2"])

    return texts.select("u", "starts", F.lower("text").alias("text")).mapInArrow(run, "u long, p long, h1 long, h2 long")


def _line_texts(batches):
    """(u, s, t): the text of each line, of rows (u, lines, lower-case text)."""
    for b in batches:
        out = []
        for u, lines, t in zip(*(c.to_pylist() for c in b.columns)):
            w = t.encode().split()
            out += [(u, x["s"], b" ".join(w[x["s"]:x["s"] + x["n"]]).decode()) for x in lines]
        u, s, t = zip(*out) if out else ((), (), ())
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(s, pa.int32()), pa.array(t, pa.string())], names=["u", "s", "t"])


def _similar(threshold: float):
    """(ua, sa, ea, ub, sb, eb) of the rows (u, s, n, hu, hs, hn, line a, line b)
    whose lines have the similarity."""
    def run(batches):
        for t in batches:
            ok = [similarity(x.as_py(), y.as_py()) >= threshold for x, y in zip(t.column(6), t.column(7))]
            u, s, n, hu, hs, hn = (t.column(i).to_numpy().astype(np.int64) for i in range(6))
            yield pa.record_batch([pa.array(x) for x in (u, s, s + n, hu, hs, hs + hn)], names=["ua", "sa", "ea", "ub", "sb", "eb"]).filter(pa.array(ok, pa.bool_()))

    return run


def _crowd_links(crowd: DataFrame, at: DataFrame, reps: DataFrame, alike: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """More rows like ``alike``: the links between the lines of a band's group that
    the comparison with its first and last line has not put together.

    ``crowd``: (band, own); ``at``: (line, own, u, s, n), where each line stands;
    ``reps``: (line, a, z), its first and last place; ``lines``: (u, s, t).  Every
    two lines of different components that are likely to be alike are compared
    exactly (:func:`.neardup.remainder`)."""
    where = lambda u, s: at.select(F.col("u").alias(u), F.col("s").cast("long").alias(s), F.col("line").alias(f"l{u}"))
    comp = components(stored(alike.join(where("ua", "sa"), ["ua", "sa"]).join(where("ub", "sb"), ["ub", "sb"]).select(F.col("lua").alias("a"), F.col("lub").alias("b")), "passage-line-edges"))
    of = crowd.select("band", fingerprint(F.col("own").cast("string")).alias("fp")).join(comp, F.col("fp") == F.col("node"), "left")
    of = stored(of.select("band", "fp", F.coalesce("comp", "fp").alias("comp")), "passage-crowd-components")
    several = of.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band")
    of = stored(of.join(several, "band"), "passage-crowds-left")
    lower = reps.join(of.select(F.col("fp").alias("line")).distinct(), "line", "left_semi").select("line", F.col("a.u").alias("u"), F.col("a.s").alias("s"))
    lower = stored(lower.join(lines, ["u", "s"]).select(F.col("line").alias("fp"), "t"), "passage-crowd-texts")
    sigs = stored(signatures(lower.select("fp", F.col("t").alias("text"))).select("fp", "n", "sig"), "passage-crowd-signatures")
    links = remainder(of.join(sigs, "fp"), lower, threshold)
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Each place of a line goes with a place of the other line in another text.
    far = F.when(F.col("x.u") != F.col("u"), F.col("x")).when(F.col("y.u") != F.col("u"), F.col("y"))
    there = reps.select(F.col("line").alias("b"), F.col("a").alias("x"), F.col("z").alias("y"))
    met = links.join(at, F.col("a") == F.col("line")).select("b", "u", "s", "n").join(there, "b").withColumn("far", far).where("far is not null")
    long = lambda c: c.cast("long")
    return met.select(F.col("u").alias("ua"), long(F.col("s")).alias("sa"), long(F.col("s") + F.col("n")).alias("ea"), F.col("far.u").alias("ub"),
                      long(F.col("far.s")).alias("sb"), long(F.col("far.s") + F.col("far.n")).alias("eb"))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50, span: int = 25, reach: int = 26,
            threshold: float = 0.8) -> DataFrame:
    """(doc_id, start, end, cluster, members, keep): the repeated passages of
    each row of ``docs``, half-open in code points, with their cluster, its
    number of passages and whether this one stays.

    ``span`` + ``reach`` may not exceed ``min_words`` + 1, so that every passage
    holds a window that its own words determine.
    """
    if span + reach > min_words + 1:
        raise ValueError("span + reach exceeds min_words + 1")
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = base.where("text is not null").select(fingerprint(F.col("text")).alias("fp"), "text")
    para = paragraphs(own, min_words, span, reach).dropDuplicates(["fp"])
    para = stored(para.withColumn("u", F.monotonically_increasing_id()), "passage-units")
    ids = para.select("u", "fp", "words")
    each = para.select("u", F.explode("units").alias("x")).select("u", "x.*")

    # Paragraphs that collide across texts.  Bands that meet in one text only
    # are of no use: they go by a count of two numbers a band, before anything
    # else of a paragraph is aggregated.
    ends = each.groupBy("band").agg(F.min("u").alias("a"), F.max("u").alias("z")).where("a <> z").select("band")
    met = stored(each.join(ends, "band").select("band", "u", "kind", "s", "n", "own"), "passage-met")
    starts = met.where(F.col("kind") == WINDOW).groupBy("u").agg(F.collect_set("s").alias("starts"))
    spot, alone = F.struct("u", "s", "n", "own"), met.where(F.col("kind") == LINE)
    ends = alone.groupBy("band").agg(F.min(spot).alias("a"), F.max(spot).alias("z")).where("a.u <> z.u")
    near = (alone.join(ends, "band").select("u", "s", "n", "own", F.explode(F.array("a", "z")).alias("h"))
            .where("u <> h.u and own <> h.own").where(F.least("n", "h.n") >= threshold * F.greatest("n", "h.n") - 5)
            .select("u", "s", "n", F.col("h.u").alias("hu"), F.col("h.s").alias("hs"), F.col("h.n").alias("hn")).distinct())
    near = stored(near, "passage-lines")
    rows = base.where("text is not null").select("doc_id", fingerprint(F.col("text")).alias("fp"))
    copied = stored(rows.groupBy("fp").agg(F.count("*").alias("m")).where("m > 1").join(ids, "fp"), "passage-copied")
    # Groups of three different lines and more: those between the first and the last may be alike too.
    each_line = alone.groupBy("band", "own").agg(F.min("n").alias("n"))
    many = each_line.groupBy("band").agg(F.count("*").alias("c")).where("c > 2").select("band")
    crowd = stored(each_line.join(many, "band").select("band", "own"), "passage-crowds")
    at = alone.join(crowd.select("own").distinct(), "own", "left_semi").select("own", "u", "s", "n").distinct()
    at = stored(at.withColumn("line", fingerprint(F.col("own").cast("string"))), "passage-crowd-lines")
    place_of = F.struct("u", "s", "n")
    reps = stored(at.groupBy("line").agg(F.min(place_of).alias("a"), F.max(place_of).alias("z")), "passage-crowd-places")
    need = starts.select("u").union(near.select("u")).union(near.select("hu")).union(copied.select("u")).union(reps.select("a.u")).distinct()
    # Every text that is looked at again is fetched here, once.
    full = own.join(need.join(ids.select("u", "fp"), "u"), "fp").dropDuplicates(["fp"])
    full = stored(full.select("u", "fp", "text"), "passage-texts")

    # Exact: common windows of min_words words, each linked to the first such.
    dense = stored(dense_windows(full.join(starts, "u").select("u", "starts", "text"), min_words, span), "passage-windows")
    firsts = dense.groupBy("h1", "h2").agg(F.min(F.struct("u", "p")).alias("a"), F.max("u").alias("zu")).where("a.u <> zu").select("h1", "h2", "a")
    marks = dense.join(firsts, ["h1", "h2"]).select("u", "p", F.col("a.u").alias("hu"), F.col("a.p").alias("hp"))
    lines = near.select("u", "s", "n").union(near.select("hu", "hs", "hn")).union(reps.select("a.u", "a.s", "a.n")).distinct().groupBy("u").agg(F.collect_list(F.struct("s", "n")).alias("lines"))
    lines = stored(full.join(lines, "u").select("u", "lines", F.lower("text").alias("t")).mapInArrow(_line_texts, "u long, s int, t string"), "passage-line-texts")
    x = (near.join(lines.select("u", "s", F.col("t").alias("ta")), ["u", "s"])
         .join(lines.select(F.col("u").alias("hu"), F.col("s").alias("hs"), F.col("t").alias("tb")), ["hu", "hs"])
         .select("u", "s", "n", "hu", "hs", "hn", "ta", "tb"))
    alike = stored(x.mapInArrow(_similar(threshold), "ua long, sa long, ea long, ub long, sb long, eb long"), "passage-alike")
    alike = alike.unionByName(_crowd_links(crowd, at, reps, alike, lines, threshold))

    # Merge what overlaps in a text.
    spans = marks.select("u", F.col("p").alias("s"), (F.col("p") + min_words).alias("e"), "hu", "hp")
    plain = [F.lit(None).cast("long").alias("hu"), F.lit(None).cast("long").alias("hp")]
    for u, s, e in (("ua", "sa", "ea"), ("ub", "sb", "eb")):
        spans = spans.union(alike.select(F.col(u), F.col(s), F.col(e), *plain))
    spans = spans.union(copied.select("u", F.lit(0).cast("long"), F.col("words"), *plain))
    order = Window.partitionBy("u").orderBy("s", "e")
    spans = spans.withColumn("top", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("g", F.sum(F.when(F.col("s") < F.col("top"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # Of the windows of a region that meet another text at one shift, one is enough.
    runs = stored(spans.groupBy("u", "g", "hu", (F.col("s") - F.col("hp")).alias("shift"))
                  .agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min("hp").alias("hp")), "passage-runs")
    regions = stored(runs.groupBy("u", "g").agg(F.min("s").alias("s"), F.max("e").alias("e")).withColumn("node", F.struct("u", "g")), "passage-regions")
    side = lambda k: regions.select(F.col("u").alias(f"u{k}"), F.col("s").alias(f"s{k}"), F.col("e").alias(f"e{k}"), F.col("node").alias(k))
    to = runs.where("hu is not null and hu <> u").join(side("b"), (F.col("hu") == F.col("ub")) & (F.col("hp") >= F.col("sb")) & (F.col("hp") < F.col("eb")))
    edges = to.select(F.struct("u", "g").alias("a"), "b")
    pairs = alike.select("ua", "sa", "ub", "sb")
    for k in "ab":
        pairs = pairs.join(side(k).select(F.col(f"u{k}").alias("_u"), F.col(f"s{k}").alias("_s"), F.col(f"e{k}").alias("_e"), k),
                           (F.col(f"u{k}") == F.col("_u")) & (F.col(f"s{k}") >= F.col("_s")) & (F.col(f"s{k}") < F.col("_e"))).drop("_u", "_s", "_e")
    edges = edges.union(pairs.select("a", "b")).distinct()
    comp = components(stored(edges, "passage-edges")).withColumnRenamed("node", "_node")
    merged = regions.join(comp, F.col("node") == F.col("_node"), "left").select("u", "s", "e", F.coalesce("comp", "node").alias("comp"))
    merged = stored(merged.join(ids.select("u", "fp"), "u").drop("u"), "passage-merged")

    # From words to code points, for the texts that have passages.
    found = merged.groupBy("fp").agg(F.collect_list(F.struct("s", "e", "comp")).alias("at"))

    def place(batches):
        for t in batches:
            at = []
            for words, x in zip(t.column(1).to_pylist(), t.column(2).to_pylist()):
                w = [m.span() for m in _WORD.finditer(x)]
                at.append([{"s": w[y["s"]][0], "e": w[y["e"] - 1][1]} for y in words])
            yield pa.record_batch([t.column(0), t.column(1), pa.array(at, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))], names=["fp", "at", "chars"])

    placed = found.join(full.select("fp", "text"), "fp").select("fp", "at", "text").mapInArrow(
        place, "fp binary, at array<struct<s:long,e:long,comp:struct<u:long,g:long>>>, chars array<struct<s:long,e:long>>")
    placed = placed.select("fp", F.explode(F.arrays_zip("at", "chars")).alias("z")).select("fp", F.col("z.at.comp").alias("comp"), F.col("z.chars.s").alias("start"), F.col("z.chars.e").alias("end"))
    out = stored(rows.join(placed, "fp").select("doc_id", "start", "end", "comp"), "passage-rows")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("start"))
    first = out.groupBy("comp").agg(F.min(rank).alias("first"), F.count("*").alias("members"))
    out = out.join(first, "comp").withColumn("keep", rank == F.col("first"))
    return out.select("doc_id", "start", "end", F.concat_ws(":", F.col("first.doc_id").cast("string"), F.col("first.start").cast("string")).alias("cluster"),
                      "members", "keep")
