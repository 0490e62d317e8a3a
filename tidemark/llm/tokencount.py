"""Token counts of whole texts, huge ones by overlap resynchronisation.

Texts of up to ``chunk`` characters are counted in one piece.  Longer ones are
cut into pieces of ``chunk`` characters plus an overlap, dealt over the
cluster and encoded with offsets.  Two neighbouring pieces are spliced at a
*stable* position of their overlap: a single space between two characters that
are not white space, where both encodings start a token.  The pre-tokenizer
splits before such a space whatever stands further left or right, and merges
never cross its splits, so the tokens on either side are those of the whole
text.  Texts with a pair of pieces that share no stable position (a long run
without such a space) are cut again with pieces and overlaps four times as
wide, until all pairs align or one piece holds the text.

The same fact lets pieces be counted by segments, cut before stable spaces:
the library encodes each distinct segment of a batch once, and a bounded cache
keeps counts of short segments.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); special strings
inside texts are handled as the library does by default; repeated texts and
ids stay row by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fingerprint, stored
from .textblocks import blocks

# White space, and characters that some libraries count as such.
_WS = "\\s\u180e\u200b\ufeff"
_RUN = re.compile(f"[{_WS}]{{2}}")
_STABLE = re.compile(f"(?<=[^{_WS}]) (?=[^{_WS}])")
CACHE = 200_000
SLICE = 4096
_tokenizers: dict = {}


def tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path), {}
    return _tokenizers[path]


def segments(text: str) -> list[str]:
    """The text cut at its stable spaces; each segment but the first has lost
    the space before it."""
    if not text or text[0].isspace() or text[-1].isspace() or _RUN.search(text):
        return _STABLE.split(text)
    return text.split(" ")


def count_texts(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text."""
    tok, cache = tokenizer(path)
    if len(cache) > CACHE:
        cache.clear()
    cut = [segments(t) for t in texts]
    new = {s for c in cut for s in c[1:]}.difference(cache)
    firsts = [c[0] for c in cut]
    def lengths(keys: list[str], before: str) -> list[int]:
        """Tokens of each key; the encodings of ``SLICE`` keys exist at a time."""
        out = []
        for i in range(0, len(keys), SLICE):
            out += map(len, tok.encode_batch_fast([before + k for k in keys[i:i + SLICE]], add_special_tokens=False))
        return out

    heads, keys = lengths(firsts, ""), list(new)
    own = dict(zip(keys, lengths(keys, " ")))
    cache.update((k, v) for k, v in own.items() if len(k) <= 32)
    get = lambda s: cache[s] if s in cache else own[s]
    return [h + sum(map(get, c[1:])) for h, c in zip(heads, cut)]


def splices(path: str, text: str, chunk: int, overlap: int) -> tuple[int, list, list]:
    """(tokens, head, tail) of a piece: head and tail list (position in the
    overlap, tokens before it) of the stable positions of either overlap."""
    tok, _ = tokenizer(path)
    e = tok.encode(text, add_special_tokens=False)
    starts = np.array([s for s, _ in e.offsets], np.int64)

    def at(lo: int, hi: int) -> list:
        out = []
        for m in _STABLE.finditer(text, lo, min(hi, len(text))):
            n = int(np.searchsorted(starts, m.start()))
            if n < len(starts) and starts[n] == m.start():
                out.append((m.start() - lo, n))
        return out

    return len(starts), at(0, overlap), at(chunk, chunk + overlap)


_MARK = "array<struct<p:int,n:int>>"
_MARK_PA = pa.list_(pa.struct([("p", pa.int32()), ("n", pa.int32())]))


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(fp, n_tokens) of (fp, text) rows; null where a pair of pieces shares no
    stable position."""
    last = F.greatest(F.ceil((F.length("text") - overlap) / chunk).cast("int") - 1, F.lit(0))
    pieces = texts.select("fp", "text", last.alias("last")).select("fp", "text", "last", F.explode(F.sequence(F.lit(0), "last")).alias("i"))
    pieces = pieces.select("fp", "i", "last", F.substr("text", F.col("i") * chunk + 1, F.lit(chunk + overlap)).alias("text"))
    dealt = pieces.repartition(F.col("fp"), F.col("i"))

    def run(batches):
        for b in batches:
            got = [splices(path, t.as_py(), chunk, overlap) for t in b.column(3)]
            n, head, tail = zip(*got) if got else ((), (), ())
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(head, _MARK_PA), pa.array(tail, _MARK_PA)],
                                  names=["fp", "i", "last", "n", "head", "tail"])

    done = stored(dealt.mapInArrow(run, f"fp binary, i int, last int, n long, head {_MARK}, tail {_MARK}"), "token-pieces")
    right = done.select(F.col("fp").alias("_fp"), (F.col("i") - 1).alias("_i"), F.col("head").alias("_head")).where("_i >= 0")
    pair = done.join(right, (F.col("fp") == F.col("_fp")) & (F.col("i") == F.col("_i")))
    # the first position that both pieces have
    both = F.expr("transform(filter(tail, t -> exists(_head, h -> h.p = t.p)), "
                  "t -> struct(t.n as left, element_at(filter(_head, h -> h.p = t.p), 1).n as right))")
    pair = pair.select("fp", "n", F.try_element_at(both, F.lit(1)).alias("s"))
    parts = done.select("fp", F.col("n").alias("d"), F.lit(0).alias("bad")).unionByName(
        pair.select("fp", F.coalesce(F.col("s.left") - F.col("n") - F.col("s.right"), F.lit(0)).alias("d"), F.col("s").isNull().cast("int").alias("bad")))
    return parts.groupBy("fp").agg(F.when(F.max("bad") == 0, F.sum("d")).cast("long").alias("n_tokens"))


def count(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", chunk: int = 32768, overlap: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    src = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"), F.octet_length(t).cast("long").alias("n_bytes"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, _, _ in blocks(b.column(1)):  # Python strings of about 2 MB of text at a time
                n = count_texts(path, b.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(n, pa.int64())],
                                      names=["doc_id", "n_bytes", "n_tokens"])

    whole = src.where(F.length("text") <= chunk + overlap).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    huge = src.where(F.length("text") > chunk + overlap).withColumn("fp", fingerprint(F.col("text")))
    todo = stored(huge.select("fp", "text").dropDuplicates(["fp"]), "token-huge")
    known = None
    while todo.limit(1).count():
        got = stored(_spliced(todo, path, chunk, overlap), "token-counts")
        good = got.where("n_tokens is not null")
        known = good if known is None else known.unionByName(good)
        chunk, overlap = chunk * 4, overlap * 4
        todo = stored(todo.join(got.where("n_tokens is null"), "fp", "left_semi"), "token-huge")
    if known is None:
        return whole
    return whole.unionByName(huge.select("doc_id", "n_bytes", "fp").join(known, "fp").select("doc_id", "n_bytes", "n_tokens"))


def report(docs: DataFrame, path: str, limit: int = 1024, **options) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``."""
    return count(docs, path, **options).withColumn("over_limit", F.col("n_tokens") > limit)
