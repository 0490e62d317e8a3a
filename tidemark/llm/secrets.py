"""Secret scans: pattern spans, and multipart credentials linked across parts.

Base spans (half-open, in code points; leftmost, non-overlapping per kind):

* ``assign``: a secret-like name, ``=`` or ``:``, and a value of 6 or more
  characters;
* ``access``: AKIA and capitals or digits, 20 or more characters;
* ``hex``: 24 or more lower-case hexadecimal digits.

Multipart linking adds spans.  Weak parts are identifiers (``client_id=``,
``user: ``, AKIA runs of 16-19 characters), keys (unlabelled runs of 20 or more
letters and digits of mixed kinds) and endpoints (URLs, ``host=``).  Alone they
mean little; a part is reported, as kind ``part_id``, ``part_key`` or
``part_url``, only if a complementary part lies within ``reach`` code points (from the end
of one to the start of the other) in the same scope, a scope being the text between two blank lines.  An identifier
or endpoint needs a key, or any base span, nearby; a key needs an identifier or
endpoint (an ``access`` span is an identifier).

The link is an interval join within (row, scope), done as a running maximum
over the parts' starts and ends: it emits no pairs.  Only rows that hold weak parts and a
possible complement are shuffled.

Edge cases: a null text counts as empty; an empty text has zero counts, the
SHA-256 of '' and ''; repeated rows and ids stay row by row; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fingerprint, stored

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
_ID_HINTS = ("id", "user", "account", "login")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a whole run: the same spans as [0-9a-f]+ of 24 or more
_ID = re.compile(r"(?:client_?id|user(?:name)?|account|access_?key_?id|login)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._+-]{3,})", re.I | re.A)
_URL = re.compile(r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]{4,}|(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{4,}", re.A)
_KEY = re.compile(r"[A-Za-z0-9+/_-]{20,}")  # whole runs; the kinds of characters are tested after
_KEY_KINDS = [re.compile(c) for c in ("[0-9]", "[a-z]", "[A-Z]")]
_BLANK = re.compile(r"\n[\x20\t\r]*\n")

KINDS = ["assign", "access", "hex", "part_id", "part_key", "part_url"]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base spans, by start and then kind."""
    out, low = [], text.lower()
    if any(k in low for k in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def weak_parts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of weak parts that overlap no base span."""
    out, low = [], text.lower()
    if "=" in text or ":" in text:
        if any(k in low for k in _ID_HINTS):
            out += [(m.start(), 3, m.end()) for m in _ID.finditer(text)]
        out += [(m.start(), 5, m.end()) for m in _URL.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), 3, m.end()) for m in _ACCESS.finditer(text) if 16 <= m.end() - m.start() < 20]
    out += [(m.start(), 4, m.end()) for m in _KEY.finditer(text) if all(c.search(m.group()) for c in _KEY_KINDS)]
    out.sort()
    free, i = [], 0
    for s, k, e in out:
        while i < len(base) and base[i][2] <= s:
            i += 1
        if i == len(base) or base[i][0] >= e:
            free.append((s, k, e))
    return free


_PART = pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64()), ("scope", pa.int64())])
_PART_SQL = "array<struct<s:long,k:int,e:long,scope:long>>"


def parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, weak): the base spans and weak parts of every whole text,
    with the number of the scope in which each starts."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        from bisect import bisect_right
        for b in batches:
            cols = [], []
            for t in b.column(1):
                t = t.as_py()
                base = base_spans(t)
                weak = weak_parts(t, base)
                ends = [m.end() for m in _BLANK.finditer(t)] if weak else []
                for c, v in zip(cols, (base, weak)):
                    c.append([(s, k, e, bisect_right(ends, s)) for s, k, e in v])
            yield pa.record_batch([b.column(0), *(pa.array(c, pa.list_(_PART)) for c in cols)], names=["doc_id", "base", "weak"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, base {_PART_SQL}, weak {_PART_SQL}")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = 200) -> DataFrame:
    """(doc_id, base, spans) for each row of ``docs``; both are arrays of
    struct(s, k, e), by start and then kind; ``k`` counts in ``KINDS``."""
    rows = stored(parts(docs, doc_id, text).withColumn("_row", F.monotonically_increasing_id()), "secret-parts")
    plain = lambda c: F.transform(c, lambda p: F.struct(p.s.alias("s"), p.k.alias("k"), p.e.alias("e")))
    rows = rows.select("doc_id", "_row", plain(F.col("base")).alias("spans"), "base", "weak",
                       ((F.size("weak") + F.size("base") >= 2) & (F.size("weak") > 0)).alias("link"))
    one = rows.where("link").select("_row", F.explode(F.concat("base", "weak")).alias("p")).select("_row", "p.*")
    # A part is at its start; what starts up to `reach` after its end and ends at most `reach` before its start is near.
    both = F.array(F.struct(F.col("s").alias("pos"), F.lit(0).alias("ask")), F.struct((F.col("e") + reach).alias("pos"), F.lit(1).alias("ask")))
    one = one.select("*", F.explode(both).alias("at")).select("_row", "scope", "s", "k", "e", "at.*")
    upto = Window.partitionBy("_row", "scope").orderBy("pos", "ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    has = lambda kinds: (F.max(F.when((F.col("ask") == 0) & F.col("k").isin(kinds), F.col("e"))).over(upto) >= F.col("s") - reach).cast("int")
    # a base span complements an identifier or endpoint whatever its kind
    one = one.withColumn("has_key", has([0, 1, 2, 4])).withColumn("has_other", has([1, 3, 5])).where("ask = 1")
    good = one.where("k >= 3 and ((k = 4 and has_other = 1) or (k <> 4 and has_key = 1))")
    added = good.groupBy("_row").agg(F.collect_list(F.struct("s", "k", "e")).alias("added"))
    linked = (rows.where("link").join(added, "_row", "left")
              .select("doc_id", F.col("spans").alias("base"),
                      F.array_sort(F.concat("spans", F.coalesce("added", F.array().cast("array<struct<s:long,k:int,e:long>>")))).alias("spans")))
    return linked.unionByName(rows.where("not link").select("doc_id", F.col("spans").alias("base"), "spans"))


def written(spans):
    """kind:start:end of each span, comma-joined, as a column."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.element_at(names, p.k + 1), p.s.cast("string"), p.e.cast("string"))), ",")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = 200) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row."""
    f = scan(docs, doc_id, text, reach)
    n = lambda k: F.size(F.filter("base", lambda p: p.k == k)).cast("long")
    return f.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                    F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", size: str | None = "n_chars", mark: str = "[SECRET]", reach: int = 200) -> DataFrame:
    """``docs`` with each span (or overlapping run of spans) of every text
    replaced by ``mark``; ``size``, if it is a column, is the length of changed
    texts.  Texts are joined to their spans by fingerprint; other rows pass."""
    own = fingerprint(F.col(text).cast("string"))
    found = scan(docs.select(own.alias("doc_id"), F.col(text).alias("text")), reach=reach).where(F.size("spans") > 0)
    found = stored(found.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("__fp"), F.col("spans").alias("__spans")))
    rows = docs.withColumn("__own", own).join(found, F.col("__own") == F.col("__fp"), "left")
    t = F.col(text).cast("string")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("pos"))
    step = lambda a, p: F.when(p.s >= a.pos, F.struct(F.concat(a.out, F.substr(t, a.pos + 1, p.s - a.pos), F.lit(mark)).alias("out"), p.e.alias("pos"))) \
        .otherwise(F.struct(a.out.alias("out"), F.greatest(a.pos, p.e).alias("pos")))
    clean = F.aggregate("__spans", zero, step, lambda a: F.concat(a.out, F.substr(t, a.pos + 1, F.length(t).cast("long"))))
    new = F.when(F.col("__spans").isNull(), t).otherwise(clean)
    cols = [new.alias(c) if c == text else
            F.when(F.col("__spans").isNull(), F.col(c)).otherwise(F.length(new)).cast(docs.schema[c].dataType).alias(c) if c == size else F.col(c)
            for c in docs.columns]
    return rows.select(*cols)
