"""Personal data: base patterns, and candidates chosen by boosted trees.

Spans are half-open, in code points.  Base spans (leftmost, non-overlapping
per kind; failing matches are dropped without a retry): email, ip (parts at
most 255), card (13 to 19 digits that pass Luhn), phone (+, 9 to 15 digits).

High-recall generators propose overlapping candidates: written-out and
bracketed addresses, defanged dotted numbers, numbers with any separators, local
phone shapes, social security and bank account numbers.  A candidate's features
are its generator, its shape and its context.  Its label is the outcome of a
rule about what the features do not hold: a known ending, octets in range, the
Luhn check, a numbering plan, number areas in use, the remainder modulo 97.
Boosted trees of depth 2 learn from all candidates of the corpus which shapes
in which contexts pass their rule.  As a rule passes some random strings too
(``CHANCE``), a fold of the texts calibrates each generator's margins to
(p - chance) / (1 - chance); candidates of a margin where this reaches
``precision``, on evidence that chance would give with at most 5 in 100, are
added when they overlap no base span.  So a shape whose members pass like random
strings is left alone, also where one of them passes.

Everything is DataFrame expressions.  A tree level is one aggregate of
gradients by (node, feature, value) over the distinct feature vectors; scoring
is one expression.  The driver gets these sums, whose number is that of the
features' values.  Starts of matches are running sums over slices of ``SLICE``
matches and then over the slices; a candidate meets the base spans of its text
in windows over both.  Neither takes a substring from a text's start.

Edge cases: a null text counts as empty, without spans; repeated rows and ids
stay row by row; without enough evidence nothing is added; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

KINDS = ["email", "ip", "card", "phone"]

# Possessive forms of the base patterns, which match the same spans in linear
# time: a match can start only where a run of its first class starts, or where
# the last match ended.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9]){12,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP_OK = rf"^(?:{_PART}\.){{3}}{_PART}$"

_AT = r"(?:@| ?(?:\[at\]|\(at\)|\[@\]) ?)"
_DOT = r"(?:\.| ?(?:\[dot\]|\(dot\)|\[\.\]) ?)"
# Candidate generators: name, pattern, and a cheap test that a text may match.
GENERATORS = [
    ("cand_email", rf"(?i)(?<![a-z0-9._%+-])(?:[a-z0-9._%+-]++{_AT}[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)++|[a-z0-9._%+-]++ at [a-z0-9-]++(?: dot [a-z0-9-]++)++)", r"(?i)@|[\[(]at[\])]| dot "),
    ("cand_dotted", rf"(?i)(?<![0-9.])[0-9]{{1,5}}+(?:(?:{_DOT}| dot )[0-9]{{1,5}}+){{2,7}}+(?![0-9])", r"(?i)[0-9](?:\.| ?[\[(]| dot )"),
    ("cand_number", r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){12,18}+(?![0-9])", r"[0-9][ ./_-]{0,2}[0-9]"),
    ("cand_phone", r"(?<![0-9])\+?(?:[0-9]{1,3}[ .-])?(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])", r"[0-9]{3}"),
    ("cand_ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-"),
    ("cand_iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])", r"[A-Z]{2}[0-9]{2}"),
]
# Share of random strings of a generator's shape that pass its rule.
CHANCE = [0.05, 0.05, 0.1, 0.64, 0.89, 0.01]
# Endings of mail addresses that count as known.
ENDINGS = ["com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "ai", "app", "dev", "eu", "us", "uk", "ca", "au", "de", "fr", "es", "it", "nl", "be",
           "ch", "at", "pt", "pl", "se", "no", "dk", "fi", "ie", "ru", "br", "mx", "ar", "in", "cn", "jp", "kr", "nz", "za"]
# Words near a candidate, by theme.
CONTEXT = [r"tel|phone|call|fax|mobil|cell|contact", r"mail|write|address|reach", r"card|visa|master|pay|account|bank|iban",
           r"host|server|ip\b|login|from", r"version|licen|section|chapter|isbn|order|invoice|page|no\."]

_SPAN = "array<struct<s:long,e:long,m:string,b:string,a:string>>"
SLICE = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def matches(text: Column, pattern: str, may: Column) -> Column:
    """All matches of ``pattern`` as structs (s, e, m, b, a): b are up to 24 code
    points between the match before and this one, a is the one after it ('' if
    another match follows at once)."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, z: Column) -> Column:
        s = (acc.at + F.length(z["p"])).cast("long")
        one = F.struct(s.alias("s"), (s + F.length(z["m"])).cast("long").alias("e"), z["m"].alias("m"),
                       F.right(z["p"], F.lit(24)).alias("b"), F.left(z["n"], F.lit(1)).alias("a"))
        return F.struct((s + F.coalesce(F.length(z["m"]), F.lit(0))).cast("long").alias("at"),
                        F.when(z["m"].isNull(), acc.out).otherwise(F.concat(acc.out, F.array(one))).alias("out"))

    def joined(parts: Column) -> Column:
        first = F.array(F.lit(0).cast("long"))
        starts = F.aggregate(parts, first, lambda acc, q: F.concat(acc, F.array(F.element_at(acc, -1) + q.at)))
        moved = lambda q, d: F.struct((q.s + d).alias("s"), (q.e + d).alias("e"), q.m.alias("m"), q.b.alias("b"), q.a.alias("a"))
        return _let(starts, lambda at: F.flatten(F.transform(parts, lambda q, i: F.transform(q.out, lambda x: moved(x, at[i])))))

    def sliced(z: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / SLICE).cast("int")),
                           lambda k: F.aggregate(F.slice(z, k * SLICE + 1, F.lit(SLICE)), zero, step))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = _let(found, lambda f: _let(F.split(text, pattern, -1), lambda p: F.transform(
        p, lambda x, i: F.struct(x.alias("p"), F.get(f, i).alias("m"), F.get(p, i + 1).alias("n")))))
    all_ = _let(zipped, lambda z: _let(sliced(z), joined))
    return F.when(may, all_).otherwise(F.array().cast(_SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of ``m`` pass the Luhn check."""
    d = F.reverse(_digits(m))
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    digit = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    add = lambda a, i: a + F.when(i % 2 == 1, digit(i)).otherwise(F.element_at(doubled, digit(i) + 1))
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind."""
    n = lambda p: F.length(_digits(p.m))
    return {
        "email": matches(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(matches(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda p: p.m.rlike(_IP_OK)),
        "card": F.filter(F.filter(matches(text, CARD, text.rlike("[0-9][ -]?[0-9]")), lambda p: n(p).between(13, 19)), lambda p: luhn(p.m)),
        "phone": F.filter(matches(text, PHONE, F.contains(text, F.lit("+"))), lambda p: n(p).between(9, 15)),
    }


N_FEATURES = 10


def passes(g: int, m: Column) -> Column:
    """Whether a match of generator ``g`` passes the rule of its kind."""
    d = _digits(m)
    if g == 0:
        last = F.lower(F.regexp_extract(m, "([A-Za-z0-9-]+)$", 1))
        return last.isin(ENDINGS) & m.rlike("^[^@\\[( ]*[A-Za-z]")
    if g == 1:
        return F.regexp_replace(m, "[^0-9]+", ".").rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$")
    if g == 2:
        return luhn(m)
    if g == 3:
        return F.when(F.startswith(m, F.lit("+")), d.rlike("^[1-9][0-9]{8,14}$")).otherwise(d.rlike("^(?:1?[2-9][0-9]{2}[2-9][0-9]{6}|0[1-9][0-9]{7,9})$"))
    if g == 4:
        return m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    bare = F.replace(m, F.lit(" "), F.lit(""))
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.left(bare, F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise((r * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)) == 1


def candidates(text: Column) -> Column:
    """All generators' spans with features and label, array of struct(g, s, e, f, y)."""
    def featured(g: int, p: Column) -> Column:
        before, prev = F.lower(p.b), F.right(p.b, F.lit(1))
        kind = lambda c: F.when(c == "", 0).when(c == " ", 1).when(c == "\n", 2).when(c.rlike("[A-Za-z0-9]"), 3).when(c.rlike("[.,;:!?]"), 4).otherwise(5)
        topic = F.coalesce(*[F.when(before.rlike(w), F.lit(i + 1)) for i, w in enumerate(CONTEXT)], F.lit(0))
        nd = F.length(_digits(p.m))
        marks = F.length(F.regexp_replace(p.m, r"[^ .()-]", ""))
        runs = F.regexp_extract_all(p.m, F.lit("[0-9]+"), F.lit(0))
        longest = F.array_max(F.concat(F.array(F.lit(0)), F.transform(runs, lambda x: F.length(x))))
        signs = sum((F.when(p.m.rlike(x), 1 << i).otherwise(0) for i, x in enumerate([r"\(", r"\.", "-", " ", r"\+", r"[\[_/]"])), F.lit(0))
        feats = F.array(F.lit(g), F.least(nd, F.lit(24)), F.least(marks, F.lit(12)), F.least(F.size(runs), F.lit(8)), F.least(longest, F.lit(20)),
                        F.least(F.length(p.m) / 4, F.lit(20)).cast("int"), kind(prev), kind(p.a), topic, signs)
        return F.struct(F.lit(g).alias("g"), p.s.alias("s"), p.e.alias("e"), F.transform(feats, lambda x: x.cast("int")).alias("f"),
                        F.coalesce(passes(g, p.m), F.lit(False)).cast("int").alias("y"))

    of = lambda g: lambda p: featured(g, p)
    return F.concat(*[F.transform(matches(text, pat, text.rlike(hint)), of(g)) for g, (_, pat, hint) in enumerate(GENERATORS)])


def _margin(trees: list, f) -> Column:
    """Sum of the trees' leaves; ``f(i)`` is feature i."""
    out = F.lit(0.0)
    for (i, v), (left, right) in trees:
        side = lambda s: F.when(f(s[0]) <= s[1], s[2]).otherwise(s[3]) if s[0] is not None else F.lit(s[2])
        out = out + F.when(f(i) <= v, side(left)).otherwise(side(right))
    return out


def _split(rows: list, shrink: float = 1.0) -> tuple:
    """(gain, feature, value, left leaf, right leaf, node leaf) of the best cut,
    from (feature, value, gradient, weight) sums of one node."""
    best = (0.0, None, None, 0.0, 0.0)
    leaf = 0.0
    for i in range(N_FEATURES):
        own = sorted((v, g, h) for k, v, g, h in rows if k == i)
        g, h = np.array([x[1] for x in own]), np.array([x[2] for x in own])
        G, H = g.sum(), h.sum()
        leaf = G / (H + shrink)
        gl, hl = np.cumsum(g), np.cumsum(h)
        gain = gl ** 2 / (hl + shrink) + (G - gl) ** 2 / (H - hl + shrink) - G ** 2 / (H + shrink)
        if len(gain) > 1 and gain[:-1].max() > best[0] + 1e-9:
            j = int(gain[:-1].argmax())
            best = (float(gain[j]), i, own[j][0], float(gl[j] / (hl[j] + shrink)), float((G - gl[j]) / (H - hl[j] + shrink)))
    return *best, float(leaf)


def boost(cand: DataFrame, trees: int = 16, rate: float = 0.4) -> list:
    """Gradient boosting for ``label`` over (f array<int>, label, n) rows, on
    logistic loss.  Two aggregates a tree."""
    model: list = []
    f = lambda i: F.col("f")[i]
    rows = cand.groupBy("f", "label").agg(F.sum("n").alias("n"))
    rows = stored(rows, "pii-vectors")

    def sums(node: Column) -> dict:
        p = 1 / (1 + F.exp(-F.col("z")))
        x = rows.withColumn("z", _margin(model, f)).select(node.alias("node"), "f", (F.col("n") * (F.col("label") - p)).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
        got = x.select("node", "g", "h", F.posexplode("f").alias("i", "v")).groupBy("node", "i", "v").agg(F.sum("g"), F.sum("h")).collect()
        out: dict = {}
        for r in got:
            out.setdefault(r[0], []).append(tuple(r)[1:])
        return out

    for _ in range(trees):
        top = sums(F.lit(0)).get(0, [])
        gain, i, v, _, _, _ = _split(top) if top else (0, None, None, 0, 0, 0)
        if i is None:
            break
        nodes = sums((f(i) > v).cast("int"))
        leaves = []
        for k in (0, 1):
            g2, i2, v2, l2, r2, own = _split(nodes.get(k, []))
            leaves.append((i2, v2, rate * (l2 if i2 is not None else own), rate * r2))
        model.append(((i, v), tuple(leaves)))
    return model


def thresholds(cand: DataFrame, model: list, precision: float) -> dict[int, float]:
    """By generator, the least margin (in tenths) from which the calibrated
    probability is at least ``precision``; generators without one are left out."""
    from .quality import isotonic

    z = F.floor(_margin(model, lambda i: F.col("f")[i]) * 10).cast("long")
    sums: dict = {}
    for g, *row in cand.groupBy(F.col("f")[0].alias("g"), z.alias("z")).agg(F.sum("n"), F.sum(F.col("n") * F.col("label"))).collect():
        sums.setdefault(g, []).append(row)
    out = {}
    for g, rows in sums.items():
        x, n, pos = map(np.array, zip(*sorted(rows)))
        knots, p = isotonic(x, n, pos)
        evidence = np.array([n[x >= k].sum() for k in knots])
        need = max(10, math.log(0.05) / math.log(CHANCE[g]))
        good = knots[((p - CHANCE[g]) / (1 - CHANCE[g]) >= precision) & (evidence >= need)]
        if len(good):
            out[g] = float(good.min()) / 10
    return out


def fit(cand: DataFrame, precision: float = 0.9) -> tuple[list, dict[int, float]]:
    """Trees and thresholds from (cal, f, label, n) rows."""
    model = boost(cand.where("not cal"))
    return model, thresholds(cand.where("cal"), model, precision)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", precision: float = 0.9) -> DataFrame:
    """(doc_id, email, ip, card, phone, added) for each row of ``docs``: arrays
    of struct(s, e), and for ``added`` of struct(k, s, e), k a generator."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    src = docs.select(F.col(doc_id).alias("doc_id"), t.alias("t"), (F.crc32(t.cast("binary")) % 4 == 0).alias("cal"), F.monotonically_increasing_id().alias("row"))
    plain = lambda a: F.transform(a, lambda p: F.struct(p.s.alias("s"), p.e.alias("e")))
    some = F.col("t").rlike(r"(?i)[0-9@]|[\[(]at[\])]| dot ")
    none = F.array().cast("array<struct<s:long,e:long>>")
    spans = {k: F.when(some, plain(v)).otherwise(none) for k, v in base_spans(F.col("t")).items()}
    cand = F.when(some, candidates(F.col("t"))).otherwise(F.array().cast("array<struct<g:int,s:long,e:long,f:array<int>,y:int>>"))
    rows = stored(src.select("row", "doc_id", "cal", *[v.alias(k) for k, v in spans.items()], cand.alias("cand")), "pii-rows")
    each = rows.where(F.size("cand") > 0).select("row", "cal", F.explode("cand").alias("c")).select("row", "cal", "c.*")
    counts = stored(each.groupBy("cal", "f", F.col("y").alias("label")).agg(F.count("*").alias("n")), "pii-candidates")
    model, limits = fit(counts, precision)
    if not limits:
        return rows.select("doc_id", *KINDS, F.array().cast("array<struct<k:int,s:long,e:long>>").alias("added"))
    least = F.coalesce(*[F.when(F.col("g") == g, F.lit(v)) for g, v in limits.items()])
    good = each.where(F.floor(_margin(model, lambda i: F.col("f")[i]) * 10) / 10 >= least).select("row", "s", "e", F.col("g").alias("k"))
    base = rows.where(F.size("cand") > 0).select("row", F.explode(F.concat(*KINDS)).alias("b")).select("row", "b.s", "b.e", F.lit(-1).alias("k"))
    w = Window.partitionBy("row").orderBy("s", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("row").orderBy(F.desc("s"), F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_base = F.col("k") < 0
    clear = (good.unionByName(base).withColumn("until", F.max(F.when(is_base, F.col("e"))).over(w)).withColumn("next", F.min(F.when(is_base, F.col("s"))).over(back))
             .where("k >= 0 and coalesce(until, s) <= s and coalesce(next, e) >= e"))
    added = clear.groupBy("row").agg(F.array_sort(F.collect_set(F.struct(F.col("k").cast("int").alias("k"), "s", "e"))).alias("added"))
    return rows.join(added, "row", "left").select("doc_id", *KINDS, F.coalesce("added", F.array().cast("array<struct<k:int,s:long,e:long>>")).alias("added"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", precision: float = 0.9) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row."""
    found = scan(docs, doc_id, text, precision)
    line = lambda k, p: F.concat_ws(":", k, p.s.cast("string"), p.e.cast("string"))
    named = lambda k: lambda p: line(F.lit(k), p)
    base = F.concat(*[F.transform(k, named(k)) for k in KINDS])
    names = F.array(*[F.lit(g[0]) for g in GENERATORS])
    more = F.transform("added", lambda p: line(F.element_at(names, p.k + 1), p))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, more), ",").alias("spans"))
