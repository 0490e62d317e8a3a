"""op8: what the boosted candidates add, against a plain scorer; linear time."""

import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import pii
from tests.llm.test_llm_ops import digits, docs, luhn, pii_by_force


def card(r, ok):
    while True:
        n = "4" + "".join(r.choice("0123456789") for _ in range(15))
        if luhn(n) == ok:
            return n


def iban(r):
    bban = "".join(r.choice("0123456789") for _ in range(18))
    check = 98 - int(f"{bban}131400") % 97      # DE -> 13 14
    return f"DE{check:02d}{bban}"


def planted():
    r, rows, want, clean = random.Random(5), [], {}, set()
    nanp = lambda: f"({r.randint(2, 9)}{r.randint(10, 99)}) {r.randint(2, 9)}{r.randint(10, 99)}-{r.randint(1000, 9999)}"
    any_ = lambda a, b: f"{r.randint(0, 999):03d}{a}{r.randint(0, 999):03d}{b}{r.randint(0, 9999):04d}"
    forms = {
        "cand_email": lambda i: f"ann{i} [at] mail{i % 9} [dot] example [dot] com",
        "cand_phone": lambda i: nanp(),
        "cand_number": lambda i: "/".join(re.findall("....", card(r, True))),
        "cand_ssn": lambda i: f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}",
        "cand_iban": lambda i: iban(r),
        "cand_dotted": lambda i: f"10[.]{i % 256}[.]{r.randint(0, 255)}[.]7",
    }
    for i in range(260):
        for j, (k, make) in enumerate(forms.items()):
            m = make(i)
            rows.append((i * 10 + j, f"said {m} to us {i}"))
            want[i * 10 + j] = f"{k}:5:{5 + len(m)}"
        rows.append((i * 10 + 7, f"write to ann.{i}@mail.example.com or +1 (555) 010-{1000 + i} please {i}"))
        rows.append((i * 10 + 8, f"part {any_('.', '.')} and {card(r, False)} of {i}"))
        clean.add(i * 10 + 8)
    return rows, want, clean


def test_planted_variants_are_added_and_random_strings_are_not(spark):
    rows, want, clean = planted()
    got = {g.doc_id: g for g in pii.report(docs(spark, rows)).collect()}
    text = dict(rows)
    missing = Counter(w.split(":")[0] for i, w in want.items() if w not in got[i].spans.split(","))
    assert not missing, missing
    assert not [got[i].spans for i in clean if "cand" in got[i].spans]
    for i, g in got.items():
        base = set(filter(None, pii_by_force(text[i]).split(",")))
        assert base <= set(g.spans.split(",")) or not base


def margin(trees, f):
    return sum((l[2] if l[0] is None or f[l[0]] <= l[1] else l[3]) for (i, v), s in trees for l in [s[0] if f[i] <= v else s[1]])


def test_added_spans_match_a_plain_scorer(spark):
    """Spans by re, the trees and thresholds in plain Python, overlap by force."""
    rows, _, _ = planted()
    rows += [(9000, "bob@x.com 4111-1111-1111-1111 bob [at] x [dot] com"), (9001, None), (9002, ""), (9003, "+1 (826) 555-4081 190.137.223.20")]
    src = docs(spark, rows)
    got = {r.doc_id: sorted((c.k, c.s, c.e) for c in r.added) for r in pii.scan(src).collect()}
    t = F.coalesce("text", F.lit(""))
    each = src.select("doc_id", (F.crc32(t.cast("binary")) % 4 == 0).alias("cal"), F.explode(pii.candidates(t)).alias("c")).select("doc_id", "cal", "c.*")
    model, limits = pii.fit(each.groupBy("cal", "f", F.col("y").alias("label")).agg(F.count("*").alias("n")))
    cand = each.collect()
    text = {i: x or "" for i, x in rows}
    spans = Counter((i, g, m.start(), m.end()) for i, x in text.items() for g, (_, p, _) in enumerate(pii.GENERATORS) for m in re.finditer(p, x))
    assert spans == Counter((c.doc_id, c.g, c.s, c.e) for c in cand)
    want = {i: [] for i in text}
    for c in cand:
        base = [tuple(map(int, b.split(":")[1:])) for b in pii_by_force(text[c.doc_id]).split(",") if b]
        at = int(margin(model, c.f) * 10 // 1) / 10
        if c.g in limits and at >= limits[c.g] and not any(s < c.e and c.s < e for s, e in base):
            want[c.doc_id].append((c.g, c.s, c.e))
    assert got == {i: sorted(set(v)) for i, v in want.items()} and any(want.values())


def test_rules(spark):
    ok = [(0, "a@b.com"), (0, "a [at] b [dot] org"), (1, "1[.]2[.]3[.]255"), (2, "4111 1111 1111 1111"), (3, "(212) 555-0100"), (3, "+49 30 1234567"), (4, "123-45-6789"), (5, "DE89 3704 0044 0532 0130 00"), (5, "GB82WEST12345698765432")]
    bad = [(0, "a@b.then"), (0, "1@2.com"), (1, "1.2.3.256"), (1, "1.2.3"), (2, "4111 1111 1111 1112"), (3, "(112) 555-0100"), (4, "000-45-6789"), (4, "900-45-6789"), (5, "DE89 3704 0044 0532 0130 01")]
    for g, m in ok + bad:
        assert spark.range(1).select(pii.passes(g, F.lit(m))).first()[0] is ((g, m) in ok), (g, m)
    assert digits("a1") == "1"


def test_many_matches_in_linear_time(spark):
    def seconds(n):
        x = " ".join(f"u{i}@ex{i % 7}.com" for i in range(n))
        at = time.time()
        r = pii.scan(docs(spark, [(1, x)])).select(F.size("email"), F.size("added"), F.col("email")[n - 1]).first()
        assert r[0] == n and r[1] == 0 and x[r[2].s:r[2].e] == f"u{n - 1}@ex{(n - 1) % 7}.com"
        return time.time() - at

    seconds(1000)
    assert seconds(100_000) < 60
