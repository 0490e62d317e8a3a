"""The operators against brute force on small tables, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (decontaminate, mixing, neardup, passages, pii, ppm, quality, secrets, tokencount, topk)
from tidemark.llm.common import table
from tidemark.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "ba ce di fo gu ka le mi no pu".split() for b in "ra se ti vo nu xa we zi".split()]


def words(seed, n):
    r = random.Random(seed)
    return [r.choice(WORDS) + r.choice(WORDS) for _ in range(n)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", None if t is None else len(t)) for i, t in rows], DOCS)


ODD = [(None, "one two three four five six"), (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "word"), (5, "word"), (6, "a" * 5000),
       (7, " ".join(words(1, 9000)))]


def shingles(t, k=5):
    w = t.lower().encode().split()
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def classes_by_force(rows, threshold=0.8):
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    sets = [shingles(t or "") for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            if both and both / (sum(sets[i].values()) + sum(sets[j].values()) - both) >= threshold:
                par[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_components(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 100)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_neardup_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    base = words(5, 200)
    for k in range(40):  # a group of variants of one text, some of them chains
        v = list(base)
        for m in range(k % 6):
            v[(k * 37 + m * 31) % 200] = f"x{k}{m}"
        rows.append((10_000 + k, " ".join(v)))
    want = classes_by_force(rows)
    ids = defaultdict(list)
    for (i, _), c in zip(rows, want):
        ids[c].append(i)
    got = {r.doc_id: (r.class_id, r.class_size) for r in neardup.classes(docs(spark, rows)).collect()}
    assert got == {i: (min(v), len(v)) for v in ids.values() for i in v}


def family(seed, n, length=200, edits=3):
    """Variants of one text: most pairs are a little under the threshold."""
    r, base = random.Random(seed), words(seed, length)
    out = []
    for k in range(n):
        v = list(base)
        for m, at in enumerate(r.sample(range(5, length - 5), edits)):
            v[at] = f"x{k}y{m}"
        out.append((k, " ".join(v)))
    return out


def linked_by_force(rows):
    ids = defaultdict(list)
    for (i, _), c in zip(rows, classes_by_force(rows)):
        ids[c].append(i)
    return {i: min(v) for v in ids.values() for i in v}


def test_neardup_verifies_all_likely_pairs_of_a_block(spark):
    rows = family(11, 300)
    assert {r.doc_id: r.class_id for r in neardup.classes(docs(spark, rows)).collect()} == linked_by_force(rows)


def test_neardup_meets_all_blocks_of_a_group(spark):
    rows = family(12, 120)
    texts = docs(spark, rows).select(F.md5("text").cast("binary").alias("fp"), "text")
    name = {hashlib.md5(t.encode()).hexdigest().encode(): i for i, t in rows}
    want = defaultdict(set)
    for i, c in linked_by_force(rows).items():
        want[c].add(i)
    want = {frozenset(v) for v in want.values() if len(v) > 1}
    for sizes in ({"block_rows": 16}, {"block_shingles": 4000}):
        got = defaultdict(set)
        for r in neardup.linked(texts, **sizes).collect():
            got[bytes(r.comp)].add(name[bytes(r.node)])
        assert {frozenset(v) for v in got.values()} == want


def test_neardup_edges(spark):
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.classes(docs(spark, ODD)).collect()), key=str)
    assert got == sorted([(None, None, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 3), (5, 4, 3), (5, 4, 3), (6, 6, 1), (7, 7, 1)], key=str)
    assert neardup.classes(docs(spark, ODD).where("false")).count() == 0
    kept = neardup.keep_one(docs(spark, ODD + [(5, "word  ")]).withColumn("fp", F.lit(1)).withColumn("comp", F.lit("x")))
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([None, 1, 2, 3, 4, 6, 7], key=str)


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    a, b = rng.uniform(0, 3, 300), rng.uniform(0, 3, 300)
    sig = neardup.dart_signatures(np.concatenate([h, h]), np.concatenate([a, b]), np.repeat([0, 1], 300), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_decontaminate_matches_brute_force(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    items = {r.item_id: set(shingles(r.text)) for r in b.collect()}
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    first = next(iter(items))
    rows += [(9001, " ".join(words(3, 4000)) + " " + b.where(f"item_id = {first}").first().text + " " + " ".join(words(4, 4000)))]
    want = {}
    for i, t in rows:
        own = set(shingles(t))
        for k, s in items.items():
            if len(s & own) / len(s) >= 0.8:
                want[i, k] = round(len(s & own) / len(s), 9)
    got = {(r.doc_id, r.item_id): round(r.containment, 9) for r in decontaminate.report(docs(spark, rows), b).collect()}
    assert got == want and (9001, first) in got
    left = {r.doc_id for r in decontaminate.clean(docs(spark, rows), b).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in want}


def test_decontaminate_edges(spark):
    b = spark.createDataFrame([(1, None), (2, ""), (3, "too short a text"), (None, "one two three four five six"), (4, "one two three four five six")], "item_id long, text string")
    got = decontaminate.report(docs(spark, ODD), b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(None, None), (None, 4)}
    assert decontaminate.report(docs(spark, ODD), b.where("item_id = 2")).count() == 0
    assert decontaminate.clean(docs(spark, ODD), b.where("false")).count() == len(ODD)


def test_passages_match_brute_force(spark):
    shared = words(11, 60)
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    rows += [(9000 + k, " ".join(words(20 + k, 40 + 7 * k) + shared[:52 + k % 8] + words(50 + k, 30))) for k in range(9)]
    rows += [(9100 + k, " ".join(words(90 + k, 40) + words(99, 45) + words(95 + k, 40))) for k in range(3)]  # 45 words: too short
    got = defaultdict(list)
    for r in passages.repeats(docs(spark, rows)).collect():
        got[r.doc_id].append((r.start, r.end))
    seen, at = defaultdict(set), {}
    for i, t in rows:
        w = [(m.span(), m.group().lower()) for m in re.finditer("[^ \t\n\x0b\f\r]+", t)]
        for k in range(len(w) - 49):
            key = tuple(x for _, x in w[k:k + 50])
            seen[key].add(i)
            at[i, k] = (key, w[k][0][0], w[k + 49][0][1])
    for (i, _), (key, s, e) in at.items():
        if len(seen[key]) > 1:
            assert any(a <= s and e <= b for a, b in got[i]), (i, s, e)
    assert all(got[9000 + k] for k in range(9)) and not any(got[9100 + k] for k in range(3))


def test_passages_edges_and_clusters(spark):
    p = " ".join(words(7, 70))
    rows = ODD + [(20, p), (20, p), (21, "x " + p), (None, p + " y"), (22, " ".join(words(8, 30) * 4))]
    got = passages.repeats(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.start, r.end, r.members, r.cluster) for r in got if r.doc_id) == [(20, 0, len(p), 4, "20:0")] * 2 + [(21, 0, 2 + len(p), 4, "20:0")]
    assert [r.keep for r in got if r.doc_id == 21] == [False] and all(r.keep for r in got if r.doc_id == 20)
    assert passages.repeats(docs(spark, rows).where("false")).count() == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(d):
    v = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 * (x > 9) for x in v) % 10 == 0


def pii_by_force(t):
    out = []
    for k, p, ok in [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
                     ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
                     ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
                     ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]:
        out += [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, t) if ok(m.group())]
    return ",".join(out)


def secrets_by_force(t):
    name = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c + "?" for c in w) for w in ("password", "passwd", "secret", "token", "api_key"))
    o = [(m.start(), 0, "assign", m.end()) for m in re.finditer(rf"""(?:{name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(1)) >= 6]
    o += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    o += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(o))


@pytest.mark.parametrize("module,force", [(pii, pii_by_force), (secrets, secrets_by_force)])
def test_spans_match_brute_force(spark, module, force):
    r = random.Random(3)
    bits = list("ab1290.@-+ ()%_é\n:=\"'") + ["AKIA", "token", "secret = ", "password", "0f9a3b", "4111 1111 1111 1111", "+1 (555) 010-9999", "1.2.3.4", "api_key", "a@b.co"]
    rows = ODD + [(100 + i, "".join(r.choice(bits) for _ in range(r.randint(0, 60)))) for i in range(500)]
    rows += [(9000, "a" * 50_000), (9001, "1." * 3000), (9002, "a@b" + ".c" * 3000), (9003, "😀 a@b.co 4111 1111 1111 1111 token: abcdefg"), (9004, "ſecret: abcdefgh")]
    got = module.report(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert Counter((g.doc_id, g.base_sha256) for g in got) == Counter((i, hashlib.sha256(force(t or "").encode()).hexdigest()) for i, t in rows)
    base = {i: force(t or "") for i, t in rows}
    assert all(set(filter(None, base[g.doc_id].split(","))) <= set(g.spans.split(",")) for g in got if g.doc_id and g.doc_id != 5)
    assert module.report(docs(spark, rows).where("false")).count() == 0


def test_secrets_links_complementary_parts_only(spark):
    key = "aGVsbG8Xb29ybGQ5Zmdh1234"
    rows = [(1, f"x\nclient_id = abc123 {key} host=db.example.com\n\nlater {key}"), (2, f"alone {key}"), (3, "client_id = abc123 and no more"),
            (4, f"client_id = abc123\n\n{key}"), (5, f"client_id = abc123 {'w ' * 150}{key}"), (6, "user: someone token=abcdefgh")]
    got = {r.doc_id: r.spans for r in secrets.report(docs(spark, rows)).collect()}
    assert got[1].count("part_") == 3 and "part_key:73" not in got[1]
    assert got[2] == got[3] == got[4] == got[5] == ""
    assert "part_id" in got[6] and "assign" in got[6]
    text = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(docs(spark, rows)).collect()}
    assert text[2][0] == rows[1][1] and key not in text[1][0].split("later")[0] and text[6] == ("[SECRET] [SECRET]", 17)


def test_secrets_long_keys_and_gaps(spark):
    key, url = "aGVsbG8Xb29ybGQ5Zmdh1234", "https://db.example.com/?" + "q=1&" * 80
    rows = [(1, f"client_id=abc123 {'aB3' * 60}"), (2, f"client_id=abc123 {'aB' * 40}7"), (3, f"{url} {key}"),
            (4, f"client_id=abc123{' ' * 200}{key}"), (5, f"client_id=abc123{' ' * 201}{key}"), (6, f"{key}{' ' * 200}client_id=abc123")]
    got = {r.doc_id: r.spans for r in secrets.report(docs(spark, rows)).collect()}
    assert got[1] == "part_id:0:16,part_key:17:197" and got[2] == "part_id:0:16,part_key:17:98"
    assert got[3] == f"part_url:0:{len(url)},part_key:{len(url) + 1}:{len(url) + 1 + len(key)}"
    assert got[4] == "part_id:0:16,part_key:216:240" and got[5] == "" and got[6] == "part_key:0:24,part_id:224:240"


def test_pii_adds_what_stands_like_known_data(spark):
    rows = [(i, f"call +1 (555) 010-{1000 + i} now, or order number {i} of {i * 7919 % 10_000}") for i in range(400)]
    rows += [(1000 + i, f"call 1 (555) 010-{2000 + i} now") for i in range(3)]
    got = {r.doc_id: r for r in pii.report(docs(spark, rows)).collect()}
    assert all(got[i].n_phone == 1 for i in range(400)) and all(got[1000 + i].n_phone == 0 for i in range(3))
    assert all("cand" not in got[i].spans for i in range(400))


def test_quality_accuracy_and_edges(spark):
    sf = SF.replace("0.001", "0.01")
    lab = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    got = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    own = [(r.score, lab[r.doc_id]) for r in got if r.held_out and r.doc_id in lab]
    pos, neg = [s for s, y in own if y], [s for s, y in own if not y]
    assert sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) > 0.9
    odd = quality.classify(docs(spark, ODD), spark.createDataFrame([(None, 1), (4, None)], "doc_id long, quality int")).collect()
    assert len(odd) == len(ODD) and all(r.score == 0.5 and r.predicted == 1 for r in odd)
    few = quality.classify(docs(spark, ODD), spark.createDataFrame([(4, 1), (7, 0), (6, 1), (6, 0)], "doc_id long, quality int")).collect()
    assert len(few) == len(ODD) and all(0 <= r.score <= 1 for r in few)
    assert quality.classify(docs(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_isotonic():
    x, v = quality.isotonic(np.arange(4.0), np.array([2, 2, 2, 2]), np.array([1, 0, 2, 2]))
    assert (np.diff(v) >= 0).all() and x[0] == 0 and x[-1] == 3


def test_ppm_is_a_distribution_and_base_is_exact(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()] + ODD
    trie = ppm.train(docs(spark, rows).select("text").where("text is not null"))
    for ctx in (b"the q", b"\xfe\xfe\xfe\xfe\xfe", b"zzzzz", b"n of "):
        key = np.array([int.from_bytes(ctx + bytes([x]), "big") for x in range(256)], np.uint64)
        assert abs(np.exp(trie.log_p(key)).sum() - 1) < 1e-4
    got = ppm.score(docs(spark, rows), head_words=50).collect()
    import zlib
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    tok = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(w for i, t in rows if not held(i) for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(tok(t)), sum(c[w] > 0 for w in tok(t)), n, round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in tok(t)), 4)) for i, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    out = [r for r in got if r.held_out and (r.doc_id or 0) > 7]
    bits = -sum(r.score for r in out) / np.log10(2) / sum(len(t.encode()) + 1 for i, t in rows if held(i) and (i or 0) > 7)
    assert bits < 2.6  # per byte, from 170 training texts
    assert ppm.score(docs(spark, [])).count() == 0


def test_ppm_against_plain_python(spark):
    rows = [(1, "abracadabra abra"), (2, "Bananas and cadabra")]
    trie = ppm.train(docs(spark, rows).select("text"), order=2)
    counts = [defaultdict(Counter) for _ in range(3)]
    for _, t in rows:
        b = b"\xfe\xfe" + t.lower().encode() + b"\xff"
        for i in range(2, len(b)):
            for k in range(3):
                counts[k][b[i - k:i]][b[i]] += 1

    def p(ctx, x):
        out, gone = 1.0, set()
        for k in (2, 1, 0):
            c = counts[k].get(ctx[2 - k:])
            if not c:
                continue
            left = {y: n for y, n in c.items() if y not in gone}
            esc = float(trie._escape(k, np.array([float(sum(left.values()))]), np.array([float(len(left))]))[0])
            if x in left:
                return out * (1 - esc) * (2 * left[x] - 1) / sum(2 * n - 1 for n in left.values())
            out, gone = out * esc, gone | set(c)
        return out / (256 - len(gone))

    for ctx in (b"ab", b"\xfe\xfe", b"zz", b"za", b"an"):
        key = np.array([int.from_bytes(ctx + bytes([x]), "big") for x in range(256)], np.uint64)
        assert np.allclose(np.exp(trie.log_p(key)), [p(ctx, x) for x in range(256)], rtol=1e-5)


def test_ppm_capacity_prunes_contexts_not_their_counts(spark):
    d = table(spark, SF, "documents").select("text")
    full, small = ppm.train(d), ppm.train(d, max_nodes=20_000)
    assert len(np.flatnonzero(small.pairs[5].keys != ppm.EMPTY)) <= 20_000
    slot = small.nodes[5].find(small.nodes[5].keys[small.nodes[5].keys != ppm.EMPTY])
    same = full.nodes[5].find(small.nodes[5].keys[slot])
    assert (full.nodes[5].values["t"][same] == small.nodes[5].values["t"][slot]).all()
    for ctx in (b"the q", b"n of "):
        key = np.array([int.from_bytes(ctx + bytes([x]), "big") for x in range(256)], np.uint64)
        assert abs(np.exp(small.log_p(key)).sum() - 1) < 1e-4


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 12)) * rng.choice([0.1, 1, 5], size=(400, 1))
    v[50:60] = v[49]
    v[61] = 0
    rows = [(i, [float(x) for x in v[i]]) for i in range(400)]
    bad = [(20, None), (40, [1.0, None]), (60, [float("nan")] * 12), (80, [float("inf")] * 12), (None, [1.0] * 12), (100, [])]
    rows = [r for r in rows if r[0] not in {b[0] for b in bad}] + bad
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = {i: np.floor(64 * np.array(x)).astype(int) for i, x in rows if i is not None and x and all(y is not None and np.isfinite(y) for y in x)}
    want = []
    for q in sorted(ints):
        if q % 20 == 0:
            best = sorted((-int(ints[q] @ ints[c]), c) for c in ints if c != q)[:20]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    for sizes in ({}, {"block_rows": 32, "query_rows": 4, "seed_rows": 40}):
        got = sorted(tuple(r) for r in topk.topk(t, F.col("vec_id") % 20 == 0, **sizes).collect())
        assert got == want
    assert topk.topk(t.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.topk(t.where("vec_id in (120, 121)"), F.col("vec_id") % 20 == 0).count() == 1


def test_topk_both_prunings_agree():
    rng = np.random.default_rng(2)
    c = rng.integers(-60, 60, (500, 8))
    q = np.concatenate([c[:20], rng.integers(-60, 60, (20, 8))])
    qid, cid = np.arange(1000, 1040), np.arange(500)
    for theta in (-1e18, 0.0, 4000.0):
        th = np.full(40, theta)
        got = [{i: (a.tolist(), s.tolist()) for i, a, s in topk.block_topk(q, qid, th, c, cid, 10, coordinate_from=f)} for f in (-2.0, 0.3, 9.0)]
        assert got[0] == got[1] == got[2]


def test_tokens_match_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    r = random.Random(5)
    bits = ["the", " ", "  ", "\n", " \n ", "Don't", "naïve", "😀", "12,345", "<|endoftext|>", " ", "᠎", "_x=1;", "\t", "...", "word"]
    rows = ODD + [(100 + i, "".join(r.choice(bits) for _ in range(r.randint(0, 300)))) for i in range(150)]
    rows += [(900, "x" * 3000), (901, " ".join(words(1, 900))), (902, ("ab " * 700) + "y" * 2500 + " z" * 500)]
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    for chunk, overlap in ((32768, 1024), (256, 32), (64, 8)):
        got = Counter(tuple(x) for x in tokencount.count(docs(spark, rows), path, chunk=chunk, overlap=overlap).collect())
        assert got == want, (chunk, list((got - want).items())[:3], list((want - got).items())[:3])
    assert tokencount.report(docs(spark, []), path).count() == 0


def test_mix_edges(spark):
    d = spark.createDataFrame([(1, "a b c", None, "src1", 5), (2, None, "en", None, 0), (3, "x y", "en", "src1", 3), (3, "x y", "en", "src1", 3), (None, "q", "en", "src2", 1)], DOCS)
    got = mixing.production(spark, d, fraction=5.0).collect()
    assert Counter((r.doc_id, r.epoch) for r in got) == {(i, e): (2 if i == 3 else 1) for i in (1, 3, None) for e in (0, 1)}
    back = mixing.drawn(spark, d, fraction=5.0).collect()
    assert Counter((r.doc_id, r.epoch, r.text) for r in back) == Counter((r.doc_id, r.epoch, {1: "a b c", 3: "x y", None: "q"}[r.doc_id]) for r in got)
    assert mixing.production(spark, d.where("false")).count() == 0


def test_mix_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("A", "a1", 10), ("A", "a2", 100), ("B", "b1", 100)], "top string, leaf string, cap long").withColumn("total", F.col("cap"))
    got = {r.leaf: r.budget for r in mixing.budgets(leaves, ["top", "leaf"], {}, F.lit(120)).collect()}
    assert got == {"a1": 10, "a2": 50, "b1": 60}
    got = {r.leaf: r.budget for r in mixing.budgets(leaves, ["top", "leaf"], {}, F.lit(220)).collect()}
    assert got == {"a1": 10, "a2": 100, "b1": 100}
