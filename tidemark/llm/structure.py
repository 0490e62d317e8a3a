"""Conversation structure repair by Four-Russians block tables.

Every conversation's rows, in order of turn, get a symbol (must go, or role and
truncated or not); the cheapest edits that give role initials ``(s?(ua)+)?`` are
found by the tables of ``fourrussians``, ties by the least letters.

The rows are sorted by range partitioning, so that a conversation with very
many rows lies in several *segments*, one for each partition it reaches.  For
such conversations each segment is first reduced to its function (vector after
-> vector before, and state -> state); one small row a segment then fixes the
vector at its right border and the state at its left.  After that every segment
is repaired by itself, its texts streamed behind its symbols (one byte a row).
The hash of a conversation's repaired text is by its nature made in order, in
one task, from chunks of text that are streamed.

Edge cases: null conversation ids form one conversation (and count as one space
in the key of the damage); null turns come first; rows of equal turn are
ordered by the MD5 of length of role, colon, role and text; a conversation whose
rows are all dropped has zeros and empty strings; an empty table gives no rows.
Columns other than the four are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fourrussians as fr
from .common import discard, stored

CHUNK = 1 << 20
_SPACE = r"[\x20\x09-\x0D]"
_ENDS = "[.!?]"


def damage(rows: DataFrame) -> DataFrame:
    """The damaged copy of (conv_id, turn, role, text) rows; a dropped row
    stays, with a null role and text."""
    t = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(t("conv_id"), F.lit(":"), t("turn")).cast("binary")) % 20
    role = F.when(kind == 4, "user").when(kind != 0, t("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(t("text"), ".!?", "")).when(kind != 0, t("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _facts(rows: DataFrame) -> DataFrame:
    """Rows with their identity and what the symbol needs of the row alone."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    return rows.select("conv_id", "turn", "role", "text", same.alias("same"), F.when(F.col("role").isNotNull(), role).alias("kind"),
                       (~F.col("text").rlike(f"[^{_SPACE[1:-1]}]")).alias("blank"),
                       (~F.col("text").rlike(f"{_ENDS}{_SPACE}*\\z")).alias("cut"))


def _sequenced(rows: DataFrame) -> DataFrame:
    """Rows in order, written once: ``pos`` ascends with (conversation, turn,
    identity), ``seg`` numbers the range partition."""
    order = ["conv_id", "turn", "same"]
    dealt = _facts(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.select("*", F.monotonically_increasing_id().alias("pos")).withColumn("seg", F.shiftright("pos", 33)), "structure-rows")


def _symbols(seq: DataFrame) -> DataFrame:
    """(conv_id, seg, pos, turn, kind, fault, sym) without texts; a dropped row
    has a null ``sym``."""
    cols = seq.select("conv_id", "seg", "pos", "turn", "same", "kind", "blank", "cut")
    again = (cols.where("kind is not null").groupBy("conv_id", "same").agg(F.min("pos").alias("_first"), F.count("*").alias("_n"))
             .where("_n > 1").select(F.col("conv_id").alias("_c"), F.col("same").alias("_s"), "_first"))
    x = cols.join(again, cols.conv_id.eqNullSafe(F.col("_c")) & (cols.same == F.col("_s")), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("pos") > F.col("_first"), 2).when(F.col("cut"), 3).otherwise(0)
    x = x.select("conv_id", "seg", "pos", F.col("turn").cast("long").alias("turn"), "kind", fault.alias("fault"))
    sym = F.when(F.col("kind").isNull(), None).when(F.col("fault").isin(1, 2), fr.GONE).otherwise(1 + F.col("kind") + F.when(F.col("fault") == 3, 4).otherwise(0))
    return x.withColumn("sym", sym)


def _at(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False)


def _borders(symbols: DataFrame, kind: str) -> DataFrame:
    """(conv_id, seg, vec, state, last) of every segment of the conversations
    that lie in several: the vector after it and the state before it."""
    spans = symbols.groupBy("conv_id").agg(F.min("seg").alias("_lo"), F.max("seg").alias("_hi")).where("_lo < _hi").select(F.col("conv_id").alias("_c"))
    parts = symbols.join(spans, symbols.conv_id.eqNullSafe(F.col("_c")), "left_semi").select("conv_id", "seg", "pos", F.coalesce("sym", F.lit(-1)).cast("byte").alias("sym"))

    def functions(batches):
        table, now, held = fr.tables(), None, []

        def done():
            first, states = table.function(np.concatenate(held))
            return pa.record_batch([pa.array([now[0]], kind_pa), pa.array([now[1]]), pa.array([np.column_stack([first, states]).astype(np.int16).tobytes()])],
                                   names=["conv_id", "seg", "f"])

        kind_pa = None
        for b in batches:
            kind_pa = b.schema.field(0).type
            seg, sym = _at(b.column(1)), _at(b.column(3))
            cut = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            for lo, hi in zip(cut, np.append(cut[1:], len(seg))):
                # rows of one segment may belong to two such conversations
                ids = b.column(0).slice(lo, hi - lo).to_pylist()
                begin = 0
                for i in range(1, len(ids) + 1):
                    if i == len(ids) or ids[i] != ids[begin]:
                        key, own = (ids[begin], int(seg[lo])), sym[lo + begin:lo + i]
                        if key != now:
                            if now is not None:
                                yield done()
                            now, held = key, []
                        held.append(own[own >= 0].astype(np.int64))
                        begin = i
        if now is not None:
            yield done()

    def chain(t: pa.Table) -> pa.Table:
        t = t.sort_by("seg")
        table = fr.tables()
        maps = [np.frombuffer(f, np.int16).reshape(len(table.vectors), 5) for f in t.column("f").to_pylist()]
        vec, state, v, q = [], [], 0, fr.START
        for m in reversed(maps):
            vec.append(v)
            v = int(m[v, 0])
        vec.reverse()
        for m, w in zip(maps, vec):
            state.append(q)
            q = int(m[w, 1 + q])
        return pa.table([t.column("conv_id"), t.column("seg"), pa.array(vec, pa.int32()), pa.array(state, pa.int32()), pa.array([False] * (len(vec) - 1) + [True])],
                        names=["conv_id", "seg", "vec", "state", "last"])

    got = (parts.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos")
           .mapInArrow(functions, f"conv_id {kind}, seg long, f binary"))
    # a group has one small row for each range partition that its conversation reaches
    return got.groupBy("conv_id").applyInArrow(chain, f"conv_id {kind}, seg long, vec int, state int, last boolean")


class _Segment:
    """One segment: its symbols come first, then its texts."""

    def __init__(self, key, vec=0, state=fr.START, last=True, whole=True):
        self.key, self.vec, self.state, self.last, self.whole = key, vec, state, last, whole
        self.syms, self.kinds, self.faults, self.turns = [], [], [], None
        self.edits, self.lines, self.size, self.sha, self.chunks = None, [], 0, hashlib.sha256(), 0

    def add(self, sym, kind, fault, turn, known):
        keep = sym >= 0
        self.syms.append(sym[keep]), self.kinds.append(kind[keep]), self.faults.append(fault[keep])
        t = turn[keep & known]
        if len(t):
            n, lo, hi = self.turns or (0, int(t[0]), None)
            self.turns = n + int((np.diff(t) != 0).sum()) + int(t[0] != hi), lo, int(t[-1])

    def solve(self):
        syms = np.concatenate(self.syms or [np.zeros(0, np.int64)]).astype(np.int64)
        self.edits, self.out, self.cost = fr.tables().trace(syms, self.vec, self.state)
        self.role, self.at = self.state, 0
        self.tail = fr.ending(self.out) if self.last else ""
        self.cost += fr.INSERT * len(self.tail)

    def put(self, line: str):
        data = line.encode()
        self.lines.append(data)
        self.size += len(data)

    def insert(self):
        self.role = fr.NEXT[self.role]
        self.put("user:" if self.role == fr.USER else "assistant:")

    def text(self, role, text):
        for letter in self.edits[self.at]:
            if letter == "I":
                self.insert()
            elif letter == "K":
                self.role = fr.SYSTEM if role[:1] == "s" else fr.NEXT[self.role]
                self.put(f"{role}:{text}")
            elif letter == "R":
                self.role = fr.NEXT[self.role]
                self.put(f"{'user' if self.role == fr.USER else 'assistant'}:{text}")
        self.at += 1

    def flush(self):
        """Lines so far, each after the first of all with a newline before it."""
        data = b"".join(b"\n" + x for x in self.lines)
        self.lines, self.size = [], 0
        return data

    def summary(self) -> dict:
        kinds = np.concatenate(self.kinds or [np.zeros(0, np.int64)])
        faults = np.concatenate(self.faults or [np.zeros(0, np.int64)])
        n, lo, hi = self.turns or (0, None, None)
        return {"conv_id": self.key[0], "seg": self.key[1], "k": 0, "n": n, "lo": lo, "hi": hi, "head": int(kinds[0]) if len(kinds) else None,
                "tail": int(kinds[-1]) if len(kinds) else None, "blank": int((faults == 1).sum()), "duplicate": int((faults == 2).sum()),
                "truncated": int((faults == 3).sum()), "illegal": _illegal(kinds), "cost": self.cost, "audit": "".join(self.edits) + self.tail}


def _illegal(kinds: np.ndarray) -> int:
    a, b = kinds[:-1], kinds[1:]
    return int((~(((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))).sum())


_NUMBERS = ["n", "lo", "hi", "head", "tail", "blank", "duplicate", "truncated", "illegal", "cost"]
_PIECE = "seg long, k long, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", audit string, chunk binary, sha string"


def _repair(batches):
    """Segments, sorted, to pieces: a summary (k = 0) with the hash of the whole
    text, or, of a conversation in several segments, chunks of it (k = 1, ...)."""
    now, rows, kind = None, [], None

    def emit(**row):
        rows.append(row)

    def drain():
        out = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("conv_id", kind), ("seg", pa.int64()), ("k", pa.int64())] + [(c, pa.int64()) for c in _NUMBERS]
                                                                + [("audit", pa.string()), ("chunk", pa.binary()), ("sha", pa.string())]))
        rows.clear()
        return out

    def spill(s):
        data = s.flush()
        if s.whole:
            s.sha.update(data if s.chunks else data[1:])
        elif data:
            emit(conv_id=s.key[0], seg=s.key[1], k=s.chunks + 1, chunk=data)
        s.chunks += bool(data)

    def done(s):
        if s.edits is None:
            s.solve()
        for _ in s.tail:
            s.insert()
        spill(s)
        emit(**s.summary(), sha=s.sha.hexdigest() if s.whole else None)

    for b in batches:
        kind = b.schema.field(0).type
        ids, segs, phase = b.column("conv_id").to_pylist(), _at(b.column("seg")), _at(b.column("phase"))
        num = {c: _at(b.column(c).fill_null(-1)).astype(np.int64) for c in ("sym", "kind", "fault")}
        turn, known = _at(b.column("turn").fill_null(0)), _at(b.column("turn").is_valid())
        role, text, lo = b.column("role"), b.column("text"), 0
        while lo < len(ids):
            key = ids[lo], int(segs[lo])
            if now is None or key != now.key:
                if now is not None:
                    done(now)
                now = _Segment(key)
            hi = lo + 1
            while hi < len(ids) and phase[hi] == phase[lo] and segs[hi] == segs[lo] and ids[hi] == ids[lo]:
                hi += 1
            if phase[lo] == 0:
                now = _Segment(key, b.column("vec")[lo].as_py(), b.column("state")[lo].as_py(), b.column("last")[lo].as_py(), False)
            elif phase[lo] == 1:
                now.add(num["sym"][lo:hi], num["kind"][lo:hi], num["fault"][lo:hi], turn[lo:hi], known[lo:hi])
            else:
                if now.edits is None:
                    now.solve()
                for i in range(lo, hi):
                    now.text(role[i].as_py(), text[i].as_py())
                    if now.size >= CHUNK:
                        spill(now)
            lo = hi
        if len(rows) >= 256:
            yield drain()
    if now is not None:
        done(now)
    if rows:
        yield drain()


def _merge(batches):
    """Pieces of conversations in several segments, sorted, to one row each;
    texts only pass through the hash."""
    now, rows, kind = None, [], None

    def row():
        s = now
        rows.append({k: s[k] for k in ("conv_id", "n", "lo", "hi", "blank", "duplicate", "truncated", "illegal", "cost")}
                    | {"audit": "".join(s["audit"]), "sha": s["sha"].hexdigest()})

    for b in batches:
        kind = b.schema.field(0).type
        for i in range(b.num_rows):
            x = {c: b.column(c)[i].as_py() for c in b.schema.names}
            if now is None or x["conv_id"] != now["conv_id"]:
                if now is not None:
                    row()
                now = {"conv_id": x["conv_id"], "audit": [], "sha": hashlib.sha256(), "any": False, "tail": None, "lo": None, "hi": None} \
                    | dict.fromkeys(("n", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
            if x["k"]:
                now["sha"].update(x["chunk"] if now["any"] else x["chunk"][1:])
                now["any"] = True
                continue
            for c in ("blank", "duplicate", "truncated", "illegal", "cost"):
                now[c] += x[c]
            if now["tail"] is not None and x["head"] is not None:
                now["illegal"] += _illegal(np.array([now["tail"], x["head"]]))
            now["tail"] = now["tail"] if x["tail"] is None else x["tail"]
            if x["n"]:
                now["n"] += x["n"] - (now["hi"] == x["lo"])
                now["lo"], now["hi"] = x["lo"] if now["lo"] is None else now["lo"], x["hi"]
            now["audit"].append(x["audit"])
    if now is not None:
        row()
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("conv_id", kind)] + [(c, pa.int64()) for c in _MERGED] + [("audit", pa.string()), ("sha", pa.string())]))


_MERGED = ["n", "lo", "hi", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of (conv_id, turn, role, text): faults,
    cheapest edits and the hash of the repaired text.  Rows with a null role
    and text only stand for their conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    seq = _sequenced(rows)
    symbols = stored(_symbols(seq), "structure-symbols")
    borders = stored(_borders(symbols, kind), "structure-borders")
    none = lambda t, c: F.lit(None).cast(t).alias(c)
    shape = {"pos": "long", "turn": "long", "kind": "int", "fault": "int", "sym": "int", "role": "string", "text": "string", "vec": "int", "state": "int", "last": "boolean"}
    part = lambda df, phase: df.select("conv_id", "seg", F.lit(phase).alias("phase"), *[F.col(c).cast(t).alias(c) if c in df.columns else none(t, c) for c, t in shape.items()])
    texts = seq.where("kind is not null").select("conv_id", "seg", "pos", "role", "text")
    stream = part(borders, 0).unionByName(part(symbols, 1)).unionByName(part(texts, 2))
    pieces = stored(stream.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "phase", "pos").mapInArrow(_repair, f"conv_id {kind}, {_PIECE}"), "structure-pieces")
    cols = ["conv_id", *_MERGED, "audit", "sha"]
    whole = pieces.where("sha is not null").select(*cols)
    split = (pieces.where("sha is null").repartition("conv_id").sortWithinPartitions("conv_id", "seg", "k")
             .mapInArrow(_merge, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _MERGED) + ", audit string, sha string"))
    discard(seq, symbols, borders)
    gaps: Column = F.when(F.col("n") > 0, F.col("hi") - F.col("lo") + 1 - F.col("n")).otherwise(F.lit(0)).cast("long")
    return whole.unionByName(split).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                           F.col("sha").alias("repaired_sha256"))


def report(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged copy of a table."""
    return repair(damage(conversations))


def crc32_sql(text: str) -> str:
    """DuckDB's CRC-32 of an ASCII string that isn't empty."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda s: unicode(s)::BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}), 4294967295)"


def oracle_sql() -> str:
    """The report in DuckDB: costs and audits as strings (nine digits, letters)
    carried row by row for the four states."""
    def then(state: str, cost: str, letter: str) -> str:
        return f"lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}'"

    def if_kept(initial: str, *states: str) -> str:
        return ", ".join(f"CASE WHEN NOT gone AND c0 = '{initial}' THEN {then(s, 'extra', 'K')} END" for s in states)

    def if_reroled(*states: str) -> str:
        return ", ".join(f"CASE WHEN NOT gone THEN {then(s, '1 + extra', 'R')} END" for s in states)

    space = r"\x20\x09-\x0D"
    return f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
copies AS (SELECT *, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE r END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS text FROM copies),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i, left(role, 1) AS c0 FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM numbered),
rows_ AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{space}]') THEN 1 WHEN nth > 1 THEN 2
                         WHEN NOT regexp_matches(text, '[.!?][{space}]*\\z') THEN 3 ELSE 0 END AS fault,
                 lag(c0) OVER (PARTITION BY conv_id ORDER BY i) || c0 AS pair FROM seen),
facts AS (SELECT *, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS extra FROM rows_),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY conv_id),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS p, NULL::VARCHAR AS s, '000000005I' AS u, '000000010II' AS a FROM counts
  UNION ALL
  SELECT conv_id, i, p, s, u, least(ga, {then("u", "5", "I")}) FROM (
    SELECT conv_id, i, p, s, ga, least(gu, {then("p", "5", "I")}, {then("s", "5", "I")}, {then("ga", "5", "I")}) AS u FROM (
      SELECT facts.conv_id, facts.i, {then("p", "2", "D")} AS p, least({then("s", "2", "D")}, {if_kept("s", "p")}) AS s,
             least({then("u", "2", "D")}, {if_kept("u", "p", "s", "a")}, {if_reroled("p", "s", "a")}) AS gu,
             least({then("a", "2", "D")}, {if_kept("a", "u")}, {if_reroled("u")}) AS ga
      FROM dp JOIN facts ON facts.conv_id IS NOT DISTINCT FROM dp.conv_id AND facts.i = dp.i + 1))),
best AS (SELECT dp.conv_id, least(p, a) AS best FROM dp JOIN counts ON counts.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = counts.n),
letters AS (SELECT conv_id, unnest(string_split(substr(best, 10), '')) AS letter, generate_subscripts(string_split(substr(best, 10), ''), 1) AS spot
            FROM best WHERE length(best) > 9),
placed AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o FROM letters
           WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
joined AS (SELECT placed.*, role, text, c0, max(CASE WHEN o = 1 AND letter = 'K' AND c0 = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY placed.conv_id) AS lead_
           FROM placed LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM placed.conv_id AND facts.i = placed.i),
fixed AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - lead_) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                                     || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS text
          FROM joined WHERE letter <> 'D' GROUP BY conv_id)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit,
       sha256(coalesce(fixed.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM every.conv_id
"""
