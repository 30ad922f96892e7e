"""Cheapest repair of the turn structure of conversations.

A whole conversation is an optional system turn and then pairs of user and
assistant, or nothing.  Rows may be kept (cost 0), given the role user or
assistant (``REROLE``) or deleted (``DELETE``, required for blank and repeated
rows); turns without text may be inserted anywhere (``INSERT``); a truncated row
that stays adds ``TRUNCATED``.  Of the cheapest edits the audit that is least in
ASCII counts: the initials K, R, D and I in order.

Every row is a symbol of its role and fault.  Symbol sequences are compressed
by Re-Pair: the most frequent pair of neighbours becomes a rule, until no pair
is found twice.  A symbol stands for a transfer matrix between the four states
of the wanted form, with the least (cost, audit) from state to state; a rule's
matrix is the min-plus product of its two parts, computed once, bottom-up, for
all conversations of a batch.  Audits are ropes that share their parts.  In a
matrix insertions come before rows, never after the last one, so of two audits
of one cost none begins with the other, and the lesser stays the lesser
whatever follows.

Rows travel sorted by conversation.  A task holds one batch of symbols, a byte
a row, and edits stream past the rows; no conversation's texts are gathered.

Defined results: rows of one turn come in the order of role and text, null turns
first; null role and null text are one space, which is blank as a text and no
role to keep.  Null conversation ids form one conversation.  An empty table gives
no rows.  Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CHARS, dropped, table, written

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = ("user", "assistant")
#: Initials of roles that the wanted form knows; any other is symbol class 3.
INITIALS = "sua"
#: The symbol of a row that must be deleted.  Others are 2 * class + truncated.
GONE = 8
#: Symbols of conversations that share a grammar; a longer conversation is one.
BATCH = 1 << 15
#: Ropes up to this length are plain text.
PLAIN = 64

# States: nothing yet, after system, after user, after assistant.  The empty
# conversation and one that ends with assistant are whole.
STATES, START, WHOLE = range(4), 0, (0, 3)
#: (from, to): what is inserted on the way.
INSERTS = {(0, 0): "", (0, 2): "I", (0, 3): "II", (1, 1): "", (1, 2): "I", (1, 3): "II", (2, 2): "", (2, 3): "I", (3, 3): "", (3, 2): "I"}
#: (from, to) of a row whose role then has this initial.
TURNS = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)]}


def leaves(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        r = stack.pop()
        if isinstance(r, str):
            yield r
        else:
            stack += (r[2], r[1])


def text_of(rope) -> str:
    return rope if isinstance(rope, str) else "".join(leaves(rope))


def joined(a, b):
    """Rope of a and b; a tuple holds length and both parts."""
    n = (len(a) if isinstance(a, str) else a[0]) + (len(b) if isinstance(b, str) else b[0])
    return text_of(a) + text_of(b) if n <= PLAIN else (n, a, b)


def less(a, b) -> bool:
    """Whether rope a comes before rope b."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    one, two, x, y = leaves(a), leaves(b), "", ""
    while True:
        x, y = x or next(one, ""), y or next(two, "")
        n = min(len(x), len(y))
        if not n or x[:n] != y[:n]:
            return x[:n] < y[:n] if n else bool(y)
        x, y = x[n:], y[n:]


def better(a: tuple | None, b: tuple | None) -> tuple | None:
    """The lesser of two (cost, rope); None is no way at all."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def product(a: list, b: list) -> list:
    """Min-plus product of matrices of (cost, rope), by rows."""
    out = []
    for row in a:
        new = [None] * len(b)
        for k, x in enumerate(row):
            if x is not None:
                for j, y in enumerate(b[k]):
                    if y is not None and (new[j] is None or x[0] + y[0] <= new[j][0]):
                        new[j] = better(new[j], (x[0] + y[0], joined(x[1], y[1])))
        out.append(new)
    return out


@cache
def terminal(symbol: int) -> list:
    """The matrix of one row: insertions, then what is done to the row."""
    edits = [(k, k, DELETE, "D") for k in STATES]
    if symbol != GONE:
        kind, cut = divmod(symbol, 2)
        extra = TRUNCATED * cut
        if kind < len(INITIALS):
            edits += [(i, j, extra, "K") for i, j in TURNS[INITIALS[kind]]]
        edits += [(i, j, REROLE + extra, "R") for role in ROLES for i, j in TURNS[role[0]]]
    out = [[None] * len(STATES) for _ in STATES]
    for (i, k), put in INSERTS.items():
        for at, j, cost, letter in edits:
            if at == k:
                out[i][j] = better(out[i][j], (INSERT * len(put) + cost, put + letter))
    return out


def re_pair(sequences: list[bytes]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules (their symbols run on from GONE + 1) and the sequences in them.

    A round replaces the most frequent pair, and with it other pairs of at least
    half its count that can't overlap it or each other.
    """
    stop = -1
    flat = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64), stop) for s in sequences]) if sequences else np.zeros(0, np.int64)
    rules: list[tuple[int, int]] = []
    while len(flat) > 1:
        width = GONE + 1 + len(rules)
        a, b = flat[:-1], flat[1:]
        code = np.where((a != stop) & (b != stop), a * width + b, stop)
        # Of a run of one symbol every second pair counts.
        twin = np.nonzero((a == b) & (code != stop))[0]
        run = np.cumsum(np.append(True, np.diff(twin) > 1)) if len(twin) else twin
        code[twin[(np.arange(len(twin)) - np.searchsorted(run, run)) % 2 == 1]] = stop
        pair, count = np.unique(code[code != stop], return_counts=True)
        if not len(pair) or count.max() < 2:
            break
        first, last, chosen = set(), set(), []
        for k in np.argsort(-count, kind="stable"):
            if count[k] < max(2, count.max() / 2):
                break
            one, two = divmod(int(pair[k]), width)
            if one not in last and two not in first:
                chosen.append(int(pair[k]))
                first.add(one)
                last.add(two)
                rules.append((one, two))
        chosen, symbol = np.array(chosen), width + np.arange(len(chosen))
        sort = np.argsort(chosen)
        chosen, symbol = chosen[sort], symbol[sort]
        place = np.minimum(np.searchsorted(chosen, code), len(chosen) - 1)
        at = np.nonzero(chosen[place] == code)[0]
        flat[at] = symbol[place[at]]
        keep = np.ones(len(flat), bool)
        keep[at + 1] = False
        flat = flat[keep]
    ends = np.nonzero(flat == stop)[0]
    return rules, [flat[i:j] for i, j in zip(np.append(0, ends[:-1] + 1), ends, strict=True)] if len(ends) else []


def repairs(sequences: list[bytes]) -> list[tuple[int, str]]:
    """(cost, audit) of each sequence of symbols."""
    distinct = sorted(set(sequences))
    rules, compressed = re_pair(distinct)
    matrices = [terminal(k) for k in range(GONE + 1)]
    for a, b in rules:
        matrices.append(product(matrices[a], matrices[b]))
    out = {}
    for sequence, symbols in zip(distinct, compressed, strict=True):
        way = [[(0, "") if k == START else None for k in STATES]]
        parts = [matrices[k] for k in symbols.tolist()]
        while len(parts) > 16:  # halves at a time: ropes are compared for all they hold
            parts = [product(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        for matrix in parts:
            way = product(way, matrix)
        best = None
        for (i, j), put in INSERTS.items():
            if j in WHOLE and way[0][i] is not None:
                best = better(best, (way[0][i][0] + INSERT * len(put), joined(way[0][i][1], put)))
        out[sequence] = (best[0], text_of(best[1]))
    return [out[s] for s in sequences]


def classified(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, nth (from 1), turn, role, text, fault, illegal (with the row before)
    and symbol of every row."""
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    in_order = [F.asc_nulls_first("turn"), "role", "text"]
    rows = rows.repartition("conv_id").withColumn("again", F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn")) > 1)
    order = Window.partitionBy("conv_id").orderBy(*in_order)
    end, initial = F.rtrim("text", F.lit(WS_CHARS)), F.substring("role", 1, 1)
    cut = ~F.substring(end, -1, 1).isin(".", "!", "?")
    fault = F.when(end == "", "blank").when(F.col("again"), "duplicate").when(cut, "truncated").otherwise("")
    rows = rows.select("conv_id", "turn", "role", "text", fault.alias("fault"), initial.alias("initial"), F.row_number().over(order).alias("nth"), F.lag(initial).over(order).alias("before"))
    illegal = F.coalesce(~F.concat("before", "initial").isin("su", "ua", "au"), F.lit(False))
    kind = F.coalesce(*[F.when(F.col("initial") == c, k) for k, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(2 * kind + (F.col("fault") == "truncated").cast("int"))
    return rows.select("conv_id", "nth", "turn", "role", "text", "fault", illegal.alias("illegal"), symbol.cast("int").alias("symbol"))


def by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, cost and audit of every conversation of ``classified`` rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sequences, held, type_ = [], [], 0, None

        def out() -> pa.RecordBatch:
            got = repairs(list(map(bytes, sequences)))
            return pa.RecordBatch.from_arrays([pa.array(ids, type_), pa.array([c for c, _ in got], pa.int64()), pa.array([a for _, a in got], pa.string())], names=["conv_id", "cost", "audit"])

        for b in batches:
            type_ = b.schema.field(0).type
            for conv, symbol in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not ids or ids[-1] != conv:
                    if held >= BATCH:
                        yield out()
                        ids, sequences, held = [], [], 0
                    ids.append(conv)
                    sequences.append(bytearray())
                sequences[-1].append(symbol)
                held += 1
        if ids:
            yield out()

    return by_conversation(rows.select("conv_id", "symbol", "nth"), "nth").select("conv_id", "symbol").mapInArrow(run, f"conv_id {kind}, cost long, audit string")


def summaries(rows: DataFrame) -> DataFrame:
    """conv_id, gaps and the counts of faults of every conversation."""
    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    count = lambda c: F.count_if(c)
    faults = [count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    return rows.groupBy("conv_id").agg(F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), *faults, count(F.col("illegal")).alias("illegal"))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place (from 1), edit, role and text of the turns of the repaired
    conversations; found: ``audits`` of the rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    lead = found.select("conv_id", F.lit(0).alias("nth"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = lead.unionByName(rows.select("conv_id", "nth", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, tail, at, place, expect = None, "", 0, 0, 0, 0

        def put(letter: str, own: str, text: str) -> tuple:
            nonlocal place, expect
            place += 1
            role = own if letter == "K" else ROLES[expect]
            expect = {"u": 1, "a": 0}.get(role[:1], 0)
            return conv, place, letter, role, text

        for b in batches:
            out: list[tuple] = []
            for own, nth, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not nth:
                    conv, audit, tail, at, place, expect = own, text, len(text.rstrip("I")), 0, 0, 0
                else:
                    while audit[at] == "I":
                        out.append(put("I", "", ""))
                        at += 1
                    if audit[at] != "D":
                        out.append(put(audit[at], role, text))
                    at += 1
                    if at == tail:  # the last row; what follows it is inserted
                        out += [put("I", "", "") for _ in audit[tail:]]
            names = ["conv_id", "place", "edit", "role", "text"]
            types = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, types, strict=True)], names=names)

    return by_conversation(both, "nth").select("conv_id", "nth", "role", "text").mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of ``role:text`` of its turns, joined by newlines."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going, conv, sha, type_ = False, None, hashlib.sha256(), None
        for b in batches:
            ids, hashes, type_ = [], [], b.schema.field(0).type
            for own, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if going and own == conv:
                    sha.update(b"\n")
                elif going:
                    ids.append(conv)
                    hashes.append(sha.hexdigest())
                if not going or own != conv:
                    going, conv, sha = True, own, hashlib.sha256()
                sha.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, type_), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])
        if going:
            yield pa.RecordBatch.from_arrays([pa.array([conv], type_), pa.array([sha.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return by_conversation(turns, "place").select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): conv_id, gaps, blank, duplicate, truncated, illegal,
    cost and audit; and the turns as ``repaired`` gives them."""
    rows = written(classified(df, conv, turn, role, text), "classified-turns")
    found = written(audits(rows), "audits")
    whole = summaries(rows).join(found.withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own"))).drop("own")
    turns = repaired(rows, found)
    return whole, turns


def damaged(df: DataFrame) -> DataFrame:
    """Rows with the faults that op13 asks for, by the crc32 of their ids."""
    id_text = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    kind = F.crc32(id_text.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = df.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("kind"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("kind != 0").withColumn("copy", F.explode(times)).drop("kind", "copy")


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    whole, turns = repair(damaged(conversations))
    same = lambda name: F.col("conv_id").eqNullSafe(F.col(name))
    out = conversations.select("conv_id").distinct().join(whole.withColumnRenamed("conv_id", "_own"), same("_own"), "left").drop("_own")
    out = out.join(digests(turns).withColumnRenamed("conv_id", "_own"), same("_own"), "left").drop("_own")
    zeros: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def oracle() -> str:
    """The same row by row, with the four states as columns of a recursion."""
    far = 1_000_000
    state = lambda c, a, t: f"{{'c': {c}, 'a': {a}, 't': {t}}}"
    step = lambda s, cost, letter, turn: state(f"{s}.c + {cost}", f"{s}.a || '{letter}'", f"{s}.t || {turn}" if turn else f"{s}.t")
    put = lambda s, role: step(s, INSERT, "I", f"chr(10) || '{role}:'")
    both = lambda s: state(f"{s}.c + {2 * INSERT}", f"{s}.a || 'II'", f"{s}.t || chr(10) || 'user:' || chr(10) || 'assistant:'")
    least = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    drop = lambda s: step(s, DELETE, "D", "")
    keep = lambda s, kind: step(s, f"CASE WHEN initial = '{kind}' AND NOT gone THEN cut ELSE {far} END", "K", "chr(10) || role || ':' || text")
    change = lambda s, role: step(s, f"CASE WHEN gone THEN {far} ELSE {REROLE} + cut END", "R", f"chr(10) || '{role}:' || text")
    return f"""WITH RECURSIVE table_ AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (SELECT keyed.*, xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT)) % 20 AS kind FROM keyed, table_),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE kind <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nth, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ending, role[1:1] AS initial FROM damaged),
faults AS (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY nth) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM numbered),
turns AS MATERIALIZED (SELECT conv_id, nth, turn, role, text, initial, fault, illegal, fault IN ('blank', 'duplicate') AS gone, {TRUNCATED} * (fault = 'truncated')::INT AS cut FROM faults),
way AS (SELECT DISTINCT conv_id, 0::BIGINT AS nth, {state("0::BIGINT", "''", "''")} AS s0, {state(f"{far}::BIGINT", "''", "''")} AS s1, {state(f"{far}::BIGINT", "''", "''")} AS s2, {state(f"{far}::BIGINT", "''", "''")} AS s3 FROM conversations
  UNION ALL SELECT conv_id, nth, {drop("m0")}, {least(drop("m1"), keep("m0", "s"))}, {least(drop("m2"), *[f(m, r) for m in ("m0", "m1", "m3") for f, r in ((keep, "u"), (change, "user"))])}, {least(drop("m3"), keep("m2", "a"), change("m2", "assistant"))}
  FROM (SELECT t.*, s0 AS m0, s1 AS m1, {least("s2", put("s0", "user"), put("s1", "user"), put("s3", "user"))} AS m2, {least("s3", put("s2", "assistant"), both("s0"), both("s1"))} AS m3 FROM way JOIN turns t ON t.conv_id IS NOT DISTINCT FROM way.conv_id AND t.nth = way.nth + 1)),
final AS (SELECT conv_id, {least("s0", "s3", put("s2", "assistant"), both("s1"))} AS f FROM way QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY nth DESC) = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM turns GROUP BY conv_id)
SELECT final.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, f.c AS cost, f.a AS audit, sha256(f.t[2:]) AS repaired_sha256
FROM final LEFT JOIN counts ON final.conv_id IS NOT DISTINCT FROM counts.conv_id"""
