"""Operators 11 to 13 against brute force, with null, empty, long, tied and repeated
rows, empty tables and extra columns that bear the names of outputs."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import repair, setm, suffix_dedup

# Suffix order.


def marked(rows, least):
    """For each (id, text), ordered, the bytes that an earlier string covers."""
    seen, out = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - least + 1):
            w = data[i : i + least]
            if w in seen:
                gone[i : i + least] = True
            seen.add(w)
        out.append((data, gone))
    return out


def passages(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(40) for _ in range(4)]
    rows = [None, "", "short", "x" * 500, "ab" * 200, "x" * 99, "x" * 100, "\0" * 300, prose(900)]
    rows += [prose(r.randint(0, 30)) + r.choice(shared)[r.randint(0, 20) :] + prose(r.randint(0, 30)) for _ in range(60)]
    rows += [rows[20], rows[20], rows[8], rows[8] + "tail", "🙂" * 60, "🙂" * 60]
    return rows


@pytest.mark.parametrize(("least", "most"), [(100, 20_000), (40, 3), (7, 1)])
def test_repeats_equal_brute_force(spark, least, most):
    rows = list(enumerate(passages(least)))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(k, t, "a", 0, 0, 0) for k, t in rows], "doc_id long, text string, key string, row long, start long, marks long").repartition(3)
    want = dict(zip(sorted(k for k, _ in rows), marked(sorted(rows), least), strict=True))
    got = suffix_dedup.remove_repeats(df, least=least, most=most).collect()
    assert len(got) == len(rows)
    for r in got:
        data, gone = want[r["doc_id"]]
        assert r["n_bytes"] == len(data) and bytes(r["kept"]) == bytes(np.frombuffer(data, np.uint8)[~gone])
        covered = np.zeros(len(data), bool)
        for s in r["spans"]:
            covered[s["start"] : s["end"]] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        assert (covered == gone).all() and len(r["spans"]) == (edges == 1).sum()


def test_repeats_of_null_and_repeated_ids(spark):
    text = "".join(chr(97 + (k * k) % 23) for k in range(300))
    rows = [(None, text), (3, text), (3, text), (1, text[100:]), (None, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _, gone = marked([(0, text)], 100)[0]
    assert Counter((r["doc_id"], len(r["kept"])) for r in got) == Counter([(None, int((~gone).sum())), (3, 0), (3, 0), (1, 0), (None, 0)])
    named = suffix_dedup.remove_repeats(spark.createDataFrame([("b", text), ("a", text)], "name string, body string"), "name", "body").collect()
    assert {r["doc_id"]: bool(r["kept"]) for r in named} == {"a": True, "b": False}
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts_are_cut_into_overlapping_blocks(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    text = "".join(random.Random(3).choice("abc") for _ in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([text])], names=["row", "text"])
    starts = []
    for buf, ends, rows, offsets in suffix_dedup._blocks(iter([batch]), 100):
        _, first, last = suffix_dedup.runs(buf, ends, 100, 16)
        text_of = np.searchsorted(ends, first, side="right")
        base = offsets[text_of] - np.concatenate([[0], ends])[text_of]
        starts += [i + o for a, b, o in zip(first, last, base, strict=True) for i in range(a, b + 1)]
    assert sorted(starts) == list(range(4901))  # each window once


def test_common_prefixes_are_the_suffixes_own():
    r = random.Random(5)
    data = [bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 40))) for _ in range(30)]
    symbols = np.concatenate([np.append(np.frombuffer(d, np.uint8).astype(np.uint16) + 1, 0) for d in data]).astype(np.uint16)
    order = suffix_dedup.suffix_order(symbols, 12)
    got = suffix_dedup.common_prefixes(symbols, order, 12)
    suffix = []
    for i in order:
        end = i + int(np.nonzero(symbols[i:] == 0)[0][0])
        suffix.append(symbols[i:end].tolist())
    for k in range(1, len(order)):
        a, b = suffix[k - 1], suffix[k]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
        assert got[k] == (n if n < 12 else -1)


def test_common_prefixes_of_equal_strings():
    """Equal suffixes stand in one order at every length, whatever follows them."""
    r = random.Random(6)
    kinds = [bytes(r.choice(b"ab") for _ in range(n)) for n in (3, 9, 11, 30, 31)]
    data = [r.choice(kinds) for _ in range(400)]
    symbols = np.concatenate([np.append(np.frombuffer(d, np.uint8).astype(np.uint16) + 1, 0) for d in data]).astype(np.uint16)
    order = suffix_dedup.suffix_order(symbols, 20)
    got = suffix_dedup.common_prefixes(symbols, order, 20)
    ends = np.nonzero(symbols == 0)[0]
    suffix = [symbols[i : ends[np.searchsorted(ends, i)]].tolist() for i in order]
    for k in range(1, len(order)):
        n = next((j for j, (x, y) in enumerate(zip(suffix[k - 1], suffix[k])) if x != y), min(len(suffix[k - 1]), len(suffix[k])))  # noqa: B905
        assert got[k] == (n if n < 20 else -1)


@pytest.mark.parametrize("least", [2, 7, 40, 100])
def test_only_windows_whose_halves_repeat_are_put_in_order(least):
    r = random.Random(least)
    line = lambda n: bytes(r.choice(b"abcdefgh") for _ in range(n))
    shared = [line(2 * least) for _ in range(3)]
    data = [line(r.randint(least, 3 * least)) for _ in range(60)] + [line(least) + r.choice(shared)[r.randint(0, least) :] + line(least) for _ in range(8)]
    windows = [(k, i, d[i : i + least]) for k, d in enumerate(data) for i in range(len(d) - least + 1)]
    times = Counter(w for _, _, w in windows)
    string, first, last = suffix_dedup.promising(data, least)
    kept = {(k, i) for k, a, b in zip(string.tolist(), first.tolist(), last.tolist(), strict=True) for i in range(a, b + 1)}
    assert {(k, i) for k, i, w in windows if times[w] > 1} <= kept
    halves = Counter(h for d in data for h in {d[i : i + least // 2] for i in range(len(d))})
    if least >= 40:  # what is left has halves of the shared texts alone
        assert 0 < len(kept) < len(windows) / 4 and all(halves[data[k][i : i + least // 2]] > 1 for k, i in kept)
    alone = suffix_dedup.promising([bytes(range(256))], 100)
    assert [len(x) for x in alone] == [0, 0, 0] and [len(x) for x in suffix_dedup.repeats([], alone[0], alone[0], 100)] == [0, 0, 0]


# Phrases.


def mined(rows, least, longest, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                count[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[p[:k]], f[p[k:]], total[lang], score))
        out += [(lang, n, *r[3:]) for n, r in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "near"), [(1 << 20, setm.NEAR), (300, setm.NEAR), (300, 0)])
def test_phrases_equal_brute_force(spark, block, near):
    r = random.Random(block)
    words = "the quick The brown Été été fox\x0bjumps over, lazy. dog; a\tb é x  ".split(" ")
    rows = [(r.choice(["en", "de", None]), " ".join(r.choices(words, [9, 5, 3, 3, 2, 2, 1, 1, 1, 1, 1, 1, 1], k=r.randint(0, 60)))) for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, "...  "), ("xx", "once"), ("en", "loud " * 400)] + [("de", "eins zwei drei vier fünf sechs")] * 9
    df = spark.createDataFrame([(lang, t, 0, "n") for lang, t in rows], "lang string, text string, id long, word string").repartition(3)
    got = sorted(map(tuple, setm.collocations(df, least=8, longest=5, top=40, block=block, near=near).collect()))
    assert got == mined(rows, 8, 5, 40)


def test_phrases_of_nothing(spark):
    assert setm.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert setm.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).count() == 0


def test_scores_beyond_64_bits(spark):
    a, n, x, y = 10**14 + 7, 9 * 10**14 + 1, 2 * 10**14 + 3, 10**14 + 9
    level = spark.createDataFrame([("en", 1, a, ["p", "q"], [x, a], [y, a])], "lang string, id long, a long, words array<string>, first_n array<long>, last_n array<long>")
    row = setm.scored(level, 2, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert row["score"] == 1000 * a * n // (x * y)


# Conversations.

NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def cheapest(symbols):
    """(cost, audit) by uniform-cost search over edits, one after the other."""
    queue, best = [(0, "", 0, 0, 0)], None
    while queue:
        cost, audit, at, state, inserted = heapq.heappop(queue)
        if best and cost > best[0]:
            return best
        if at == len(symbols) and state in (0, 3):
            best = min(best or (cost, audit), (cost, audit))
        moves = [("I", 2, at, r, inserted + 1) for r in "ua" if inserted < 3]
        if at < len(symbols):
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state, 0))
            if symbols[at] != repair.GONE:
                kind, cut = divmod(symbols[at], 2)
                moves += [("K", cut, at + 1, "suax"[kind], 0)] + [("R", 2 + cut, at + 1, r, 0) for r in "ua"]
        for letter, price, to, role, n in moves:
            if (role, state) in NEXT:
                heapq.heappush(queue, (cost + price, audit + letter, to, NEXT[role, state], n))
    return best


def test_repairs_equal_search():
    r = random.Random(2)
    sequences = [bytes(r.choice(range(9)) for _ in range(r.randint(1, 7))) for _ in range(300)] + [bytes([2] * 7), bytes([8]), bytes([0]), bytes([2, 4, 2, 4])]
    assert repair.repairs(sequences) == [cheapest(s) for s in sequences]
    assert repair.repairs([]) == []


def test_grammar_gives_the_sequences_back():
    r = random.Random(4)
    sequences = sorted({bytes(r.choice(range(3)) for _ in range(r.randint(1, 30))) for _ in range(200)})
    rules, compressed = repair.re_pair(sequences)
    opened = lambda k: [k] if k <= repair.GONE else opened(rules[k - repair.GONE - 1][0]) + opened(rules[k - repair.GONE - 1][1])
    assert rules and [bytes(x for k in c.tolist() for x in opened(k)) for c in compressed] == sequences


def test_long_conversations_and_ropes():
    assert repair.repairs([bytes([2, 4] * 20000)]) == [(0, "K" * 40000)]
    one, two = repair.joined("K" * 60, "D" * 10), repair.joined("K" * 50, "K" * 11 + "D" * 9)
    assert isinstance(one, tuple) and repair.less(one, two) and not repair.less(two, one) and not repair.less(one, one)


def whole(audit_rows):
    """The row of a conversation from its rows in order, by the contract's words."""
    seen, faults, symbols = set(), [], []
    for _, role, text in audit_rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        symbols.append(repair.GONE if fault in ("blank", "duplicate") else 2 * ("sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3) + (fault == "truncated"))
    turns = [t for t, _, _ in audit_rows if t is not None]
    cost, audit = cheapest(symbols)
    out, k, expect = [], 0, 0
    for c in audit:
        role, text = ("", "") if c == "I" else audit_rows[k][1:]
        k += c != "I"
        if c != "D":
            role = role if c == "K" else ("user", "assistant")[expect]
            expect = int(role[:1] == "u")
            out.append(f"{role}:{text}")
    initials = [r[:1] for _, r, _ in audit_rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))  # noqa: B905
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_conversations_equal_brute_force(spark):
    r = random.Random(7)
    rows = []
    for conv in [None, *range(60)]:
        for turn in r.sample([None, *range(9)], r.randint(1, 7)):
            for _ in range(1 + (r.random() < 0.1)):
                rows.append((conv, turn, r.choice(["user", "assistant", "system", "User", "", None, "tool"]), r.choice(["Hi.", "Hi", "", " \n", "Yes!\t ", "no ", None, "é" * 3000 + "?"])))
    df = spark.createDataFrame([(*x, "f", 0) for x in rows], "conv_id long, turn long, role string, text string, fault string, nth long").repartition(3)
    conversations, turns = repair.repair(df)
    hashed = {x["conv_id"]: x["repaired_sha256"] for x in repair.digests(turns).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn, " " if role is None else role, " " if text is None else text))
    got = conversations.collect()
    assert len(got) == len(want)
    for x in got:
        own = sorted(want[x["conv_id"]], key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        mine = (*[x[c] for c in repair.COUNTS], x["audit"], hashed.get(x["conv_id"], hashlib.sha256(b"").hexdigest()))
        assert mine == whole(own)
    # The repaired turns have the wanted form and need no edit themselves, but for what was inserted.
    roles = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "role"))).alias("t")).collect()
    assert all(re.fullmatch("s?(ua)+", "".join(t["role"][:1] for t in x["t"])) for x in roles)


def test_conversations_of_nothing(spark):
    conversations, turns = repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert conversations.count() == 0 and turns.count() == 0 and repair.digests(turns).count() == 0


def test_damage_keeps_every_conversation(spark, tmp_path):
    import zlib

    rows = [(c, t, "user", "Hm. So?") for c in range(40) for t in range(2)] + [(None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {x["conv_id"]: x for x in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {*range(40), None}
    for c in range(40):
        kinds = [zlib.crc32(f"{c}:{t}".encode()) % 20 for t in range(2)]
        if kinds == [0, 0]:
            assert got[c]["audit"] == "" and got[c]["cost"] == 0 and got[c]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
        assert got[c]["blank"] == kinds.count(1)
